"""DuckDB SQL for the queries of chapters, dictionaries and resolution, on the same tables."""

from __future__ import annotations

from . import sample_reports
from .reference_sql import _clean, _HEAD, _TAGGED, present, q, strip

_COUNTRIES = """VALUES ('australia', 'Australia'), ('belgium', 'Belgium'), ('canada', 'Canada'), ('china', 'China'), ('denmark', 'Denmark'), ('european commission', 'European Commission'), ('france', 'France'), ('germany', 'Germany'), ('india', 'India'),
  ('ireland', 'Ireland'), ('italy', 'Italy'), ('japan', 'Japan'), ('mexico', 'Mexico'), ('monaco', 'Monaco'), ('netherlands', 'Netherlands'), ('the netherlands', 'Netherlands'), ('new zealand', 'New Zealand'), ('nigeria', 'Nigeria'), ('norway', 'Norway'),
  ('portugal', 'Portugal'), ('republic of korea', 'Republic of Korea'), ('korea', 'Republic of Korea'), ('singapore', 'Singapore'), ('south africa', 'South Africa'), ('spain', 'Spain'), ('sweden', 'Sweden'), ('united kingdom', 'United Kingdom'), ('uk', 'United Kingdom'),
  ('united states', 'United States'), ('united states of america', 'United States'), ('usa', 'United States')"""
_MARK = r"'^(author|authors|author\s*\(s\)|authors\s*\(s\)|report prepared by|this report has been prepared|this report was prepared|overview|introduction|introductory note|ocean energy policy|national strategy|supporting policies)\s*:?($|[^\p{L}\p{N}_])'"
_AUTHOR = "'^(author|report prepared|this report)'"
_BACK = r"'^(appendix($|[^\p{L}])|appendices($|[^\p{L}])|membership of the executive committee|exco members|e x c o($|[^\p{L}])|executive committee members)'"


def _with_reports() -> str:
    """The documents and the sample reports, as ``whole``."""
    rows = ", ".join(f"({-i}, {q(t)})" for i, t in sample_reports.TEXTS)
    return f"whole AS (SELECT doc_id, text FROM documents UNION ALL SELECT * FROM (VALUES {rows}) v(doc_id, text))"


def _chapters() -> str:
    lines = _clean("whole")
    return rf"""{_with_reports()}, {lines},
    hd AS (SELECT doc_id, line_no, line, {_HEAD} AS h0, lower({_HEAD}) AS h FROM lines),
    co(k, c) AS ({_COUNTRIES}),
    nx AS (SELECT *, trim(concat_ws(' ', h, lead(h) OVER (PARTITION BY doc_id ORDER BY line_no))) AS w FROM hd),
    nm AS (SELECT n.doc_id, n.line_no, coalesce(a.c, b.c) AS country, CASE WHEN a.c IS NOT NULL THEN 1 ELSE 2 END AS skip FROM nx n LEFT JOIN co a ON n.h = a.k LEFT JOIN co b ON n.w = b.k WHERE a.c IS NOT NULL OR b.c IS NOT NULL),
    ca AS (SELECT m.doc_id, m.line_no, m.country, bool_or(regexp_matches(x.h, {_MARK})) AS mk, bool_or(regexp_matches(x.h, {_MARK}) AND regexp_matches(x.h, {_AUTHOR})) AS au,
        bool_or(x.line_no = m.line_no + m.skip AND x.h IN (SELECT k FROM co)) AS li, bool_or(contains(upper(x.line), 'TEST SITE NAME') AND x.line_no < m.line_no + m.skip + 3) AS ts
      FROM nm m JOIN hd x ON x.doc_id = m.doc_id AND x.line_no >= m.line_no + m.skip AND x.line_no < m.line_no + m.skip + 10 GROUP BY 1, 2, 3),
    cb AS (SELECT * FROM ca WHERE mk AND NOT li AND NOT ts),
    ci AS (SELECT * FROM cb a WHERE NOT EXISTS (SELECT 1 FROM cb b WHERE b.doc_id = a.doc_id AND b.country <> a.country AND abs(b.line_no - a.line_no) < 15)),
    nl AS (SELECT doc_id, max(line_no) + 1 AS n FROM lines GROUP BY 1),
    sp AS (SELECT i.*, n, coalesce(lead(line_no) OVER (PARTITION BY doc_id ORDER BY line_no), n) - line_no AS span FROM ci i JOIN nl USING (doc_id)),
    rk AS (SELECT *, row_number() OVER (PARTITION BY doc_id, country ORDER BY au DESC, span DESC, line_no) AS r FROM sp),
    st AS (SELECT doc_id, line_no AS s, country, coalesce(lead(line_no) OVER (PARTITION BY doc_id ORDER BY line_no), n) AS e0 FROM rk WHERE r = 1),
    bk AS (SELECT st.doc_id, s, country, least(e0, coalesce(min(x.line_no), e0)) AS e FROM st LEFT JOIN hd x ON x.doc_id = st.doc_id AND x.line_no > s AND x.line_no < e0 AND regexp_matches(x.h, {_BACK}) GROUP BY st.doc_id, s, country, e0),
    al AS (SELECT bk.*, (SELECT min(line_no) FROM hd x WHERE x.doc_id = bk.doc_id AND line_no > s AND line_no < e AND line_no <= s + 10 AND regexp_matches(h, '^(authors?|report prepared by)')) AS a FROM bk),
    an AS (SELECT al.*, (SELECT regexp_replace(h0, '(?i)^(authors?(\s*\(s\))?|report prepared by)\s*:?\s*', '') FROM hd x WHERE x.doc_id = al.doc_id AND x.line_no = a) AS own,
        coalesce((SELECT list(h0 ORDER BY line_no) FROM hd x WHERE x.doc_id = al.doc_id AND x.line_no BETWEEN a + 1 AND a + 3 AND NOT regexp_matches(h, {_MARK})), []) AS more FROM al),
    chapters AS (SELECT doc_id, s AS start, e AS "end", country, CASE WHEN a IS NULL THEN '' ELSE trim(array_to_string(CASE WHEN own <> '' THEN list_prepend(own, more[1:2]) ELSE more[1:3] END, '; '), '; ') END AS author FROM an)"""


def _sections() -> str:
    return f"""{_chapters()}, {_TAGGED},
    tg AS (SELECT k.*, coalesce((SELECT country FROM chapters c WHERE c.doc_id = k.doc_id AND k.line_no >= c.start AND k.line_no < c."end"), '') AS country FROM kinds k),
    tr AS (SELECT *, CASE WHEN country = lag(country) OVER (PARTITION BY doc_id ORDER BY line_no) THEN 0 ELSE 1 END AS turn FROM tg),
    rn AS (SELECT *, sum(turn) OVER (PARTITION BY doc_id ORDER BY line_no) AS run FROM tr),
    cy AS (SELECT *, last_value(CASE WHEN kind IS NOT NULL THEN {{'h': heading, 'k': kind}} END IGNORE NULLS) OVER w AS c, last_value(CASE WHEN kind IS NOT NULL AND kind <> 'test sites' THEN {{'k': kind}} END IGNORE NULLS) OVER w AS o
      FROM rn WINDOW w AS (PARTITION BY doc_id, run ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    sections AS (SELECT doc_id, line_no, line, country, kind IS NOT NULL AS is_heading, coalesce(c.h, '') AS section, CASE WHEN c.k = 'test sites' AND o.k IN ('demonstration', 'deployment', 'planned', 'R&D') THEN o.k ELSE c.k END AS section_kind FROM cy)"""


def _entries() -> str:
    kinds = "('demonstration', 'deployment', 'planned', 'R&D')"
    trim = lambda c: rf"regexp_replace({c}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"
    bullet = r"regexp_replace(line, '^[\s\p{Z}]*[•▪●►][\s\p{Z}]*', '')"
    return rf"""{_sections()},
    mo AS (SELECT *, max(coalesce(section_kind IN {kinds}, false)) OVER (PARTITION BY doc_id, country) AS ap, max(country <> '') OVER (PARTITION BY doc_id) AS ac FROM sections),
    wa AS (SELECT *, CASE WHEN country <> '' THEN NOT ap OR coalesce(section_kind IN {kinds}, false) ELSE NOT ac END AND NOT is_heading AS inn FROM mo),
    wb AS (SELECT *, CASE WHEN inn AND (NOT coalesce(lag(inn) OVER (PARTITION BY doc_id ORDER BY line_no), false) OR country <> lag(country) OVER (PARTITION BY doc_id ORDER BY line_no)) THEN 1 ELSE 0 END AS f FROM wa),
    bl AS (SELECT * FROM (SELECT *, sum(f) OVER (PARTITION BY doc_id ORDER BY line_no) AS block FROM wb) WHERE inn),
    ne AS (SELECT *, lag(line) OVER w AS pv, lead(line) OVER w AS nx, {trim('line')} AS s, string_split_regex({trim('line')}, '[\s\p{{Z}}]+') AS ws, coalesce(median(CASE WHEN length(line) > 20 THEN length(line) END) OVER (PARTITION BY doc_id, block), 60) AS typ
      FROM bl WINDOW w AS (PARTITION BY doc_id, block ORDER BY line_no)),
    ti AS (SELECT *, coalesce(s <> '' AND length(s) <= least(70, typ * 0.7) AND len(ws) <= 10 AND right(s, 1) NOT IN ('.', ',', ';', ':', '-') AND regexp_matches(s, '^[A-Z0-9"(]') AND NOT regexp_matches(s, '(?i)^(annual report|ocean energy systems|\d+)$')
        AND len(list_filter(ws, lambda w: regexp_matches(w, '^[A-Z0-9("]'))) / len(ws) >= 0.5 AND NOT regexp_matches(s, '(?i)^(©|\(c\)|(courtesy|photo|image|source|figure|table)($|[^\p{{L}}\p{{N}}_])|fig\.[\p{{L}}\p{{N}}_])') AND length({trim('nx')}) >= 25
        AND (pv IS NULL OR right(rtrim(pv), 1) IN ('.', '!', '?', ':', ')') OR length({trim('pv')}) < 40), false) AS title FROM ne),
    ke AS (SELECT *, lag(title) OVER (PARTITION BY doc_id, block ORDER BY line_no) AS pk FROM ti WHERE s NOT IN ('•', '', '-', '–', '▪', '●')),
    st2 AS (SELECT *, title OR pk IS NULL OR (NOT pk AND regexp_matches(line, '^[\s\p{{Z}}]*[•▪●►]')) OR (NOT pk AND coalesce(right(rtrim(pv), 1) IN ('.', '!', '?') AND length(pv) < 0.75 * typ AND regexp_matches(line, '^[\s\p{{Z}}]*[A-Z0-9"]'), false)) AS beg FROM ke),
    en AS (SELECT *, sum(beg::INT) OVER (PARTITION BY doc_id, block ORDER BY line_no) AS entry, {trim(bullet)} AS body FROM st2),
    en2 AS (SELECT doc_id, block, entry, max(CASE WHEN title THEN s END) AS title, min(CASE WHEN NOT title THEN line_no END) AS a, max(CASE WHEN NOT title THEN line_no END) AS b, list(body ORDER BY line_no) FILTER (NOT title) AS l,
        first(section ORDER BY line_no) AS section, first(nullif(section_kind, '') ORDER BY line_no) FILTER (nullif(section_kind, '') IS NOT NULL) AS section_kind, first(country ORDER BY line_no) AS country FROM en GROUP BY 1, 2, 3),
    entries AS (SELECT doc_id, block::BIGINT AS block, entry::BIGINT AS entry, coalesce(title, '') AS title, (a + 1 - CASE WHEN title IS NULL THEN 0 ELSE 1 END)::INT AS line_start, (b + 1)::INT AS line_end,
        list_reduce(l, lambda o, t: CASE WHEN ends_with(o, '-') AND regexp_matches(t, '^\p{{Ll}}') THEN o[1:-2] || t ELSE trim(o || ' ' || t) END) AS text, section, section_kind, country FROM en2 WHERE a IS NOT NULL)"""


_WS = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _guarded(text: str, a: str, n: str) -> str:
    return rf"NOT regexp_matches(substr({text}, {a}, CASE WHEN {a} > 0 THEN 1 ELSE 0 END), '[\p{{L}}\p{{M}}\p{{N}}_-]') AND NOT regexp_matches(substr({text}, {a} + {n} + 1, 1), '[\p{{L}}\p{{M}}\p{{N}}_-]')"


_FLAT = rf"""
    fl AS (SELECT doc_id, text, regexp_replace(text, '{_WS}+', ' ', 'g') AS t FROM documents WHERE text IS NOT NULL AND text <> ''),
    spots AS (SELECT doc_id, list_filter(range(0, length(text)), lambda i: i = 0 OR NOT (regexp_matches(substr(text, i + 1, 1), '{_WS}') AND regexp_matches(substr(text, i, 1), '{_WS}'))) AS p, length(text) AS n FROM fl)"""


def _found(terms: str) -> str:
    """All guarded matches of ``terms`` (``term``) in the squeezed texts: ``hits`` (``doc_id``, ``x``, ``term``)."""
    return rf"""
    tm AS (SELECT DISTINCT trim(regexp_replace(term, '{_WS}+', ' ', 'g')) AS term FROM {terms} WHERE trim(term) <> ''),
    pr AS (SELECT doc_id, t, term, string_split(t, term) AS s FROM fl JOIN tm ON contains(t, term)),
    ps AS (SELECT doc_id, t, term, unnest(list_transform(range(1, len(s)), lambda i: list_sum(list_transform(s[1:i], lambda y: length(y))) + (i - 1) * length(term)))::BIGINT AS x FROM pr),
    hits AS (SELECT doc_id, x, term FROM ps WHERE {_guarded('t', 'x', 'length(term)')})"""


_SITES = rf"""
    sn AS (SELECT site_id, {present('name')} AS name, coalesce({present('country')}, '') AS country, {present('aliases')} AS v FROM test_sites),
    sl AS (SELECT site_id, CASE WHEN v LIKE '["%"]' THEN from_json(v, '["VARCHAR"]') WHEN regexp_matches(regexp_replace(v, '"(?:[^"]|"")*"', '', 'g'), '[|;\n\t]') THEN regexp_extract_all(v, '\s*("(?:[^"]|"")*"\s*|[^|;\n\t]+)(?:[|;\n\t]|$)', 1)
        WHEN regexp_matches(regexp_replace(v, '"(?:[^"]|"")*"', '', 'g'), '\s/\s') THEN string_split_regex(v, '\s/\s') ELSE regexp_extract_all(v, '\s*("(?:[^"]|"")*"\s*|[^,]+)(?:[,]|$)', 1) END AS items FROM sn WHERE v IS NOT NULL),
    sv AS (SELECT site_id, unnest([{strip('x')} FOR x IN items IF {strip('x')} <> '']) AS v FROM sl),
    sa AS (SELECT site_id, CASE WHEN regexp_matches(v, '^"(?:[^"]|"")*"$') THEN {strip("replace(v[2:-2], chr(34) || chr(34), chr(34))")} ELSE v END AS alias FROM sv),
    aliases AS (SELECT DISTINCT site_id, country, term FROM (SELECT site_id, country, trim(regexp_replace(name, '{_WS}+', ' ', 'g')) AS term FROM sn WHERE name IS NOT NULL UNION ALL SELECT sn.site_id, sn.country, trim(regexp_replace(alias, '{_WS}+', ' ', 'g')) FROM sa JOIN sn USING (site_id) WHERE sn.name IS NOT NULL) WHERE term <> ''),
    owners AS (SELECT term, list_sort(list({{'site_id': site_id, 'country': country}})) AS o FROM aliases GROUP BY 1)"""

_CLAIMED = """
    cl AS (SELECT doc_id, list({'a': x, 'b': x + length(term), 't': term} ORDER BY -length(term), term, x) AS f FROM hits GROUP BY 1),
    g(doc_id, i, k) AS (SELECT doc_id, 0, []::STRUCT(a BIGINT, b BIGINT, t VARCHAR)[] FROM cl
      UNION ALL SELECT g.doc_id, i + 1, CASE WHEN len(list_filter(k, lambda y: f[i + 1].a < y.b AND f[i + 1].b > y.a)) > 0 THEN k ELSE list_append(k, f[i + 1]) END FROM g JOIN cl USING (doc_id) WHERE i < len(f)),
    cm AS (SELECT g.doc_id, unnest(k) AS m FROM g JOIN cl USING (doc_id) WHERE i = len(f)),
    mentions AS (SELECT cm.doc_id, p[m.a + 1] AS a, p[m.b] + 1 AS b, m.t AS term, coalesce(list_filter(o, lambda z: z.country = coalesce(d.reporting_country, ''))[1].site_id, o[1].site_id) AS site_id
      FROM cm JOIN spots USING (doc_id) JOIN owners ON owners.term = m.t JOIN documents d USING (doc_id))"""


def _mentions() -> str:
    return f"WITH RECURSIVE {_FLAT}, {_SITES}, {_found('aliases')}, {_CLAIMED}"


_TERMS = rf"""
    pt AS (SELECT upper({present('project_id')}) AS project_id, {present('search_terms')} AS st FROM projects),
    pu AS (SELECT project_id, trim(regexp_replace(unnest(string_split(st, '|')), '[\s\p{{Z}}]+', ' ', 'g')) AS raw FROM pt WHERE project_id IS NOT NULL AND st IS NOT NULL),
    pterms AS (SELECT project_id, trim(regexp_replace(raw, '^~+', '')) AS term, bool_or(starts_with(raw, '~')) AS weak FROM pu WHERE raw <> '' AND trim(regexp_replace(raw, '^~+', '')) <> '' GROUP BY 1, 2)"""


def _context(text: str, a: str, b: str, n: int = 160) -> str:
    left, right = f"substr({text}, greatest({a} - {n}, 0) + 1, least({a}, {n}))", f"substr({text}, {b} + 1, {n})"
    return rf"regexp_replace(regexp_replace({left}, '(?s)^.*\. ', '') || substr({text}, {a} + 1, {b} - {a}) || CASE WHEN instr({right}, '. ') > 0 THEN substr({right}, 1, instr({right}, '. ')) ELSE {right} END, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"


def _resolved() -> str:
    lm = """
    lf AS (SELECT doc_id, list({'a': x, 'b': x + length(term), 't': term} ORDER BY x, -length(term)) AS f FROM hits GROUP BY 1),
    g(doc_id, i, k, e) AS (SELECT doc_id, 0, []::STRUCT(a BIGINT, b BIGINT, t VARCHAR)[], 0::BIGINT FROM lf
      UNION ALL SELECT g.doc_id, i + 1, CASE WHEN f[i + 1].a >= e THEN list_append(k, f[i + 1]) ELSE k END, CASE WHEN f[i + 1].a >= e THEN f[i + 1].b ELSE e END FROM g JOIN lf USING (doc_id) WHERE i < len(f)),
    lk AS (SELECT g.doc_id, unnest(k) AS m FROM g JOIN lf USING (doc_id) WHERE i = len(f)),
    pm AS (SELECT lk.doc_id, p[m.a + 1] AS a, p[m.b] + 1 AS b, m.t AS term FROM lk JOIN spots USING (doc_id))"""
    guard = r"regexp_matches(right(y[j], 1), '[\p{L}\p{M}\p{N}_-]')"
    return rf"""WITH RECURSIVE {_FLAT}, {_SITES}, {_TERMS}, {_found('pterms')}, {lm},
    ow AS (SELECT term, count(DISTINCT project_id) AS n, bool_or(weak) AS weak, min(project_id) AS only_one FROM pterms GROUP BY 1),
    po AS (SELECT upper({present('project_id')}) AS project_id, max({present('country')}) AS country, max({present('reporting_country')}) AS rc, max(lower({present('test_site_id')})) AS site_id FROM projects GROUP BY 1),
    cu AS (SELECT project_id, term AS cue FROM pterms UNION SELECT po.project_id, trim(regexp_replace(a.cue, '{_WS}+', ' ', 'g')) FROM po JOIN (SELECT site_id, trim(name) AS cue FROM sn WHERE name IS NOT NULL UNION SELECT sa.site_id, alias FROM sa JOIN sn USING (site_id) WHERE sn.name IS NOT NULL) a USING (site_id) WHERE a.cue <> ''),
    un AS (SELECT pm.*, n, coalesce(d.reporting_country, '') AS land, substr(d.text, greatest(a - 600, 0) + 1, b + 600 - greatest(a - 600, 0)) AS ctx0 FROM pm JOIN ow USING (term) JOIN documents d USING (doc_id) WHERE n > 1 OR weak),
    uo AS (SELECT un.*, regexp_replace(ctx0, '{_WS}+', ' ', 'g') AS ctx, t.project_id FROM un JOIN pterms t USING (term)),
    ch AS (SELECT uo.doc_id, uo.a, uo.b, uo.term, uo.project_id, cue FROM uo JOIN cu ON cu.project_id = uo.project_id AND cu.cue <> uo.term AND contains(ctx, cue)
      WHERE len(list_filter(range(1, len(string_split(ctx, cue))), lambda j: NOT regexp_matches(right(string_split(ctx, cue)[j], 1), '[\p{{L}}\p{{M}}\p{{N}}_-]') AND NOT regexp_matches(left(string_split(ctx, cue)[j + 1], 1), '[\p{{L}}\p{{M}}\p{{N}}_-]'))) > 0),
    hs AS (SELECT uo.doc_id, uo.a, uo.b, uo.term, uo.n, uo.project_id, land, list_sort(list(DISTINCT cue) FILTER (cue IS NOT NULL)) AS h, any_value(po.country) AS country, any_value(po.rc) AS rc
      FROM uo LEFT JOIN ch ON ch.doc_id = uo.doc_id AND ch.a = uo.a AND ch.b = uo.b AND ch.term = uo.term AND ch.project_id = uo.project_id LEFT JOIN po ON po.project_id = uo.project_id GROUP BY 1, 2, 3, 4, 5, 6, 7),
    sc AS (SELECT *, coalesce(len(h), 0) AS c, coalesce(len(h), 0) > 0 AND land <> '' AND (coalesce(land = country, false) OR coalesce(land = rc, false)) AS home FROM hs),
    rk AS (SELECT *, c + CASE WHEN home THEN 0.5 ELSE 0 END AS score, row_number() OVER (PARTITION BY doc_id, a, b, term ORDER BY c + CASE WHEN home THEN 0.5 ELSE 0 END DESC, project_id DESC) AS r, lead(c + CASE WHEN home THEN 0.5 ELSE 0 END) OVER (PARTITION BY doc_id, a, b, term ORDER BY c + CASE WHEN home THEN 0.5 ELSE 0 END DESC, project_id DESC) AS second FROM sc),
    resolved AS (SELECT pm.doc_id, pm.a, pm.b, pm.term, only_one AS project_id, 'unique term' AS resolution FROM pm JOIN ow USING (term) WHERE n = 1 AND NOT weak
      UNION ALL SELECT doc_id, a, b, term, CASE WHEN score >= 1 AND score > coalesce(second, 0) THEN project_id END, CASE WHEN score >= 1 AND score > coalesce(second, 0) THEN 'context: ' || array_to_string(CASE WHEN home THEN list_append(h, 'chapter ' || land) ELSE h END, ', ') WHEN n > 1 THEN 'ambiguous' ELSE 'weak term, no context' END FROM rk WHERE r = 1)"""


def oracle_sql() -> dict[str, str]:
    return {
        "document_chapters": f'WITH {_chapters()} SELECT doc_id, start::BIGINT AS first_line, "end"::BIGINT AS end_line, country, author FROM chapters',
        "chapter_lines": f"WITH {_sections()} SELECT doc_id, country, count(*)::BIGINT AS n_lines, count(*) FILTER (section <> '')::BIGINT AS n_in_section FROM sections GROUP BY 1, 2",
        "chapter_sections": f"WITH {_sections()} SELECT doc_id, line_no, country, section, coalesce(section_kind, '') AS section_kind FROM sections WHERE country <> '' AND section <> ''",
        "document_entries": f"WITH {_entries()} SELECT * FROM entries",
        "hyphen_join": rf"""WITH {_clean('documents')}, l AS (SELECT doc_id, list(regexp_replace(line, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g') ORDER BY line_no) AS l FROM lines GROUP BY 1)
            SELECT doc_id, list_reduce(l, lambda o, t: CASE WHEN ends_with(o, '-') AND regexp_matches(t, '^\p{{Ll}}') THEN o[1:-2] || t ELSE o || ' ' || t END) AS text FROM l""",
        "site_mentions": f"{_mentions()} SELECT doc_id, a::INT AS a, b::INT AS b, term, site_id FROM mentions",
        "mention_contexts": f"{_mentions()} SELECT doc_id, a::INT AS a, b::INT AS b, term, site_id, {_context('d.text', 'a', 'b')} AS context FROM mentions JOIN documents d USING (doc_id)",
        "mentioned_sites": f"""{_mentions()}, m AS (SELECT site_id, count(*) AS n, list_sort(list_distinct(list(report_year))) AS y, list_sort(list_distinct(list(coalesce(reporting_country, '')))) AS l FROM mentions JOIN documents USING (doc_id) GROUP BY 1)
            SELECT site_id, name AS site_name, coalesce(n, 0)::BIGINT AS n_mentions, coalesce(len(y), 0)::BIGINT AS n_reports, list_min(y)::INT AS first_year, list_max(y)::INT AS last_year, coalesce(array_to_string(y, ', '), '') AS years_mentioned, coalesce(array_to_string(l, '; '), '') AS reporting_countries
            FROM sn LEFT JOIN m USING (site_id) WHERE name IS NOT NULL""",
        "term_hits": f"""WITH {_FLAT}, {_TERMS}, {_found('pterms')}, c AS (SELECT term, count(*) AS n, list_sort(list_distinct(list(report_year))) AS y FROM hits JOIN documents USING (doc_id) GROUP BY 1)
            SELECT term, coalesce(n, 0)::BIGINT AS n_hits, coalesce(array_to_string(y, ', '), '') AS years FROM (SELECT DISTINCT term FROM pterms) LEFT JOIN c USING (term)""",
        "search_terms": f"WITH {_TERMS} SELECT project_id, term, weak AS is_weak FROM pterms",
        "project_mentions": f"{_resolved()} SELECT doc_id, a::INT AS a, b::INT AS b, term, project_id, resolution FROM resolved",
    }
