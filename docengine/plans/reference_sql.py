"""DuckDB SQL for the queries SQL can express, on the same tables."""

from __future__ import annotations

from ..functions import text, vocab
from ..functions.missing import PLACEHOLDERS

_HOLES = ", ".join(f"'{p}'" for p in PLACEHOLDERS)


def strip(c: str) -> str:
    return rf"regexp_replace({c}, '^[\s\p{{Z}}\x{{200b}}\x{{feff}}]+|[\s\p{{Z}}\x{{200b}}\x{{feff}}]+$', '', 'g')"


def missing(c: str) -> str:
    return f"({c} IS NULL OR {strip(c)} = '' OR lower({strip(c)}) IN ({_HOLES}))"


def present(c: str) -> str:
    return f"(CASE WHEN NOT {missing(c)} THEN {strip(c)} END)"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _clean(source: str = "documents") -> str:
    """Lines of the documents, from the same fixed values as the operator."""
    t = "text"
    for a, b in text.LIGATURES.items():
        t = f"replace({t}, {q(a)}, {q(b)})"
    for a, b in text.SINGLE.items():
        t = f"replace({t}, {f'chr({ord(a)})'}, {f'chr({ord(b)})' if ord(b) < 32 else q(b)})"
    t = f"replace({t}, chr(173), '')"
    for f in vocab.FOOTERS:
        if "(?=" in f:
            f, put = f.replace(r"(?=\S|$)", r"(\S|$)"), r"chr(10) || '\1'"
        else:
            put = "chr(10)"
        t = f"regexp_replace({t}, {q(f)}, {put}, 'gi')"
    upper = "|".join(sorted((c.upper() for c in vocab.COUNTRIES), key=lambda c: (-len(c), c)))
    heads = r"(OVERVIEW|INTRODUCTION|SUPPORTING POLICIES( FOR OCEAN ENERGY)?|OCEAN ENERGY POLICY|NATIONAL STRATEGY|AUTHORS?|REPORT PREPARED BY)"
    trim = r"'^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g'"
    return rf"""
    raw AS (SELECT doc_id, unnest(string_split({t}, chr(10))) AS l, generate_subscripts(string_split({t}, chr(10)), 1) AS i FROM {source} WHERE text IS NOT NULL),
    s1 AS (SELECT doc_id, i, regexp_replace(regexp_replace(l, '[ \t]+', ' ', 'g'), {trim}) AS l FROM raw),
    s2 AS (SELECT doc_id, i, regexp_replace(regexp_replace(regexp_replace(l, '^\d{{1,3}}([A-Z]{{3}})', '\1'), '^(20\d\d\s*)?ANNUAL REPORT([A-Z]{{3}})', '\2'), '^\d{{1,3}} 0\d COUNTRY REPORTS([A-Z]{{3}})', '\1') AS l FROM s1),
    s3 AS (SELECT doc_id, i, unnest(CASE WHEN regexp_matches(l, '(?i)^({upper})\s*{heads}\s*:?\s*$')
      THEN [regexp_extract(l, '(?i)^({upper})', 1), regexp_replace(l, '(?i)^({upper})\s*', '')] ELSE [l] END) AS line, unnest([1, 2]) AS j FROM s2),
    lines AS (SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i, j) - 1)::BIGINT AS line_no, line FROM s3 WHERE line IS NOT NULL AND regexp_replace(line, {trim}) <> '')"""


_HEAD = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(line, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g'), '^(\d+(\.\d+)*\.?|[IVX]+\.)\s*', ''), '[\s\p{Z}]+', ' ', 'g'), '^[ :]+|[ :]+$', '', 'g')"""
_KIND = "CASE " + " ".join(rf"WHEN regexp_matches(h, {q('(?i)^(' + p + r')\s*:?$')}) THEN {q(k)}" for p, k in vocab.SECTIONS) + " END"
_TAGGED = rf"""
    headed AS (SELECT doc_id, line_no, line, {_HEAD} AS h, contains(upper(line), 'TEST SITE NAME') AS t FROM lines),
    kinds AS (SELECT doc_id, line_no, line, CASE WHEN t THEN 'Test site table' ELSE h END AS heading,
      CASE WHEN t THEN 'test sites' WHEN length(h) <= 80 AND h <> '' THEN {_KIND} END AS kind FROM headed)"""

_IDS = {"OB": r"regexp_extract_all(upper(coalesce(obs_ids, '')), 'OB\d+')", "PIL": r"regexp_extract_all(upper(coalesce(pilot_project_id, '')), 'PIL\d+')"}
_OBSERVED = f"""
    cited AS (SELECT row_id, upper({present('project_id')}) AS project_id, unnest({_IDS['OB']}) AS obs_id, generate_subscripts({_IDS['OB']}, 1) - 1 AS pos FROM projects),
    obs AS (SELECT upper({present('obs_id')}) AS obs_id, arg_min({{'y': report_year, 'c': reporting_country, 'e': evidence}}, (loaded_at, evidence IS NOT NULL, evidence, report_year IS NOT NULL, report_year)) AS o FROM observations GROUP BY 1),
    observed AS (SELECT row_id, project_id, pos, obs_id, try_cast({strip('o.y')} AS INT) AS report_year, coalesce({present('o.c')}, '') AS reporting_country, coalesce(o.e, '') AS evidence FROM cited JOIN obs USING (obs_id))"""
# letters beyond ASCII as one ASCII letter, other signs as "~", so that \\b and \\w of ASCII say the same as those of Unicode
_PLAIN = r"regexp_replace(regexp_replace(regexp_replace(text, '[^\x00-\x7F\p{L}\p{N}\p{M}\p{Z}]', '~', 'g'), '[^\x00-\x7F\p{L}\p{N}\p{M}]', chr(9), 'g'), '[^\x00-\x7F]', 'z', 'g')"
_LABEL = lambda t: "[x FOR x IN [" + ", ".join(f"CASE WHEN regexp_matches({_PLAIN}, {q('(?i)' + p)}) THEN {q(n)} END" for n, p in t) + "] IF x IS NOT NULL]"
_HAS = lambda p, i=True: f"regexp_matches({_PLAIN}, {q(('(?i)' if i else '') + p)})::BIGINT"
_CAP = r"(^|[^\p{L}\p{N}_.])(\d{1,3}(?:[ ,]\d{3})*(?:\.\d+)?|\d+(?:\.\d+)?)\s?(kW|MW|GW)\b"
_YEARS = r"regexp_extract_all(coalesce(report_years, ''), '\d{4}')"


def p3(rows: str) -> str:
    """Orphan references from plain joins and set operations."""
    return rf"""
    WITH c AS (
      SELECT 'test_site_id' AS field, row_id, lower({present('test_site_id')}) AS ref, loaded_at FROM projects
      UNION ALL SELECT 'pilot_project_id', row_id, unnest({_IDS['PIL']}), loaded_at FROM projects
      UNION ALL SELECT 'obs_ids', row_id, unnest({_IDS['OB']}), loaded_at FROM projects),
    t AS (
      SELECT 'test_site_id' AS field, lower({present('site_id')}) AS ref, min(loaded_at) AS loaded FROM test_sites WHERE deleted_at IS NULL GROUP BY 2
      UNION ALL SELECT 'pilot_project_id', upper({present('project_id')}), min(loaded_at) FROM pilot_projects WHERE deleted_at IS NULL GROUP BY 2
      UNION ALL SELECT 'obs_ids', upper({present('obs_id')}), min(loaded_at) FROM observations WHERE deleted_at IS NULL GROUP BY 2),
    o AS (SELECT DISTINCT c.field, c.row_id, c.ref, c.loaded_at FROM c LEFT JOIN t USING (field, ref) WHERE c.ref IS NOT NULL AND (t.loaded IS NULL OR c.loaded_at < t.loaded))
    {rows}"""


def p7() -> str:
    num = lambda c, most: f"(CASE WHEN abs(try_cast({strip(c)} AS DOUBLE)) <= {most} AND NOT isnan(try_cast({strip(c)} AS DOUBLE)) AND NOT coalesce(try_cast({strip('lat')} AS DOUBLE) = 0 AND try_cast({strip('lon')} AS DOUBLE) = 0, false) THEN 'x' END)"
    parts = " UNION ALL ".join(f"SELECT row_id, lower({present('test_site_id')}) AS g, '{f}' AS field, {v} AS v FROM projects" for f, v in (("lat", num("lat", 90)), ("lon", num("lon", 180)), ("location_basis", present("location_basis")), ("capacity_basis", present("capacity_basis"))))
    return f"WITH c AS ({parts}), k AS (SELECT DISTINCT g, field FROM c WHERE g IS NOT NULL AND v IS NOT NULL) SELECT c.row_id, c.field FROM c JOIN k ON c.g = k.g AND c.field = k.field WHERE c.v IS NULL"


def p2() -> str:
    """Packed fields by regular expressions: items in quotes or without, cut at the strongest delimiter outside quotes."""
    quoted = r'"(?:[^"]|"")*"'
    bare = rf"regexp_replace(v, '{quoted}', '', 'g')"
    item = lambda marks: rf"regexp_extract_all(v, '\s*({quoted}\s*|[^{marks}]+)(?:[{marks}]|$)', 1)"
    return rf"""
    WITH n AS (SELECT 'test_sites.aliases' AS field, lower({present('site_id')}) AS row_key, {present('aliases')} AS v FROM test_sites
      UNION ALL SELECT 'projects.primre_name', row_id::VARCHAR, {present('primre_name')} FROM projects),
    l AS (SELECT field, row_key, CASE
        WHEN v LIKE '["%"]' THEN from_json(v, '["VARCHAR"]')
        WHEN regexp_matches({bare}, '[|;\n\t]') THEN {item(r'|;\n\t')}
        WHEN regexp_matches({bare}, '\s/\s') THEN string_split_regex(v, '\s/\s')
        ELSE {item(',')} END AS items FROM n WHERE v IS NOT NULL
      UNION ALL SELECT 'projects.obs_ids', row_id::VARCHAR, regexp_extract_all(obs_ids, 'OB\d+') FROM projects
      UNION ALL SELECT 'projects.report_years', row_id::VARCHAR, regexp_extract_all(report_years, '\d+') FROM projects),
    t AS (SELECT field, row_key, [{strip('x')} FOR x IN items IF {strip('x')} <> ''] AS items FROM l),
    e AS (SELECT field, row_key, unnest(items) AS v, generate_subscripts(items, 1) AS pos FROM t WHERE len(items) > 1)
    SELECT field, row_key, pos::INT AS pos, CASE WHEN regexp_matches(v, '^{quoted}$') THEN {strip("replace(v[2:-2], chr(34) || chr(34), chr(34))")} ELSE v END AS value FROM e"""


_NUMBERS = "CASE lower(w) " + " ".join(f"WHEN '{w}' THEN {n}" for w, n in (("two", 2), ("three", 3), ("four", 4), ("five", 5), ("six", 6), ("seven", 7), ("eight", 8), ("nine", 9), ("ten", 10), ("twelve", 12))) + " ELSE 1 END"


def p4() -> str:
    """Capacities by plain steps: count, number, unit of the text, of the column or of the basis."""
    unit = lambda c: rf"CASE lower(left(regexp_replace({c}, '\s', '', 'g'), 1)) WHEN 'k' THEN 1e3 WHEN 'm' THEN 1e6 WHEN 'g' THEN 1e9 WHEN 'w' THEN 1.0 END"
    words = r"(?i)(k\s?w|kilowatt|m\s?w|megawatt|g\s?w|gigawatt|w|watt)"
    return rf"""
    WITH r AS (
      SELECT 'projects' AS src, row_id::VARCHAR AS row_key, {present('capacity_kw')} AS v, NULL AS col, false AS other, {unit(f"regexp_extract(capacity_basis, '(?i)(?:^|[^a-z])(kw|mw|megawatts|watts|w)(?:[^a-z]|$)', 1)")} AS hint, 'kW' AS usual FROM projects
      UNION ALL SELECT 'pilot_projects', upper({present('project_id')}), {present('capacity_max_value')}, {unit('capacity_max_unit')},
        coalesce(lower({present('capacity_max_unit')}), 'see value') NOT IN ('see value', 'as stated') AND NOT regexp_matches(capacity_max_unit, '(?i)^\s*(k\s?w|m\s?w|g\s?w|w|kilowatts?|megawatts?|gigawatts?|watts?)(e| \(el\.\))?\s*$'), NULL, coalesce(capacity_max_unit, '') FROM pilot_projects),
    s AS (SELECT *, regexp_replace(v, '[\x{{a0}}\x{{202f}}]', ' ', 'g') AS t FROM r WHERE v IS NOT NULL),
    c AS (SELECT *, regexp_extract(t, '(?i)^(two|three|four|five|six|seven|eight|nine|ten|twelve) ', 1) AS w, CASE WHEN regexp_matches(t, '\d\s*[x×]\s*\d') THEN regexp_extract(t, '(\d+)\s*[x×]', 1)::INT END AS k, regexp_replace(t, '^.*[x×]\s*', '') AS rest FROM s),
    m AS (SELECT *, regexp_extract(rest, '\d+(?:[ ,.''’]\d+)*(?:e\d+)?') AS d, regexp_extract(rest, '\d\s*-?\s*(?:{words})', 1) AS u FROM c),
    x AS (SELECT *, regexp_replace(d, '[ ''’]', '', 'g') AS n, CASE WHEN u <> '' THEN {unit('u')} END AS own FROM m WHERE NOT regexp_matches(v, '(?i)\d\s*m rotor')),
    y AS (SELECT *, (CASE WHEN regexp_matches(n, '^\d{{1,3}}(,\d{{3}})+(\.\d+)?$') THEN replace(n, ',', '') ELSE replace(n, ',', '.') END)::DOUBLE * coalesce(k, {_NUMBERS}) AS q, coalesce(own, CASE WHEN other THEN NULL ELSE coalesce(col, hint, CASE WHEN src = 'projects' THEN 1e3 END) END) AS f FROM x)
    SELECT src, row_key, round(q * f)::BIGINT AS capacity_w FROM y WHERE f IS NOT NULL AND q > 0 AND NOT (regexp_matches(v, '^\d+(\.\d*)?$') AND f = 1e3 AND usual = 'kW')"""


_CODES = "CASE " + " ".join(f"WHEN {strip('technology')} = {q(a)} THEN {q(b)}" for a, b in vocab.PILOT_TECH.items()) + f" ELSE coalesce({strip('technology')}, '') END"
_FIXES = "CASE " + " ".join(f"WHEN lower(s) = {q(a)} THEN {q(b)}" for a, b in vocab.COUNTRY_FIX.items()) + " ELSE string_split(s, ' ')[1] || coalesce(nullif(' ' || array_to_string([CASE WHEN lower(w) IN ('of', 'and', 'the') THEN lower(w) ELSE w END FOR w IN string_split(s, ' ')[2:]], ' '), ' '), '') END"


def oracle_sql() -> dict[str, str]:
    lines = _clean()
    return {
        "doc_lines": f"WITH {lines} SELECT doc_id, line_no, length(line)::BIGINT AS n_chars, line FROM lines",
        "heading_tags": f"WITH {lines}, {_TAGGED} SELECT doc_id, line_no, heading, kind FROM kinds WHERE kind IS NOT NULL",
        "section_carry_forward": f"""WITH {lines}, {_TAGGED},
            carried AS (SELECT doc_id, line_no, last_value(CASE WHEN kind IS NOT NULL THEN {{'h': heading, 'k': kind}} END IGNORE NULLS) OVER w AS c,
              last_value(CASE WHEN kind IS NOT NULL AND kind <> 'test sites' THEN {{'k': kind}} END IGNORE NULLS) OVER w AS o FROM kinds WINDOW w AS (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
            SELECT doc_id, line_no, c.h AS section, CASE WHEN c.k = 'test sites' AND o.k IN ('demonstration', 'deployment', 'planned', 'R&D') THEN o.k ELSE c.k END AS section_kind FROM carried WHERE c.h <> ''""",
        "blocks_runs": f"""WITH {lines}, {_TAGGED}, x AS (SELECT doc_id, line_no, length(line) > 40 AND kind IS NULL AS w FROM kinds),
            y AS (SELECT *, CASE WHEN w AND NOT coalesce(lag(w) OVER (PARTITION BY doc_id ORDER BY line_no), false) THEN 1 ELSE 0 END AS s FROM x),
            z AS (SELECT *, sum(s) OVER (PARTITION BY doc_id ORDER BY line_no) AS b FROM y WHERE true)
            SELECT doc_id, b::BIGINT AS block, min(line_no)::BIGINT AS first_line, count(*)::BIGINT AS n_lines FROM z WHERE w GROUP BY 1, 2""",
        "line_stats_median": f"WITH {lines} SELECT doc_id, coalesce(median(CASE WHEN length(line) > 20 THEN length(line) END), 60)::DOUBLE AS typical FROM lines GROUP BY 1",
        "joined_offsets": f"WITH {lines} SELECT doc_id, line_no, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM lines",
        "clipped_text": r"""WITH s AS (SELECT doc_id, trim(regexp_replace(text, '[\s\p{Z}]+', ' ', 'g')) AS s FROM documents WHERE text IS NOT NULL)
            SELECT doc_id, CASE WHEN length(s) <= 80 THEN s ELSE regexp_replace(s[1:77], '[\s\p{Z}][^\s\p{Z}]*$', '') || '…' END AS clip FROM s""",
        "attr_capacities": f"""WITH c AS (SELECT doc_id, [regexp_replace(regexp_extract(x, {q(_CAP)}, 2), ' ', '', 'g') || ' ' || regexp_extract(x, {q(_CAP)}, 3) FOR x IN regexp_extract_all({_PLAIN}, {q(_CAP)})] AS c FROM documents)
            SELECT doc_id, array_to_string(c, '; ') AS capacities FROM c WHERE len(c) > 0""",
        "attr_labels": f"SELECT doc_id, array_to_string({_LABEL(vocab.TECHNOLOGIES)}, '; ') AS technologies, array_to_string({_LABEL(vocab.STATUS)}, '; ') AS status FROM documents WHERE text IS NOT NULL",
        "attr_years": f"WITH y AS (SELECT doc_id, list_sort(list_distinct(regexp_extract_all({_PLAIN}, {q(vocab.YEAR)}, 1))) AS y FROM documents) SELECT doc_id, array_to_string(y, '; ') AS years FROM y WHERE len(y) > 0",
        "signal_scores": f"SELECT doc_id, {_HAS(_CAP, False)} + {_HAS(vocab.DEPLOY_VERB)} + {_HAS(vocab.DEVICE_WORD)} AS signal_score FROM documents WHERE text IS NOT NULL",
        "site_summary": f"""WITH m AS (SELECT lower({present('test_site_id')}) AS k, count(*) AS n, list_sort(list_distinct(list(try_cast({strip('first_seen')} AS INT)))) AS y, list_sort(list_distinct(list(coalesce({present('reporting_country')}, '')))) AS l FROM projects GROUP BY 1)
            SELECT lower({present('site_id')}) AS site_id, coalesce({present('name')}, '') AS site_name, coalesce(n, 0)::BIGINT AS n_mentions, coalesce(len([x FOR x IN y IF x IS NOT NULL]), 0)::BIGINT AS n_reports, list_min(y)::BIGINT AS first_year, list_max(y)::BIGINT AS last_year,
            coalesce(array_to_string([x FOR x IN y IF x IS NOT NULL], ', '), '') AS years_mentioned, coalesce(array_to_string(l, '; '), '') AS reporting_countries FROM test_sites LEFT JOIN m ON m.k = lower({present('site_id')})""",
        "project_years": f"""WITH {_OBSERVED}, o AS (SELECT * FROM observed WHERE project_id IS NOT NULL AND report_year IS NOT NULL),
            d AS (SELECT *, row_number() OVER (PARTITION BY project_id, report_year, obs_id ORDER BY row_id, pos) AS ti, row_number() OVER (PARTITION BY project_id, report_year, reporting_country ORDER BY row_id, pos) AS ci,
              row_number() OVER (PARTITION BY project_id, report_year ORDER BY row_id, pos) AS li FROM o)
            SELECT project_id, report_year::BIGINT AS report_year, count(*)::BIGINT AS n_mentions, array_to_string(list(obs_id ORDER BY row_id, pos) FILTER (ti = 1), '; ') AS terms_matched,
            array_to_string(list(reporting_country ORDER BY row_id, pos) FILTER (ci = 1), '; ') AS reporting_countries, array_to_string(list(pos::VARCHAR ORDER BY row_id, pos) FILTER (li <= 20), '; ') AS lines,
            first(evidence ORDER BY evidence = '', row_id, pos) AS example_context FROM d GROUP BY 1, 2""",
        "recall_check": f"""WITH {_OBSERVED}, f AS (SELECT DISTINCT project_id, report_year::VARCHAR AS year FROM observed WHERE project_id IS NOT NULL AND report_year IS NOT NULL),
            v AS (SELECT DISTINCT * FROM (SELECT upper({present('project_id')}) AS project_id, unnest({_YEARS}) AS year FROM projects WHERE report_years_basis = 'Pilot observations') WHERE project_id IS NOT NULL),
            h AS (SELECT count(*) AS hit FROM v JOIN f USING (project_id, year))
            SELECT hit::BIGINT AS n_found, (SELECT count(*) FROM v)::BIGINT AS n_verified, round_even(100 * hit / greatest((SELECT count(*) FROM v), 1), 0)::BIGINT AS percent, ((SELECT count(*) FROM f) - hit)::BIGINT AS n_extra FROM h""",
        "country_years": f"""WITH s AS (SELECT lower({present('site_id')}) AS k, coalesce({present('name')}, '') AS site_name, coalesce(lower({present('country')}), '') AS country FROM test_sites),
            u AS (SELECT try_cast({strip('first_seen')} AS INT) AS report_year, s.country, s.k AS site_id, s.site_name, NULL AS score, NULL AS cap, 'm' AS src FROM projects JOIN s ON s.k = lower({present('test_site_id')})
              UNION ALL SELECT try_cast({strip('first_seen')} AS INT), coalesce(lower({present('country')}), ''), NULL, NULL, CASE WHEN NOT {missing('latest_status')} THEN 2 ELSE 1 END, NOT {missing('capacity_kw')}, 'e' FROM projects
              UNION ALL SELECT try_cast({strip('report_year')} AS INT), coalesce(lower({present('reporting_country')}), ''), NULL, NULL, NULL, NULL, 'c' FROM observations)
            SELECT report_year::BIGINT AS report_year, country, CASE WHEN bool_or(src = 'c') THEN 'yes' ELSE 'no' END AS country_chapter_found, count(DISTINCT site_id)::BIGINT AS n_test_sites, count(*) FILTER (src = 'm')::BIGINT AS n_test_site_mentions,
            count(*) FILTER (src = 'e')::BIGINT AS n_projects, count(*) FILTER (src = 'e' AND score >= 2)::BIGINT AS n_projects_signal_2plus, count(*) FILTER (src = 'e' AND cap)::BIGINT AS n_projects_with_capacity,
            count(*) FILTER (src = 'e' AND NOT cap)::BIGINT AS n_projects_without_capacity, coalesce(array_to_string(list_sort(list_distinct(list(site_name))), '; '), '') AS test_sites FROM u GROUP BY 1, 2""",
        "filled_capacity": f"""WITH k(unit, f) AS (VALUES ('W', 0.001), ('kW', 1.0), ('MW', 1000.0), ('GW', 1000000.0)),
            c AS (SELECT row_id, unnest({_IDS['PIL']}) AS pid FROM projects),
            x AS (SELECT row_id, 0 AS i, 'pilot' AS source, try_cast(capacity_max_value AS DOUBLE) * f AS kw FROM c JOIN pilot_projects p ON upper({present('p.project_id')}) = pid JOIN k ON k.unit = capacity_max_unit
              UNION ALL SELECT row_id, 1, 'own', try_cast(capacity_kw AS DOUBLE) FROM projects),
            y AS (SELECT row_id, i, source, max(kw) AS kw FROM x WHERE kw IS NOT NULL GROUP BY 1, 2, 3), z AS (SELECT row_id, arg_min(source, i) AS source, arg_min(kw, i) AS kw FROM y GROUP BY 1)
            SELECT row_id, round(kw::DOUBLE, 6) AS capacity_kw, source FROM z WHERE kw > 0""",
        "filled_position": f"""WITH s AS (SELECT lower({present('site_id')}) AS k, try_cast({strip('lat')} AS DOUBLE) AS lat, try_cast({strip('lon')} AS DOUBLE) AS lon FROM test_sites),
            r AS (SELECT row_id, s.lat AS sl, s.lon AS so, try_cast({strip('p.lat')} AS DOUBLE) AS pl, try_cast({strip('p.lon')} AS DOUBLE) AS po FROM projects p LEFT JOIN s ON s.k = lower({present('p.test_site_id')})),
            g AS (SELECT row_id, CASE WHEN abs(sl) <= 90 AND abs(so) <= 180 THEN {{'lat': sl, 'lon': so, 'basis': 'test site'}} WHEN abs(pl) <= 90 AND abs(po) <= 180 THEN {{'lat': pl, 'lon': po, 'basis': 'project'}} END AS x FROM r)
            SELECT row_id, x.lat AS lat, x.lon AS lon, x.basis AS basis FROM g WHERE x IS NOT NULL""",
        "year_ranges": f"""WITH y AS (SELECT DISTINCT row_id, unnest({_YEARS})::INT AS y FROM projects), g AS (SELECT row_id, y, y - row_number() OVER (PARTITION BY row_id ORDER BY y) AS k FROM y),
            r AS (SELECT row_id, min(y) AS a, max(y) AS b FROM g GROUP BY row_id, k)
            SELECT row_id, array_to_string(list(CASE WHEN a = b THEN a::VARCHAR ELSE a || '–' || lpad((b % 100)::VARCHAR, 2, '0') END ORDER BY a), ', ') AS ranges FROM r GROUP BY 1""",
        "chapter_top1": """WITH e AS (SELECT user_id AS doc_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS line_no, event_type AS country, value > 50 AS a FROM events),
            i AS (SELECT * FROM e WHERE NOT EXISTS (SELECT 1 FROM e f WHERE f.doc_id = e.doc_id AND f.country <> e.country AND abs(f.line_no - e.line_no) < 2)),
            s AS (SELECT i.*, coalesce(lead(line_no) OVER (PARTITION BY doc_id ORDER BY line_no), (SELECT max(line_no) + 1 FROM e f WHERE f.doc_id = i.doc_id)) - line_no AS span FROM i),
            r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, country ORDER BY a DESC, span DESC, line_no) AS k FROM s)
            SELECT doc_id, line_no, country FROM r WHERE k = 1""",
        "owner_margin": """WITH p AS (SELECT p_brand, p_type, sum(p_retailprice) AS score FROM part GROUP BY 1, 2), r AS (SELECT *, row_number() OVER w AS k, lead(score) OVER w AS second FROM p WINDOW w AS (PARTITION BY p_brand ORDER BY score DESC, p_type))
            SELECT p_brand, p_type, round(score, 2) AS score, round(score - coalesce(second, 0), 2) AS margin FROM r WHERE k = 1""",
        "facet_counts": f"""WITH p AS (SELECT coalesce({present('country')}, '') AS country, coalesce({present('technology')}, '') AS technology, coalesce({present('category')}, '') AS category, coalesce(try_cast({strip('capacity_kw')} AS DOUBLE), 0) AS kw FROM projects),
            f AS (SELECT *, country IN ('United Kingdom', 'France', 'China') AS a, technology IN ('wave', 'tidal stream') AS b FROM p)
            SELECT 'country' AS facet, country AS value, count(*) FILTER (b)::BIGINT AS n, round(coalesce(sum(kw) FILTER (b), 0), 2) AS total FROM f GROUP BY 2
            UNION ALL SELECT 'technology', technology, count(*) FILTER (a)::BIGINT, round(coalesce(sum(kw) FILTER (a), 0), 2) FROM f GROUP BY 2
            UNION ALL SELECT 'category', category, count(*) FILTER (a AND b)::BIGINT, round(coalesce(sum(kw) FILTER (a AND b), 0), 2) FROM f GROUP BY 2""",
        "top_k_list": "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 250",
        "anti_link": f"SELECT upper({present('p.project_id')}) AS project_id, canonical_name FROM pilot_projects p WHERE upper({present('p.project_id')}) NOT IN (SELECT unnest({_IDS['PIL']}) FROM projects WHERE lower({strip('review_status')}) IN ('checked', 'reviewed'))",
        "multi_ref_join": f"""WITH c AS (SELECT row_id, unnest({_IDS['PIL']}) AS pid, generate_subscripts({_IDS['PIL']}, 1) AS i FROM projects)
            SELECT row_id, array_to_string(list(coalesce(canonical_name, '') ORDER BY i, canonical_name), ' | ') AS names FROM c JOIN pilot_projects p ON upper({present('p.project_id')}) = pid GROUP BY 1""",
        "prefer_then_first": f"""SELECT coalesce({present('reporting_country')}, '') AS country, coalesce({strip('report_year')}, '') AS year, count(*)::BIGINT AS n, first(evidence ORDER BY {missing('printed_page')}, obs_id, evidence) AS example
            FROM observations WHERE evidence IS NOT NULL GROUP BY 1, 2""",
        "coordinates_parsed": rf"""WITH t AS (SELECT site_id, {strip("coalesce(lat, '')")} AS a, {strip("coalesce(lon, '')")} AS b FROM test_sites)
            SELECT site_id, printf('%.4f', a::DOUBLE) AS lat, printf('%.4f', b::DOUBLE) AS lon FROM t WHERE regexp_matches(a, '^-?\s*\d+(\.\d+)?$') AND regexp_matches(b, '^-?\s*\d+(\.\d+)?$')""",
        "country_names": rf"WITH s AS (SELECT trim(regexp_replace(coalesce(country, ''), '[\s\p{{Z}}]+', ' ', 'g')) AS s FROM projects) SELECT {_FIXES} AS country, count(*)::BIGINT AS n FROM s GROUP BY 1",
        "chapter_counts": f"""WITH {_OBSERVED}, u AS (SELECT project_id, report_year AS year, 1 AS n FROM observed WHERE project_id IS NOT NULL AND report_year IS NOT NULL
            UNION ALL SELECT upper({present('project_id')}), unnest({_YEARS})::INT, 0 FROM projects) SELECT project_id, year::BIGINT AS year, greatest(sum(n), 1)::BIGINT AS n FROM u WHERE project_id IS NOT NULL GROUP BY 1, 2""",
        "names_with_sources": f"""WITH u AS (SELECT {present('test_site_name')} AS name, coalesce({present('deployment_country')}, '') AS country, 'pilot' AS source FROM pilot_projects
            UNION ALL SELECT {present('test_site_name_raw')}, coalesce({present('country')}, ''), 'projects' FROM projects) SELECT name, country, count(*)::BIGINT AS n, array_to_string(list_sort(list_distinct(list(source))), '; ') AS sources FROM u WHERE name IS NOT NULL GROUP BY 1, 2""",
        "shared_records": f"WITH p AS (SELECT row_id, {present('primre_website')} AS site FROM projects), g AS (SELECT site, count(*) AS n FROM p WHERE site IS NOT NULL GROUP BY 1 HAVING count(*) > 1) SELECT row_id, n::BIGINT AS n_shared, site FROM p JOIN g USING (site)",
        "numbered_records": "SELECT project_id, 'P' || lpad((row_number() OVER (ORDER BY project_id))::VARCHAR, 8, '0') AS new_id FROM pilot_projects",
        "site_projects": f"""WITH p AS (SELECT DISTINCT lower({present('test_site_id')}) AS site_id, coalesce({strip('first_seen')}, '') AS y, coalesce({strip('name')}, '') AS n FROM projects)
            SELECT site_id, count(*)::BIGINT AS n, array_to_string(list(y || ' ' || p.n ORDER BY y, p.n), '; ') AS projects FROM p WHERE site_id IS NOT NULL GROUP BY 1""",
        "status_texts": f"""WITH p AS (SELECT row_id, coalesce(lower({present('latest_status')}) || coalesce(' (' || try_cast({strip('last_seen')} AS INT) || ')', ''), {present('primre_status')}) AS status FROM projects) SELECT row_id, status FROM p WHERE status IS NOT NULL""",
        "technology_codes": f"WITH t AS (SELECT {_CODES} AS technology FROM pilot_projects) SELECT technology, count(*)::BIGINT AS n, count(*) FILTER (technology <> 'other')::BIGINT AS n_in_scope FROM t GROUP BY 1",
        "map_filter": f"""WITH p AS (SELECT lower({strip("coalesce(in_scope, '')")}) = 'yes' AS s, len({_YEARS}) > 0 AS n, NOT {missing('capacity_kw')} AS c FROM projects)
            SELECT count(*) FILTER (s AND n AND c)::BIGINT AS shown, count(*) FILTER (NOT s)::BIGINT AS out_of_scope, count(*) FILTER (s AND NOT n)::BIGINT AS not_named, count(*) FILTER (s AND n AND NOT c)::BIGINT AS no_capacity FROM p""",
        "capacity_split": f"SELECT (NOT {missing('capacity_kw')})::BIGINT AS with_capacity, count(*)::BIGINT AS n FROM projects GROUP BY 1",
        "spiral_layout": """WITH s AS (SELECT s_suppkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) - 1 AS n FROM supplier)
            SELECT s_suppkey, n::BIGINT AS n, round(6.0 * sqrt(n) * cos(n * 2.39996::DOUBLE), 6) AS dx, round(6.0 * sqrt(n) * sin(n * 2.39996::DOUBLE), 6) AS dy FROM s""",
        "colour_years": f"WITH y AS (SELECT row_id, unnest({_YEARS}) AS y FROM projects) SELECT row_id, min(y) AS first, max(y) AS latest FROM y WHERE y BETWEEN '2012' AND '2019' GROUP BY 1",
        "p2_found": p2(),
        "p4_found": p4(),
        "p3_found": p3("SELECT field, row_id, ref FROM o"),
        "p3_report": p3("SELECT field, date_trunc('year', loaded_at)::TIMESTAMP AS period, count(*)::BIGINT AS n_references, count(DISTINCT ref)::BIGINT AS n_keys FROM o GROUP BY 1, 2"),
        "p7_found": p7(),
    }
