"""Queries of sources, sinks, links and layout over the register, and the SQL they are compared with."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions import text as T, vocab
from ..functions.missing import is_missing, key_lower, key_upper, present, trimmed
from ..operators import facets, resolve, structure, summarize, terms
from ..session import shared_dir
from ..sources import readers, sinks
from . import sample_reports
from .reference_queries import big, docs, table
from .reference_sql import _clean, missing, present as p, q, strip


def _folder(spark: SparkSession) -> str:
    """A folder of this call's own among those all executors share."""
    return os.path.join(shared_dir(spark), f"files-{uuid.uuid4().hex}")


# --- sources and sinks

_SITE_COLUMNS = ["site_id", "name", "country", "location", "lat", "lon", "aliases", "pilot_names", "review_status"]


def register_round_trip(spark, d):
    """The sites written as CSV and read again."""
    path = f"{_folder(spark)}/sites"
    sinks.csv(table(spark, d, "test_sites").select(*_SITE_COLUMNS), path)
    return readers.register(spark, path, [*_SITE_COLUMNS, "absent"]).select(*[F.coalesce(c, F.lit("")).alias(c) for c in (*_SITE_COLUMNS, "absent")])


def sheet_round_trip(spark, d):
    """The nations written as a workbook's sheet and read again."""
    path = f"{_folder(spark)}/nations.xlsx"
    nations = table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    sinks.put(spark, path, sinks.workbook({"regions": table(spark, d, "region"), "nations": nations}))
    return readers.sheets(spark, path, ["n_name", "n_nationkey"], "nations")


def country_sheets(spark, d):
    """A workbook a country of sites, read again: its rows."""
    s = table(spark, d, "test_sites").select("site_id", present(F.col("name")).alias("name"), F.coalesce(present(F.col("country")), F.lit("")).alias("country"))
    made = sinks.country_workbooks(s, "country", ["site_id"])

    def read(frames):
        import pandas as pd

        for pdf in frames:
            for country, content in zip(pdf["country"], pdf["content"]):
                header, *rows = readers.xlsx_rows(bytes(content))
                yield pd.DataFrame([(country, *(r[header.index(c)] or "" for c in ("site_id", "name"))) for r in rows], columns=["country", "site_id", "name"])

    return made.mapInPandas(read, "country string, site_id string, name string")


def numbered_reports(spark, d):
    """The lines of reports written with their numbers and read again by the year in the file's name."""
    folder = _folder(spark)
    made = spark.createDataFrame(sample_reports.TEXTS, "doc_id bigint, text string")
    for r in sinks.numbered_lines(structure.lines(made)).collect():  # a few small reports
        sinks.put(spark, f"{folder}/report_{2000 + r['doc_id']}.txt", r["text"].encode())
    return readers.numbered_texts(spark, folder).select("source_file", *big("report_year"), "text")


def _rtf(text: str) -> str:
    body = "".join(c if ord(c) < 128 and c not in "\\{}" else "\\" + c if c in "\\{}" else f"\\u{ord(c)}?" for c in text).replace("\n", "\\par\n")
    return "{\\rtf1\\ansi{\\fonttbl{\\f0 Arial;}}\\f0 " + body + "}"


def rtf_reports(spark, d):
    """Reports written as RTF and read again."""
    folder = _folder(spark)
    for i, text in sample_reports.TEXTS:
        sinks.put(spark, f"{folder}/report {2000 + i}.rtf", _rtf(text).encode())
    return readers.reports(spark, folder).select("source_file", *big("report_year"), "text")


_GEO = {"P1": (50.5, -3.25, "exact"), "P2": (None, None, "none"), "P3": (-10.0, 170.125, "region")}


def geocoded_projects(spark, d):
    """Positions from a JSON object keyed by project."""
    import json

    path = f"{_folder(spark)}/geo.json"
    sinks.put(spark, path, json.dumps({k: {"geo_lat": a, "geo_lon": b, "geo_tier": t} for k, (a, b, t) in _GEO.items()}, indent=1).encode())
    return readers.geocoded(spark, path)


def listed_words(spark, d):
    """Ordinary words of a word list: those that begin in lower case."""
    path = f"{_folder(spark)}/words"
    words = table(spark, d, "common_words").select("word").union(table(spark, d, "nation").select("n_name"))
    words.write.text(path)
    return readers.word_list(spark, path)


def safe_cells(spark, d):
    return table(spark, d, "projects").where("notes is not null").select(*big("row_id"), T.cell(F.concat(F.lit("\x01"), "notes")).alias("cell"), T.html_escape(F.col("notes")).alias("html"))


# --- numbers and lists as text


def capacity_texts(spark, d):
    kw = trimmed(F.col("capacity_kw")).try_cast("double")
    rows = table(spark, d, "projects").select("row_id", kw.alias("kw")).where("kw > 0")
    return rows.select(*big("row_id"), T.power_text(F.col("kw")).alias("power"), F.round(T.radius(F.col("kw")), 6).alias("radius"))


def device_lists(spark, d):
    listed = F.concat_ws(", ", present(F.col("developer")), F.concat_ws("/", F.lit("maker"), present(F.col("device"))))
    return table(spark, d, "projects").select(*big("row_id"), F.array_join(T.devices(listed), " | ").alias("devices"), F.replace(F.coalesce("report_years", F.lit("")), F.lit("; "), F.lit(" | ")).alias("rewritten"))


# --- links and corrections


def overridden_sites(spark, d):
    """Sites with the country that candidates merged into them tell, in place of their own."""
    c = table(spark, d, "test_site_candidates").select(key_lower(F.col("site_id")).alias("site_id"), present(F.col("country")).alias("country")).where("site_id is not null")
    fixes = c.groupBy("site_id").agg(F.min("country").alias("country"))
    s = table(spark, d, "test_sites").select(key_lower(F.col("site_id")).alias("site_id"), present(F.col("name")).alias("name"), present(F.col("country")).alias("country"))
    return summarize.overridden(s, fixes, "site_id")


def free_acronyms(spark, d):
    """Acronyms of names, blank where an existing name already has them as a word."""
    s = table(spark, d, "test_sites").select("site_id", present(F.col("name")).alias("name")).where("name is not null")
    initials = F.array_join(F.transform(F.split("name", " "), lambda w: F.upper(F.substr(w, F.lit(1), F.lit(1)))), "")
    named = s.select(F.concat("name", F.lit(" ("), initials, F.lit(")")).alias("name")).distinct()
    existing = table(spark, d, "test_sites").select(F.concat_ws(" ", "name", "pilot_names").alias("alias"))
    return terms.taken_acronyms(named, existing)


def reviewed_links(spark, d):
    """Links of candidates to sites: the decision of a review counts before the number of records."""
    c = table(spark, d, "test_site_candidates").select(F.col("candidate_id").alias("ord"), F.lower(trimmed("candidate")).alias("left_name"), F.coalesce(key_lower(F.col("site_id")), F.lower(present(F.col("country"))), F.lit("")).alias("right_name"), present(F.col("decision")).alias("decision"), F.when(F.col("n_records") > 1, "high").otherwise("low").alias("confidence"))
    verdict = F.when(F.col("decision") == "merged", "match").when(F.col("decision") == "added", "unsure, added").when(F.col("decision").isNotNull(), "different")
    return resolve.decided_links(c.where("left_name is not null").withColumn("verdict", verdict))


def appended_records(spark, d):
    """Values of all outside records of one website, in order."""
    r = table(spark, d, "primre_only_test_sites").select("primre_row_id", present(F.col("primre_website")).alias("website"), *[F.coalesce(present(F.col(c)), F.lit("")).alias(c) for c in ("primre_resource", "location")])
    return summarize.appended(r.where("website is not null"), "website", ["primre_resource", "location"], "primre_row_id")


# --- positions and layout


def centroid_positions(spark, d):
    """Position of each project: its own, else its site's, else the middle of its country's sites."""
    real = lambda c, most: F.when(F.abs(trimmed(F.col(c)).try_cast("double")) <= most, trimmed(F.col(c)).try_cast("double"))
    land = lambda: F.lower(T.canonical_country(F.col("country"))).alias("land")
    s = table(spark, d, "test_sites").select(key_lower(F.col("site_id")).alias("k"), land(), real("lat", 90).alias("s_lat"), real("lon", 180).alias("s_lon"))
    middle = s.where("land <> '' and s_lat is not null and s_lon is not null").groupBy("land").agg(F.avg("s_lat").alias("c_lat"), F.avg("s_lon").alias("c_lon"))
    own = table(spark, d, "projects").select("row_id", key_lower(F.col("test_site_id")).alias("k"), land(), real("lat", 90).alias("p_lat"), real("lon", 180).alias("p_lon"))
    at = summarize.first_position(("project", F.col("p_lat"), F.col("p_lon")), ("test site", F.col("s_lat"), F.col("s_lon")), ("country", F.col("c_lat"), F.col("c_lon")))
    rows = own.join(s.drop("land"), "k", "left").join(middle, "land", "left").select("row_id", at.alias("x")).where("x is not null")
    return rows.select(*big("row_id"), F.round("x.lat", 6).alias("lat"), F.round("x.lon", 6).alias("lon"), "x.basis")


def precision_histogram(spark, d):
    grade = F.coalesce(F.lower(present(F.col("location_basis"))), F.lit("none"))
    return table(spark, d, "projects").groupBy(grade.alias("precision")).agg(F.count("*").alias("n"))


def example_choices(spark, d):
    """Per country the example of the latest chosen year that has one, else of the latest year."""
    o = table(spark, d, "observations").select(F.coalesce(present(F.col("reporting_country")), F.lit("")).alias("country"), trimmed("report_year").try_cast("int").alias("year"), present(F.col("evidence")).alias("text")).where("year is not null")
    per_year = o.groupBy("country", "year").agg(F.min("text").alias("text"))  # few rows a country
    g = per_year.groupBy("country").agg(F.collect_list(F.struct("year", "text")).alias("examples"))
    return g.select("country", facets.example_choice(F.col("examples"), F.array(*[F.lit(y) for y in range(2010, 2016)])).alias("example"))


def ring_areas(spark, d):
    """Area and middle of rings made of suppliers; those of odd nations lie across the date line."""
    odd = F.col("s_nationkey") % 2 == 1
    lon = F.when(odd, F.when(F.col("s_suppkey") % 3 == 0, -175.0).otherwise(172.0)).otherwise(F.col("s_suppkey") % 40 - 20.0)
    points = table(spark, d, "supplier").select("s_nationkey", "s_suppkey", F.struct((lon + F.col("s_suppkey") % 7 / 10).alias("lon"), F.round(F.col("s_acctbal") / 200, 2).alias("lat")).alias("p"))
    rings = points.groupBy("s_nationkey").agg(F.array_sort(F.collect_list(F.struct("s_suppkey", "p"))).alias("r")).where("size(r) >= 3")
    closed = rings.select("s_nationkey", F.concat(F.col("r.p"), F.array(F.col("r")[0]["p"])).alias("ring"))
    flat = closed.select("s_nationkey", facets.unwrapped(F.col("ring")).alias("ring"))
    at = flat.select("s_nationkey", facets.shoelace(F.col("ring")).alias("s"), facets.largest_ring(F.array("ring")).alias("l"))
    return at.select(*big("s_nationkey"), F.round("s.area", 4).alias("area"), F.round("l.area", 4).alias("size"), F.round("s.lon", 4).alias("lon"), F.round("s.lat", 4).alias("lat"))


def near_sites(spark, d):
    """Distance of each project's own position from its site's, in km."""
    real = lambda c: trimmed(F.col(c)).try_cast("double")
    s = table(spark, d, "test_sites").select(key_lower(F.col("site_id")).alias("k"), real("lat").alias("a"), real("lon").alias("b")).where("abs(a) <= 90 and abs(b) <= 180")
    rows = table(spark, d, "projects").select("row_id", key_lower(F.col("test_site_id")).alias("k"), real("lat").alias("x"), real("lon").alias("y")).where("abs(x) <= 90 and abs(y) <= 180")
    return rows.join(s, "k").select(*big("row_id"), F.round(facets.distance_km(F.col("x"), F.col("y"), F.col("a"), F.col("b")), 3).alias("km"))


def run_statistics(spark, d):
    """One row of counts of a run over the documents."""
    x = docs(spark, d)
    lines = structure.lines(x).agg(F.count("*").alias("n_lines"), F.count_distinct("doc_id").alias("n_read"))
    whole = x.agg(F.count("*").alias("n_documents"), F.count_if(F.length("text") > 0).alias("n_with_text"), F.sum(F.coalesce(F.length("text"), F.lit(0))).alias("n_chars"), F.count_distinct("source_file").alias("n_files"), F.min("report_year").cast("bigint").alias("first_year"), F.max("report_year").cast("bigint").alias("last_year"))
    return whole.join(lines)  # one row each


def linked_lists(spark, d):
    """Projects of each site as rows, numbered by first year and name."""
    rows = table(spark, d, "projects").select(key_lower(F.col("test_site_id")).alias("site_id"), F.coalesce(trimmed(F.col("first_seen")), F.lit("")).alias("first_year"), F.coalesce(trimmed(F.col("name")), F.lit("")).alias("name")).where("site_id is not null").distinct()
    return rows.withColumn("ord", F.row_number().over(Window.partitionBy("site_id").orderBy("first_year", "name")).cast("bigint"))


def queries() -> dict:
    names = """register_round_trip sheet_round_trip country_sheets numbered_reports rtf_reports geocoded_projects listed_words safe_cells capacity_texts device_lists overridden_sites free_acronyms reviewed_links appended_records
    centroid_positions precision_histogram example_choices ring_areas near_sites run_statistics linked_lists""".split()
    return {n: globals()[n] for n in names}


def _num(c: str) -> str:
    return f"try_cast({strip(c)} AS DOUBLE)"


_UPPER_W = r"array_to_string([upper(left(w, 1)) FOR w IN string_split(n, ' ')], '')"
_LAND = r"lower(CASE lower(trim(regexp_replace(coalesce(country, ''), '[\s\p{Z}]+', ' ', 'g'))) WHEN 'south korea' THEN 'Republic of Korea' WHEN 'korea' THEN 'Republic of Korea' WHEN 'united states of america' THEN 'United States' WHEN 'usa' THEN 'United States' ELSE trim(regexp_replace(coalesce(country, ''), '[\s\p{Z}]+', ' ', 'g')) END)"


def oracle_sql() -> dict[str, str]:
    reports = ", ".join(f"({i}, {q(t)})" for i, t in sample_reports.TEXTS)
    three = lambda x: rf"(CASE WHEN {x} >= 100 THEN printf('%.0f', {x}) WHEN {x} >= 10 THEN regexp_replace(printf('%.1f', {x}), '\.?0+$', '') ELSE regexp_replace(printf('%.2f', {x}), '\.?0+$', '') END)"
    acronym = r"regexp_extract(candidate, '\(([A-Za-z][A-Za-z0-9\-]{1,11})\)', 1)"
    short = r"regexp_replace(regexp_replace(candidate, '[\s\p{Z}]*\([^)]*\)', '', 'g'), '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')"
    norm = lambda c: rf"trim(regexp_replace(regexp_replace(lower(regexp_replace(nfc_normalize(strip_accents(regexp_replace({c}, '\p{{Z}}', ' ', 'g'))), '[^\x00-\x7F]', '', 'g')), '''', '', 'g'), '[^a-z0-9]+', ' ', 'g'))"
    return {
        "register_round_trip": "SELECT " + ", ".join(f"coalesce({c}, '') AS {c}" for c in _SITE_COLUMNS) + ", '' AS absent FROM test_sites",
        "sheet_round_trip": "SELECT n_name, n_nationkey::VARCHAR AS n_nationkey FROM nation",
        "country_sheets": f"SELECT coalesce({p('country')}, '') AS country, site_id, coalesce({p('name')}, '') AS name FROM test_sites",
        "numbered_reports": rf"WITH r AS (SELECT * FROM (VALUES {reports}) v(doc_id, text)), {_clean('r')} SELECT 'report_' || (2000 + doc_id) || '.txt' AS source_file, 2000 + doc_id::BIGINT AS report_year, trim(regexp_replace(string_agg(line, ' ' ORDER BY line_no), '[\s\p{{Z}}]+', ' ', 'g')) AS text FROM lines GROUP BY doc_id",
        "rtf_reports": f"SELECT 'report ' || (2000 + doc_id) || '.rtf' AS source_file, 2000 + doc_id::BIGINT AS report_year, text FROM (VALUES {reports}) v(doc_id, text)",
        "geocoded_projects": "SELECT * FROM (VALUES ('P1', 50.5::DOUBLE, -3.25::DOUBLE, 'exact'), ('P2', NULL, NULL, 'none'), ('P3', -10, 170.125, 'region')) v(project_id, lat, lon, tier)",
        "listed_words": r"SELECT DISTINCT trim(word) AS word FROM (SELECT word FROM common_words UNION ALL SELECT n_name FROM nation) WHERE regexp_matches(trim(word), '^\p{Ll}')",
        "safe_cells": r"SELECT row_id, left(regexp_replace(notes, '[\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g'), 32000) AS cell, replace(replace(replace(replace(notes, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;') AS html FROM projects WHERE notes IS NOT NULL".replace('\\"', '"'),
        "capacity_texts": f"WITH k AS (SELECT row_id, {_num('capacity_kw')} AS kw FROM projects) SELECT row_id, CASE WHEN kw >= 1000 THEN {three('kw / 1000')} || ' MW' ELSE {three('kw')} || ' kW' END AS power, round(3.5 + 2.3 * log10(greatest(kw, 1)), 6) AS radius FROM k WHERE kw > 0",
        "device_lists": rf"""WITH l AS (SELECT row_id, report_years, array_to_string([x FOR x IN [{p('developer')}, 'maker' || coalesce('/' || {p('device')}, '')] IF x IS NOT NULL], ', ') AS l FROM projects)
            SELECT row_id, array_to_string([y FOR y IN [regexp_replace(string_split(x, '/')[-1], '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g') FOR x IN string_split(l, ',')] IF y <> ''], ' | ') AS devices, replace(coalesce(report_years, ''), '; ', ' | ') AS rewritten FROM l""",
        "overridden_sites": f"""WITH f AS (SELECT lower({p('site_id')}) AS k, min({p('country')}) AS c FROM test_site_candidates GROUP BY 1)
            SELECT lower({p('site_id')}) AS site_id, {p('name')} AS name, coalesce(c, {p('country')}) AS country FROM test_sites LEFT JOIN f ON k = lower({p('site_id')})""",
        "free_acronyms": rf"""WITH s AS (SELECT DISTINCT n || ' (' || {_UPPER_W} || ')' AS name FROM (SELECT {p('name')} AS n FROM test_sites) WHERE n IS NOT NULL),
            a AS (SELECT name, regexp_extract(name, '\(([A-Za-z][A-Za-z0-9\-]{{1,11}})\)', 1) AS acronym FROM s),
            u AS (SELECT DISTINCT unnest(regexp_extract_all(concat_ws(' ', name, pilot_names), '[A-Za-z][A-Za-z0-9-]{{1,11}}')) AS w FROM test_sites)
            SELECT name, CASE WHEN acronym IN (SELECT w FROM u) THEN '' ELSE acronym END AS acronym FROM a""",
        "reviewed_links": f"""WITH c AS (SELECT candidate_id AS o, lower({strip('candidate')}) AS left_name, coalesce(lower({p('site_id')}), lower({p('country')}), '') AS right_name, {p('decision')} AS d, n_records > 1 AS h FROM test_site_candidates WHERE candidate IS NOT NULL),
            l AS (SELECT left_name, right_name, arg_max({{'d': d, 'h': h}}, o) AS x FROM c GROUP BY 1, 2) SELECT left_name, right_name, CASE WHEN x.d IS NOT NULL THEN x.d IN ('merged', 'added') ELSE x.h END AS is_linked FROM l""",
        "appended_records": f"""WITH r AS (SELECT primre_row_id AS o, {p('primre_website')} AS website, {p('primre_resource')} AS a, {p('location')} AS b FROM primre_only_test_sites)
            SELECT website, coalesce(string_agg(a, ' | ' ORDER BY o), '') AS primre_resource, coalesce(string_agg(b, ' | ' ORDER BY o), '') AS location FROM r WHERE website IS NOT NULL GROUP BY 1""",
        "centroid_positions": f"""WITH s AS (SELECT lower({p('site_id')}) AS k, {_LAND} AS land, CASE WHEN abs({_num('lat')}) <= 90 THEN {_num('lat')} END AS a, CASE WHEN abs({_num('lon')}) <= 180 THEN {_num('lon')} END AS b FROM test_sites),
            m AS (SELECT land, avg(a) AS a, avg(b) AS b FROM s WHERE land <> '' AND a IS NOT NULL AND b IS NOT NULL GROUP BY 1),
            r AS (SELECT row_id, lower({p('test_site_id')}) AS k, {_LAND} AS land, CASE WHEN abs({_num('lat')}) <= 90 THEN {_num('lat')} END AS a, CASE WHEN abs({_num('lon')}) <= 180 THEN {_num('lon')} END AS b FROM projects),
            x AS (SELECT row_id, CASE WHEN r.a IS NOT NULL AND r.b IS NOT NULL THEN {{'a': r.a, 'b': r.b, 'c': 'project'}} WHEN s.a IS NOT NULL AND s.b IS NOT NULL THEN {{'a': s.a, 'b': s.b, 'c': 'test site'}} WHEN m.a IS NOT NULL THEN {{'a': m.a, 'b': m.b, 'c': 'country'}} END AS x FROM r LEFT JOIN s ON s.k = r.k LEFT JOIN m ON m.land = r.land)
            SELECT row_id, round(x.a, 6) AS lat, round(x.b, 6) AS lon, x.c AS basis FROM x WHERE x IS NOT NULL""",
        "precision_histogram": f"SELECT coalesce(lower({p('location_basis')}), 'none') AS precision, count(*)::BIGINT AS n FROM projects GROUP BY 1",
        "example_choices": f"""WITH o AS (SELECT coalesce({p('reporting_country')}, '') AS country, try_cast({strip('report_year')} AS INT) AS y, min({p('evidence')}) AS t FROM observations GROUP BY 1, 2)
            SELECT country, first(t ORDER BY t IS NULL, y BETWEEN 2010 AND 2015 DESC, y DESC) AS example FROM o WHERE y IS NOT NULL GROUP BY 1""",
        "ring_areas": """WITH s AS (SELECT s_nationkey AS k, s_suppkey AS i, CASE WHEN s_nationkey % 2 = 1 THEN CASE WHEN s_suppkey % 3 = 0 THEN -175.0 ELSE 172.0 END ELSE s_suppkey % 40 - 20.0 END::DOUBLE + (s_suppkey % 7)::DOUBLE / 10 AS x, round(s_acctbal / 200, 2) AS y FROM supplier),
            c AS (SELECT k, i, x, y FROM s WHERE k IN (SELECT k FROM s GROUP BY 1 HAVING count(*) >= 3) UNION ALL SELECT k, 1000000000, arg_min(x, i), arg_min(y, i) FROM s GROUP BY k HAVING count(*) >= 3),
            j AS (SELECT *, abs(x - lag(x) OVER (PARTITION BY k ORDER BY i)) > 180 AS j FROM c),
            t AS (SELECT k, bool_or(j) AS j, count(*) FILTER (x >= 0) * 2 >= count(*) AS east FROM j GROUP BY 1),
            u AS (SELECT c.k, i, y, CASE WHEN j AND east AND x < 0 THEN x + 360 WHEN j AND NOT east AND x >= 0 THEN x - 360 ELSE x END AS x FROM c JOIN t USING (k)),
            p AS (SELECT k, x, y, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM u WINDOW w AS (PARTITION BY k ORDER BY i)),
            a AS (SELECT k, sum(x * ny - nx * y) AS s, sum((x + nx) * (x * ny - nx * y)) AS sx, sum((y + ny) * (x * ny - nx * y)) AS sy FROM p WHERE nx IS NOT NULL GROUP BY 1)
            SELECT k::BIGINT AS s_nationkey, round(s / 2, 4) AS area, round(abs(s / 2), 4) AS size, round(sx / (3 * s), 4) AS lon, round(sy / (3 * s), 4) AS lat FROM a""",
        "near_sites": f"""WITH s AS (SELECT lower({p('site_id')}) AS k, {_num('lat')} AS a, {_num('lon')} AS b FROM test_sites), r AS (SELECT row_id, lower({p('test_site_id')}) AS k, {_num('lat')} AS x, {_num('lon')} AS y FROM projects)
            SELECT row_id, round(2 * 6371.0 * asin(least(1.0, sqrt(pow(sin(radians(a - x) / 2), 2) + cos(radians(x)) * cos(radians(a)) * pow(sin(radians(b - y) / 2), 2)))), 3) AS km FROM r JOIN s USING (k) WHERE abs(a) <= 90 AND abs(b) <= 180 AND abs(x) <= 90 AND abs(y) <= 180""",
        "run_statistics": f"""WITH {_clean()} SELECT (SELECT count(*) FROM documents)::BIGINT AS n_documents, (SELECT count(*) FROM documents WHERE length(text) > 0)::BIGINT AS n_with_text, (SELECT sum(coalesce(length(text), 0)) FROM documents)::BIGINT AS n_chars,
            (SELECT count(DISTINCT source_file) FROM documents)::BIGINT AS n_files, (SELECT min(report_year) FROM documents)::BIGINT AS first_year, (SELECT max(report_year) FROM documents)::BIGINT AS last_year, count(*)::BIGINT AS n_lines, count(DISTINCT doc_id)::BIGINT AS n_read FROM lines""",
        "linked_lists": f"""WITH r AS (SELECT DISTINCT lower({p('test_site_id')}) AS site_id, coalesce({strip('first_seen')}, '') AS first_year, coalesce({strip('name')}, '') AS name FROM projects)
            SELECT site_id, first_year, name, row_number() OVER (PARTITION BY site_id ORDER BY first_year, name)::BIGINT AS ord FROM r WHERE site_id IS NOT NULL""",
        "name_aliases": rf"""WITH c AS (SELECT candidate_id, {strip('candidate')} AS candidate, {short} AS s, {acronym} AS a FROM test_site_candidates WHERE candidate IS NOT NULL)
            SELECT candidate_id, a AS acronym, array_to_string([x FOR x, i IN l IF x IS NOT NULL AND list_position(l, x) = i], ' | ') AS aliases
            FROM (SELECT *, [candidate, nullif(s, ''), CASE WHEN s LIKE 'The %' THEN s[5:] END, CASE WHEN length(a) >= 3 THEN a END] AS l FROM c)""",
        "site_slugs": rf"""WITH c AS (SELECT candidate_id, trim(left(regexp_replace({norm(f"CASE WHEN {acronym} <> '' THEN {acronym} ELSE {short} END")}, '[^a-z0-9]+', '_', 'g'), 40), '_') AS b FROM test_site_candidates WHERE candidate IS NOT NULL),
            n AS (SELECT candidate_id, CASE WHEN b = '' THEN 'site' ELSE b END AS b, row_number() OVER (PARTITION BY CASE WHEN b = '' THEN 'site' ELSE b END ORDER BY candidate_id) AS i FROM c)
            SELECT candidate_id, CASE WHEN i = 1 THEN b ELSE b || '_' || i END AS slug FROM n""",
        "json_payload": """SELECT '[' || string_agg('{"n_name":"' || n_name || '","r_name":"' || r_name || '"}', ',' ORDER BY n_name) || ']' AS payload FROM nation JOIN region ON n_regionkey = r_regionkey""",
        "candidate_phrases": rf"""WITH m AS (SELECT unnest(regexp_extract_all(text, {q(vocab.CANDIDATE.replace(chr(92) + 's', r'[' + chr(92) + 's' + chr(92) + 'p{Z}]').replace(r"[\w'.&-]", r"[\p{L}\p{M}\p{N}_'.&-]").replace(r"[\w-]", r"[\p{L}\p{M}\p{N}_-]"))})) AS t FROM documents),
            n AS (SELECT regexp_replace(regexp_replace(t, {q('(?i)^((' + '|'.join([*vocab.CANDIDATE_LEAD, *sorted(vocab.COUNTRIES, key=lambda c: (-len(c), c))]) + r')[\s\p{Z}]+)+')}, ''), '^[ ,.;:]+|[ ,.;:]+$', '', 'g') AS name FROM m)
            SELECT lower(name) AS name, count(*)::BIGINT AS n FROM n WHERE len(string_split_regex(trim(name), '[\s\p{{Z}}]+')) >= 2 AND regexp_matches(name, '^[A-Z]') AND NOT (upper(name) = name AND contains(name, 'TEST SITE')) GROUP BY 1""",
    }
