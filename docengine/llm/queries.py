"""Queries of the operators for training data, and their SQL."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.missing import PLACEHOLDERS, is_missing, key_lower, key_upper, present, trimmed
from ..operators import packed
from ..session import spread
from . import matching, mixing, names, quality, survivor, tokenize
from .vocabulary import MARINE


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# Trust in a row by its review status, from least to most.
TRUST = {"imported": 1, "seeded": 2, "checked": 3, "reviewed": 4}
CUT_OFF = r"(?i)(?:\.\.\.|…|\[cut\]|\(truncated\)|\[\.\.\.\]|\[truncated\]|\(cut\)|\[…\]|\(…\))\s*$"


def survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "projects")
    trust = F.create_map(*[F.lit(x) for pair in TRUST.items() for x in pair])
    rows = p.select("row_id", key_upper(F.col("project_id")).alias("project_id"), "edited_at", "capacity_kw", "latest_status", "notes", F.coalesce(F.try_element_at(trust, F.lower(trimmed(F.col("review_status")))), F.lit(0)).alias("trust"))
    usable = {f: ~is_missing(F.col(f)) for f in ("capacity_kw", "latest_status")} | {"notes": ~is_missing(F.col("notes")) & ~F.col("notes").rlike(CUT_OFF)}
    return survivor.survivors(rows, "project_id", "row_id", "trust", "edited_at", usable)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivors(spark, sf_dir).select("project_id", "field", "row_id")


def p1_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The surviving record of each project."""
    return survivor.merged_records(table(spark, sf_dir, "projects"), survivors(spark, sf_dir), "project_id", "row_id", ["capacity_kw", "latest_status", "notes"])


def facility_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every name of ``test_sites`` and ``test_site_candidates``: ``id``, ``country``, ``name``, ``is_main``."""
    sites, candidates = table(spark, sf_dir, "test_sites"), table(spark, sf_dir, "test_site_candidates")
    key = key_lower(F.col("site_id")).alias("id")
    main = sites.select(key, present(F.col("country")).alias("country"), present(F.col("name")).alias("name"), F.lit(True).alias("is_main"))
    rest = sites.select(key, present(F.col("country")).alias("country"), present(F.col("aliases")).alias("value"), present(F.col("pilot_names")).alias("joined"))
    other = packed.unpack(rest.select("id", "country", "value").where("value is not null")).select("id", "country", F.col("value").alias("name"), F.lit(False).alias("is_main"))
    pilot = rest.where("joined is not null").select("id", "country", F.explode(F.split("joined", r"\|")).alias("name"), F.lit(False).alias("is_main"))
    typed = candidates.select(key_upper(F.col("candidate_id")).alias("id"), present(F.col("country")).alias("country"), present(F.col("candidate")).alias("name"), F.lit(True).alias("is_main"))
    return main.unionByName(other).unionByName(pilot).unionByName(typed)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.pairs(p5_groups(spark, sf_dir))


def p5_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a record: the facility it names, that facility's first record and their number."""
    return names.groups(names.link_names(facility_names(spark, sf_dir), MARINE))


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    keep = lambda df, *cs: [present(F.col(c)).alias(c) for c in cs]
    p, r = table(spark, sf_dir, "projects"), table(spark, sf_dir, "primre_only_test_sites")
    projects = p.select(key_upper(F.col("project_id")).alias("project_id"), *keep(p, "name", "device", "developer", "country", "technology", "primre_website", "location"))
    records = r.select(key_upper(F.col("primre_row_id")).alias("primre_row_id"), *keep(r, "primre_name", "country", "primre_resource", "primre_website", "location"))
    other = p.select(key_upper(F.col("project_id")).alias("project_id"), present(F.col("primre_name")).alias("value")).where("project_id is not null and value is not null")
    return matching.match(projects, records, other_names=packed.unpack(other).select("project_id", F.col("value").alias("name")))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(spark, sf_dir).select("project_id", "primre_row_id")


def p6_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(spark, sf_dir)


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenize.encode(spread(table(spark, sf_dir, "documents")), keep=["doc_id"])


def p8_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of each document and where each token begins in the UTF-8 bytes of its text."""
    return tokenize.encode(spread(table(spark, sf_dir, "documents")), keep=["doc_id"], offsets="offsets")


def mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = table(spark, sf_dir, "mix_targets")
    docs = spread(table(spark, sf_dir, "documents")).where("source is not null").join(F.broadcast(targets.select("source")), "source", "left_semi")
    sized = tokenize.count_tokens(docs, keep=["doc_id", "source"]).withColumn("memberships", F.array("source"))
    return mixing.mix(sized, targets)


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(spark, sf_dir)


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.shares(mixture(spark, sf_dir), table(spark, sf_dir, "mix_targets"))


def overlapping(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Documents that stand for their source and for their language, and the target shares of both."""
    of_source = table(spark, sf_dir, "mix_targets").where("source is not null").select("source", (F.col("target_share") * 0.6).alias("target_share"), "max_repeats")
    langs = table(spark, sf_dir, "common_words").select("lang").distinct()
    of_lang = langs.select(F.concat(F.lit("lang "), "lang").alias("source"), (F.lit(0.4) / langs.count()).alias("target_share"), F.lit(2).alias("max_repeats"))
    docs = tokenize.count_tokens(spread(table(spark, sf_dir, "documents")), keep=["doc_id", "source", "lang"])
    sized = docs.withColumn("memberships", F.array_compact(F.array("source", F.concat(F.lit("lang "), "lang"))))
    return sized, of_source.unionByName(of_lang)


def p9_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture where a document may stand for its source or for its language."""
    return mixing.mix(*overlapping(spark, sf_dir))


def p9_overlap_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, targets = overlapping(spark, sf_dir)
    return mixing.shares(mixing.mix(docs, targets), targets)


def qualities(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = frozenset(r["word"] for r in table(spark, sf_dir, "common_words").select("word").distinct().collect())  # a fixed table
    return quality.classify(spread(table(spark, sf_dir, "documents")), words)


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qualities(spark, sf_dir).where("kind != 'prose'").select("doc_id", "kind")


def p10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qualities(spark, sf_dir)


def queries() -> dict:
    return {"p1_found": p1_found, "p1_records": p1_records, "p5_found": p5_found, "p5_groups": p5_groups, "p6_found": p6_found, "p6_matches": p6_matches, "p8_ids": p8_ids, "p8_offsets": p8_offsets, "p9_mix": p9_mix, "p9_shares": p9_shares, "p9_overlap": p9_overlap, "p9_overlap_shares": p9_overlap_shares, "p10_found": p10_found, "p10_quality": p10_quality}


_HOLES = ", ".join(f"'{p}'" for p in PLACEHOLDERS)
_MISSING = "({0} IS NULL OR trim({0}) = '' OR lower(trim({0})) IN (" + _HOLES + "))"

P1_SQL = f"""
WITH r AS (
  SELECT row_id, upper(trim(project_id)) AS project_id, coalesce(edited_at, TIMESTAMP '0001-01-01') AS edited,
         CASE review_status WHEN 'imported' THEN 1 WHEN 'seeded' THEN 2 WHEN 'checked' THEN 3 WHEN 'reviewed' THEN 4 ELSE 0 END AS trust,
         capacity_kw, latest_status, notes FROM projects WHERE NOT {_MISSING.format("project_id")}),
n AS (SELECT project_id FROM r GROUP BY 1 HAVING count(*) > 1),
u AS (
  SELECT project_id, 'capacity_kw' AS field, row_id, trust, edited FROM r WHERE NOT {_MISSING.format("capacity_kw")}
  UNION ALL SELECT project_id, 'latest_status', row_id, trust, edited FROM r WHERE NOT {_MISSING.format("latest_status")}
  UNION ALL SELECT project_id, 'notes', row_id, trust, edited FROM r WHERE NOT {_MISSING.format("notes")}
    AND NOT regexp_matches(trim(notes), '(\\.\\.\\.|…|\\[cut\\]|\\(truncated\\))$')),
k AS (SELECT *, row_number() OVER (PARTITION BY project_id, field ORDER BY trust DESC, edited DESC, row_id) AS i FROM u WHERE project_id IN (SELECT project_id FROM n))
SELECT project_id, field, row_id FROM k WHERE i = 1
"""


P1_RECORDS_SQL = P1_SQL.replace("SELECT project_id, field, row_id FROM k WHERE i = 1", """, w AS (SELECT project_id, field, row_id FROM k WHERE i = 1)
SELECT project_id, max(CASE WHEN field = 'capacity_kw' THEN p.capacity_kw END) AS capacity_kw, max(CASE WHEN field = 'latest_status' THEN p.latest_status END) AS latest_status, max(CASE WHEN field = 'notes' THEN p.notes END) AS notes
FROM w JOIN (SELECT row_id, capacity_kw, latest_status, notes FROM projects) p USING (row_id) GROUP BY 1""")


def oracle_sql() -> dict[str, str]:
    return {"p1_found": P1_SQL, "p1_records": P1_RECORDS_SQL}
