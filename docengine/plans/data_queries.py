"""Queries of the register: packed fields, orphan references, units, imputation."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.missing import is_missing, key_lower, key_upper, trimmed
from ..operators import impute, packed, references, units


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _cells(df: DataFrame, key: Column, *fields: str, prefix: str = "") -> DataFrame:
    """The non-missing ``fields`` of each row as rows (``field``, ``row_key``, ``value``), in one pass."""
    each = F.explode(F.array(*[F.struct(F.lit(prefix + f).alias("field"), F.when(~is_missing(F.col(f)), F.col(f)).alias("value")) for f in fields])).alias("c")
    return df.select(key.alias("row_key"), each).select("c.field", "row_key", "c.value").where("value is not null")


def packed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value of the packed fields: ``field``, ``row_key``, ``pos``, ``value``, ``n_values``."""
    sites, projects = table(spark, sf_dir, "test_sites"), table(spark, sf_dir, "projects")
    row = F.col("row_id").cast("string")
    names = _cells(sites, key_lower(F.col("site_id")), "aliases", prefix="test_sites.").unionByName(_cells(projects, row, "primre_name", prefix="projects."))
    keys = _cells(projects, row, "obs_ids", "report_years", prefix="projects.")
    return packed.unpack(names).unionByName(packed.unpack(keys, atomic=True))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_values(spark, sf_dir).where("n_values > 1").select("field", "row_key", "pos", "value")


def citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys cited by ``projects`` rows: ``field``, ``row_id``, ``ref``, ``loaded_at``."""
    p = table(spark, sf_dir, "projects")
    pick = lambda f: F.struct(F.lit(f).alias("field"), F.when(~is_missing(F.col(f)), F.col(f)).alias("value"))
    lists = p.select("row_id", "loaded_at", F.explode(F.array(pick("pilot_project_id"), pick("obs_ids"))).alias("c")).select("c.field", "row_id", "loaded_at", "c.value").where("value is not null")
    lists = packed.unpack(lists, atomic=True).select("field", "row_id", F.upper("value").alias("ref"), "loaded_at").where(~is_missing(F.col("ref")))
    sites = p.select(F.lit("test_site_id").alias("field"), "row_id", key_lower(F.col("test_site_id")).alias("ref"), "loaded_at").where("ref is not null")
    return sites.unionByName(lists)


def reference_state(spark: SparkSession, sf_dir: str, cited: DataFrame) -> DataFrame:
    return references.apply_deltas(
        references.reference_deltas(cited),
        references.existence_deltas(table(spark, sf_dir, "test_sites"), "test_site_id", key_lower(F.col("site_id"))),
        references.existence_deltas(table(spark, sf_dir, "pilot_projects"), "pilot_project_id", key_upper(F.col("project_id"))),
        references.existence_deltas(table(spark, sf_dir, "observations"), "obs_ids", key_upper(F.col("obs_id"))),
    )


def p3_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    cited = citations(spark, sf_dir)
    return references.orphan_references(cited, reference_state(spark, sf_dir, cited))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_orphans(spark, sf_dir).select("field", "row_id", "ref")


def p3_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return references.orphan_report(p3_orphans(spark, sf_dir))


# log odds that a ``capacity_kw`` without any unit is in kW
USUAL_KW = 12.0


def capacities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stated capacities of both tables with ``watts`` and the unit decoded; a project's rows and the pilot rows it cites form one chain."""
    p, pilot = table(spark, sf_dir, "projects"), table(spark, sf_dir, "pilot_projects")
    own = units.parse_quantity(p, F.col("capacity_kw"), hint=F.col("capacity_basis")).select(
        F.lit("projects").alias("src"), F.col("row_id").cast("string").alias("row_key"), F.coalesce(key_upper(F.col("project_id")), F.concat(F.lit("row "), "row_id")).alias("chain"),
        F.col("edited_at").alias("at"), "magnitude", "unit", "is_power", "is_plain", (F.col("unit").isNull() | (F.col("unit") == "kW")).alias("is_usual"), F.lit("kW").alias("default_unit"), F.lit(USUAL_KW).alias("log_default"),
    )
    links = packed.unpack(p.select(key_upper(F.col("project_id")).alias("chain"), F.when(~is_missing(F.col("pilot_project_id")), F.col("pilot_project_id")).alias("value")).where("chain is not null and value is not null"), atomic=True)
    links = links.groupBy(F.upper("value").alias("row_key")).agg(F.min("chain").alias("linked"))
    parsed = units.parse_quantity(pilot.withColumnRenamed("project_id", "pilot_id"), F.col("capacity_max_value"), unit=F.col("capacity_max_unit"))
    parsed = parsed.withColumn("row_key", key_upper(F.col("pilot_id"))).join(links, "row_key", "left")
    theirs = parsed.select(
        F.lit("pilot_projects").alias("src"), "row_key", F.coalesce("linked", "row_key").alias("chain"), F.col("loaded_at").alias("at"), "magnitude", "unit", "is_power", "is_plain",
        (F.coalesce(F.col("capacity_max_unit"), F.lit("")) == "kW").alias("is_usual"), F.lit("kW").alias("default_unit"), F.lit(0.0).alias("log_default"),
    )
    return units.decode_units(own.unionByName(theirs), "chain", "at", ["src", "row_key"])


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capacities(spark, sf_dir).where("not (is_plain and is_usual)").select("src", "row_key", F.round("watts").cast("bigint").alias("capacity_w"))


def p4_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stated capacity in watts, with the unit decoded for it and what that rests on."""
    return capacities(spark, sf_dir).select("src", "row_key", "magnitude", F.col("unit").alias("stated_unit"), "decoded_unit", "unit_basis", F.round("watts").cast("bigint").alias("capacity_w"))


SITE_FIELDS = {"lat": "number", "lon": "number", "location_basis": "category", "capacity_basis": "category"}


def imputed(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "projects")
    lat, lon = (trimmed(F.col(c)).try_cast("double") for c in ("lat", "lon"))
    zero = (lat == 0) & (lon == 0)
    possible = lambda x, most: F.when((F.abs(x) <= most) & ~F.isnan(x) & ~F.coalesce(zero, F.lit(False)), x)
    rows = p.select(
        "row_id", key_lower(F.col("test_site_id")).alias("group"), F.coalesce(key_upper(F.col("project_id")), F.lit("")).alias("entity"),
        possible(lat, 90).alias("lat"), possible(lon, 180).alias("lon"),
        *[F.when(~is_missing(F.col(c)), trimmed(F.col(c))).alias(c) for c in ("location_basis", "capacity_basis")],
    )
    return impute.impute(rows, "row_id", "group", "entity", SITE_FIELDS)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells filled: those the model decodes a value for."""
    return imputed(spark, sf_dir).where("value is not null").select("row_id", "field")


def p7_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imputed(spark, sf_dir)


def queries() -> dict:
    return {"p2_found": p2_found, "p3_found": p3_found, "p3_report": p3_report, "p4_found": p4_found, "p4_units": p4_units, "p7_found": p7_found, "p7_filled": p7_filled}
