"""References to records that do not exist, kept as signed counts per key and time.

Every change is a delta: a citing row adds one to (or takes one from) the citations of a key at the row's time; a delivery adds
one to the existence of a record at its time, a deletion takes back the delivery it ends. The sum of all deltas is the state; it does
not depend on their order, and what sums to zero is gone. Keys with citations and no existence are orphans. State and deltas have
one form, so old state and new deltas are summed by the same aggregate, in batch or per micro-batch, and nothing is recounted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# ``what`` is ``cite`` or ``load``, ``at`` the time of the citing row or of the delivery, ``n`` the signed count
STATE = "field string, ref string, what string, at timestamp_ntz, n bigint"
SALTS = 16


def reference_deltas(cited: DataFrame, sign: int = 1) -> DataFrame:
    """Deltas of citations (``field``, ``ref``, ``loaded_at``); ``sign=-1`` takes them back. Null keys cite nothing."""
    return cited.where("ref is not null").select("field", "ref", F.lit("cite").alias("what"), F.col("loaded_at").cast("timestamp_ntz").alias("at"), F.lit(sign).cast("bigint").alias("n"))


def existence_deltas(records: DataFrame, field: str, key: Column, was_known: Column | None = None) -> DataFrame:
    """Deltas of records (``loaded_at``, ``deleted_at``) that ``field`` may cite.

    A row without ``deleted_at`` is a delivery: +1 at ``loaded_at``. One with it is also the end of a delivery: -1 at its ``loaded_at``.
    In a table of all records the two cancel out; of a change feed ``was_known`` tells that the delivery itself came as an
    earlier delta, so that only the -1 is new. A deletion may come before its delivery. Null keys are no records.
    """
    rows = records.select(key.alias("ref"), F.col("loaded_at").cast("timestamp_ntz").alias("at"), F.col("deleted_at").isNotNull().alias("gone"), F.coalesce(was_known if was_known is not None else F.lit(False), F.lit(False)).alias("known")).where("ref is not null")
    signs = F.when(F.col("gone") & F.col("known"), F.array(F.lit(-1))).when(F.col("known"), F.array().cast("array<int>")).when(F.col("gone"), F.array(F.lit(1), F.lit(-1))).otherwise(F.array(F.lit(1)))
    return rows.select(F.lit(field).alias("field"), "ref", F.lit("load").alias("what"), "at", F.explode(signs.cast("array<bigint>")).alias("n"))


def apply_deltas(*parts: DataFrame) -> DataFrame:
    """The state after all ``parts`` (states and deltas alike); partial sums are formed before the shuffle."""
    return reduce(DataFrame.unionByName, parts).groupBy("field", "ref", "what", "at").agg(F.sum("n").alias("n")).where("n <> 0")


def key_counts(state: DataFrame) -> DataFrame:
    """Per key: ``n_refs``, ``n_exists``, ``first_cited``, ``last_cited``, ``first_loaded``; times of what is still there."""
    of = lambda what, time: F.when((F.col("what") == what) & (F.col("n") > 0), time)
    count = lambda what: F.sum(F.when(F.col("what") == what, F.col("n")).otherwise(0))
    at = F.col("at")
    return state.groupBy("field", "ref").agg(
        count("cite").alias("n_refs"), count("load").alias("n_exists"), F.min(of("cite", at)).alias("first_cited"), F.max(of("cite", at)).alias("last_cited"), F.min(of("load", at)).alias("first_loaded")
    )


def orphan_keys(state: DataFrame) -> DataFrame:
    """Keys (``key_counts``) cited while not there: never loaded, deleted, or loaded after the first citation."""
    return key_counts(state).where("n_refs > 0 and (n_exists <= 0 or first_loaded > first_cited)")


def orphan_references(cited: DataFrame, state: DataFrame) -> DataFrame:
    """The citing rows (``field``, ``row_id``, ``ref``, ``loaded_at``) of orphan keys, one per case.

    Only the orphan keys are joined back, each once per salt, so a key cited by a third of all rows spreads over
    ``SALTS`` tasks. A row cites too early if it was loaded before its record; unknown load times never are.
    """
    bad = orphan_keys(state).select("field", "ref", "n_exists", "first_loaded", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    rows = cited.withColumn("_salt", F.pmod(F.xxhash64("row_id"), F.lit(SALTS)).cast("int"))
    hit = rows.join(bad, ["field", "ref", "_salt"]).where((F.col("n_exists") <= 0) | (F.col("loaded_at") < F.col("first_loaded")))
    return hit.select("field", "row_id", "ref", "loaded_at").dropDuplicates(["field", "row_id", "ref"])


def orphan_report(orphans: DataFrame, period: str = "year") -> DataFrame:
    """Orphan references per field and period of ``loaded_at``: citations, distinct keys."""
    return orphans.groupBy("field", F.date_trunc(period, "loaded_at").cast("timestamp_ntz").alias("period")).agg(F.count("*").alias("n_references"), F.count_distinct("ref").alias("n_keys"))
