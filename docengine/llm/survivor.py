"""The surviving record of each duplicate group, chosen field by field by skyline layers.

Record A dominates B if A has every field B has, is at least as trusted and at least as recent, and better in one of them.
The records no other dominates are layer 1, those only layer 1 dominates are layer 2, and so on. A field's value comes from
the first layer that has one; within a layer the policy is lexicographic: trust, then recency, then the smaller row id.

Of records with the same set of fields and the same trust only the most recent can win, so each group is first reduced to at
most (2^fields x trust levels) records by one aggregate with partial sums; a group of any size is then a bounded array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def survivors(df: DataFrame, key: str, row_id: str, trust: str, recency: str, usable: dict[str, Column], min_rows: int = 2) -> DataFrame:
    """``key``, ``field``, ``row_id``, ``layer``: for each group and field the row whose value survives.

    ``usable`` gives per field whether a row's value can be used; ``trust`` is an integer (higher is better, null lowest),
    ``recency`` is ordered (null is earliest). Groups with fewer than ``min_rows`` rows, null keys and fields no row has
    are left out; there are at most 62 fields. Ties in trust and recency go to the smaller ``row_id``. Other columns are ignored, empty input is empty.
    """
    fields = list(usable)
    if len(fields) > 62:
        raise ValueError("at most 62 fields: choose the others in a second call")
    bits = sum((F.when(F.coalesce(c, F.lit(False)), F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint")) for i, c in enumerate(usable.values())), F.lit(0).cast("bigint"))
    rows = df.where(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), F.col(row_id).alias("_row"), bits.alias("_has"), F.coalesce(F.col(trust).cast("int"), F.lit(-1)).alias("_trust"),
        F.coalesce(F.unix_micros(F.col(recency).cast("timestamp")), F.lit(-(2**62))).alias("_at"),
    )
    best = rows.groupBy("_key", "_has", "_trust").agg(F.max(F.struct(F.col("_at"), (-F.col("_row")).alias("_neg"))).alias("m"), F.count("*").alias("_n"))
    groups = best.groupBy("_key").agg(F.sum("_n").alias("_n"), F.collect_list(F.struct("_has", "_trust", F.col("m._at").alias("_at"), (-F.col("m._neg")).alias("_row"))).alias("_all"))
    groups = groups.where((F.col("_n") >= min_rows) & F.exists("_all", lambda r: r["_has"] > 0))

    def dominates(a: Column, b: Column) -> Column:
        covers = a["_has"].bitwiseAND(b["_has"]) == b["_has"]
        better = (a["_has"] != b["_has"]) | (a["_trust"] > b["_trust"]) | (a["_at"] > b["_at"])
        return covers & (a["_trust"] >= b["_trust"]) & (a["_at"] >= b["_at"]) & better

    def peel(state: Column, step: Column) -> Column:
        """Moves the undominated of the rest into ``done`` with the layer's number."""
        rest = state["rest"]
        front = F.filter(rest, lambda b: ~F.exists(rest, lambda a: dominates(a, b)))
        marked = F.transform(front, lambda r: F.struct(step.alias("layer"), (-r["_trust"]).alias("untrust"), (-r["_at"]).alias("age"), r["_row"].alias("row"), r["_has"].alias("has")))
        return F.struct(F.filter(rest, lambda b: F.exists(rest, lambda a: dominates(a, b))).alias("rest"), F.concat(state["done"], marked).alias("done"))

    layers = F.sequence(F.lit(1), F.size("_all"))
    empty = F.array().cast("array<struct<layer:int,untrust:int,age:bigint,row:bigint,has:bigint>>")
    peeled = F.aggregate(layers, F.struct(F.col("_all").alias("rest"), empty.alias("done")), lambda s, i: F.when(F.size(s["rest"]) > 0, peel(s, i)).otherwise(s))
    ranked = groups.select("_key", F.array_sort(peeled["done"]).alias("_done"))

    def first_with(i: int) -> Column:
        return F.get(F.filter("_done", lambda r: r["has"].bitwiseAND(F.lit(1 << i).cast("bigint")) != 0), F.lit(0))

    chosen = F.array(*[F.struct(F.lit(f).alias("field"), first_with(i).alias("r")) for i, f in enumerate(fields)])
    out = ranked.select("_key", F.explode(chosen).alias("c")).where("c.r is not null")
    return out.select(F.col("_key").alias(key), F.col("c.field").alias("field"), F.col("c.r.row").alias(row_id), F.col("c.r.layer").alias("layer"))


def merged_records(df: DataFrame, chosen: DataFrame, key: str, row_id: str, fields: list[str]) -> DataFrame:
    """One record per group with each of ``fields`` taken from its surviving row."""
    wanted = chosen.select(F.col(key).alias("_key"), "field", F.col(row_id).alias("_row"))
    values = df.select(F.col(row_id).alias("_row"), F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])).alias("c"))
    joined = wanted.join(values.select("_row", "c.*"), ["_row", "field"])
    return joined.groupBy(F.col("_key").alias(key)).agg(*[F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in fields])
