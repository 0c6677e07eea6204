"""Missing values filled from similar records by a low-rank model of mixed features.

Records of one entity are first merged, so the model's rows are entities and its cells are sums and counts per feature:
numbers (standardised) and the values of categories (one feature each, 1 or 0), both as deviation from their group. Alternating
least squares over the known cells: the feature factors, a bounded table, travel to the tasks; each entity's factors are
solved where its cells are; the features' normal equations are summed per partition before they meet. A missing cell's
estimate is decoded to a valid value: the nearest one known for the entity, else the nearest to its own estimate that is
known for its group. Only an entity with no known cell at all, so without an estimate, gets its group's most central value.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..session import cut_lineage

RANK, ROUNDS, RIDGE, CATEGORY_FEATURES = 4, 4, 0.5, 64
MOST_WEIGHT = 8  # records of one entity that count, so that one with very many does not decide the factors alone
SALTS = 16
OWN_FEATURES, LOOKUPS = 48, 20_000


def _long(df: DataFrame, row_id: str, group: str, entity: str, fields: dict[str, str]) -> DataFrame:
    """One row per record and field, ``text`` as written and ``number`` for numeric fields."""
    cells = [F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("text"), (F.col(f).cast("double") if k == "number" else F.lit(None).cast("double")).alias("number")) for f, k in fields.items()]
    return df.select(F.col(row_id).alias("row_id"), F.col(group).alias("group"), F.col(entity).alias("entity"), F.explode(F.array(*cells)).alias("c")).select("row_id", "group", "entity", "c.*")


def _solve(cells: np.ndarray, weights: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Factors of each row of ``cells`` (n x features) given those of the features; weight 0 is unknown."""
    a = np.einsum("nf,fk,fl->nkl", weights, factors, factors, optimize=True) + RIDGE * np.eye(factors.shape[1])
    b = (weights * cells) @ factors
    return np.linalg.solve(a, b[:, :, None])[:, :, 0]


def _dense(pdf: pd.DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    cells, weights = np.zeros((len(pdf), width)), np.zeros((len(pdf), width))
    size = pdf["features"].map(len).to_numpy()
    at = (np.repeat(np.arange(len(pdf)), size), np.concatenate(pdf["features"].to_numpy()).astype(int)) if len(pdf) else ([], [])
    if len(pdf):
        cells[at], weights[at] = np.concatenate(pdf["cells"].to_numpy()), np.minimum(np.concatenate(pdf["weights"].to_numpy()), MOST_WEIGHT)
    return cells, weights


def fit_factors(entities: DataFrame, width: int, rank: int = RANK, rounds: int = ROUNDS, seed: int = 7) -> np.ndarray:
    """Feature factors (``width`` x ``rank``) by alternating least squares; each round is one pass and sends ``width`` rows a partition."""
    factors = np.random.default_rng(seed).normal(0, 0.3, (width, rank))
    names = [f"s{i}" for i in range(rank * rank + rank)]
    schema = "f int, " + ", ".join(f"{n} double" for n in names)
    for _ in range(rounds):
        now = factors.copy()

        def equations(frames: Iterator[pd.DataFrame], now: np.ndarray = now) -> Iterator[pd.DataFrame]:
            total = np.zeros((width, rank * rank + rank))
            for pdf in frames:
                for lo in range(0, len(pdf), 4096):
                    cells, weights = _dense(pdf.iloc[lo : lo + 4096], width)
                    u = _solve(cells, weights, now)
                    outer = np.einsum("nk,nl->nkl", u, u).reshape(len(u), -1)
                    total[:, : rank * rank] += weights.T @ outer
                    total[:, rank * rank :] += (weights * cells).T @ u
            yield pd.DataFrame(total, columns=names).assign(f=np.arange(width, dtype=np.int32))[["f", *names]]

        sums = entities.mapInPandas(equations, schema).groupBy("f").agg(*[F.sum(n).alias(n) for n in names]).orderBy("f").toPandas()
        if sums.empty:
            break
        m = sums[names].to_numpy()
        a = m[:, : rank * rank].reshape(-1, rank, rank) + RIDGE * np.eye(rank)
        factors = np.linalg.solve(a, m[:, rank * rank :, None])[:, :, 0]
    return factors


def _nearest(asked: DataFrame, values: DataFrame) -> DataFrame:
    """``group``, ``entity``, ``field``, ``own``: the value of ``values`` (``group``, ``field``, ``number``, ``text``, ``n``) nearest ``x`` of ``asked``.

    Both are sorted together per group and field; a group of many lookups is split, each part with the group's values.
    """
    parts = asked.groupBy("group", "field").agg(F.ceil(F.count("*") / LOOKUPS).cast("int").alias("_parts"))
    v = values.join(parts, ["group", "field"]).select("group", "field", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"), F.col("number").alias("x"), F.lit(None).cast("string").alias("entity"), F.struct("number", "n", "text").alias("_v"))
    q = asked.join(parts, ["group", "field"]).select("group", "field", F.pmod(F.xxhash64("entity"), F.col("_parts")).cast("int").alias("_part"), "x", "entity")
    rows = v.unionByName(q, allowMissingColumns=True)
    up = Window.partitionBy("group", "field", "_part").orderBy("x")
    down = Window.partitionBy("group", "field", "_part").orderBy(F.desc("x"))
    rows = rows.withColumns({"_a": F.last("_v", ignorenulls=True).over(up), "_b": F.last("_v", ignorenulls=True).over(down)}).where("entity is not null")
    near = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.round(F.abs(F.col(c)["number"] - F.col("x")), 9).alias("d"), (-F.col(c)["n"]).alias("n"), F.col(c)["text"].alias("text")))
    return rows.select("group", "entity", "field", F.least(near("_a"), near("_b"))["text"].alias("own"))


def impute(df: DataFrame, row_id: str, group: str, entity: str, fields: dict[str, str]) -> DataFrame:
    """Every fillable missing cell of ``df``: ``row_id``, ``field``, ``value`` (text), ``is_filled`` (true), ``basis``.

    ``fields`` names the columns and whether each is a ``number`` or a ``category``; null is missing. A cell is fillable if
    another record of the same, non-null ``group`` has a value in the field. ``basis`` tells whether the value is known for
    the same entity (``entity``) or only for its group. Empty input gives no rows; other columns of ``df`` are not read.
    """
    empty = "row_id bigint, field string, value string, is_filled boolean, basis string"
    long = _long(df.where(F.col(group).isNotNull()), row_id, group, entity, fields)
    known = long.where("text is not null").groupBy("group", "entity", "field", "text").agg(F.count("*").alias("n"), F.first("number").alias("number"))
    known = cut_lineage(known)  # distinct values per entity: the base of all that follows
    numbers = known.where("number is not null")
    # partial sums per entity come first, so a hot group is no hot task
    centre = numbers.groupBy("group", "field").agg((F.sum(F.col("number") * F.col("n")) / F.sum("n")).alias("centre"))
    mean = known.groupBy("group", "entity", "field").agg(F.sum("n").alias("n"), (F.sum(F.col("number") * F.col("n")) / F.sum(F.when(F.col("number").isNotNull(), F.col("n")))).alias("mean"))
    kinds = [f for f, k in fields.items() if k == "number"]
    categories = [f for f, k in fields.items() if k != "number"]
    index = {f: i for i, f in enumerate(kinds)}
    width = len(kinds) + CATEGORY_FEATURES * len(categories)
    base = {f: len(kinds) + CATEGORY_FEATURES * i for i, f in enumerate(categories)}
    offset = lambda m: F.create_map(*[F.lit(x) for pair in m.items() for x in pair])[F.col("field")] if m else F.lit(None).cast("int")
    deviation = mean.where(F.col("mean").isNotNull()).join(centre, ["group", "field"])
    spread = {r["field"]: r["s"] or 1.0 for r in deviation.groupBy("field").agg(F.stddev_pop(F.col("mean") - F.col("centre")).alias("s")).collect()}
    spread = {f: max(spread.get(f, 1.0), 1e-9) for f in kinds}
    scale = F.create_map(*[F.lit(x) for pair in spread.items() for x in pair])[F.col("field")] if spread else F.lit(1.0)
    numeric = deviation.select("group", "entity", offset(index).alias("feature"), ((F.col("mean") - F.col("centre")) / scale).alias("cell"), F.col("n").cast("double").alias("weight"))
    # the most frequent values have a feature of their own, the others share the rest; decoding below tells them apart again
    usual = {f: [r["text"] for r in known.where(F.col("field") == f).groupBy("text").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "text").limit(OWN_FEATURES).collect()] for f in categories}
    rank = F.create_map(*[F.lit(x) for f, ts in usual.items() for i, t in enumerate(ts) for x in (f"{f} {t}", i)]) if any(usual.values()) else F.create_map().cast("map<string,int>")
    bucket = F.coalesce(F.try_element_at(rank, F.concat_ws(" ", "field", "text")), F.lit(OWN_FEATURES) + F.pmod(F.xxhash64("text"), F.lit(CATEGORY_FEATURES - OWN_FEATURES)).cast("int"))
    told = known.where("number is null").withColumn("bucket", bucket)
    # per group and field one row of at most CATEGORY_FEATURES buckets: share, and the most frequent value in it
    values = told.groupBy("group", "field", "bucket", "text").agg(F.sum("n").alias("n"))
    values = values.groupBy("group", "field", "bucket").agg(F.sum("n").alias("n"), F.min(F.struct((-F.col("n")).alias("m"), "text")).alias("v"))
    choices = values.groupBy("group", "field").agg(F.sum("n").alias("all"), F.collect_list(F.struct("bucket", "n", "v")).alias("v"))
    choices = cut_lineage(choices.select("group", "field", F.transform("v", lambda x: F.struct(x["bucket"].alias("bucket"), (x["n"] / F.col("all")).alias("share"), x["v"]["m"].alias("m"), x["v"]["text"].alias("text"))).alias("choices")))
    # an entity that tells a category tells 0 for the group's other values
    held = told.groupBy("group", "entity", "field", "bucket").agg(F.sum("n").alias("n")).groupBy("group", "entity", "field").agg(F.sum("n").alias("all"), F.map_from_entries(F.collect_list(F.struct("bucket", "n"))).alias("held"))
    marked = held.join(choices, ["group", "field"]).select("group", "entity", "field", "all", "held", F.explode("choices").alias("c"))
    marked = marked.select("group", "entity", (offset(base) + F.col("c.bucket")).alias("feature"), (F.coalesce(F.try_element_at("held", F.col("c.bucket")), F.lit(0)) / F.col("all") - F.col("c.share")).alias("cell"), F.col("all").cast("double").alias("weight"))
    cells = numeric.unionByName(marked).groupBy("group", "entity", "feature").agg(F.avg("cell").alias("cell"), F.sum("weight").alias("weight"))
    entities = cells.groupBy("group", "entity").agg(F.collect_list(F.struct("feature", "cell", "weight")).alias("c"))
    entities = cut_lineage(entities.select("group", "entity", F.col("c.feature").alias("features"), F.col("c.cell").alias("cells"), F.col("c.weight").alias("weights")))
    factors = fit_factors(entities, width)
    names, offsets = list(fields), {**{f: (i, 1) for f, i in index.items()}, **{f: (i, CATEGORY_FEATURES) for f, i in base.items()}}

    def estimate(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            guess = _solve(*_dense(pdf, width), factors) @ factors.T
            out = pdf[["group", "entity"]].copy()
            out["estimate"] = [{}] * len(pdf)
            out["estimate"] = [[guess[i, a : a + w].tolist() for a, w in (offsets[f] for f in names)] for i in range(len(pdf))]
            yield out

    estimates = cut_lineage(entities.mapInPandas(estimate, "group string, entity string, estimate array<array<double>>"))  # read three times
    at = F.create_map(*[F.lit(x) for f in names for x in (f, names.index(f) + 1)])[F.col("field")]
    kinds_of = F.create_map(*[F.lit(x) for f, k in fields.items() for x in (f, k)])[F.col("field")]
    scored = known.join(estimates, ["group", "entity"]).join(centre, ["group", "field"], "left").join(choices, ["group", "field"], "left")
    own = F.element_at("estimate", at)
    distance = F.when(kinds_of == "number", F.abs(F.col("number") - F.col("centre") - own[0] * scale)).otherwise(-F.round(F.get(own, bucket) + F.get(F.filter("choices", lambda c: c["bucket"] == bucket), F.lit(0))["share"], 6))
    scored = scored.select("group", "entity", "field", "text", "n", F.coalesce(distance, F.lit(0.0)).alias("d"))
    of_entity = scored.groupBy("group", "entity", "field").agg(F.min_by("text", F.struct(F.col("d"), -F.col("n"), F.col("text"))).alias("own"), F.lit("entity").alias("basis"))
    of_group = known.join(centre, ["group", "field"], "left").groupBy("group", "field", "text").agg(F.sum("n").alias("n"), F.first(F.abs(F.col("number") - F.col("centre"))).alias("d"))
    of_group = of_group.groupBy("group", "field").agg(F.min_by("text", F.struct(F.coalesce("d", F.lit(0.0)), -F.col("n"), F.col("text"))).alias("shared"))
    # cells of which the entity has no value: its own estimate picks among the group's
    holes = long.where("text is null").select("group", "entity", "field").distinct().join(of_entity, ["group", "entity", "field"], "left_anti")
    holes = cut_lineage(holes.join(estimates, ["group", "entity"]).select("group", "entity", "field", own.alias("estimate")))
    asked = holes.where(kinds_of == "number").join(centre, ["group", "field"]).select("group", "entity", "field", (F.col("centre") + F.col("estimate")[0] * scale).alias("x"))
    nearest = _nearest(asked, numbers.groupBy("group", "field", "number").agg(F.sum("n").alias("n"), F.min("text").alias("text")))
    score = F.transform("choices", lambda c: F.struct((-F.round(F.get("estimate", c["bucket"]) + c["share"], 6)).alias("d"), c["m"].alias("m"), c["text"].alias("text")))
    likely = holes.where(kinds_of != "number").join(choices, ["group", "field"]).select("group", "entity", "field", F.array_min(score)["text"].alias("own"))
    decoded = of_entity.unionByName(nearest.unionByName(likely).withColumn("basis", F.lit("group")))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    missing = long.where("text is null").select("row_id", "group", "entity", "field", F.pmod(F.xxhash64("row_id"), F.lit(SALTS)).cast("int").alias("_salt"))
    filled = missing.join(of_group.select("*", salts), ["group", "field", "_salt"]).join(decoded, ["group", "entity", "field"], "left")
    out = filled.select(F.col("row_id").cast("bigint").alias("row_id"), "field", F.coalesce("own", "shared").alias("value"), F.lit(True).alias("is_filled"), F.coalesce("basis", F.lit("group")).alias("basis"))
    return out.sparkSession.createDataFrame([], empty).unionByName(out)
