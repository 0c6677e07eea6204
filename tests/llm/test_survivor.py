import itertools
import random
from datetime import datetime, timedelta

import duckdb
import pytest
from docengine.llm import survivor
from pyspark.sql import functions as F

SCHEMA = "k string, row_id bigint, trust int, at timestamp, a string, b string, layer string"


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    out = survivor.survivors(df, "k", "row_id", "trust", "at", {"a": F.col("a").isNotNull(), "b": F.col("b").isNotNull()}, **kw)
    return {(r.k, r.field): (r.row_id, r.layer) for r in out.collect()}


def brute(rows):
    """Layers by definition over all rows of a group, then the policy."""
    out = {}
    for k, g in itertools.groupby(sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]), key=lambda r: r[0]):
        g = list(g)
        if len(g) < 2:
            continue
        rest = [(r[1], (r[4] is not None, r[5] is not None), -1 if r[2] is None else r[2], datetime.min if r[3] is None else r[3]) for r in g]

        def dom(x, y):
            ge = all(p >= q for p, q in zip(x[1], y[1])) and x[2] >= y[2] and x[3] >= y[3]
            return ge and (x[1], x[2], x[3]) != (y[1], y[2], y[3])

        layer, found = 1, {}
        while rest:
            front = [y for y in rest if not any(dom(x, y) for x in rest)]
            for i, f in enumerate("ab"):
                have = [x for x in front if x[1][i]]
                if f not in found and have:
                    t = max((x[2], x[3]) for x in have)
                    found[f] = (min(x[0] for x in have if (x[2], x[3]) == t), layer)
            rest = [y for y in rest if y not in front]
            layer += 1
        out |= {(k, f): v for f, v in found.items()}
    return out


def test_random_groups_equal_brute_force(spark):
    rnd = random.Random(5)
    day = datetime(2020, 1, 1)
    rows = [(f"k{rnd.randrange(30)}", i, rnd.choice([None, 0, 1, 2]), rnd.choice([None, day + timedelta(days=rnd.randrange(4))]), rnd.choice([None, "v"]), rnd.choice([None, "w"])) for i in range(300)]
    got, want = run(spark, rows), brute(rows)
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}


def test_edges(spark):
    t = datetime(2020, 1, 1)
    assert run(spark, []) == {}
    assert run(spark, [("one", 1, 1, t, "x", "y"), (None, 2, 1, t, "x", "y"), (None, 3, 1, t, "x", "y")]) == {}
    assert run(spark, [("k", 1, 1, t, None, None), ("k", 2, 1, t, None, None)]) == {}
    assert run(spark, [("k", 9, 1, t, "x", None), ("k", 4, 1, t, "x", None)])["k", "a"] == (4, 1)
    assert run(spark, [("k", 1, None, None, "x", None), ("k", 2, 3, t, None, "y")]) == {("k", "a"): (1, 1), ("k", "b"): (2, 1)}


def test_second_layer_fills(spark):
    t = datetime(2020, 1, 1)
    # a is only held by a row that another row with the same fields and more trust dominates
    rows = [("k", 1, 1, t, "x", "y"), ("k", 2, 2, t, "x", "y"), ("k", 3, 3, t, None, None)]
    assert run(spark, rows)["k", "a"] == (2, 1)


def test_hot_group_is_reduced_first(spark):
    df = spark.range(20000).select(F.lit("hot").alias("k"), F.col("id").alias("row_id"), (F.col("id") % 5).cast("int").alias("trust"), F.timestamp_seconds("id").alias("at"), F.lit("x").alias("a"), F.lit(None).cast("string").alias("b"))
    out = survivor.survivors(df, "k", "row_id", "trust", "at", {"a": F.col("a").isNotNull(), "b": F.col("b").isNotNull()}).collect()
    assert [(r.field, r.row_id) for r in out] == [("a", 19999)]


def test_query_against_sql(spark, sf):
    from docengine.llm.queries import P1_SQL, p1_found, p1_records

    duckdb.sql(f"create or replace view projects as select * from '{sf}/projects.parquet'")
    want = sorted(duckdb.sql(P1_SQL).fetchall())
    assert sorted(p1_found(spark, sf).collect()) == want
    assert p1_records(spark, sf).count() == len({r[0] for r in want})


def test_many_fields(spark):
    wide = spark.range(2).select(F.lit("k").alias("k"), "id", F.lit(1).alias("trust"), F.lit(None).cast("timestamp_ntz").alias("at"), *[F.when(F.col("id") == i % 2, "x").alias(f"f{i}") for i in range(40)])
    usable = {f"f{i}": F.col(f"f{i}").isNotNull() for i in range(40)}
    got = {r.field: r.id for r in survivor.survivors(wide, "k", "id", "trust", "at", usable).collect()}
    assert got == {f"f{i}": i % 2 for i in range(40)}
    with pytest.raises(ValueError):
        survivor.survivors(wide, "k", "id", "trust", "at", {f"g{i}": F.lit(True) for i in range(63)})
