import duckdb
import numpy as np
from docengine.operators import impute

FIELDS = {"lat": "number", "basis": "category"}
SCHEMA = "row_id bigint, g string, e string, lat double, basis string, extra string"


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    return {(r.row_id, r.field): (r.value, r.basis) for r in impute.impute(df, "row_id", "g", "e", FIELDS).collect()}


def test_fills_from_entity_then_group(spark):
    got = run(spark, [(1, "a", "p", 50.5, None), (2, "a", "p", None, "region"), (3, "a", "q", None, None), (4, "b", "r", None, "place"), (5, None, "s", None, None), (6, "a", "q", 50.7, "region")])
    assert got[2, "lat"] == ("50.5", "entity")
    assert got[3, "lat"] == ("50.7", "entity")
    assert got[1, "basis"] == ("region", "entity")
    assert got[3, "basis"] == ("region", "entity")
    assert set(got) == {(1, "basis"), (2, "lat"), (3, "lat"), (3, "basis")}


def test_group_without_values_and_no_rows(spark):
    assert run(spark, [(1, "a", "p", None, None), (2, "a", "p", None, None)]) == {}
    assert run(spark, []) == {}


def test_values_are_valid_and_whole(spark):
    rnd = np.random.default_rng(0)
    rows = [(i, f"g{i % 3}" if i % 5 else "hot", f"e{i % 40}", None if rnd.random() < 0.3 else round(float(i % 3 + rnd.random()), 3), None if rnd.random() < 0.4 else f"c{i % 4}") for i in range(600)]
    got = run(spark, rows)
    groups = {}
    for i, g, _, lat, basis in rows:
        groups.setdefault((g, "lat"), set()).update([str(lat)] if lat is not None else [])
        groups.setdefault((g, "basis"), set()).update([basis] if basis else [])
    assert len(got) == sum(r[3] is None for r in rows) + sum(r[4] is None for r in rows)
    by_id = {r[0]: r for r in rows}
    assert all(v in groups[by_id[i][1], f] for (i, f), (v, _) in got.items())


def test_many_categories_share_features(spark):
    rows = [(i, "g", f"e{i}", 1.0, f"category {i}") for i in range(300)] + [(1000, "g", "e7", None, None)]
    assert run(spark, rows)[1000, "basis"] == ("category 7", "entity")


def test_group_cells_follow_the_entity(spark):
    """In each group the category tells the side a project lies on; those with only one of both get what goes with it."""
    rows = [(100 * g + i, f"g{g}", f"e{g}-{i}", g * 10 + (1.0 if i % 2 else -1.0), "north" if i % 2 else "south") for g in range(4) for i in range(30)]
    more = [(1001, "g1", "x", None, "north"), (1002, "g1", "y", None, "south"), (1003, "g2", "z", 21.0, None), (1004, "g2", "w", 19.0, None), (1005, "g2", "v", None, None)]
    got = run(spark, rows + more)
    assert [got[i, f] for i, f in ((1001, "lat"), (1002, "lat"), (1003, "basis"), (1004, "basis"))] == [("11.0", "group"), ("9.0", "group"), ("north", "group"), ("south", "group")]
    assert (1005, "lat") in got and (1005, "basis") in got


def test_low_rank_is_recovered():
    rnd = np.random.default_rng(2)
    u, v = rnd.normal(size=(200, 2)), rnd.normal(size=(6, 2))
    full = u @ v.T
    weights = (rnd.random(full.shape) < 0.7).astype(float)
    factors = rnd.normal(0, 0.3, (6, 2))
    for _ in range(60):
        rows = impute._solve(full, weights, factors)
        factors = impute._solve(full.T, weights.T, rows)
    error = np.abs(impute._solve(full, weights, factors) @ factors.T - full)[weights == 0]
    assert np.median(error) < 0.15


def test_query_against_sql(spark, sf):
    from docengine.plans.data_queries import p7_found
    from docengine.plans.reference_sql import oracle_sql

    duckdb.sql(f"create or replace view projects as select * from '{sf}/projects.parquet'")
    assert sorted(p7_found(spark, sf).collect()) == sorted(duckdb.sql(oracle_sql()["p7_found"]).fetchall())
