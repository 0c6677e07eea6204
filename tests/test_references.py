from datetime import datetime as D

from docengine.operators import references as R
from pyspark.sql import functions as F

CITED = "field string, row_id bigint, ref string, loaded_at timestamp_ntz"
RECORDS = "id string, loaded_at timestamp_ntz, deleted_at timestamp_ntz"


def cited(spark, *rows):
    return spark.createDataFrame([("f", i, r, t) for i, r, t in rows], CITED)


def found(spark, cites, records):
    c = cited(spark, *cites)
    state = R.apply_deltas(R.reference_deltas(c), R.existence_deltas(spark.createDataFrame(records, RECORDS), "f", F.col("id")))
    return sorted((r.row_id, r.ref) for r in R.orphan_references(c, state).collect())


def test_absent_deleted_late_and_good(spark):
    t1, t2, t3 = D(2020, 1, 1), D(2020, 1, 2), D(2020, 1, 3)
    cites = [(1, "gone", t1), (2, "dead", t2), (3, "late", t1), (4, "late", t3), (5, "good", t2), (5, "good", t2), (6, "same", t2)]
    records = [("dead", t1, t1), ("late", t2, None), ("good", t1, None), ("good", t3, None), ("same", t2, None)]
    assert found(spark, cites, records) == [(1, "gone"), (2, "dead"), (3, "late")]


def test_no_rows(spark):
    assert found(spark, [], []) == []
    assert found(spark, [(1, "x", None)], []) == [(1, "x")]
    assert found(spark, [(1, "x", None)], [("x", D(2020, 1, 1), None)]) == []


def test_hot_key_and_repeats(spark):
    t = D(2020, 1, 1)
    got = found(spark, [(i, "hot", t) for i in range(500)] * 2, [])
    assert got == [(i, "hot") for i in range(500)]


def test_deltas_take_back(spark):
    t = D(2020, 1, 1)
    c = cited(spark, (1, "x", t), (2, "x", t))
    state = R.apply_deltas(R.reference_deltas(c))
    after = R.apply_deltas(state, R.reference_deltas(c, -1))
    assert [r.n_refs for r in R.key_counts(state).collect()] == [2]
    assert after.count() == 0 and R.orphan_keys(after).count() == 0


def test_report(spark):
    c = cited(spark, (1, "x", D(2020, 1, 1)), (2, "x", D(2020, 5, 1)), (3, "y", D(2021, 1, 1)))
    got = {(r.field, r.period.year): (r.n_references, r.n_keys) for r in R.orphan_report(c).collect()}
    assert got == {("f", 2020): (2, 1), ("f", 2021): (1, 1)}


def changes(spark, *rows):
    """Deltas of a change feed: (key, loaded, deleted, whether its delivery came before)."""
    df = spark.createDataFrame(list(rows), RECORDS + ", known boolean")
    return R.existence_deltas(df, "f", F.col("id"), F.col("known"))


def test_deletions_are_signed_and_order_is_free(spark):
    import random

    t1, t2, t3 = D(2020, 1, 1), D(2020, 2, 1), D(2020, 3, 1)
    cites = R.reference_deltas(cited(spark, (1, "x", t2), (2, "y", t2), (3, "z", t1), (4, "w", t2)))
    feed = [("x", t1, None, False), ("x", t1, t2, True), ("y", t1, None, False), ("y", t1, t2, True), ("y", t3, None, False), ("y", t1, None, False), ("z", t2, None, False), ("w", t1, None, False), ("w", t1, None, True)]
    want = None
    for seed in range(4):
        random.Random(seed).shuffle(feed)
        state = None
        for lo in range(0, len(feed), 2):
            parts = [changes(spark, *feed[lo : lo + 2])] + ([state] if state is not None else [cites])
            state = R.apply_deltas(*parts)
        got = {r.ref: (r.n_refs, r.n_exists, r.first_loaded) for r in R.key_counts(state).collect()}
        assert got == {"x": (1, 0, None), "y": (1, 2, t1), "z": (1, 1, t2), "w": (1, 1, t1)}
        assert sorted(r.ref for r in R.orphan_keys(state).collect()) == ["x", "z"]
        rows = sorted(map(tuple, state.collect()), key=str)
        assert want is None or rows == want
        want = rows


def test_snapshot_equals_feed(spark):
    t1, t2 = D(2020, 1, 1), D(2020, 2, 1)
    table = R.existence_deltas(spark.createDataFrame([("a", t1, t2), ("b", t1, None)], RECORDS), "f", F.col("id"))
    feed = changes(spark, ("a", t1, None, False), ("b", t1, None, False), ("a", t1, t2, True))
    assert sorted(map(tuple, R.apply_deltas(table).collect())) == sorted(map(tuple, R.apply_deltas(feed).collect()))


def test_stream_with_deletions_equals_batch(spark, tmp_path):
    from docengine.streaming.streams import latest_state, maintain_references

    t, u = D(2020, 1, 1), D(2020, 2, 1)
    src, state = str(tmp_path / "in"), str(tmp_path / "state")
    batches = [R.reference_deltas(cited(spark, (1, "x", u), (2, "y", u))), changes(spark, ("x", t, None, False), ("y", t, None, False)), R.reference_deltas(cited(spark, (3, "x", t))), changes(spark, ("x", t, u, True)), R.reference_deltas(cited(spark, (2, "y", u)), -1)]
    assert latest_state(spark, state) is None
    for part in batches:
        part.coalesce(1).write.mode("append").parquet(src)
        maintain_references(spark.readStream.schema(R.STATE).parquet(src), state, str(tmp_path / "ck"), compact_every=2).awaitTermination()
    whole = R.apply_deltas(*batches)
    assert sorted(map(str, latest_state(spark, state).collect())) == sorted(map(str, whole.collect()))
    assert [r.ref for r in R.orphan_keys(latest_state(spark, state)).collect()] == ["x"]
    kept = sorted(p.name for p in (tmp_path / "state").iterdir() if p.name[0] in "vd")
    assert "d000000000000" not in kept and "d000000000004" in kept  # what two bases hold is dropped
