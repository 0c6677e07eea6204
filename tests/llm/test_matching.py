from docengine.llm import matching as M
from docengine.llm.project_names import lead_of, place_of, resource_fits
from pyspark.sql import functions as F

PROJECTS = "project_id string, name string, device string, developer string, country string, technology string, primre_website string, location string, confidence string"
RECORDS = "primre_row_id string, primre_name string, country string, primre_resource string, primre_website string, location string, key string"


def run(spark, ps, rs, **kw):
    p = spark.createDataFrame([(*x, "c") for x in ps], PROJECTS)
    r = spark.createDataFrame([(*x, "c") for x in rs], RECORDS)
    return sorted((x.project_id, x.primre_row_id) for x in M.match(p, r, **kw).collect())


P = [
    ("P1", "Kelodan Mk II at Sovar Tebogan", "Kelodan Mk II", "Ramofor Energy", "France", "wave", None, "Tebogan, France"),
    ("P1", "Kelodan Mk II at Sovar Tebogan", None, None, None, None, None, None),
    ("P2", "Rilopen Hadestal Tidal Array Phase 1", None, "Sobigam Hydro", "Spain", "tidal stream", "https://rilopen-hadestal.example/", None),
    ("P3", "Mitofar Drive at Benalo Gisteron", "Mitofar Drive", "Tasebim Wave AS", "Chile", "wave", None, None),
]


def test_matches(spark):
    rs = [
        ("R1", "Wave Farm, Sovar Tebogan", "FR", "Wave", None, None), ("R2", "KELODAN MK II WAVE PARK (TEBOGAN)", None, "Wave", None, None), ("R3", "Rilopn Hadestal Tidal Turbine", "España", "Tidal", None, None),
        ("R4", "Rilopen Hadestal", "Norway", None, None, None), ("R5", "Wave Park, Benalo Gisteron", "Chile", "Thermal Gradient", None, None), ("R6", "Favaro Wave Farm - Benalo Gisteron", "Chile", "Wave", None, None),
        ("R7", None, None, None, None, None), ("R8", "Benalo Wave Farm by Tasebim Wave AS", "Chile", "Wave", None, None), ("R1", "Wave Farm, Sovar Tebogan", "FR", "Wave", None, None),
    ]
    assert run(spark, P, rs) == [("P1", "R1"), ("P1", "R2"), ("P2", "R3"), ("P3", "R8")]


def test_every_name_of_a_project_counts(spark):
    ps = [("P1", "Hydro Test", "Kelodan Mk II", "Ramofor Energy", "France", "wave", None, None)] * 2 + [("P1", "Kelodan Mk II at Sovar Tebogan", *[None] * 6)]
    ps += [("P2", "Mitofar Drive", "Mitofar Drive", "Tasebim Wave AS", "Chile", "wave", None, None)]
    rs = [("R1", "Wave Farm, Sovar Tebogan", "France", "Wave", None, None), ("R2", "Wave Park, Benalo Gisteron", "Chile", "Wave", None, None)]
    assert run(spark, ps, rs) == [("P1", "R1")]
    names = spark.createDataFrame([("P2", "Benalo Gisteron Pilot"), ("P2", "Mitofar Drive Wave Farm"), ("P2", None)], "project_id string, name string")
    assert run(spark, ps, rs, other_names=names) == [("P1", "R1"), ("P2", "R2")]


def test_empty(spark):
    assert run(spark, [], []) == [] and run(spark, P, []) == [] and run(spark, [], [("R", "x y", None, None, None, None)]) == []
    assert run(spark, [(None,) * 8], [(None,) * 6]) == []


def test_window_reaches_over_partitions(spark):
    """Matches do not depend on how the order is cut into tasks."""
    got = set()
    for n in ("1", "3", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got.add(tuple(sorted((r.project_id, r.primre_row_id) for r in _query(spark))))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(got) == 1 and got != {()}


def _query(spark):
    from docengine.llm.queries import p6_found

    return p6_found(spark, "/root/testdata/sf0.001").collect()


def test_recall_against_all_pairs(spark):
    from docengine.llm import queries as Q

    d = "/root/testdata/sf0.01"
    got = {(r.project_id, r.primre_row_id) for r in Q.p6_found(spark, d).collect()}
    fields = ["name", "device", "developer", "country", "technology", "primre_website", "location"]
    others = ["primre_name", "country", "primre_resource", "primre_website", "location"]
    p = M._usual(Q.table(spark, d, "projects").select(Q.key_upper(F.col("project_id")).alias("k"), *[Q.present(F.col(c)).alias(c) for c in fields]), "k", fields).toPandas()
    r = M._usual(Q.table(spark, d, "primre_only_test_sites").select(F.col("primre_row_id").alias("k"), *[Q.present(F.col(c)).alias(c) for c in others]), "k", others).toPandas()
    ps, rs = M._variant_rows(p), M._record_rows(r)
    best = {}
    for y in rs:
        for x in ps:
            c = M.confidence(x[2:8], y[2:8])
            if c >= M.THRESHOLD:
                best[y[1]] = min(best.get(y[1], (9, "")), (-c, x[1]))
    want = {(v[1], k) for k, v in best.items()}
    assert len(got & want) / len(want) >= 0.98 and len(got - want) <= 0.02 * len(want)


def test_hot_keys_hide_nothing(spark):
    """More rows of one key than the window has places: every pair of equal and of neighbouring keys is met."""
    rows = [("1sovar tebogan", "p", f"P{i:03}") for i in range(70)] + [("1sovar tebogan", "r", f"R{i:03}") for i in range(70)] + [("1sovar tebogam", "r", "near")]
    got = {tuple(x) for x in M._neighbours(spark.createDataFrame(rows, "key string, side string, id string"), M.WINDOW).collect()}
    assert got == {(f"P{i:03}", r) for i in range(70) for r in [*(f"R{j:03}" for j in range(70)), "near"]}


def test_window_does_not_depend_on_the_cuts(spark):
    """Sixty keys in one order, all alike: the same pairs from one task and from twenty, most of which hold fewer keys than the window."""
    import random

    rnd = random.Random(2)
    rows = [(f"1sovar teboga{a}{b}", "pr"[rnd.random() < 0.5], f"{a}{b}") for a in "abcdef" for b in "abcdefghij"]
    df, got = spark.createDataFrame(rows, "key string, side string, id string"), {}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    for n in ("1", "3", "20"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got[n] = {tuple(x) for x in M._neighbours(df, M.WINDOW).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    order = sorted(rows)
    want = set()
    for i, (_, side, one) in enumerate(order):
        for _, _, two in [x for x in order[max(0, i - 4 * M.WINDOW) : i] if x[1] != side][-M.WINDOW :]:
            want.add((one, two) if side == "p" else (two, one))
    assert got["1"] == got["3"] == got["20"] == want


def test_a_slip_in_the_first_letters_is_met(spark):
    """Neighbours need not share their first letters."""
    rs = [("R1", "Wave Farm, Tovar Tebogan", "France", "Wave", None, None)]
    assert run(spark, P, rs) == [("P1", "R1")]


def test_best_assignment_against_all():
    import random

    from docengine.llm.assignment import best_assignment

    def most(edges, keys, used=frozenset()):
        if not keys:
            return 0.0
        return max([most(edges, keys[1:], used), *(w + most(edges, keys[1:], used | {p}) for p, w in edges[keys[0]].items() if p not in used)])

    rnd = random.Random(1)
    for _ in range(400):
        edges = {f"g{i}": {f"p{j}": rnd.choice([0.6, 0.7, 0.8, rnd.random() + 0.01]) for j in range(4) if rnd.random() < 0.6} for i in range(rnd.randint(0, 5))}
        got = best_assignment(edges)
        assert len(set(got.values())) == len(got)
        assert abs(sum(edges[g][p] for g, p in got.items()) - most(edges, sorted(edges))) < 1e-9


def test_records_are_assigned_one_to_one(spark):
    """Records of one undertaking stay together; two undertakings that want one project are parted so that the total is largest."""
    edges = [("p1", "a", 0.9), ("p1", "b", 0.8), ("p1", "c", 0.95), ("p2", "c", 0.9), ("p3", "d", 0.7), ("p1", "e", 0.94)]
    records = [("a", "", "Wave", 1), ("b", "", "", 2), ("c", "France", "Wave", 1), ("d", "", "", 1), ("e", "Spain", "Tidal", 1)]
    got = M.assign(spark.createDataFrame(edges, "project_id string, record string, confidence double"), spark.createDataFrame(records, "record string, country string, kind string, n bigint"))
    # e contradicts c, the surest of p1: it has no other project; a and b go with c
    assert sorted((r.project_id, r.record) for r in got.collect()) == [("p1", "a"), ("p1", "b"), ("p1", "c"), ("p3", "d")]
    crowd = [("p", f"r{i:03}", 0.6 + i / 1000) for i in range(300)]
    lands = [(f"r{i:03}", f"land {i}", "", 1) for i in range(300)]
    got = M.assign(spark.createDataFrame(crowd, "project_id string, record string, confidence double"), spark.createDataFrame(lands, "record string, country string, kind string, n bigint"))
    assert [(r.project_id, r.record) for r in got.collect()] == [("p", "r299")]
    assert M.assign(got.limit(0), spark.createDataFrame([], "record string, country string, kind string, n bigint")).count() == 0


def test_vectorised_likeness():
    import random

    import numpy as np
    from docengine.llm.lcs import lcs_ratio, lcs_ratios

    rnd = random.Random(3)
    a, b = (["".join(rnd.choice("abcdé 火") for _ in range(rnd.choice([0, 1, 5, 12, 63, 64, 90]))) for _ in range(400)] for _ in range(2))
    assert np.allclose(lcs_ratios(np.array(a), np.array(b), chunk=64), [lcs_ratio(x, y) for x, y in zip(a, b)])
    assert len(lcs_ratios(np.array([], str), np.array([], str))) == 0


def test_parts():
    assert place_of("Ramofor Kelodan Mk II deployment, Sovar Tebogan", "Kelodan Mk II", "Ramofor Energy", "", "") == ("sovar", "tebogan")
    assert place_of("Rilopen Hadestal Tidal Array Phase 1", "", "", "", "") == ("rilopen", "hadestal")
    assert place_of("x", "", "", "https://sovar-tebogan.example/", "") == ("sovar", "tebogan")
    assert lead_of("Favaro Wave Farm - Benalo Gisteron") == ["favaro"] and lead_of("Wave Farm, Benalo Gisteron") == []
    assert resource_fits("Wave", "wave") is True and resource_fits("Wave", "OTEC") is False and resource_fits("", "wave") is None and resource_fits("Wave,Tidal", "tidal range") is True


def test_little_is_moved(spark):
    """What is shuffled stays a few times the size of both tables."""
    import os
    import time

    from docengine.llm.queries import p6_found

    def moved():
        time.sleep(1)
        told = spark.sparkContext._jsc.sc().statusStore().executorList(False)
        return sum(told.apply(i).totalShuffleWrite() for i in range(told.size()))

    d, before = "/root/testdata/sf0.01", moved()
    p6_found(spark, d).count()
    size = sum(os.path.getsize(f"{d}/{t}.parquet") for t in ("projects", "primre_only_test_sites"))
    assert 0 < moved() - before < 5 * size


def test_packed_cut_gives_the_same_rows(spark):
    from docengine.session import cut_packed

    df = spark.range(0, 25_000, 1, 3).select("id", F.when(F.col("id") % 7 > 0, F.concat(F.lit("Bökesin "), F.col("id").cast("string"))).alias("name"), F.array(F.lit("a"), F.lit(None)).alias("names"))
    kept = cut_packed(df)
    assert kept.schema == df.schema and kept.exceptAll(df).isEmpty() and df.exceptAll(kept).isEmpty()
    assert cut_packed(df.limit(0)).count() == 0


def test_pairs_of_two_lands_are_not_made(spark):
    rows = [("1sovar tebogan", "p", 1, 10), ("1sovar tebogan", "r", 2, 10), ("1sovar tebogan", "r", 3, 11), ("1sovar tebogam", "r", 4, None), ("1sovar tebogam", "r", 5, 11)]
    got = M._neighbours(spark.createDataFrame(rows, "key string, side string, id bigint, land int"), M.WINDOW).collect()
    assert sorted(tuple(x) for x in got) == [(1, 2), (1, 4)]
