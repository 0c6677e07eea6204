import itertools

import pytest
from docengine.llm import mixing

DOCS, TARGETS = "doc_id bigint, memberships array<string>, n_tokens bigint", "source string, target_share double, max_repeats int"


def mix(spark, docs, targets, **kw):
    t = spark.createDataFrame(targets, TARGETS)
    m = mixing.mix(spark.createDataFrame(docs, DOCS), t, **kw)
    return m.collect(), mixing.shares(m, t).collect()


def test_flow_is_cheapest():
    arcs = [("S", "a", 5, 0), ("S", "a", 5, 1), ("S", "b", 4, 0), ("a", "x", 10, 0), ("a", "y", 10, 0), ("b", "y", 4, 0), ("x", "T", 6, 0), ("y", "T", 6, 0)]
    size, on = mixing.min_cost_flow(arcs, "S", "T")
    assert size == 12 and sum(f * a[3] for f, a in zip(on, arcs)) == 3
    best = min(c for b in range(5) for c in [max(0, 12 - b - 5)] if b <= 4 and 12 - b <= 10)
    assert best == 3


def test_shares_are_met_within_a_document(spark):
    docs = [(i, ["big"], 50) for i in range(400)] + [(1000 + i, ["small"], 30) for i in range(20)] + [(2000, ["other"], 99), (2001, ["big"], 0)]
    rows, report = mix(spark, docs, [("big", 0.8, 1), ("small", 0.2, 4)])
    share = {r.source: r.actual_share for r in report}
    assert share["big"] == pytest.approx(0.8, abs=0.02) and share["small"] == pytest.approx(0.2, abs=0.02)
    assert all(r.repeats <= {"big": 1, "small": 4}[r.source] for r in rows)
    assert {r.doc_id for r in rows} & {2000, 2001} == set()
    # the largest mixture: the small source is used as often as it may be
    assert sum(r.repeats * r.n_tokens for r in rows if r.source == "small") == pytest.approx(20 * 30 * 4, abs=60)


def test_overlapping_sources(spark):
    docs = [(i, ["a"], 10) for i in range(50)] + [(100 + i, ["a", "b"], 10) for i in range(50)]
    rows, report = mix(spark, docs, [("a", 0.5, 1), ("b", 0.5, 1)])
    assert {r.source: r.actual_share for r in report} == pytest.approx({"a": 0.5, "b": 0.5}, abs=0.03)
    assert all(r.doc_id >= 100 for r in rows if r.source == "b")


def test_plan_against_every_split():
    patterns = {("a",): 6, ("a", "b"): 5, ("b",): 2}
    targets = {"a": (0.5, 2), "b": (0.5, 1)}
    got = mixing.plan(patterns, targets)
    per = {s: sum(f for (p, t), f in got.items() if t == s) for s in "ab"}
    best = max(2 * min(a1 + x, b1 + y) for a1, x, y, b1 in itertools.product(range(13), range(11), range(6), range(3)) if x <= 10 and y <= 5)
    assert per["a"] == per["b"] == best // 2


def test_seed_and_total(spark):
    docs = [(i, ["s"], 10) for i in range(200)]
    a = {r.doc_id for r in mix(spark, docs, [("s", 1.0, 1)], total=500, seed=1)[0]}
    b = {r.doc_id for r in mix(spark, docs, [("s", 1.0, 1)], total=500, seed=2)[0]}
    assert len(a) == len(b) == 50 and a != b
    assert a == {r.doc_id for r in mix(spark, docs, [("s", 1.0, 1)], total=500, seed=1)[0]}


def test_empty(spark):
    assert mix(spark, [], [("s", 1.0, 1)])[0] == []
    assert mix(spark, [(1, ["s"], 5)], [])[0] == []
    assert mix(spark, [(1, None, 5), (2, ["t"], 5)], [("s", 1.0, 3)])[0] == []


def test_hot_source_and_repeated_rows(spark):
    docs = [(i % 100, ["hot"], 7) for i in range(3000)] + [(9000, ["cold"], 7)]
    rows, report = mix(spark, docs, [("hot", 0.999, 2), ("cold", 0.001, 6)])
    assert sum(r.repeats for r in rows if r.source == "hot") <= 6000
    assert {r.source: r.actual_share for r in report}["hot"] == pytest.approx(0.999, abs=0.005)


def test_query(spark, sf):
    from docengine.llm.queries import p9_mix, p9_shares

    caps = {r.source: r.max_repeats for r in spark.read.parquet(f"{sf}/mix_targets.parquet").collect()}
    of = {r.doc_id: r.source for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = p9_mix(spark, sf).collect()
    assert rows and all(of[r.doc_id] == r.source and 1 <= r.repeats <= caps[r.source] for r in rows)
    assert all(abs(r.actual_share - r.target_share) < 0.1 for r in p9_shares(spark, sf).collect())


def test_more_patterns_than_the_plan_takes(spark, monkeypatch):
    """The rarer sets of sources are narrowed to one source each; shares are met all the same and nothing fails."""
    monkeypatch.setattr(mixing, "MAX_PATTERNS", 7)
    names = "abcd"
    sets = [list(c) for n in range(1, 5) for c in itertools.combinations(names, n)]
    docs = [(i, sets[i % len(sets)], 10) for i in range(600)]
    rows, report = mix(spark, docs, [(s, 0.25, 1) for s in names])
    of = {i: m for i, m, _ in docs}
    assert {r.source: r.actual_share for r in report} == pytest.approx({s: 0.25 for s in names}, abs=0.03)
    assert all(r.source in of[r.doc_id] for r in rows) and sum(r.n_tokens * r.repeats for r in rows) >= 5000


def test_overlap_query(spark, sf):
    from docengine.llm.queries import overlapping, p9_overlap, p9_overlap_shares

    docs, targets = overlapping(spark, sf)
    of = {r.doc_id: r.memberships for r in docs.collect()}
    caps = {r.source: r.max_repeats for r in targets.collect()}
    rows = p9_overlap(spark, sf).collect()
    assert rows and all(r.source in of[r.doc_id] and r.repeats <= caps[r.source] for r in rows)
    assert len({r.source.startswith("lang ") for r in rows}) == 2
    assert all(abs(r.actual_share - r.target_share) < 0.1 for r in p9_overlap_shares(spark, sf).collect())


def test_flow_by_levels_costs_as_little():
    """Random plans of sources: both ways give a flow of the same size and cost, within capacities, and keep what goes in."""
    import random

    rnd = random.Random(4)
    for _ in range(150):
        sources, arcs = [f"s{i}" for i in range(rnd.randint(1, 4))], []
        for i in range(rnd.randint(1, 6)):
            arcs += [("S", f"p{i}", rnd.randint(1, 9), r) for r in range(rnd.randint(1, 4))]
            arcs += [(f"p{i}", x, rnd.randint(1, 20), 0) for x in rnd.sample(sources, rnd.randint(1, len(sources)))]
        arcs += [(x, "T", rnd.randint(0, 25), 0) for x in sources]
        (size, on), (want, best) = mixing.min_cost_flow_by_levels(arcs, "S", "T"), mixing.min_cost_flow(arcs, "S", "T")
        cost = lambda flow: sum(f * a[3] for f, a in zip(flow, arcs))
        assert size == want and cost(on) == cost(best) and all(0 <= f <= a[2] for f, a in zip(on, arcs))
        for x in {a[0] for a in arcs} - {"S"}:
            assert sum(f for f, a in zip(on, arcs) if a[1] == x) == sum(f for f, a in zip(on, arcs) if a[0] == x)


def test_many_patterns_keep_their_choice(spark, monkeypatch):
    """Beyond ``MAX_PATTERNS`` every set of sources keeps all its sources: the mixture is as large as with fewer."""
    docs = [(i, ["a", "b"], 10) for i in range(100)] + [(200 + i, ["a"], 10) for i in range(90)] + [(400 + i, ["a", "c"], 10) for i in range(10)]
    targets = [("a", 0.5, 1), ("b", 0.45, 1), ("c", 0.05, 1)]
    used = lambda: sum(r.n_tokens * r.repeats for r in mix(spark, docs, targets)[0])
    most = used()
    monkeypatch.setattr(mixing, "MAX_PATTERNS", 2)
    assert used() == most
