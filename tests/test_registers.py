import math

import pytest
from docengine.functions import vocab
from docengine.operators import facets, resolve, summarize as S, terms
from pyspark.sql import functions as F


def test_project_years(spark):
    cols = "project_id string, report_year int, doc_id bigint, a int, term string, reporting_country string, section string, section_kind string, line int, resolution string, context string, source_file string"
    rows = [("P", 2010, 1, 5, "t2", "France", "", None, 3, "context: x", "c1", "f1"), ("P", 2010, 1, 1, "t1", "Spain", "S", "planned", 1, "context: y", "c2", "f1"), ("P", 2010, 2, 1, "t2", "France", "S", None, 9, "unique term", "c3", "f2"), (None, 2010, 2, 1, "t", "", "", None, 1, "ambiguous", "c", "f")]
    r = S.project_years(spark.createDataFrame(rows, cols)).collect()
    assert len(r) == 1 and (r[0].n_mentions, r[0].terms_matched, r[0].reporting_countries, r[0].sections, r[0].lines, r[0].example_context, r[0].source_file) == (3, "t1; t2", "Spain; France", "S", "1; 3; 9", "c3", "f1")


def test_recall(spark):
    v = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], "k string, y int")
    f = spark.createDataFrame([("a", 1), ("b", 1), ("z", 2), ("a", 1)], "k string, y int")
    assert tuple(S.recall(f, v).first()) == (2, 3, 67, 1)
    assert tuple(S.recall(f.limit(0), v.limit(0)).first()) == (0, 0, 0, 0)


def test_site_summary_keeps_unmentioned(spark):
    s = spark.createDataFrame([("a", "A"), ("b", "B")], "site_id string, site_name string")
    m = spark.createDataFrame([("b", 2012, "x"), ("b", 2010, "x"), ("b", 2010, "w")], "site_id string, report_year int, reporting_country string")
    r = S.site_summary(s, m).collect()
    assert [(x.site_id, x.n_mentions, x.n_reports, x.years_mentioned, x.reporting_countries) for x in r] == [("b", 3, 2, "2010, 2012", "w; x"), ("a", 0, 0, "", "")]


def test_ordered_refs_and_appended(spark):
    p = spark.createDataFrame([(1, ["b", "x", "a"]), (2, [])], "k int, refs array<string>")
    t = spark.createDataFrame([("a", "A"), ("b", "B")], "id string, v string")
    assert [(r.k, r.v) for r in S.ordered_refs(p, "k", "refs", t, "id", "v").collect()] == [(1, ["B", "A"])]
    d = spark.createDataFrame([(1, 2, "x", ""), (1, 1, "y", None), (2, 1, "", "z")], "k int, o int, f string, g string")
    assert sorted(map(tuple, S.appended(d, "k", ["f", "g"], "o").collect())) == [(1, "y | x", ""), (2, "", "z")]


def test_capacity_by_source(spark):
    base = spark.createDataFrame([(1,), (2,), (3,), (4,)], "k int")
    a = spark.createDataFrame([(1, "0.5", "MW"), (1, "700", "kW"), (2, "x", "kW"), (3, "-1", "kW")], "k int, value string, unit string")
    b = spark.createDataFrame([(1, "9", "MW"), (2, "2", "MW"), (3, "5", "kW")], "k int, value string, unit string")
    got = {r.k: (r.capacity_kw, r.source) for r in S.filled_capacity(base, "k", [("a", a), ("b", b)]).collect()}
    assert got == {1: (700.0, "a"), 2: (2000.0, "b"), 3: (None, None), 4: (None, None)}


def test_positions_and_status(spark):
    d = spark.createDataFrame([(None, 1.0, 5.0, 6.0), (1.0, 2.0, 5.0, 6.0), (None, None, None, 1.0)], "a double, b double, c double, d double")
    at = [r[0] for r in d.select(S.first_position(("x", F.col("a"), F.col("b")), ("y", F.col("c"), F.col("d")))).collect()]
    assert [tuple(x) if x else None for x in at] == [(5.0, 6.0, "y"), (1.0, 2.0, "x"), None]
    s = spark.createDataFrame([("on", 2010, "z"), ("", 2010, "z"), (None, None, ""), ("on", None, "")], "s string, y int, o string")
    assert [r[0] for r in s.select(S.status_with_fallback(F.col("s"), F.col("y"), F.col("o"))).collect()] == ["on (2010)", "z", None, "on"]


def test_sequential_ids(spark):
    d = spark.range(1000).select((999 - F.col("id")).alias("k"))
    got = [r.new_id for r in S.sequential_ids(d, ["k"], after=5).orderBy("k").collect()]
    assert got == [f"P{i + 6:04d}" for i in range(1000)]
    assert S.sequential_ids(d.limit(0), ["k"]).count() == 0


def test_facets(spark):
    d = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 2.0), ("b", "x", 4.0), (None, "x", None)], "f string, g string, m double")
    got = {(r.facet, r.value): (r.n, r.total) for r in facets.facet_counts(d, {"f": ["a"], "g": ["x"]}, "m").collect()}
    assert got == {("f", "a"): (1, 1.0), ("f", "b"): (1, 4.0), ("f", None): (1, 0.0), ("g", "x"): (1, 1.0), ("g", "y"): (1, 2.0)}


def test_geometry(spark):
    ring = "array<struct<lon:double,lat:double>>"
    square = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0), (0.0, 0.0)]
    far = [(179.0, 0.0), (-179.0, 0.0), (-179.0, 1.0), (179.0, 1.0), (179.0, 0.0)]
    r = spark.createDataFrame([(square,), (far,), ([],)], f"r {ring}").select(facets.shoelace(F.col("r")).alias("s"), facets.unwrapped(F.col("r")).alias("u")).collect()
    assert tuple(r[0].s) == (4.0, 1.0, 1.0) and [p.lon for p in r[0].u] == [0, 2, 2, 0, 0]
    assert max(p.lon for p in r[1].u) - min(p.lon for p in r[1].u) == 2.0 and r[2].s.area == 0
    big = spark.createDataFrame([([square, [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]],)], f"r array<{ring}>").select(facets.largest_ring(F.col("r")).alias("x")).first().x
    assert tuple(big) == (4.0, 1.0, 1.0)
    s = facets.spiral(spark.createDataFrame([(1, 5.0), (2, 9.0)], "k int, w double").withColumn("p", F.lit("x")), ["p"], ["-w"]).orderBy("n").collect()
    assert s[0].k == 2 and s[0].dx == 0 and s[1].dx == pytest.approx(6 * math.cos(facets.GOLDEN_ANGLE))
    d = spark.range(1).select(facets.distance_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)).alias("d")).first().d
    assert d == pytest.approx(math.pi * 6371)


def test_examples_and_colours(spark):
    e = spark.createDataFrame([([("2010", "a"), ("2012", None), ("2011", "b")],)], "e array<struct<year:string,text:string>>")
    pick = lambda ys: e.select(facets.example_choice(F.col("e"), F.array(*[F.lit(y) for y in ys]))).first()[0]
    assert pick(["2010", "2012"]) == "a" and pick(["1999"]) == "b"
    y = spark.createDataFrame([(["2010", "2015"],)], "y array<string>").select(facets.colour_year(F.col("y"), F.array(F.lit("2010"), F.lit("2015"))), facets.colour_year(F.col("y"), F.array(F.lit("1999")))).first()
    assert tuple(y) == ("2015", None)


SITES = [("s1", "National Blue Head Test Site (NBH)", "France", ["Blue Head", "BlueHd"]), ("s2", "Weihai Test Site", "China", []), ("s3", "Brehat Tidal Site", "", ["x"]), ("s4", "Marine Test Site (Zhoushan Deep)", "China", [])]


def test_tiers(spark):
    s = spark.createDataFrame(SITES, "site_id string, name string, country string, aliases array<string>")
    ns = [("n1", "blue head", "France"), ("n2", "BlueHd lab at sea", None), ("n3", "Brahat Tidal", "France"), ("n4", "Zhuhai", "China"), ("n5", "National Comprehensive Zhoushan Deep Water Test Site", "China"), ("n6", "blue head", "Spain"), ("n7", "Foo (NBH)", ""), ("n8", "", ""), ("n9", None, None), ("n10", "x", "France")]
    got = {r.name_id: (r.site_id, r.tier) for r in resolve.match_tiers(spark.createDataFrame(ns, "name_id string, name string, country string"), s).collect()}
    assert got == {"n1": ("s1", 1), "n2": ("s1", 2), "n3": ("s3", 3), "n5": ("s4", 4), "n10": ("s3", 1)} | ({"n7": got["n7"]} if "n7" in got else {})
    assert resolve._same_places("brehat tidal", "brahat tidal") and not resolve._same_places("weihai", "zhuhai")


def test_links_decided(spark):
    p = spark.createDataFrame([(1, "a", "b", None, "high"), (2, "a", "b", "different", "high"), (3, "c", "d", "Unsure: check", "low"), (4, "e", "f", None, "low"), (5, "g", "h", "match", None)], "ord int, left_name string, right_name string, verdict string, confidence string")
    assert {r.left_name: r.is_linked for r in resolve.decided_links(p).collect()} == {"a": False, "c": True, "e": False, "g": True}


def test_drop_reasons(spark):
    ts = {"ab": "too short", "One Two Three Four Five Six Seven": "descriptive (long)", "sea wolf": "descriptive (lower-case)", "Sea wolf": "descriptive (lower-case words)", "Marina di Pisa": "", "Blue Head": "test-site name", "France": "country name", "Wave Energy": "generic words only", "Many": "ordinary word", "CorMany": "", "OE35": "", "Desalination": "ordinary word"}
    arr = lambda *x: F.array(*[F.lit(v) for v in x])
    df = spark.createDataFrame([(t,) for t in ts], "t string").select("t", terms.drop_reason(F.col("t"), arr("Blue Head"), arr("France"), arr("many")).alias("r"))
    assert {r.t: r.r for r in df.collect()} == ts


def test_prune(spark):
    rows = [("p", "Fair Head", 3, ""), ("p", "Fair Head Array", 2, ""), ("p", "Other", 0, ""), ("q", "Long Term", 0, ""), ("q", "Short", 0, ""), ("q", "Longest Term", 0, ""), ("r", "Acme", 1, "place name"), ("r", "Acme Two", 1, "")]
    got = {r.project_id: r.terms for r in terms.prune(spark.createDataFrame(rows, "project_id string, term string, n_hits int, flags string")).collect()}
    assert got == {"p": ["Fair Head"], "q": ["Short", "Long Term"], "r": ["Acme", "Acme Two"]}


def test_flags(spark):
    t = spark.createDataFrame([("p", "Foo"), ("q", "Foo"), ("p", "Bar")], "project_id string, term string")
    h = spark.createDataFrame([("Foo", 70, [2010, 2011])], "term string, n_hits bigint, years array<int>")
    got = {(r.project_id, r.term): (r.n_hits, r.n_years, r.flags) for r in terms.flags(t, h, F.col("term") == "Bar").collect()}
    assert got == {("p", "Foo"): (70, 2, "shared with q; frequent (70)"), ("q", "Foo"): (70, 2, "shared with p; frequent (70)"), ("p", "Bar"): (0, 0, "place name")}


def test_vocabulary_is_consistent():
    assert set(vocab.COUNTRIES.values()) >= {"France", "United Kingdom"} and len(vocab.SECTIONS) == 21 and len(vocab.TECHNOLOGIES) == len(vocab.STATUS) == 7


def test_corrections(spark):
    d = spark.createDataFrame([("a", "x", "1"), ("b", "y", None)], "k string, v string, w string")
    c = spark.createDataFrame([("b", None, "9", "z"), ("q", "n", "n", "n")], "k string, v string, w string, extra string")
    assert sorted(map(tuple, S.overridden(d, c, "k").collect())) == [("a", "x", "1"), ("b", "y", "9")]


def test_alike_names_lose_no_pair(spark):
    """The filter of the third tier against all pairs of random names: what reaches the ratio is compared."""
    import random
    from difflib import SequenceMatcher

    from docengine.operators import resolve

    rnd = random.Random(3)

    def slips(w):
        w = list(w)
        for _ in range(rnd.randint(0, 3)):
            i = rnd.randrange(len(w))
            w[i : i + 1] = rnd.choice([[], [w[i], rnd.choice("abcd")], [rnd.choice("abcd")]]) if len(w) > 4 else [w[i]]
        return "".join(w)

    base = ["".join(rnd.choice("abcd ") for _ in range(rnd.randint(5, 24))).strip() for _ in range(120)] + ["bcdefghijk", "abcdefghijkl", "abcde", "abde"]
    names, cores = sorted({x for x in base if len(x) >= 5}), sorted({slips(b) for b in base if b} | {b for b in base if b})
    n = spark.createDataFrame([(x, "", x) for x in names], "name_id string, land string, c string")
    c = spark.createDataFrame([(x, "", x) for x in cores], "site_id string, s_land string, sc string")
    got = {(r.c, r.sc) for r in resolve._share_grams(n, c).collect()}
    want = {(a, b) for a in names for b in cores if SequenceMatcher(None, a, b).ratio() >= resolve.RATIO}
    assert want - got == set() and ("bcdefghijk", "abcdefghijkl") in got and len(got) < len(names) * len(cores) / 2


def test_site_names_and_busy_places(spark):
    from docengine.operators import terms

    rows = spark.createDataFrame([("p", "Sea Lab", ""), ("p", "Foo", "ordinary word"), ("p", "of sea Lab", "descriptive (lower-case words)"), ("p", "Maine", ""), ("p", "Fair Head", "")], "project_id string, term string, reason string")
    got = terms.named_as_sites(rows, spark.createDataFrame([("Sea Lab",), ("Foo",), ("of sea Lab",)], "alias string"))
    hits = spark.createDataFrame([("Maine", 61), ("Fair Head", 99), ("Sea Lab", 99)], "term string, n_hits bigint")
    out = {r.term: r.reason for r in terms.busy_places(got, hits, F.col("term") == "Maine").collect()}
    assert out == {"Sea Lab": "test-site name", "Foo": "test-site name", "of sea Lab": "descriptive (lower-case words)", "Maine": "busy place name (61 hits)", "Fair Head": ""}


def test_workbooks_by_country(spark):
    from docengine.sources import readers, sinks

    df = spark.createDataFrame([("b", "France", "é <&"), ("a", "France", None), ("c", None, "x")], "id string, country string, note string")
    got = {r.country: readers.xlsx_rows(bytes(r.content)) for r in sinks.country_workbooks(df, order=["id"]).collect()}
    assert got == {"France": [["id", "country", "note"], ["a", "France", ""], ["b", "France", "é <&"]], "": [["id", "country", "note"], ["c", "", "x"]]}
    with pytest.raises(ValueError):
        sinks.country_workbooks(df, most_rows=1)
    with pytest.raises(ValueError):
        sinks.json_payload(df, ["id"], most_rows=2)


def test_flags_of_a_widely_shared_term_stay_small(spark):
    """What is told of a term that many projects share does not grow with their number, and prunes as the owners' names do."""
    rows = [(f"P{i:03}", t) for i in range(300) for t in ("Foo", f"Foo Bay{i}")]
    t, h = spark.createDataFrame(rows, "project_id string, term string"), spark.createDataFrame([("Foo", 3, [2010])], "term string, n_hits bigint, years array<int>")
    short = terms.flags(t, h, F.lit(False), name_owners=False)
    assert {r.flags for r in short.collect()} == {"", "shared"}
    kept = lambda f: sorted((r.project_id, r.terms) for r in terms.prune(f).collect())
    assert kept(short) == kept(terms.flags(t, h, F.lit(False))) and len(kept(short)) == 300


def test_names_of_the_same_letters_are_not_all_compared(spark):
    """Names that share runs of letters but can't reach the ratio are told apart before the comparison in Python, unlike lands too."""
    import random

    from docengine.operators import resolve

    rnd = random.Random(5)
    words = ["bremo", "vistika", "holmsa", "kodilan", "ferrasu", "gantobi", "wick"]
    names = sorted({" ".join(rnd.sample(words, 3)) for _ in range(100)})
    n = spark.createDataFrame([(x, "France" if x == names[0] else "", x) for x in names], "name_id string, land string, c string")
    c = spark.createDataFrame([(x, "Spain", x) for x in names], "site_id string, s_land string, sc string")
    got = {(r.c, r.sc) for r in resolve._share_grams(n, c).collect()}
    assert {(x, x) for x in names[1:]} <= got and not any(a == names[0] for a, _ in got) and len(got) < 10 * len(names)
