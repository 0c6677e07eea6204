import random
import re

from docengine.functions import vocab
from docengine.operators import gazetteer as G, spans
from pyspark.sql import functions as F

DOC = "doc_id bigint, text string, reporting_country string, report_year int"


def docs(spark, *texts, land="", year=2010):
    return spark.createDataFrame([(i, t, land, year) for i, t in enumerate(texts)], DOC)


def pairs(df):
    return sorted((r.doc_id, r.a, r.b, r.term) for r in df.collect())


def test_two_policies(spark):
    d = docs(spark, "Alpha Bay Test Centre")
    assert pairs(spans.scan(d, ["Alpha Bay", "Bay Test Centre"], "longest")) == [(0, 6, 21, "Bay Test Centre")]
    assert pairs(spans.scan(d, ["Alpha Bay", "Bay Test Centre"], "leftmost")) == [(0, 0, 9, "Alpha Bay")]


def test_guard_and_wrapped(spark):
    d = docs(spark, "KRISO-WETS, xWETS, WETS.", "at Blue\n  Head now", None, "")
    assert pairs(spans.scan(d, ["WETS", "Blue Head", " ", None])) == [(0, 19, 23, "WETS"), (1, 3, 14, "Blue Head")]
    assert pairs(spans.scan(d, [])) == []


def test_scan_against_regular_expressions(spark):
    rnd = random.Random(11)
    words = ["Foo", "Bar", "Foo Bar", "Bar Foo Baz", "O'Neil", "é-x", "(Foo)", "Baz"]
    texts = [" ".join(rnd.choice([*words, "xx", "-", "Foo,", "\n"]) for _ in range(12)) for _ in range(60)]
    body = "|".join(r"\s+".join(map(re.escape, w.split())) for w in sorted(words, key=lambda w: (-len(w), w)))
    rx = re.compile(rf"(?<![\w-])(?:{body})(?![\w-])")
    want = sorted((i, m.start(), m.end(), " ".join(m.group().split())) for i, t in enumerate(texts) for m in rx.finditer(t))
    assert pairs(spans.scan(docs(spark, *texts), words, "leftmost")) == want


def test_large_dictionary_gives_the_same(spark):
    rnd = random.Random(12)
    words = [f"{a} {b}" for a in ("Foo", "Bar", "Kelo") for b in ("Bay", "Head", "Sound Test Site")] + ["Foo", "Kelo"]
    texts = [" ".join(rnd.choice([*words, "then", "Foo\n Bay", "x-Foo"]) for _ in range(15)) for _ in range(40)]
    d, table = docs(spark, *texts), spark.createDataFrame([(w,) for w in words], "term string")
    for policy in ("longest", "leftmost", "all"):
        assert pairs(spans.scan_table(d, table, policy)) == pairs(spans.scan(d, words, policy))


def test_large_dictionary_knows_marks_accents_and_blanks(spark):
    words = ["Dilado", "Dilado X", "(Dilado", "Bökesin Bay", "Bökesin", "#4 Buoy", "&Co", "“Sea Lab”", "e\u0301tude", "²x", "O'Neil (Foo)", "-Foo", "a b c", " Tab\tSite ", "\x1cOdd\x1c"]
    texts = ["(Dilado X), \"Dilado\" #Dilado 'Dilado' -Dilado (Dilado", "Bökesin  Bay, (Bökesin) xBökesin", "at #4 Buoy &Co, &Co. “Sea Lab” e\u0301tude ²x", "a" + " \n" * 40 + "b\xa0\x1fc", "O'Neil (Foo) -Foo --Foo Tab Site Odd", "", None]
    d, table = docs(spark, *texts), spark.createDataFrame([(w,) for w in [*words, None, " "]], "term string")
    for policy in ("longest", "leftmost", "all"):
        got = pairs(spans.scan_table(d, table, policy))
        assert got == pairs(spans.scan(d, words, policy))
    assert {t for _, _, _, t in got} == {" ".join(w.split()) for w in words}


def test_large_and_small_dictionaries_agree_on_anything(spark):
    """Random phrases and texts of letters with and without accents, marks and blanks of all kinds."""
    rnd, marks = random.Random(21), ["a", "b", "é", "Ö", "e\u0301", "_", "-", "(", ")", "&", "#", "'", ".", " ", "  ", "\t", "\n", "\xa0", "\x1f", "1", "火", "🙂"]
    word = lambda n: "".join(rnd.choice(marks) for _ in range(rnd.randint(1, n)))
    words = sorted({word(4) for _ in range(150)})
    texts = [word(40) for _ in range(150)] + ["".join(rnd.choice(words) + rnd.choice([" ", "", "\n", ", "]) for _ in range(12)) for _ in range(100)]
    d, table = docs(spark, *texts), spark.createDataFrame([(w,) for w in words], "term string")
    for policy in ("longest", "leftmost", "all"):
        assert pairs(spans.scan_table(d, table, policy)) == pairs(spans.scan(d, words, policy))


def test_cues_may_run_over_lines(spark):
    assert resolved(spark, "Shared device near Sea\n  Wolf.")[1][1:] == ("P1", "context: Sea Wolf")


def test_shared_alias_goes_home(spark):
    sites = spark.createDataFrame([("s1", "France", ["Sea Lab"]), ("s2", "Spain", ["Sea Lab", "Other"]), ("s3", None, [""])], "site_id string, country string, aliases array<string>")
    index = G.alias_index(sites)
    at = lambda land: [r.site_id for r in G.site_mentions(docs(spark, "The Sea Lab.", land=land), index).collect()]
    assert at("Spain") == ["s2"] and at("Chile") == ["s1"] and at(None) == ["s1"]


PROJECTS = [("P1", "France", "France", "Sea Wolf | ~Acme | Shared"), ("P2", "Spain", "Spain", "Moon Tide | Shared | Shared"), ("P3", None, None, ""), ("P4", None, None, None)]


def resolved(spark, text, land=""):
    p = spark.createDataFrame(PROJECTS, "project_id string, country string, reporting_country string, search_terms string")
    d, t = docs(spark, text, land=land), G.project_terms(p)
    out = G.resolve(G.project_mentions(d, t), d, t, p)
    return sorted((r.term, r.project_id, r.resolution) for r in out.collect())


def test_resolution(spark):
    assert resolved(spark, "Sea Wolf ran.") == [("Sea Wolf", "P1", "unique term")]
    assert resolved(spark, "Shared device near Sea Wolf.")[1] == ("Shared", "P1", "context: Sea Wolf")
    assert resolved(spark, "Shared device.") == [("Shared", None, "ambiguous")]
    assert resolved(spark, "Acme said so.") == [("Acme", None, "weak term, no context")]
    assert ("Acme", "P1", "context: Sea Wolf") in resolved(spark, "Acme and Sea Wolf.")
    both = "Shared, with Sea Wolf and Moon Tide."
    assert ("Shared", None, "ambiguous") in resolved(spark, both)
    assert ("Shared", "P2", "context: Moon Tide, chapter Spain") in resolved(spark, both, land="Spain")
    assert ("Shared", None, "ambiguous") in resolved(spark, "Shared " + "x" * 700 + " Sea Wolf")


def test_candidates(spark):
    d = docs(spark, "The Blue Head Test Site and the Foo Wave Tank (FWT) are open. test site", "The Blue Head Test Site again, the BLUE HEAD Test Site twice")
    got = G.candidates(d)
    assert ("Foo Wave Tank (FWT)" in {r.name for r in got.collect()}) and "Blue Head Test Site" in {r.name for r in got.collect()}
    taken = spark.createDataFrame([(0, 4, 23)], "doc_id bigint, a int, b int")
    assert "Blue Head Test Site" not in {r.name for r in G.candidates(d, taken).where("doc_id = 0").collect()}
    s = {r.candidate: r.n_mentions for r in G.candidate_summary(got.join(d.select("doc_id", "report_year", "reporting_country"), "doc_id")).collect()}
    assert s["Blue Head Test Site"] == 3


def test_term_hits(spark):
    d = docs(spark, "Foo Foo xFoo", "Foo Bar")
    t = spark.createDataFrame([("Foo",), ("Foo Bar",), ("None",)], "term string")
    assert {r.term: (r.n_hits, r.years) for r in G.term_hits(d, t).collect()} == {"Foo": (3, [2010]), "Foo Bar": (1, [2010]), "None": (0, [])}


def test_candidate_pattern_compiles_as_python():
    assert re.compile(vocab.CANDIDATE).search("The Blue Head Test Site")


def test_phrases_that_begin_alike_are_not_moved(spark):
    """A word that begins many phrases costs no row a phrase wherever it stands: only spans that are phrases are moved."""
    store = spark.sparkContext._jsc.sc().statusStore()
    written = lambda: sum(store.lastStageAttempt(i).shuffleWriteRecords() for i in done())
    done = lambda: [s for g in [spark.sparkContext.statusTracker().getJobIdsForGroup("moved")] for j in g for s in spark.sparkContext.statusTracker().getJobInfo(j).stageIds]
    d, table = docs(spark, *["Test " * 100 + f"Test no{i}" for i in range(10)]), spark.createDataFrame([(f"Test no{i}",) for i in range(1000)], "term string")
    spark.sparkContext.setJobGroup("moved", "")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for large tables
    try:
        got = pairs(spans.scan_table(d, table, "leftmost"))
        assert got == [(i, 500, 508, f"Test no{i}") for i in range(10)] and written() < 10_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
