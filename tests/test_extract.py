import re

from docengine.functions import vocab
from docengine.operators import extract as E
from pyspark.sql import functions as F


def one(spark, column, *values, kind="string"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], f"v {kind}").select(column(F.col("v"))).collect()]


def corpus(spark):
    return [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect() if r.text]


def test_capacities(spark):
    assert one(spark, E.capacities, "1,500 kW, 12 500 kW, 3 MWh, 2.5MW, v1.5 MW", None, "") == [["1,500 kW", "12500 kW", "2.5 MW"], [], []]


def test_patterns_against_python(spark):
    texts = corpus(spark)
    got = one(spark, lambda c: F.struct(E.capacities(c).alias("c"), E.years(c).alias("y"), E.labels(c, vocab.TECHNOLOGIES).alias("t"), E.labels(c, vocab.STATUS).alias("s"), E.signal_score(c, F.lit(False)).alias("n")), *texts)
    for text, r in zip(texts, got):
        assert r.c == [f"{m[1].replace(' ', '')} {m[2]}" for m in re.finditer(vocab.CAPACITY, text)]
        assert r.y == sorted(set(re.findall(vocab.YEAR, text)))
        assert r.t == [n for n, p in vocab.TECHNOLOGIES if re.search(p, text, re.I)]
        assert r.s == [n for n, p in vocab.STATUS if re.search(p, text, re.I)]
        assert r.n == sum(map(bool, (re.search(vocab.CAPACITY, text), re.search(vocab.DEPLOY_VERB, text, re.I), re.search(vocab.DEVICE_WORD, text, re.I))))


ENTITIES = {
    "The Blue Head Array was built by CorPower and Wave Star in Bay of Fundy.": ["Blue Head Array", "CorPower and Wave Star", "Bay of Fundy"],
    "In 2016 the Isle of Man and France saw a Kite 500 trial; THE KITE was lost.": ["Isle of Man and France", "Kite 500", "KITE"],
    "The device. In July it left. A Report": [],
    "Foo Bar, foo bar, FOO BAR and Foo Bar": ["Foo Bar", "FOO BAR and Foo Bar"],
    "eWave and kiteX 2 met Ångström": ["eWave", "kiteX 2"],
    "": [],
}


def test_entities(spark):
    got = dict(zip(ENTITIES, one(spark, E.named_entities, *ENTITIES)))
    assert got == ENTITIES
    many = ". ".join(f"Alpha{chr(97 + i)} x" for i in range(20))
    assert one(spark, E.named_entities, many, None) == [[f"Alpha{chr(97 + i)}" for i in range(12)], []]


def test_quantities_and_angles(spark):
    assert one(spark, E.depths, "at depths of up to 40 m", "a depth of about 12.5 m", "in 30-50 metres of water depth", "25 m depth", "18 meters deep", "a 40 m long hull", "depths of 5 km") == [["40 m"], ["12.5 m"], ["30-50 m"], ["25 m"], ["18 m"], [], []]
    assert one(spark, E.offshore, "3 km offshore", "2 nautical miles off shore", "1.5 miles from the coastline", "12 km off the coast", "10 kilometres from shore", "5 km from Sovar", "3 m offshore") == [["3 km"], ["2 nautical miles"], ["1.5 miles"], ["12 km"], ["10 kilometres"], [], []]
    assert one(spark, E.coordinates, "58.97° N, 3.35° W", "at 12°30'15\" S", "41°N; 8°W", "12° of arc", "58° 58.5′ N") == [["58.97° N, 3.35° W"], ["12°30'15\" S"], ["41°N; 8°W"], [], ["58° 58.5′ N"]]


def test_plausible_names(spark):
    words = F.array(F.lit("many"), F.lit("system"))
    assert one(spark, lambda c: E.is_plausible_name(c, words), "Many", "Systems", "OTEC", "2.5 MW", "kW", "Fair Head", "The", "ab", None, "CorPower", "France") == [False, False, True, False, False, True, False, False, False, True, False]
    assert one(spark, lambda c: E.name_guess(F.lit("Many"), F.array(c), words), "Fair Head", "The") == ["Fair Head", ""]


def test_places(spark):
    got = one(spark, E.places, "Built in Kvichak River near Igiugig, Alaska and at Fundy Institute.", "in the Bay of Fundy, off Fundy", "In France, in 2010 Bay.", "at Foo Bar", None)
    assert got[0] == ["Kvichak River", "Igiugig, Alaska"] and got[1] == ["Bay of Fundy"] and got[2:] == [[], [], []]
    assert one(spark, lambda c: E.places(c, F.array(F.lit("Foo Bar"))), "at Foo Bar") == [["Foo Bar"]]
    assert one(spark, E.countries, "From Scotland and the USA to Spain, Spain.", "nowhere") == [["United Kingdom", "United States", "Spain"], []]
    assert one(spark, E.depths, "in a depth of 35 m, 20–30 m water depth, 12 metres deep and 12 m deep") == [["35 m", "20–30 m", "12 m"]]
    assert one(spark, E.offshore, "2.5 km off the coast and 3 nm from shore") == [["2.5 km", "3 nm"]]
    assert one(spark, E.coordinates, "at 58° 58.5' N, 3° 21' W or 12.5°S") == [["58° 58.5' N, 3° 21' W", "12.5°S"]]
    assert one(spark, E.registered_places, "Orkney, near x; Fall of the Foo in Bar", None) == [["Orkney", "Fall", "Foo", "Bar"], []]


def test_rows_emitted(spark):
    rows = [
        (1, 1, 1, "Big One", 1, 2, "A device of 500 kW was installed and tested at sea for a year.", "Projects", "deployment", "France"),
        (1, 1, 2, "", 3, 3, "A note about nothing in particular that goes on for long enough.", "Projects", "deployment", "France"),
        (1, 1, 3, "", 4, 4, "The device was tested at sea and in the tank for a very long time.", "", None, "France"),
        (1, 1, 4, "", 5, 5, "short", "Projects", "deployment", "France"),
    ]
    e = spark.createDataFrame(rows, "doc_id bigint, block int, entry int, title string, line_start int, line_end int, text string, section string, section_kind string, country string")
    got = E.describe(E.emit(e)).collect()
    assert [(r.entry, r.signal_score, r.method) for r in got] == [(1, 3, "project section")]
    assert got[0].capacities == ["500 kW"] and got[0].name_guess == "Big One"
    sites = spark.createDataFrame([(1, 3)], "doc_id bigint, line_no int")
    assert sorted(r.entry for r in E.emit(e, sites).collect()) == [1, 3]


def test_mode_of_chapter(spark):
    rows = [(1, 0, "A", "deployment"), (1, 1, "A", None), (1, 2, "B", None), (1, 3, "", None), (2, 0, "", None)]
    got = {(r.doc_id, r.line_no): r.wanted for r in E.mode_of_chapter(spark.createDataFrame(rows, "doc_id int, line_no int, country string, section_kind string")).collect()}
    assert got == {(1, 0): True, (1, 1): False, (1, 2): True, (1, 3): False, (2, 0): True}


def test_project_rows_know_sites_and_their_places(spark, tmp_path):
    from docengine.plans import reference_queries as R

    text = "The device was installed and tested at the Sea\nLab for a very long time in Foo Bar.\n\nThe device was installed and tested in a tank for a very long time indeed."
    spark.createDataFrame([(1, text), (2, "The device was installed and tested in a tank for a very long time."), (3, None)], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([("s1", "Sea Lab", "France", None, "Foo Bar, France")], "site_id string, name string, country string, aliases string, location string").write.parquet(f"{tmp_path}/test_sites.parquet")
    got = R.project_rows(spark, str(tmp_path)).collect()
    assert [(r.doc_id, r.signal_score, r.places) for r in got if r.doc_id > 0] == [(1, 3, "Foo Bar")]
    # the made reports: entries end where a chapter does; without a chapter the whole text is scanned for keywords
    made = sorted((r.doc_id, r.line_start, r.line_end, r.title, r.capacities, r.signal_score, r.method) for r in got if r.doc_id < 0)
    first, second = ("Blue Head Array", "500 kW", 3), ("", "20 kW; 1.2 MW", 3)
    entry = lambda doc, a, b, what, method="project section": (doc, a, b, *what, method)
    assert made == [
        entry(-3, 5, 6, first, "keyword scan"), entry(-3, 7, 8, second, "keyword scan"), entry(-2, 16, 17, first), entry(-2, 18, 19, second),
        entry(-1, 29, 30, first), entry(-1, 31, 32, second), entry(-1, 34, 34, ("", "", 1)), entry(-1, 52, 52, ("", "500 kW", 3)), entry(-1, 53, 54, second),
    ]
