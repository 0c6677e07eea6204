import itertools
import random

from docengine.llm import components, names
from docengine.llm import facility_names
from docengine.llm.lcs import lcs_length, lcs_ratio
from docengine.llm.vocabulary import MARINE, Vocabulary
from pyspark.sql import functions as F

SCHEMA = "id string, country string, name string, is_main boolean"


def test_lcs_against_dynamic_programming():
    rnd = random.Random(1)

    def slow(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        return row[-1]

    for _ in range(500):
        a, b = ("".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 12))) for _ in "ab")
        assert lcs_length(a, b) == slow(a, b)
    assert lcs_ratio("", "") == 0 and lcs_ratio("abc", "abc") == 1


def parse(name):
    return facility_names.parse(name, MARINE)


def test_parse():
    assert parse("Kelo Mabrin Laboratry")["kinds"] == parse("Kelo Mabrin Laboratory")["kinds"] and parse("Kelo Mabrin Testingsite Tidal")["tokens"] == ["kelo", "mabrin"]
    assert parse("Towing Tank at Kelo Mabrin Sovarholm")["tokens"] == ["kelo", "mabrin", "sovarholm"]
    assert parse("Towing Tank at Kelo Mabrin")["tokens"] == ["kelo", "mabrin"]
    assert parse("Kelo Mabrin Wave Tst Site [new name]")["kinds"] == {"WTS"}
    assert parse("The Kelo Mabrin towing tk., North Coast")["tokens"] == ["kelo", "mabrin"]
    assert parse("KMTT Mabrin")["acronym"] == "km"
    assert parse("K. Mabrin Towing Tank")["initials"] == [("k", 0)]
    assert parse("Site d'essais hydrolien Kelo Mabrin")["kinds"] == {"TTS", "TSDZ"}
    assert parse("Test Site") is None and parse("") is None and parse("***") is None


def groups(spark, rows, vocabulary=MARINE):
    out = {}
    for r in names.link_names(spark.createDataFrame(rows, SCHEMA), vocabulary).collect():
        out.setdefault(r.entity, set()).add(r.id)
    return sorted(sorted(g) for g in out.values())


def test_links(spark):
    rows = [
        ("a", "France", "Kelodan Mabrinholm Towing Tank", True), ("b", "FR", "KELODAN-MABRINHOLM TOWING TK.", True), ("c", None, "Towing Tank (Mabrinholm Kelodan)", True), ("d", "", "K. Mabrinholm Towing Tank", True),
        ("e", "France", "KMTT Mabrinholm", True), ("f", "france", "Keldan Mabrinhlm Towing Tank", True), ("g", "France", "Kelodan Mabrinholm Wave Test Site", True), ("h", "Spain", "Sorivar Tebogan Towing Tank", True),
        ("h", "Spain", "Sorivar Tebogan Towing Tank", True), ("i", "Japan", "K. Mabrinholm Towing Tank", True), ("j", None, None, True), ("k", None, "", True), ("l", "France", "Kélodan Mabrinholm", True),
    ]
    got = groups(spark, rows)
    assert ["h"] in got and ["g"] in got
    assert next(g for g in got if "a" in g) == ["a", "b", "c", "d", "e", "f", "l"]


def test_empty(spark):
    assert groups(spark, []) == []
    assert groups(spark, [("x", None, None, True)]) == []


def test_pairs(spark):
    linked = spark.createDataFrame([("b", "1"), ("a", "1"), ("c", "1"), ("d", "2")], "id string, entity string")
    assert sorted(map(tuple, names.pairs(linked).collect())) == [("a", "b"), ("a", "c"), ("b", "c")]


def test_crowd_of_one_facility(spark):
    """A block of many spellings costs no square and loses no link."""
    rnd = random.Random(4)

    def typo(w):
        i = rnd.randrange(1, len(w) - 1)
        return w[:i] + rnd.choice("aeiou") + w[i:]

    rows = [(f"r{i}", "France", f"{typo('kelodan')} {typo('mabrinholm')} Towing Tank", True) for i in range(300)]
    assert [len(g) for g in groups(spark, rows)] == [300]


def test_crowded_blocks_are_compared_whole(spark):
    """However a crowded block is cut, every two of its names meet."""
    forms = spark.range(90).select(*[F.concat(F.lit(f"{c}-"), "id").alias(c) if c == "form" else F.lit(v).alias(c) for c, v in (("form", ""), ("shape", "full"), ("one", "kelodansovarholm"), ("two", "mabrinholm"), ("lead", ""), ("kinds", ""))])
    got = {}
    for crowd in (256, 20, 7):
        pairs = names._compare(names._blocks(forms, common=1, crowd=crowd)).select("form_a", "form_b").distinct().collect()
        got[crowd] = {tuple(sorted(p)) for p in pairs}
    assert got[256] == got[20] == got[7] and len(got[7]) == 90 * 89 // 2


def test_scores_in_batches_equal_single_ones():
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcde") for _ in range(rnd.randint(3, 9)))
    some = [rnd.choice([("full", word(), word(), ""), ("joined", word() + word(), "", ""), ("part", word(), "", rnd.choice("abc") + rnd.choice("<>"))]) for _ in range(60)]
    a, b = zip(*itertools.combinations(some, 2))
    assert max(abs(x - names.place_score(p, q)) for x, p, q in zip(names._scores(list(a), list(b)), a, b)) < 1e-9


def test_another_vocabulary(spark):
    """Nothing of the marine register is built in: names of another field, with its vocabulary and with none at all."""
    rnd = random.Random(12)
    syllables = [a + b for a in "bdfgklmnprstv" for b in "aeiou"]
    place = lambda: ("".join(rnd.sample(syllables, 3)) + rnd.choice(["ham", "wick", "stad"])).capitalize()
    slip = lambda w: w[:3] + w[4:] if rnd.random() < 0.5 else w[:2] + rnd.choice("aeiou") + w[2:]
    hospital = Vocabulary(("HOSP", "CLN"), {}, {"hospital": "HOSP", "hosp": "HOSP", "clinic": "CLN", "general": "", "community": ""}, frozenset({"the", "of", "at"}))
    rows, truth = [], {}
    for i in range(80):
        a, b = place(), place()
        for j, name in enumerate([f"{a} {b} General Hospital", f"General Hosp. at {slip(a)} {b}", f"{a}-{slip(b)} Hospitel", f"the Hospital of {b} {a}"]):
            rows.append((f"{i:02}-{j}", None, name, True))
            truth[f"{i:02}-{j}"] = i
        rows.append((f"{i:02}-c", None, f"{a} {b} Community Clinic", True))
    same = {frozenset(p) for p in itertools.combinations(sorted(truth), 2) if truth[p[0]] == truth[p[1]]}
    linked = [g for g in groups(spark, rows, hospital)]
    found = {frozenset(p) for g in linked for p in itertools.combinations([x for x in g if x in truth], 2)}
    assert len(found & same) >= 0.99 * len(same) and len(found - same) <= 0.01 * len(same)
    assert all(not (x.endswith("c") and len(g) > 1) for g in linked for x in g)  # the clinic beside is another facility
    # with no vocabulary frequent words are learned, and what is left is the place
    blind = [r for r in rows if not r[0].endswith("c")]
    found = {frozenset(p) for g in groups(spark, blind, None) for p in itertools.combinations(g, 2)}
    assert len(found & same) >= 0.95 * len(same) and len(found - same) <= 0.01 * len(same)


def test_groups(spark):
    linked = spark.createDataFrame([("b", "1"), ("a", "1"), ("d", "2")], "id string, entity string")
    assert sorted(map(tuple, names.groups(linked).collect())) == [("a", "1", "a", 2), ("b", "1", "a", 2), ("d", "2", "d", 1)]


def test_components_against_union_find(spark):
    rnd = random.Random(9)
    edges = [(f"v{rnd.randrange(120)}", f"v{rnd.randrange(120)}") for _ in range(90)] + [(f"c{i}", f"c{i + 1}") for i in range(60)] + [("hub", f"h{i}") for i in range(50)]
    nodes = sorted({x for e in edges for x in e} | {"alone"})
    got = {r.id: r.component for r in components.components(spark.createDataFrame([(n,) for n in nodes], "id string"), spark.createDataFrame(edges, "a string, b string")).collect()}
    label = {n: n for n in nodes}
    for _ in nodes:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert got == label


def test_block_recall_against_all_pairs(spark):
    """Every pair of spellings that all-pairs comparison links ends in one group."""
    from docengine.llm.queries import facility_names

    rows = facility_names(spark, "/root/testdata/sf0.001").where("is_main").collect()
    forms = {r.id: f for r in rows if (f := names._form(r.name or "", True, MARINE))}
    entity = {r.id: r.entity.split("#")[0] for r in names.link_names(facility_names(spark, "/root/testdata/sf0.001"), MARINE).collect()}
    full = [(a, b) for a, b in itertools.combinations(sorted(forms), 2) if forms[a][0] == forms[b][0] == "full" and names.place_score(forms[a][:4], forms[b][:4]) >= 0.88]
    assert full and sum(entity[a] == entity[b] for a, b in full) / len(full) >= 0.98
