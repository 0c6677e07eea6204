import csv
import io
import json
import random

import pyarrow as pa
import pytest
from docengine.operators.packed import _exact, split_packed, unpack
from pyspark.sql import functions as F


def split(*xs, atomic=False):
    return split_packed(pa.array(list(xs), pa.string()), atomic).to_pylist()


CASES = {
    "a | b": ["a", "b"],
    '"x, y"; z': ["x, y", "z"],
    "": [],
    '["a", "b \\"q\\" c"]': ["a", 'b "q" c'],
    "T | Foo Site; F/S site": ["T", "Foo Site", "F/S site"],
    'A, "The ""Old X"" zone", B': ["A", 'The "Old X" zone', "B"],
    'Foo "Old x" site, y | Bar': ['Foo "Old x" site, y', "Bar"],
    " | a |b | ": ["a", "b"],
    '5" x | 6" y': ['5" x', '6" y'],
    '"x" y" | b': ['"x" y"', "b"],
    "a;b;": ["a", "b"],
    "Wave Farm, X / Wave Pilot": ["Wave Farm, X", "Wave Pilot"],
    "x\ny": ["x", "y"],
    "p || q": ["p", "q"],
    "Foo [new name];B": ["Foo [new name]", "B"],
    '"a|b"': ["a|b"],
    "é | ü": ["é", "ü"],
}


@pytest.mark.parametrize("text", CASES)
def test_cases(text):
    assert split(text) == [CASES[text]]


def test_batch_equals_rows_one_by_one():
    keys = list(CASES)
    assert split(None, *keys) == [[]] + [CASES[k] for k in keys]
    assert split() == []


def test_atomic():
    assert split("OB1 OB2", '["1", "2"]', "a / b,c", '"x"; "y"', atomic=True) == [["OB1", "OB2"], ["1", "2"], ["a", "b", "c"], ["x", "y"]]


def test_round_trip_of_random_lists():
    rnd = random.Random(3)
    words = ["Foo", "bar baz", "O'Neil", 'The "Old" pier', "x (y)", "ä ö", "a-b"]
    packed, want = [], []
    for _ in range(400):
        items = [rnd.choice(words) for _ in range(rnd.randint(2, 5))]
        style = rnd.randrange(5)
        if style == 0:
            out = io.StringIO()
            csv.writer(out, lineterminator="").writerow(items)
            packed.append(out.getvalue().replace(",", ", "))
        elif style == 1:
            packed.append(json.dumps(items))
        else:
            packed.append(rnd.choice([" | ", "|", ";", "; ", "\n", " ;; "]).join(items))
        want.append(items)
    assert split(*packed) == want


def test_exact_scanner_agrees_on_clean_rows():
    for text, items in CASES.items():
        if not text.startswith("["):
            assert _exact(text.strip(), False) == items


def test_very_long_and_repeated(spark):
    long = " | ".join(f"value {i}" for i in range(50_000))
    df = spark.createDataFrame([(1, long, "x"), (1, "a|b", "y"), (2, None, "z")], "id int, value string, pos_name string")
    out = unpack(df)
    assert out.count() == 50_002
    assert out.where("pos_name = 'y'").orderBy("pos").select("pos", "value", "n_values").collect() == [(1, "a", 2), (2, "b", 2)]
    assert unpack(df.limit(0)).count() == 0


def test_pieces_cover_all_rows_once():
    from docengine.operators import packed

    values = pa.array(["x" * n for n in (0, 5, packed.PIECE, 3, packed.PIECE * 3, 1, 1)] + [None], pa.string())
    got = list(packed._pieces(values))
    assert [i for lo, hi in got for i in range(lo, hi)] == list(range(8))
    assert list(packed._pieces(pa.array([], pa.string()))) == []


def test_one_text_beyond_the_arrays():
    from docengine.operators import packed

    long = "; ".join(["value"] * (packed.LONG // 6))
    assert packed._split_piece(pa.array([long]), False).to_pylist() == [["value"] * (packed.LONG // 6)]
    assert packed._split_piece(pa.array([json.dumps(["a;b"] * (packed.LONG // 5))]), False).to_pylist() == [["a;b"] * (packed.LONG // 5)]


def test_both_scans_agree():
    """Texts of any length, quoting and blanks: the scan of whole batches and that of one text give the same items."""
    import random

    from docengine.operators import packed

    rnd, marks = random.Random(4), [*'ab"";|,/ \t\n[]\\1', '""', '" ', '",', " / ", "é", "\u00a0", '["', '"]', "\x1c", "\r"]
    for atomic in (False, True):
        texts = ["".join(rnd.choice(marks) for _ in range(rnd.randint(0, 14))) for _ in range(20_000)] + ['["' + "".join(rnd.choice(marks) for _ in range(rnd.randint(0, 9))) + '"]' for _ in range(8_000)]
        texts += ['"x;y"z|w', '["a", 1, "b"]', '["a;b", 1]', '"a""b;c"; d', 'ab"c;d"e', '"a;b" ,c']
        alone = [x for t in texts for x in pa.compute.utf8_trim_whitespace(pa.array(packed._exact(t, atomic), pa.string())).to_pylist() if x]
        assert [x for g in packed.split_packed(pa.array(texts), atomic).to_pylist() for x in g] == alone


def test_clashing_names(spark):
    df = spark.createDataFrame([("a|b", 7, 8, 9)], "value string, pos int, n_values int, index int")
    assert sorted((r.pos, r.value, r.n_values, r["index"]) for r in unpack(df).collect()) == [(1, "a", 2, 9), (2, "b", 2, 9)]


def test_query_against_rows_split_alone(spark, sf):
    from docengine.plans.data_queries import p2_found

    got = {}
    for r in p2_found(spark, sf).where("field = 'projects.obs_ids'").orderBy("row_key", "pos").collect():
        got.setdefault(r.row_key, []).append(r.value)
    want = {}
    for r in spark.read.parquet(f"{sf}/projects.parquet").select(F.col("row_id").cast("string").alias("k"), F.regexp_extract_all("obs_ids", F.lit(r"OB\d+"), F.lit(0)).alias("v")).where("size(v) > 1").collect():
        want[r.k] = r.v
    assert got == want
