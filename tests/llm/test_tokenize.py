import base64
import random

import numpy as np
import pytest
from docengine.llm import tokenize as T

tiktoken = pytest.importorskip("tiktoken")
# The published pattern of the tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@pytest.fixture(scope="module")
def both():
    with open(T.DEFAULT_PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return T.Encoder.load(), tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(encoder, texts):
    ids, sizes = encoder.encode(texts)
    out, at = [], 0
    for n in sizes:
        out.append(ids[at : at + n].tolist())
        at += n
    return out


def test_against_the_library(both):
    own, library = both
    rnd = random.Random(2)
    alphabet = "ab 'stlremdvSTLL\n\t\r 12²é世한 .,\"''   ​🙂½Ⅷ́"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(4000)]
    texts += ["", " ", "  ", "a" * 9000, " " * 3000, "'" * 500, "<|endoftext|> x", "\0a\0\0b", "it's's 'll 'lls ''s \n's 'S", "don't we'll they've I'd"]
    assert ids_of(own, texts) == [library.encode_ordinary(t) for t in texts]


def test_scan_equals_one_step_at_a_time():
    import numpy as np

    rnd = np.random.default_rng(0)
    table, classes = T.transitions(), rnd.integers(0, 8, 5000).astype(np.uint8)
    state, want = T.FRESH, []
    for c in classes:
        want.append(state)
        state = table[c, state]
    for block in (1, 7, 512, 8192):
        assert T.scan_states(classes, table, block).tolist() == want


def test_round_trip_and_offsets(both):
    own, _ = both
    for text in ("The turbine's 1,200 kW — ça va? 한국 🙂", "x" * 3000):
        ids = ids_of(own, [text])[0]
        assert own.decode(ids) == text
        raw, table = text.encode(), own.decoder()
        assert all(raw[o : o + len(table[i])] == table[i] for i, o in zip(ids, own.offsets(np.array(ids, np.int32), np.array([len(ids)]))))


def test_table(spark, both):
    df = spark.createDataFrame([(1, "a b", "k"), (2, None, "k"), (3, "", "k"), (3, "", "k"), (4, "word " * 50_000, "k")], "doc_id bigint, text string, ids string")
    got = T.encode(df, keep=["doc_id"]).collect()
    assert sorted((r.doc_id, len(r.ids)) for r in got) == [(1, 2), (2, 0), (3, 0), (3, 0), (4, 50_001)]
    assert sorted((r.doc_id, r.n_tokens) for r in T.count_tokens(df, keep=["doc_id"]).collect()) == [(1, 2), (2, 0), (3, 0), (3, 0), (4, 50_001)]
    assert T.encode(df).columns == ["doc_id", "ids"] and T.encode(df).count() == 5
    assert T.encode(df.limit(0), keep=["doc_id"]).count() == 0
    assert T.encode(df.limit(0), keep=["doc_id"]).schema["ids"].dataType.simpleString() == "array<int>"


def test_query(spark, sf, both):
    from docengine.llm.queries import p8_ids

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert {r.doc_id: r.ids for r in p8_ids(spark, sf).collect()} == {k: both[1].encode_ordinary(t) for k, t in texts.items()}


def test_offsets_of_a_table(spark):
    texts = ["wave é buoy", None, "", "火 \n\n x", "wave é buoy"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    table = T.Encoder.load().decoder()
    for r in T.encode(df, keep=["doc_id", "text"], offsets="offsets").collect():
        raw = (r.text or "").encode()
        ends = [*r.offsets[1:], len(raw)] if r.offsets else []
        assert [raw[a:b] for a, b in zip(r.offsets, ends)] == [table[i] for i in r.ids] and (r.ids == []) == (not r.text)
