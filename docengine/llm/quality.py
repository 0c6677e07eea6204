"""Document statistics, and prose told from lists, tables and junk by boosted trees on them.

Rules that are nearly always right label a bounded sample (``SAMPLE`` rows, chosen by a hash of the id); the trees learn from
it and from a few written texts, and decide for every document, also where no rule speaks. A holdout they never learn from
calibrates the probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .boosting import BoostedTrees
from .holdout import HOLDOUT, SEEDS
from .textstats import NAMES, Memo, features

KINDS = ("prose", "list", "table", "junk")
SAMPLE = 8000
REPORTED = ("n_words", "mean_word_length", "symbol_ratio", "ended_share", "common_share")


def weak_label(f: dict[str, float]) -> str | None:
    """What a rule of high precision says of a document, if one does."""
    wordy = f["wide_ratio"] < 0.2
    if (f["n_lines"] >= 4 and f["top_line_share"] > 0.5) or (f["top_sentence_share"] > 0.8 and f["sentences"] >= 4) or (f["n_words"] >= 20 and f["distinct_trigrams"] < 0.2):
        return "junk"
    if f["rare_letter_ratio"] > 0.25 or f["backslash_ratio"] > 0.1 or f["tag_ratio"] > 0.12 or f["mixed_word_share"] > 0.3:
        return "junk"
    if f["n_words"] <= 3 and f["longest_word"] > 60 and wordy:
        return "junk"
    if f["letter_ratio"] < 0.5 and f["n_lines"] < 3 and wordy and f["prose_chars"] < 0.1:
        return "junk"
    if f["flip_share"] > 0.03 and f["common_share"] < 0.3 and f["cells_per_line"] < 1 and (f["joined_share"] > 0.01 or f["flip_share"] > 0.1):
        return "junk"
    if f["common_share"] < 0.02 and f["capital_words"] < 0.05 and f["n_words"] > 20 and f["prose_chars"] < 0.1 and wordy and f["cell_share"] < 0.5 and f["marked_share"] < 0.3:
        return "junk"
    if f["n_lines"] >= 3 and f["same_cells_share"] > 0.6 and f["marked_share"] < 0.3 and f["sentences"] <= 0.3 * f["n_lines"] and f["statement_share"] < 0.3:
        return "table"
    if f["n_lines"] >= 3 and f["marked_chars"] > 0.6:
        return "list"
    if f["prose_chars"] < 0.1 and f["common_share"] < 0.12 and wordy and f["capital_words"] > 0.3 and (f["semicolon_items"] >= 4 or (f["n_lines"] >= 4 and f["cells_per_line"] < 1)):
        return "list"
    if f["prose_chars"] > 0.5 and f["sentences"] >= 1 and not wordy:
        return "prose"
    if f["common_share"] > 0.2 and f["sentences"] >= 1 and f["prose_chars"] > 0.7 and f["marked_chars"] < 0.2 and f["words_per_sentence"] < 60 and f["top_sentence_share"] < 0.6:
        return "prose"
    return None


def _features_of(texts: list[str], common: frozenset[str], memo: Memo | None = None) -> np.ndarray:
    memo = Memo(common) if memo is None else memo
    return np.nan_to_num(np.array([features(t, common, memo) for t in texts], float).reshape(len(texts), len(NAMES)))


def _statistics(df: DataFrame, common: frozenset[str], keep: list[str], text: str) -> DataFrame:
    schema = df.select(*keep, F.array().cast("array<double>").alias("f")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = _features_of(batch.column(batch.schema.get_field_index(text)).to_pylist(), common)
            cells = pa.ListArray.from_arrays(pa.array(np.arange(len(table) + 1, dtype=np.int32) * len(NAMES)), pa.array(table.ravel()))
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(c)) for c in keep], cells], names=[*keep, "f"])

    return df.select(*keep, text).mapInArrow(run, schema)


def has_text(text: Column) -> Column:
    return text.isNotNull() & text.rlike(r"(?U)[^\s\u200b\ufeff]")


def train(docs: DataFrame, common: frozenset[str], doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> BoostedTrees | None:
    """Trees fitted on at most ``sample`` labelled documents and calibrated on the holdout; none without documents."""
    n = docs.count()
    if n == 0:
        return None
    place = F.pmod(F.xxhash64(F.col(doc_id), F.lit(17)), F.lit(1 << 40))
    rows = docs.where(place < int(min(1.0, 0.97 * sample / n) * (1 << 40)) + 1).where(has_text(F.col(text)))
    got = _statistics(rows, common, [doc_id], text).select(doc_id, "f").limit(sample).toPandas()
    x = np.array(got["f"].tolist(), float).reshape(len(got), len(NAMES))
    label = [weak_label(dict(zip(NAMES, r))) for r in x]
    known = np.array([k is not None for k in label], bool)
    kinds, texts = zip(*SEEDS)
    # a few written texts of each kind are always learned from, so a kind that is rare in the sample is known; the holdout never is
    xs = np.vstack([x[known], _features_of(list(texts), common)])
    ys = np.array([KINDS.index(k) for k in [*(k for k in label if k), *kinds]], int)
    model = BoostedTrees(KINDS).fit(xs, ys)
    kinds, texts = zip(*HOLDOUT)
    model.calibrate(_features_of(list(texts), common), np.array([KINDS.index(k) for k in kinds]))
    return model


def classify(docs: DataFrame, common: frozenset[str], doc_id: str = "doc_id", text: str = "text", model: BoostedTrees | None = None, sample: int = SAMPLE) -> DataFrame:
    """``doc_id``, the reported statistics, ``kind`` and its ``confidence`` of every document that has text, in one pass.

    Null, empty and blank texts are left out; every other text counts whole. Repeated ids give a row each. No shuffle.
    """
    model = model or train(docs, common, doc_id, text, sample)
    schema = docs.select(F.col(doc_id).alias("doc_id"), *[F.lit(0.0).alias(c) for c in REPORTED], F.lit("").alias("kind"), F.lit(0.0).alias("confidence")).schema
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where(has_text(F.col("text")))
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    pick = [NAMES.index(c) for c in REPORTED]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(common)
        for batch in batches:
            x = _features_of(batch.column(1).to_pylist(), common, memo)
            p = model.probabilities(x)
            kind = p.argmax(1)
            cols = [batch.column(0), *[pa.array(x[:, i]) for i in pick], pa.array([KINDS[k] for k in kind]), pa.array(p[np.arange(len(p)), kind])]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", *REPORTED, "kind", "confidence"])

    return rows.mapInArrow(run, schema)
