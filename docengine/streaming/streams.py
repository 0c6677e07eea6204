"""Structured Streaming: documents to lines and attributes as they arrive, and reference counts kept from change deltas."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import extract, references, structure


def stream_lines(docs: DataFrame) -> DataFrame:
    """Lines of a stream of documents; stateless, so batch and stream share the operator."""
    return structure.lines(docs)


def stream_attributes(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the capacities, technologies, status and years told, of a stream of documents."""
    t = docs.text
    return docs.select("doc_id", extract.capacities(t).alias("capacities"), extract.labels(t, extract.vocab.TECHNOLOGIES).alias("technologies"), extract.labels(t, extract.vocab.STATUS).alias("status"), extract.years(t).alias("years"))


def maintain_references(deltas: DataFrame, state_dir: str, checkpoint: str, trigger: dict | None = None, compact_every: int = 16) -> StreamingQuery:
    """Keeps the signed counts per key and time under ``state_dir``.

    A micro-batch writes only its own summed deltas, named by the batch, so one that is run again writes the same over again: exactly
    once. Every ``compact_every`` batches base and deltas are summed into a new base and what it holds is dropped.
    """

    def step(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        references.apply_deltas(batch).write.mode("overwrite").parquet(os.path.join(state_dir, f"d{epoch:012d}"))
        if (epoch + 1) % compact_every == 0:
            latest_state(spark, state_dir, epoch).write.mode("overwrite").parquet(os.path.join(state_dir, f"v{epoch:012d}"))
            path, fs = _folder(spark, state_dir)
            # the base before the new one stays until the next compaction, for those that read it now
            bases = [n for n in _done(spark, state_dir) if n[0] == "v" and int(n[1:]) < epoch]
            old = int(bases[-1][1:]) if bases else -1
            for name in _done(spark, state_dir):
                if int(name[1:]) < old or (name[0] == "d" and int(name[1:]) <= old):
                    fs.delete(spark._jvm.org.apache.hadoop.fs.Path(path, name), True)

    return deltas.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def _folder(spark: SparkSession, state_dir: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(state_dir)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _done(spark: SparkSession, state_dir: str) -> list[str]:
    """Names of the complete parts of the state, bases ``v`` and deltas ``d``, by batch."""
    path, fs = _folder(spark, state_dir)
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path) if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
    return sorted((n for n in names if n[:1] in "vd"), key=lambda n: (int(n[1:]), n))


def latest_state(spark: SparkSession, state_dir: str, last: int | None = None) -> DataFrame | None:
    """The counts after batch ``last`` (by default after all): the newest base and the deltas since; null before the first batch."""
    names = [n for n in _done(spark, state_dir) if last is None or int(n[1:]) <= last]
    bases = [n for n in names if n[0] == "v"]
    since = int(bases[-1][1:]) if bases else -1
    parts = [*bases[-1:], *(n for n in names if n[0] == "d" and int(n[1:]) > since)]
    return references.apply_deltas(spark.read.schema(references.STATE).parquet(*[os.path.join(state_dir, n) for n in parts])) if parts else None
