"""Session defaults, the shared folder and lineage cuts."""

from __future__ import annotations

import gc
import os
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "docengine", cores: str | int = "*", **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for; ``conf`` overrides."""
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",  # a cut lineage goes when nothing refers to it
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    builder = SparkSession.builder.appName(app)
    if "SPARK_MASTER" not in os.environ:
        builder = builder.master(f"local[{cores}]")
    return builder.config(map=base | conf).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Only where the setting is absent and the master is local (as in tests) a temporary folder is made.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named:
        if not (sc.master or "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="docengine-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so that later stages survive lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_packed(df: DataFrame) -> DataFrame:
    """``cut_lineage`` of rows packed a batch at a time: Spark writes its own rows unpacked, which take several times the room."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, b.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(b)
            yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["packed"])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for packed in b.column(0):
                yield from pa.ipc.open_stream(packed.as_py())

    return cut_lineage(df.mapInArrow(pack, "packed binary")).mapInArrow(unpack, df.schema)


def free_unused(spark: SparkSession) -> None:
    """Let shuffle files and lineage cuts go that nothing refers to any more: Spark deletes them when the driver collects its garbage, which may be long after."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def spread(df: DataFrame) -> DataFrame:
    """``df`` of a plain scan over at least as many tasks as the cluster runs at once; a no-op where the scan has them.

    For work that is heavy per row, such as reading text; large inputs always have enough tasks and are not moved.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(wanted) if df._jdf.queryExecution().toRdd().getNumPartitions() < wanted else df
