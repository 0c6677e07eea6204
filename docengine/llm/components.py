"""Connected components of a table of links, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage


def components(vertices: DataFrame, edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``id`` and ``component`` (the smallest id reached) of each of ``vertices`` (``id``), by ``edges`` (``a``, ``b``).

    Smallest labels travel along the links, and labels are followed to their own label, so long chains halve each round. A
    vertex with very many links is reduced by partial minima before the shuffle. Every round is cut from its lineage.
    """
    both = cut_lineage(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct())
    labels = cut_lineage(vertices.select("id").distinct().withColumn("label", F.col("id")))
    for _ in range(most_rounds):
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        step = labels.join(near, "id", "left").select("id", F.least("label", F.coalesce("near", "label")).alias("next"), F.col("label").alias("old"))
        far = step.select(F.col("id").alias("next"), F.col("next").alias("far"))
        jumped = step.join(far, "next", "left").select("id", F.least("next", F.coalesce("far", "next")).alias("label"), "old")
        jumped = cut_lineage(jumped)
        done = jumped.where("label <> old").isEmpty()
        labels = jumped.select("id", "label")
        if done:
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return labels.withColumnRenamed("label", "component")
