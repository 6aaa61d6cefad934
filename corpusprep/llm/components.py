"""Connected components of a table of edges, without bringing edges or components to the driver."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.session import ensure_checkpoint_dir


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` (the smallest node of its component) for every node of an edge.

    Rounds of minimum propagation, each followed by pointer jumping, until no root changes. The
    labels are checkpointed between rounds, so lineage stays short and survives lost executors.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    pairs = edges.where(F.col(a) != F.col(b)).select(F.col(a).alias("node"), F.col(b).alias("other"))
    both = pairs.union(pairs.select("other", "node")).distinct().checkpoint()
    labels = both.groupBy("node").agg(F.least("node", F.min("other")).alias("root")).checkpoint()
    while True:
        seen = both.join(labels.select(F.col("node").alias("other"), F.col("root").alias("r")), "other").groupBy("node").agg(F.min("r").alias("r"))
        near = labels.join(seen, "node").select("node", F.col("root").alias("was"), F.least("root", "r").alias("root"))
        hop = near.select(F.col("node").alias("root"), F.col("root").alias("next"))
        moved = near.join(hop, "root", "left").select("node", "was", F.least("root", F.coalesce("next", "root")).alias("root")).checkpoint()
        labels = moved.select("node", "root")
        if moved.where("was <> root").isEmpty():
            return labels
