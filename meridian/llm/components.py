"""Connected components of an edge table as DataFrame rounds (hook to the smallest neighbour, flatten, contract)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.llm.common import written


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges(u, v)``; root is the smallest node of its component.

    Each round every node hooks to its smallest smaller neighbour, the forest is flattened
    by pointer jumping and the edges are contracted, so the rounds grow with the logarithm
    of the longest path. State is written to the shared folder after each step; nothing but
    counts reaches the driver. Self-loops and repeated edges are harmless, no edges give no rows.
    """
    left = edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    nodes = left.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    labels = written(spark, nodes.select("node", F.col("node").alias("root")), "cc-labels")
    left = written(spark, left.where("u < v").distinct(), "cc-edges")
    while left.limit(1).count():
        parents = written(spark, left.groupBy("v").agg(F.min("u").alias("p")), "cc-parents")
        while True:
            up = parents.select(F.col("v").alias("p"), F.col("p").alias("pp"))
            parents = written(spark, parents.join(up, "p", "left").select(
                "v", F.coalesce("pp", "p").alias("p"), F.col("pp").isNotNull().alias("moved")), "cc-parents")
            if not parents.where("moved").limit(1).count():
                break
            parents = parents.drop("moved")
        to = parents.select(F.col("v").alias("old"), F.col("p").alias("new"))
        labels = written(spark, labels.join(to, labels.root == to.old, "left")
                         .select("node", F.coalesce("new", "root").alias("root")), "cc-labels")
        moved = (left.join(to, left.u == to.old, "left").select(F.coalesce("new", "u").alias("u"), "v")
                 .join(to, F.col("v") == to.old, "left").select("u", F.coalesce("new", "v").alias("v")))
        left = written(spark, moved.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
                       .distinct(), "cc-edges")
    return labels
