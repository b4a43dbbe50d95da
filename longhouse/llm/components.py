"""Connected components of an edge table, without a driver or a task that sees them all."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from longhouse.llm.common import lookup
from longhouse.session import stage


def local_labels(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest node of each node's component among nodes 0..n-1 with edges (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        # roots of both ends point to the smaller one, then all paths are halved
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
        if (label == before).all():
            return label


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node in ``edges`` (a, b: long), label being its component's smallest node.

    First every node keeps its smallest neighbour below it and hands its other ones that neighbour
    instead (small-star steps, Kiveris et al. 2014), until each has one: a forest. Then paths are
    halved until every node points to its root. Each round is written to the shared folder, which
    cuts the lineage. A smallest node with any share of the edges is no bottleneck: steps gather by
    the larger end, and paths are followed with ``lookup``. Self-loops and repeated edges are
    harmless; no edges give no rows.
    """
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    # edges that are there for the least neighbour are settled, those handed on are not
    forest = stage(down.withColumn("moved", F.lit(True)), "edges")
    while not forest.where("moved").isEmpty():
        low = F.min("b").over(Window.partitionBy("a"))
        both = forest.select("a", "b", low.alias("m")).select(
            F.inline(
                F.array(
                    F.struct(F.col("a"), F.col("m").alias("b"), F.lit(False).alias("moved")),
                    F.struct(F.col("b").alias("a"), F.col("m").alias("b"), F.lit(True).alias("moved")),
                )
            )
        )
        forest = stage(both.where("a <> b").groupBy("a", "b").agg(F.max("moved").alias("moved")), "edges")
    paths = forest.select("a", "b", F.lit(True).alias("moved"))
    while not paths.where("moved").isEmpty():
        up = paths.select(F.col("a").alias("b"), F.col("b").alias("up"))
        higher = lookup(paths.select("a", "b"), up, "b", F.xxhash64("a"))
        paths = stage(
            higher.select("a", F.coalesce("up", "b").alias("b"), F.col("up").isNotNull().alias("moved")), "edges"
        )
    return paths.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        paths.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    )
