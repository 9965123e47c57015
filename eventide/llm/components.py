"""Connected components of a graph held in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventide.session import ensure_checkpoint_dir


def connected_components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """``(node, component)`` of every node of ``edges (a, b)`` (bigints);
    component is the smallest node reachable.

    Every round hooks each node, and its parent, below the smallest grandparent
    among its neighbours, then shortcuts; the number of rounds grows with the
    logarithm of the longest path. Rounds are cut by checkpoint(), so a lost
    executor costs one round at most, and nothing is gathered on the driver
    but one sum. Joins are on plain exchanges, so AQE splits a large star.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    both = (edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
            .filter("a != b").distinct().checkpoint())
    f = both.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("parent")).checkpoint()
    total = None
    for _ in range(max_rounds):
        now = f.agg(F.sum(F.col("parent").cast("decimal(38,0)")).alias("t")).first()["t"]
        if now == total:  # parents only fall: an equal sum is an equal table
            return f.withColumnRenamed("parent", "component")
        total = now
        up = f.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        g = f.join(up, "parent").select("node", "parent", "grand").checkpoint()
        near = both.join(g.select(F.col("node").alias("b"), F.col("grand").alias("low")), "b").select("a", "low")
        least = near.groupBy(F.col("a").alias("node")).agg(F.min("low").alias("low"))
        own = g.join(least, "node")
        f = (own.select("node", F.least("grand", "low").alias("parent"))
             .union(own.select(F.col("parent").alias("node"), F.least("grand", "low").alias("parent")))
             .groupBy("node").agg(F.min("parent").alias("parent")).checkpoint())
    raise RuntimeError(f"no end after {max_rounds} rounds")
