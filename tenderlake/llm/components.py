"""Connected components of a link table, by joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.llm.common import written


def components(spark: SparkSession, links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b); root is the smallest node of its component.

    Alternates the large-star and the small-star step: each node hands its larger, then its smaller neighbours to
    the smallest node next to it. The number of rounds grows with the logarithm of the number of nodes. Minima are
    aggregated before they are joined back, so a node with very many links costs one row a task in the shuffle, and
    each round's links are written to the shared folder. Null ends are dropped; an empty table has no components.
    """
    edges = written(spark, links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    for _ in range(max_rounds):
        # large star: larger neighbours of a node go to the smallest node around it
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: smaller neighbours and the node itself go to its smallest neighbour
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        new = written(spark, small.where("a <> b").distinct(), "links")
        # done when every node hangs below one root that hangs below none, and nothing moved
        moved = edges.exceptAll(new).limit(1).count() + new.exceptAll(edges).limit(1).count()
        edges = new
        if not moved:
            roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
