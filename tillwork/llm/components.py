"""Connected components of a graph in a table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b): the smallest node that links reach.

    Each pass hangs every node's larger neighbours, then its smaller ones, on the smallest node it
    sees, until nothing moves; passes grow with the logarithm of the longest path.  Neighbours meet
    in joins and minima, never in one list.  Every pass is a table in the shared folder.
    """
    e = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        # a > b throughout
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = now
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # nodes without a smaller neighbour are minima of their own
        large = large.where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        hung = down.select("a", F.col("m").alias("b"))
        e = stored(small.where("a <> b").unionByName(hung).distinct(), "edges")
