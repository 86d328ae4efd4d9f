"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorewright.sources.scratch import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) of the nodes of `edges` (a, b): the smallest node that links reach. Nodes that stand in no edge are not in the result.

    Large and small stars in turn: every node hands its larger neighbours to the smallest node that it knows, then its smaller ones, until no edge
    changes. Each star is a minimum per node, aggregated before it is shuffled, and a join; a node's neighbours are never one list. Rounds are
    written to the scratch folder, about as many as the logarithm of the longest path.
    """
    now = scratch.write(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        count, mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if (count, mark) == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        before = count, mark
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = scratch.write(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large-stars")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = scratch.write(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "small-stars")
