"""Connected components of an edge table by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, materialised

ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id that each end of `edges` (a, b) reaches.

    Each round every node points to the smallest of itself and its neighbours, pointers are followed twice, and the edges are
    redrawn between what the ends point to; loops and repeats go. Chains shrink by a factor each round and stars in one.
    Nothing is collected, and each round's tables are written to the shared folder.
    """
    edges = materialised(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    done = None
    for _ in range(ROUNDS):
        if not edges.take(1):
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = materialised(both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("to")).withColumnRenamed("a", "id"), "up")
        for _ in range(2):
            jump = up.select(F.col("id").alias("to"), F.col("to").alias("next"))
            new = materialised(up.join(jump, "to").select("id", F.col("next").alias("to")), "up")
            dropped(up)
            up = new
        old, done = done, materialised(_composed(done, up), "components")
        left = edges.join(up.select(F.col("id").alias("a"), F.col("to").alias("ta")), "a").join(up.select(F.col("id").alias("b"), F.col("to").alias("tb")), "b")
        new = materialised(left.where("ta <> tb").select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct(), "edges")
        for x in (edges, up, *([old] if old is not None else [])):
            dropped(x)
        edges = new
    else:
        raise RuntimeError("components did not settle")
    if done is None:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return done.select("id", F.col("to").alias("component"))


def _composed(done: DataFrame | None, up: DataFrame) -> DataFrame:
    """Where every id of all rounds so far points after this one."""
    if done is None:
        return up
    step = up.select(F.col("id").alias("to"), F.col("to").alias("next"))
    return done.join(step, "to", "left").select("id", F.coalesce("next", "to").alias("to"))
