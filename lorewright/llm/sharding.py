"""Sharding: rendezvous hashing of stable record keys over weighted shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import hex_number, materialised

#: Hex digits of MD5 behind a score: as many bits as a double holds.
DIGITS = 13


def scores(key: Column, weights: Sequence[float]) -> Column:
    """array<struct<score, rank, shard>>: each shard's rendezvous score, -weight / ln(u) with u from MD5(key:shard)."""
    w = F.array(*[F.lit(float(x)) for x in weights])

    def score(s: Column) -> Column:
        u = (hex_number(F.concat(key, F.lit(":"), s.cast("string")), DIGITS) + F.lit(0.5)) / F.lit(float(16**DIGITS))
        return F.struct((-F.get(w, s) / F.ln(u)).alias("score"), (-s).alias("rank"), s.alias("shard"))

    return F.transform(F.sequence(F.lit(0), F.lit(len(weights) - 1)), score)


def winner(found: Column) -> Column:
    """The shard with the highest score; of equal ones the smallest."""
    return F.array_max(found)["shard"]


def free(df: DataFrame, *names: str) -> list[str]:
    """Column names like these that `df` doesn't have."""
    out = []
    for name in names:
        while name in df.columns:
            name = f"_{name}"
        out.append(name)
    return out


def assigned(df: DataFrame, key_col: str, weights: Sequence[float], grown: float | None = None) -> DataFrame:
    """`df` with shard, and with grown_shard where one more shard of weight `grown` stands at the end; columns of these names are replaced.

    A record's shard depends on its key and the weights alone: the other shards' scores don't change when one is added, so
    records move only into the new shard, and about its share of them. Null keys count as empty; rows that repeat a key go
    together; of equal scores the smaller shard wins. No shuffle.
    """
    made = ["shard"] + ["grown_shard"] * (grown is not None)
    if key_col in made:
        raise ValueError(f"the key column may not be named {key_col!r}")
    all_weights = [*weights, *([grown] if grown is not None else [])]
    (held,) = free(df, "_scores")
    df = df.withColumn(held, scores(F.coalesce(F.col(key_col).cast("string"), F.lit("")), all_weights))
    df = df.withColumn("shard", winner(F.slice(held, 1, len(weights))))
    if grown is not None:
        df = df.withColumn("grown_shard", winner(F.col(held)))
    return df.drop(held)


def placed(df: DataFrame, key_col: str, rows_per_bucket: int = 1_000_000) -> DataFrame:
    """`df` (with shard) plus slot: each row's place in its shard, gapless from 0; a column of that name is replaced.

    Rows are numbered within (shard, bucket) and shifted by the counts of the buckets before, so no task holds a shard. A bucket is a
    hash of the key and of the whole row, so rows of one key, null among them, are dealt too. The table of counts has one row
    per shard and bucket: 256 or 4,096 buckets, by the row count. Rows of one key are in the order of a hash of all
    their columns; equal rows take places of their own.
    """
    if key_col in ("shard", "slot"):
        raise ValueError(f"the key column may not be named {key_col!r}")
    df = df.drop("slot")
    mark, bucket, rank, n, before = free(df, "_mark", "_bucket", "_rank", "_n", "_before")
    digits = 2 if df.count() < 256 * 40 * rows_per_bucket else 3
    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
    df = df.withColumn(mark, F.md5(whole)).withColumn(bucket, F.substring(mark, 1, digits))
    order = Window.partitionBy("shard", bucket).orderBy(key_col, mark)
    ranked = materialised(df.withColumn(rank, F.row_number().over(order)), "shard-rows")
    counts = ranked.groupBy("shard", bucket).agg(F.count(F.lit(1)).alias(n))
    earlier = Window.partitionBy("shard").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn(before, F.coalesce(F.sum(n).over(earlier), F.lit(0))).drop(n)
    out = ranked.join(F.broadcast(counts), ["shard", bucket])
    return out.withColumn("slot", (F.col(before) + F.col(rank) - 1).cast("long")).drop(mark, bucket, rank, before)


def write_shards(df: DataFrame, key_col: str, weights: Sequence[float], path: str) -> None:
    """Writes `df` as one folder per shard (`shard=<k>`). Null keys count as empty, repeated rows are all written, and an empty table writes no folder."""
    assigned(df, key_col, weights).write.partitionBy("shard").parquet(path)
