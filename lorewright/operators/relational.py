"""Relational operators: latest row, pending rows, dimension keys, key checks, append without repeats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lorewright.functions.keys import idempotency_key


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in `order`; end it with a unique column so ties are decided.

    Only the first rank is asked for, so each task passes on one row a key before the exchange (a window group limit): a hot key
    is one row for each map task, not a partition of all its rows.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def pending(rows: DataFrame, done: DataFrame, key: Column) -> DataFrame:
    """Rows without any counterpart in `done`; superseded rows and rows whose work was cut off half way are told apart by incomplete()."""
    return rows.join(done, key, "left_anti")


def incomplete(rows: DataFrame, expected: str, done: DataFrame, id_col: str, done_id: str) -> DataFrame:
    """Rows with fewer counterparts in `done` than `expected` says."""
    have = done.groupBy(F.col(done_id).alias("_id")).agg(F.count(F.lit(1)).alias("_have"))
    return rows.join(have, F.col(id_col) == F.col("_id"), "left").where(F.coalesce("_have", F.lit(0)) < F.col(expected)).drop("_id", "_have")


def with_keys(rows: DataFrame, dimension: DataFrame, name: str, key: str = "id", dim_name: str = "nombre") -> tuple[DataFrame, DataFrame]:
    """(`rows` with `key` found by exact name, the rows that `dimension` lacks with new keys after its largest, in order of name)."""
    top = dimension.agg(F.coalesce(F.max(key), F.lit(0)).alias("_top"))
    missing = rows.select(F.col(name).alias(dim_name)).where(F.col(dim_name).isNotNull()).distinct().join(dimension.select(dim_name), dim_name, "left_anti")
    new = numbered(missing, [F.col(dim_name)], "_n").select((F.lit(top.first()[0]) + F.col("_n")).alias(key), dim_name)
    known = dimension.groupBy(dim_name).agg(F.min(key).alias(key)).unionByName(new.select(dim_name, key))
    return rows.join(known.withColumnRenamed(dim_name, name), name, "left"), new


def numbered(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """`df` numbered from 1 in `order` without one task for all rows: ranges are sorted apart and shifted by the counts before them.

    The table of counts has one row per range, as many as there are shuffle partitions.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    within = dealt.withColumn("_part", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id())
    first = within.groupBy("_part").agg(F.count(F.lit(1)).alias("_count"), F.min("_row").alias("_first"))
    before = F.coalesce(F.sum("_count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = first.select("_part", "_first", before.alias("_before"))
    return within.join(F.broadcast(first), "_part").withColumn(name, F.col("_before") + F.col("_row") - F.col("_first") + 1).drop("_part", "_row", "_first", "_before")


def repeated_keys(rows: DataFrame, id_col: str = "object_path") -> DataFrame:
    """Keys that more than one row holds: (legacy, key, time, n, ids). Rows with a drive id are keyed by id and time, the others by hash."""
    key = idempotency_key(F.col("drive_file_id"), F.col("modified_time"), F.col("hash_md5"))
    groups = rows.select(key.alias("k"), F.col(id_col).cast("string").alias("i")).groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("i")).alias("ids"))
    return groups.where("n > 1").select("k.legacy", "k.key", "k.time", "n", "ids")


def orphans(rows: DataFrame, parents: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows without a parent that has the same values; null equals null."""
    other = parents.select(*[F.col(p).alias(f"_p{k}") for k, (_, p) in enumerate(pairs)])
    on = F.lit(True)
    for k, (c, _) in enumerate(pairs):
        on = on & F.col(c).eqNullSafe(F.col(f"_p{k}"))
    return rows.join(other, on, "left_anti")


def new_rows(rows: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key isn't stored, one per key (the first by all columns)."""
    on = F.lit(True)
    held = stored.select(*[F.col(k).alias(f"_s_{k}") for k in keys])
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_s_{k}"))
    return latest(rows.join(held, on, "left_anti"), keys, [F.col(c).asc_nulls_last() for c in rows.columns])


def foreign(df: DataFrame, column: str, parents: DataFrame, key: str) -> DataFrame:
    """Rows whose non-null reference has no parent."""
    return df.where(F.col(column).isNotNull()).join(parents.select(F.col(key).alias(column)), column, "left_anti")
