"""Joins along time and along offsets: the latest earlier row (as-of), and points or intervals that overlap intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Time ranges that a key's rows are dealt to.
RANGES = 64


def free(df: DataFrame, *others: DataFrame) -> str:
    """A prefix of which no column name begins."""
    names = [c for d in (df, *others) for c in d.columns]
    prefix = "_"
    while any(c.startswith(prefix) for c in names):
        prefix += "_"
    return prefix


def as_of(left: DataFrame, right: DataFrame, key: str, time: str, values: list[str], tie: str, ranges: int = RANGES) -> DataFrame:
    """`left` with `values` of the row of `right` that has its `key` and the largest `time` not after its own; of equal times the largest `tie`. Null where there is none.

    Both sides are one table, in which the last row of `right` so far is carried forward; nothing is joined by inequality. Time is cut into ranges, so a key with very many rows is
    sorted in as many tasks; what a range begins with is the last row of the ranges before it, one row for each key and range. Null keys and times find nothing
    and are kept. Rows that repeat are kept as often. Names in both sides don't clash: `values` replace columns of these names.
    """
    p = free(left, right)
    part, own, at, is_left, kind, carried = (f"{p}{n}" for n in ("part", "own", "at", "left", "tie", "carried"))
    ends = right.agg(F.min(time).alias("a"), F.max(time).alias("z")).unionByName(left.agg(F.min(time).alias("a"), F.max(time).alias("z"))).agg(F.min("a").alias("a"), F.max("z").alias("z")).first()
    number = lambda c: F.unix_micros(c.cast("timestamp")) if dict(left.dtypes)[time].startswith(("timestamp", "date")) else c.cast("double")
    if ends.a is None or ends.a == ends.z:
        cut = F.lit(0)
    else:
        low, high = (number(F.lit(x)) for x in (ends.a, ends.z))
        cut = F.least(F.lit(ranges - 1), F.floor((number(F.col(time)) - low) / (high - low) * ranges)).cast("int")
    row = F.struct(*[F.col(v).alias(v) for v in values])
    found = right.where(F.col(key).isNotNull() & F.col(time).isNotNull()).select(F.col(key).alias(f"{p}key"), F.col(time).alias(at), cut.alias(part), F.lit(False).alias(is_left), F.col(tie).alias(kind), row.alias(own))
    asked = left.select(F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias(f"{p}row"), F.col(key).alias(f"{p}key"), F.col(time).alias(at), F.coalesce(cut, F.lit(-1)).alias(part), F.lit(True).alias(is_left))
    # one row a key and range, aggregated before it is shuffled
    last = found.groupBy(f"{p}key", part).agg(F.max_by(own, F.struct(at, kind)).alias(own))
    before = Window.partitionBy(f"{p}key").orderBy(part).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = last.select(f"{p}key", part, F.last(own).over(before).alias(carried), F.lead(part).over(Window.partitionBy(f"{p}key").orderBy(part)).alias(f"{p}next"))
    # what ended a range is there at the beginning of all later ones up to the next that has rows
    starts = starts.select(f"{p}key", F.explode(F.sequence(F.col(part) + 1, F.coalesce(f"{p}next", F.lit(ranges)))).alias(part), F.col(carried).alias(own))
    starts = starts.where(F.col(part) < ranges).withColumns({is_left: F.lit(False), at: F.lit(None).cast(dict(found.dtypes)[at]), kind: F.lit(None).cast(dict(found.dtypes)[kind])})
    both = found.unionByName(starts).unionByName(asked, allowMissingColumns=True)
    order = Window.partitionBy(f"{p}key", part).orderBy(F.col(at).asc_nulls_first(), is_left, kind).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = both.withColumn(carried, F.last(own, ignorenulls=True).over(order)).where(is_left)
    hit = F.when(F.col(f"{p}key").isNotNull() & F.col(at).isNotNull(), F.col(carried))
    kept = [c for c in left.columns if c not in values]
    return out.select(*[F.col(f"{p}row")[c].alias(c) for c in kept], *[hit[v].alias(v) for v in values])


def overlapping(left: DataFrame, right: DataFrame, key: str, begin: str, end: str, other_begin: str, other_end: str) -> DataFrame:
    """Pairs of rows of equal `key` whose intervals [begin, end) and [other_begin, other_end) share a place; a point is an interval of length one.

    Each length has its level of bins, as wide as the power of two that is not below it, so an interval touches two bins at most at its own level and at coarser ones. A pair
    meets at the level of its longer interval, in bins of which there are as many as such intervals, and comes out of the first bin alone that both touch. There are 64 levels at most, and an
    interval stands only at those that the other side has. Empty intervals, null bounds and null keys meet nothing. The names of both sides must differ, but for `key`.
    """
    p = free(left, right)
    level, bin_ = f"{p}level", f"{p}bin"

    def laid(df: DataFrame, a: str, z: str) -> DataFrame:
        df = df.where(F.col(a).isNotNull() & F.col(z).isNotNull() & F.col(key).isNotNull() & (F.col(z) > F.col(a)))
        # the power of two that is not below the length
        return df.withColumn(f"{p}own", F.ceil(F.log2((F.col(z) - F.col(a)).cast("double"))).cast("int"))

    one, two = laid(left, begin, end), laid(right, other_begin, other_end)
    levels = [sorted(r[0] for r in df.select(f"{p}own").distinct().collect()) for df in (one, two)]

    def placed(df: DataFrame, a: str, z: str, at: Column) -> DataFrame:
        """A row for each level and bin: an interval is no longer than its own level's bins, and so touches two at most there and above."""
        rows = df.withColumn(level, F.explode(at))
        width = F.call_function("shiftleft", F.lit(1).cast("long"), F.col(level))
        low, high = F.floor(F.col(a) / width), F.floor((F.col(z) - 1) / width)
        return rows.withColumn(bin_, F.explode(F.sequence(low.cast("long"), high.cast("long")))).drop(f"{p}own")

    every = [F.array(*[F.lit(x) for x in x_levels]).cast("array<int>") for x_levels in levels]
    # longer on the right or equal: at the right's level; longer on the left: at the left's
    at_right = placed(one, begin, end, F.filter(every[1], lambda x: x >= F.col(f"{p}own"))).join(placed(two, other_begin, other_end, F.array(f"{p}own")), [key, level, bin_])
    at_left = placed(one, begin, end, F.array(f"{p}own")).join(placed(two, other_begin, other_end, F.filter(every[0], lambda x: x > F.col(f"{p}own"))), [key, level, bin_])
    width = F.call_function("shiftleft", F.lit(1).cast("long"), F.col(level))
    first = F.col(bin_) == F.floor(F.greatest(F.col(begin), F.col(other_begin)) / width)
    return at_right.unionByName(at_left).where(first & (F.col(begin) < F.col(other_end)) & (F.col(other_begin) < F.col(end))).drop(level, bin_)
