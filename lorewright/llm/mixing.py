"""Mixing sources to target weights: iterative proportional fitting of token weights, then sampling by calibrated probabilities."""

from __future__ import annotations

import math
import warnings
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hex_number, materialised

#: Sweeps over all margins at most; error of a margin's share that ends the fit.
SWEEPS, ERROR = 64, 1e-12
#: Error of a margin's share from which a fit that has ended by its sweeps is none.
MISSED = 1e-6
#: Cells up to which the table of cells is broadcast, and combinations of all margins but the longest, which come to the driver in each sweep.
BROADCAST_CELLS, COMBINATIONS = 100_000, 100_000
#: Listed shares that leave less than this of a margin leave nothing: sums of decimal shares miss 1 by a few roundings.
LEFT = 1e-9
NONE = "none"
WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(text: Column) -> Column:
    """Words of the whole text, parted by ASCII white space; null has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def length_topic(tokens: Column) -> Column:
    """The topic of a document for want of a better one: brief, article or book, by its words."""
    return F.when(tokens < 60, "brief").when(tokens < 600, "article").otherwise("book")


def targets(cells: DataFrame, name: str, listed: Mapping[str, float], keep_unlisted: bool) -> DataFrame:
    """(name, _want): the share of all tokens that each value that occurs is to get.

    A value that is listed gets its listed share; the values that aren't divide what is left by their tokens. Shares are scaled to one over
    the values that occur; if all of these are to get nothing, they keep their own shares.
    """
    want = F.lit(None).cast("double")
    for value, share in listed.items():
        want = F.when(F.col(name).eqNullSafe(F.lit(value)), F.lit(float(share))).otherwise(want)
    left = max(0.0, 1.0 - sum(listed.values()))
    values = cells.groupBy(name).agg(F.sum("tokens").cast("double").alias("_n")).where("_n > 0").withColumn("_want", want)
    row = values.agg(F.sum("_n"), F.sum(F.when(F.col("_want").isNull(), F.col("_n"))), F.sum("_want")).first()
    everything, others, given = (float(x or 0.0) for x in row)
    if keep_unlisted and left < LEFT:
        kept = F.col("_n") / everything if everything else F.lit(0.0)
        want = F.coalesce(F.col("_want") * ((1 - others / everything) / given) if given else F.lit(None).cast("double"), kept)
        return values.select(name, want.alias("_want"))
    whole = given + (left if others else 0.0)
    want = F.coalesce("_want", F.col("_n") * (left / others if others else 0.0))
    # nothing that occurs is to get anything: the values keep their shares
    return values.select(name, (want / whole if whole else F.col("_n") / max(everything, 1.0)).alias("_want"))


def fitted(cells: DataFrame, margins: Mapping[str, Mapping[str, float]], keep_unlisted: bool = False, unmet: str = "error") -> DataFrame:
    """`cells` (one row per combination of the margins' columns, with `tokens`) plus `weight`: tokens raked to the targets(), with the same sum.

    A cell's weight is its tokens times a factor for each of its values. The margin with the most values is a column: its factor
    is found in each row of a table that holds one value with all its cells, so no value's cells are sorted or ranked, and the only shuffle
    of a sweep is that of sums by the other margins' combinations. These sums, COMBINATIONS of them at most, come to the
    driver, which finds the other margins' factors. The fit ends when all margins are met within ERROR; if they aren't within MISSED after
    SWEEPS sweeps, the targets contradict each other on these cells: `unmet` "error" raises, "warn" goes on with a warning, the longest margin
    met and the others as near as they came. Without tokens every weight is 0.

    keep_unlisted: where the listed shares leave nothing, the values that aren't listed keep their own shares of the tokens and the
    listed ones divide the rest, instead of the others being lost.
    """
    spark, names = cells.sparkSession, list(margins)
    cells = materialised(cells, "cells")
    wants = {name: targets(cells, name, margins[name], keep_unlisted) for name in names}
    total = cells.agg(F.sum("tokens")).first()[0]
    if not total:
        return cells.withColumn("weight", F.lit(0.0))
    sizes = {name: wants[name].count() for name in names}
    long = max(names, key=lambda name: (sizes[name], name == names[0]))
    short = [name for name in names if name != long]
    found = {name: {r[0]: r[1] for r in wants[name].limit(COMBINATIONS + 1).collect()} for name in short}
    if math.prod(max(1, len(found[name])) for name in short) > COMBINATIONS:
        raise ValueError(f"more than {COMBINATIONS} combinations of {short}")
    values = {name: sorted(found[name], key=lambda v: (v is None, v)) for name in short}
    code = F.lit(0).cast("long")
    for name in short:
        known = [v for v in values[name] if v is not None]
        place = F.greatest(F.array_position(F.lit(known), F.col(name)) - 1, F.lit(0)) if known else F.lit(0)
        cells = cells.withColumn(f"_{name}", F.when(F.col(name).isNull(), F.lit(len(known))).otherwise(place).cast("long"))
        code = code * len(values[name]) + F.col(f"_{name}")
    packed = cells.where("tokens > 0").withColumn("_code", code.cast("int")).groupBy(long, "_code").agg(F.sum("tokens").cast("double").alias("n"))
    packed = packed.groupBy(long).agg(F.collect_list(F.struct("_code", "n")).alias("cells"))
    packed = packed.join(wants[long].withColumnRenamed(long, "_v"), F.col(long).eqNullSafe(F.col("_v"))).drop("_v")
    packed = materialised(packed.withColumn("want", F.col("_want") * total), "packed-cells")
    factors = {name: [1.0] * len(values[name]) for name in short}

    def product(combination: int) -> float:
        out = 1.0
        for name in reversed(short):
            combination, k = divmod(combination, len(values[name]))
            out *= factors[name][k]
        return out

    def factor() -> Column:
        """The long margin's factor in each row of `packed`, for the present factors of the others."""
        size = math.prod(len(values[name]) for name in short)
        by_code = F.lit([product(c) for c in range(size)])
        now = F.aggregate("cells", F.lit(0.0), lambda s, x: s + x["n"] * F.get(by_code, x["_code"]))
        return F.when(now > 0, F.col("want") / now).otherwise(F.lit(0.0))

    def shares(sums: list[tuple[int, float]], name: str) -> list[float]:
        """What each value of a short margin gets, as a share, for the present factors."""
        out = [0.0] * len(values[name])
        for combination, x in sums:
            weight, rest = product(combination), combination
            for other in reversed(short):
                rest, k = divmod(rest, len(values[other]))
                if other == name:
                    out[k] += x * weight / total
        return out

    gap = 0.0
    for _ in range(SWEEPS):
        rows = packed.withColumn("a", factor()).select("a", F.explode("cells").alias("x"))
        sums = [(r[0], r[1]) for r in rows.groupBy(F.col("x._code")).agg(F.sum(F.col("a") * F.col("x.n"))).collect()]
        gap = max((abs(x - found[name][v]) for name in short for x, v in zip(shares(sums, name), values[name], strict=True)), default=0.0)
        if gap < ERROR:
            break
        for name in short:
            now = shares(sums, name)
            factors[name] = [f * found[name][v] / x if x > 0 else 0.0 for f, x, v in zip(factors[name], now, values[name], strict=True)]
    if gap > MISSED:
        text = f"the targets of {names} contradict each other on these rows: a share is off by {gap:.2g} after {SWEEPS} sweeps"
        if unmet == "error":
            raise ValueError(text)
        warnings.warn(text, stacklevel=2)
    by_value = packed.select(F.col(long).alias("_v"), factor().alias("_a"))
    weight = F.col("tokens").cast("double") * F.coalesce("_a", F.lit(0.0))
    for name in short:
        weight = weight * F.get(F.lit(factors[name]), F.col(f"_{name}").cast("int"))
    if sizes[long] <= BROADCAST_CELLS:
        by_value = F.broadcast(by_value)
    out = cells.join(by_value, F.col(long).eqNullSafe(F.col("_v")), "left").withColumn("weight", weight)
    return out.drop("_v", "_a", *[f"_{name}" for name in short])


def calibrated(docs: DataFrame, margins: Mapping[str, Mapping[str, float]], fraction: float = 1.0, topic=length_topic, id_col: str = "doc_id", text_col: str = "text", seed: str = "mix", keep_unlisted: bool = False, unmet: str = "error") -> DataFrame:
    """`docs` plus _source, _lang, _topic, _tokens, _rate (expected copies per document) and _copies.

    margins: targets by "source", "lang" and "topic". The rate of a cell is fraction * fitted weight / tokens; a document
    gets the whole part of it as copies, and one more if a hash of its id falls under the rest: the same rows always give the
    same sample, and a row that repeats an id gets the same answer. Null sources and languages are a value of their own. Documents without words count as one token.
    """
    marked = docs.withColumn("_tokens", F.greatest(word_count(F.col(text_col)), F.lit(1)))
    marked = marked.withColumns({"_source": F.coalesce("source", F.lit(NONE)), "_lang": F.coalesce("lang", F.lit(NONE)), "_topic": topic(F.col("_tokens"))})
    keys = [f"_{name}" for name in margins]
    cells = marked.groupBy(*[F.col(k).alias(k[1:]) for k in keys]).agg(F.sum("_tokens").alias("tokens"))
    rates = fitted(cells, margins, keep_unlisted, unmet).select(*[F.col(k[1:]).alias(k) for k in keys], (F.col("weight") / F.col("tokens") * F.lit(float(fraction))).alias("_rate"))
    if rates.count() <= BROADCAST_CELLS:
        rates = F.broadcast(rates)
    u = (hex_number(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 12) + F.lit(0.5)) / F.lit(float(16**12))
    out = marked.join(rates, keys)
    return out.withColumn("_copies", (F.floor("_rate") + (u < F.col("_rate") - F.floor("_rate")).cast("long")).cast("long"))


def mixed(docs: DataFrame, margins: Mapping[str, Mapping[str, float]], fraction: float = 1.0, keep_unlisted: bool = False, unmet: str = "error") -> DataFrame:
    """The sampled rows of `docs`, its own columns only, each as often as it has copies: rates over 1 repeat rows, or the targets would be missed.

    Null texts count as one token and null sources and languages as a value; rows that repeat an id are sampled alike; an empty table gives no rows.
    """
    own = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    # other columns keep out of the way of those that calibrated() adds
    renamed = docs.select(*[F.col(f"`{c}`").alias(c if c in ("doc_id", "text", "source", "lang") else n) for c, n in own.items()])
    sampled = calibrated(renamed, margins, fraction, keep_unlisted=keep_unlisted, unmet=unmet).where("_copies > 0")
    sampled = sampled.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    return sampled.select(*[F.col(c if c in ("doc_id", "text", "source", "lang") else n).alias(c) for c, n in own.items()])
