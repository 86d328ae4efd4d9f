"""Hard negatives by norm-bucketed search: candidates sorted by norm, in buckets that a bound on the inner product skips."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lorewright.operators.relational import numbered

from .common import dropped, materialised, shipped

#: Rows of a bucket and buckets at most (beyond them buckets grow); anchors that meet a bucket in one task, and of these at once.
BUCKET, BUCKETS, ANCHORS, TOGETHER = 16_384, 65_536, 8_192, 64
#: What a component is multiplied by before it is rounded down, positives of an anchor, negatives of a positive, percent of the positive's score at least and at most.
SCALE, POSITIVES, NEGATIVES, AT_LEAST, AT_MOST = 256, 5, 5, 80, 100
#: Parts in which an anchor's hits are first brought together.
PARTS = 32
ROWS = "id long, label long, v array<long>, norm double"
FOUND = "anchor long, place int, id long, score long"


def whole(vectors: DataFrame, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """(id, label, v, norm) of the rows that take part: components are multiplied by SCALE and rounded down."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.coalesce((F.size(v) > 0) & ~bad, F.lit(False)))
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.transform(v, lambda x: F.floor(x * SCALE)).alias("v"), F.transform(v, lambda x: F.floor(x * SCALE).cast("double")).alias("d"))
    return rows.withColumn("norm", F.sqrt(F.aggregate("d", F.lit(0.0), lambda s, x: s + x * x))).drop("d")


def bucketed(rows: DataFrame, order: list[Column], count: int, size: int, name: str) -> tuple[DataFrame, pd.DataFrame]:
    """(`rows` with bucket, the buckets' highest norms, least and largest labels and sizes): ranges of the rows in `order`, about `size` in each, equal norms dealt by id."""
    n = min(BUCKETS, max(1, -(-count // size)))
    table = materialised(rows.repartitionByRange(n, *order).withColumn("bucket", F.spark_partition_id()), name)
    # one row a bucket
    about = table.groupBy("bucket").agg(F.max("norm").alias("top"), F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("n")).toPandas()
    return table, about.sort_values("bucket", ignore_index=True)


def product(exact: bool, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of rows: through doubles where no partial sum leaves their whole numbers, else in 64 bits."""
    return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64) if exact else a @ b.T


def best_of(hits: DataFrame, k: int) -> DataFrame:
    """The `k` best hits of each anchor and place, higher scores and then smaller ids first, in two steps: no list holds the hits of all buckets."""
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "id"))), 1, k).alias("best")
    for keys in (["anchor", "place", F.pmod(F.xxhash64("id"), F.lit(PARTS)).alias("part")], ["anchor", "place"]):
        hits = hits.groupBy(*keys).agg(best).select("anchor", "place", F.explode("best").alias("x")).select("anchor", "place", "x.id", (-F.col("x.s")).alias("score"))
    return hits


def searched(table: DataFrame, about: pd.DataFrame, anchors: DataFrame, windows: DataFrame, same: bool, k: int, exact: bool, group: int = ANCHORS) -> DataFrame:
    """(anchor, place, id, score): the `k` best rows of `table` in each window (anchor, place, low, high) of the anchors (anchor, id, label, v, norm), of the same label or of others.

    Buckets are met in the order of their norms, in rounds that grow fourfold: a window goes to a bucket only if |anchor| times the bucket's highest
    norm reaches its lower limit and, once it holds `k` rows, the last of their scores. Equal scores go on, since ids decide between them.
    """
    spark = table.sparkSession
    top, low, high, sizes = (about[c].to_numpy() for c in ("top", "low", "high", "n"))
    names = about["bucket"].to_numpy(np.int64)
    shared = spark.sparkContext.broadcast((names, top, low, high))
    # in an index by label the buckets of a label lie together, and its first has the highest norms
    chains = int(np.max(np.searchsorted(low, high, "right") - np.searchsorted(high, low, "left"), initial=0)) if same else len(names)
    hits, made = None, []

    def routed(begin: int, end: int):
        def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            names, top, low, high = shared.value
            for batch in batches:
                for k0 in range(0, len(batch), TOGETHER):
                    some = batch.iloc[k0 : k0 + TOGETHER]
                    label = some["label"].to_numpy()[:, None]
                    if same:
                        fits = (low <= label) & (label <= high)
                        turn = np.cumsum(fits, axis=1) - 1
                    else:
                        fits = ~((low == label) & (high == label))
                        turn = np.broadcast_to(np.arange(len(names)), fits.shape)
                    limit = np.array([min(x) for x in some["limits"]])[:, None]
                    reach = some["norm"].to_numpy()[:, None] * top * (1 + 1e-12)
                    row, column = np.nonzero(fits & (turn >= begin) & (turn < end) & (reach >= limit))
                    yield some.iloc[row].assign(bucket=names[column])

        return route

    def search(rows: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {name: [] for name in ("anchor", "place", "id", "score")}
        if len(rows) and len(wanted):
            rows = rows.sort_values("id", ignore_index=True)
            ids, label, v = rows["id"].to_numpy(np.int64), rows["label"].to_numpy(np.int64), np.stack(rows["v"].to_numpy())
            for k0 in range(0, len(wanted), TOGETHER):
                some = wanted.iloc[k0 : k0 + TOGETHER]
                for scores, w in zip(product(exact, np.stack(some["v"].to_numpy()), v), some.itertuples(), strict=True):
                    fits = (label == w.label) & (ids != w.id) if same else label != w.label
                    near = np.flatnonzero(fits & (scores >= min(w.limits)) & (scores <= max(w.highs)))
                    # ids are in order, and stay so among equal scores
                    near = near[np.argsort(-scores[near], kind="stable")]
                    down = -scores[near]
                    for place, high, least in zip(w.places, w.highs, w.limits, strict=True):
                        first = int(np.searchsorted(down, -high))
                        kept = near[first : min(first + k, int(np.searchsorted(down, -least, "right")))]
                        for name, values in (("anchor", np.full(len(kept), w.anchor)), ("place", np.full(len(kept), place)), ("id", ids[kept]), ("score", scores[kept])):
                            out[name].append(values)
        return pd.DataFrame({name: np.concatenate(values) if values else [] for name, values in out.items()}).astype({"anchor": "int64", "place": "int32", "id": "int64", "score": "int64"})

    kinds = "anchor long, id long, label long, v array<long>, norm double, places array<int>, highs array<long>, limits array<long>"
    begin = 0
    while begin < chains:
        end = 4 * begin + 1
        limits = windows.withColumn("limit", F.col("low"))
        if hits is not None:
            kth = hits.groupBy("anchor", "place").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("kth"))
            limits = windows.join(kth, ["anchor", "place"], "left").withColumn("limit", F.greatest("low", "kth"))
        held = limits.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "high", "limit"))).alias("w"))
        asked = anchors.join(held, "anchor").select(*anchors.columns, *[F.col(f"w.{c}").alias(f"{c}s") for c in ("place", "high", "limit")])
        wanted = materialised(asked.mapInPandas(routed(begin, end), f"{kinds}, bucket int"), "negative-routes")
        # one row a bucket that is asked
        loads = wanted.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / F.lit(group)).alias("groups"))
        dealt = wanted.join(F.broadcast(loads), "bucket").withColumn("group", F.pmod(F.xxhash64("anchor"), F.col("groups"))).drop("groups")
        rows = table.join(F.broadcast(loads), "bucket").withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1))).drop("groups")
        new = rows.groupBy("bucket", "group").cogroup(dealt.groupBy("bucket", "group")).applyInPandas(search, FOUND)
        hits = materialised(best_of(new if hits is None else hits.unionByName(new), k), "negative-hits")
        dropped(wanted)
        made.append(hits)
        begin = end
    for old in made[:-1]:
        dropped(old)
    shared.unpersist()
    return hits if hits is not None else spark.createDataFrame([], FOUND)


def hard_negatives(
    vectors: DataFrame, anchors: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
    positives: int = POSITIVES, negatives: int = NEGATIVES, at_least: int = AT_LEAST, at_most: int = AT_MOST, bucket: int = BUCKET,
) -> DataFrame:
    """For each row that `anchors` (a condition on id) picks and each of its `positives` best rows of the same label, the first `negatives` rows of other labels whose score is between two shares of the positive's.

    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score. Components are multiplied by SCALE and rounded down, and a score is the exact integer
    inner product; higher ones come first, ties by the smaller id. at_least * positive <= 100 * negative <= at_most * positive.

    Rows are sorted by norm into buckets, once by label for the positives and once for the negatives. |anchor| times a bucket's highest
    norm is over every score in it (Cauchy-Schwarz); a bucket whose bound is below a window's lower limit or its running k-th score is skipped for that
    anchor. Every row is indexed and no list of candidates is cut; a label that holds most rows has many buckets. Where norms are nearly equal, little is skipped.

    Rows with a null id, label or vector, a null or non-finite component, or a length that is not the most frequent one take no part. Rows that
    repeat an id each count as candidates, but never for an anchor of that id; anchors that repeat one are asked each (equal rows once), and their lists stand under one id. Other
    columns are not read. An empty table gives no rows. Components so large that a score may not fit 64 bits raise an error.
    """
    spark = vectors.sparkSession
    shipped(spark)
    every = whole(vectors, id_col, label_col, vector_col)
    sizes = every.groupBy(F.size("v").alias("dims")).agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("top")).orderBy(F.desc("n"), "dims").limit(1).collect()
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not sizes:
        return spark.createDataFrame([], schema)
    dims, count, top = sizes[0]
    # partial sums stay below the product of the norms of their parts
    if top * top * 1.01 >= 2**63:
        raise ValueError(f"scores of vectors of norm {top:.3g} may not fit 64 bits")
    exact = top * top * 1.01 < 2**53
    every = every.where(F.size("v") == dims)
    by_label, about_labels = bucketed(every, [F.col("label"), F.desc("norm"), F.col("id")], count, bucket, "negatives-by-label")
    by_norm, about_norms = bucketed(by_label.drop("bucket"), [F.desc("norm"), F.col("id")], count, bucket, "negatives-by-norm")
    asked = by_norm.drop("bucket").where(anchors).dropDuplicates(["id", "label", "v"])
    asked = materialised(numbered(asked, [F.col("id"), F.col("label"), F.col("v")], "anchor").select("anchor", "id", "label", "v", "norm"), "anchors")
    lowest, highest = (F.lit(x).cast("long") for x in (-(1 << 62), 1 << 62))
    near = searched(by_label, about_labels, asked, asked.select("anchor", F.lit(0).alias("place"), lowest.alias("low"), highest.alias("high")), True, positives, exact)
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    chosen = materialised(near.select("anchor", F.row_number().over(order).alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # the smallest and the largest whole numbers in the window
    wide = F.col("positive_score").cast("decimal(19,0)")
    low, high = F.ceil(wide * at_least / F.lit(100)).cast("long"), F.floor(wide * at_most / F.lit(100)).cast("long")
    windows = chosen.select("anchor", "place", low.alias("low"), high.alias("high")).where("low <= high")
    found = searched(by_norm, about_norms, asked, windows, False, negatives, exact)
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "id")
    out = found.withColumn("rank", F.row_number().over(order)).join(chosen, ["anchor", "place"]).join(asked.select("anchor", F.col("id").alias("anchor_id")), "anchor")
    out = materialised(out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")), "hard-negatives")
    for table in (by_label, by_norm, asked, chosen, near, found):
        dropped(table)
    return out
