"""Approximate nearest neighbours: randomly rotated one-bit codes with error bounds, reranked on the original vectors."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialised, shipped

#: Bits of a code at least (more than dimensions: the rotation also lifts) and of a component of a quantised query; standard errors in a bound.
BITS, LEVELS, ERRORS = 256, 4, 3.0
#: Vectors that the centres are fitted to at most, centres at most, rounds of fitting them.
SAMPLE, CENTRES, FITTING = 20_000, 4096, 6
#: Vectors and queries in a block; a task holds one block of each.
VECTORS, QUERIES = 16_384, 8_192
#: Parts in which a query's hits are first brought together.
PARTS = 64
FOUND = "query_id long, vec_id long, score double"


def usable(vector: Column) -> Column:
    """True where the vector has components, all of them finite, and one that is not zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def rotation(dims: int, bits: int, seed: int) -> np.ndarray:
    """Orthonormal columns: a random rotation of the vectors into `bits` dimensions."""
    return np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, dims)))[0]


def distances(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows to q in double precision; squares that would leave the range are taken after a shift by a power of two."""
    with np.errstate(over="ignore"):
        away = v - q
        most = np.abs(away).max(axis=1)
        out = np.sqrt((away**2).sum(axis=1))
        odd = (most > 1e150) | ((most < 1e-140) & (most > 0))
        if odd.any():
            shift = np.frexp(np.maximum(np.abs(v[odd]).max(axis=1), np.abs(q).max()))[1]
            away = np.ldexp(v[odd], -shift[:, None]) - np.ldexp(q[None, :], -shift[:, None])
            own = np.frexp(np.maximum(np.abs(away).max(axis=1), 5e-324))[1]
            out[odd] = np.ldexp(np.sqrt((np.ldexp(away, -own[:, None]) ** 2).sum(axis=1)), shift + own)
    return out


def centres_of(sample: np.ndarray, count: int, seed: int) -> np.ndarray:
    """`count` centres of the sample, by a few rounds of assigning and averaging."""
    rng = np.random.default_rng(seed)
    if not len(sample):
        return np.zeros((1, sample.shape[1]))
    out = sample[rng.permutation(len(sample))[:count]]
    for _ in range(FITTING if len(out) > 1 else 0):
        own = nearest_centre(sample, out)[0]
        for k in np.unique(own):
            out[k] = sample[own == k].mean(axis=0)
    return out if len(out) > 1 else sample.mean(axis=0, keepdims=True)


def nearest_centre(v: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre of each row, and the distances to all."""
    d = np.sqrt(np.maximum((v**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1) - 2 * v @ centres.T, 0))
    return d.argmin(axis=1), d


class Block:
    """Codes of a block's vectors: `words` in rows of 64 bits by place, ones in a code, norm of the residual, and its inner product with the code."""

    def __init__(self, codes: list[bytes], norm: np.ndarray, f: np.ndarray):
        packed = np.frombuffer(b"".join(codes), np.uint64).reshape(len(codes), -1)
        self.bits = packed.shape[1] * 64
        self.words = np.ascontiguousarray(packed.T)
        self.ones = np.bitwise_count(packed).sum(axis=1, dtype=np.int64)
        self.norm, self.f = norm, np.maximum(f, 1e-6)
        self.spread = ERRORS * np.sqrt(np.maximum(1 / self.f**2 - 1, 0) / (self.bits - 1))

    def squares(self, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated squared distances to a query (its residual to the centre, rotated), and what to allow for errors.

        The query's components are rounded to 2 ** LEVELS steps, whose bits make LEVELS words of a code's length; the inner product with a
        code is a sum over AND and bit counts of packed words.
        """
        size = float(np.sqrt((turned**2).sum()))
        low = float(turned.min())
        step = max((float(turned.max()) - low) / ((1 << LEVELS) - 1), 1e-300)
        steps = np.rint((turned - low) / step).astype(np.uint8)
        inner = np.zeros(len(self.norm), np.int64)
        for level in range(LEVELS):
            plane = np.packbits((steps >> level) & 1).view(np.uint64)
            ones = np.zeros(len(self.norm), np.uint16)
            for row, word in zip(self.words, plane, strict=True):
                ones += np.bitwise_count(row & word)
            inner += ones.astype(np.int64) << level
        total = low * len(turned) + step * int(steps.sum())
        signed = (2 * (low * self.ones + step * inner) - total) / math.sqrt(self.bits)
        middle = self.norm**2 + size**2 - 2 * self.norm * signed / self.f
        slack = 2 * self.norm * (self.spread * size + ERRORS * step / math.sqrt(12) / self.f) + 1e-9 * (self.norm**2 + size**2)
        return middle, slack


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The `k` nearest hits of each query, in two steps: no list holds the hits of all blocks."""
    best = F.slice(F.array_sort(F.collect_list(F.struct("score", "vec_id"))), 1, k).alias("near")
    for keys in (["query_id", F.pmod(F.xxhash64("vec_id"), F.lit(PARTS)).alias("part")], ["query_id"]):
        found = found.groupBy(*keys).agg(best).select("query_id", F.explode("near").alias("hit")).select("query_id", "hit.*")
    return found


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", seed: int = 17, block: int = VECTORS) -> DataFrame:
    """The `k` rows of `vectors` nearest to each row of `queries` by Euclidean distance: query_id, rank, vec_id, score.

    Every vector goes to the nearest of some centres, one for about `block` vectors. Its residual to the centre is rotated, and the
    signs are its code. With f the inner product of the code and the unit residual, code . query / f estimates the residual's inner
    product with a query, within ERRORS * |query| * sqrt((1 / f^2 - 1) / (bits - 1)) but for a rare exception; the query is
    rounded to a few bits and the product counted on packed words. In a block, vectors whose lower bound is not over the k-th upper
    bound are reranked in double precision; ties go to the smaller id. A query first searches its own centre's blocks, and
    then those of each centre whose distance less its radius is not over the k-th distance found. Every vector is indexed, and no list of candidates is cut.

    Codes and bounds are made of vectors scaled by a power of two, so large and small components neither overflow nor vanish; bounds that
    aren't numbers rerank. Scores are of the original vectors. Vectors that usable() rejects, or whose length is not the most frequent
    one, take no part, nor do null ids. A query never finds rows with its own id. Rows that repeat an id each count; a query that repeats is asked once. The
    centres are fitted to SAMPLE rows at most, by a hash of their ids. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    shipped(spark)

    def good(df: DataFrame) -> DataFrame:
        return df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(F.col("id").isNotNull() & usable(F.col("v")))

    everything, asked = good(vectors), good(queries)
    most = F.max(F.array_max(F.transform("v", F.abs))).alias("most")
    sizes = everything.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"), most).orderBy(F.desc("n"), "d").limit(1).collect()
    schema = "query_id long, rank int, vec_id long, score double"
    if not sizes:
        return spark.createDataFrame([], schema)
    dims, count, most = sizes[0]
    shift = -math.frexp(most)[1]
    everything, asked = everything.where(F.size("v") == dims), asked.where(F.size("v") == dims).dropDuplicates(["id", "v"])
    share = min(1.0, 0.8 * SAMPLE / count)
    sample = everything.where(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30))).select("v").limit(SAMPLE).collect()
    sample = np.ldexp(np.array([r[0] for r in sample] or np.zeros((0, dims)), np.float64).reshape(-1, dims), shift)
    centres = centres_of(sample, min(CENTRES, max(1, -(-count // block))), seed)
    bits = -(-max(BITS, dims) // 64) * 64
    shared = spark.sparkContext.broadcast((centres, rotation(dims, bits, seed)))

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centres, turn = shared.value
        for batch in batches:
            if len(batch):
                v = np.ldexp(np.stack(batch["v"].to_numpy()), shift)
                own = nearest_centre(v, centres)[0]
                away = v - centres[own]
                norm = np.sqrt((away**2).sum(axis=1))
                turned = (away / np.maximum(norm, 1e-300)[:, None]) @ turn.T
                f = np.abs(turned).sum(axis=1) / math.sqrt(turned.shape[1])
                yield batch.assign(centre=own, code=[c.tobytes() for c in np.packbits(turned > 0, axis=1)], norm=norm, f=f)

    coded = materialised(everything.mapInPandas(encode, "id long, v array<double>, centre long, code binary, norm double, f double"), "codes", 4000)
    # one row a centre, CENTRES at most
    held = coded.groupBy("centre").agg(F.max("norm").alias("radius"), F.count(F.lit(1)).alias("n")).collect()
    index = np.array([r[0] for r in held])
    radius, parts = np.array([r[1] for r in held]), np.array([-(-r[2] // block) for r in held])
    blocks = spark.createDataFrame([(int(c), int(p)) for c, p in zip(index, parts, strict=True)], "centre long, parts long")
    routes = spark.sparkContext.broadcast((index, radius, parts))
    coded = coded.join(F.broadcast(blocks), "centre").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts"))).drop("parts")

    def routed(own: bool):
        def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            centres, (index, radius, parts) = shared.value[0], routes.value
            for batch in batches:
                for begin in range(0, len(batch), 64):
                    some = batch.iloc[begin : begin + 64]
                    near, d = nearest_centre(np.ldexp(np.stack(some["v"].to_numpy()), shift), centres[index])
                    mine = np.arange(len(index)) == near[:, None]
                    wanted = mine if own else ~mine & ~(d - radius > np.ldexp(some["limit"].to_numpy(), shift)[:, None] * (1 + 1e-9) + 1e-7)
                    row, column = np.nonzero(wanted)
                    times = parts[column]
                    row, column = np.repeat(row, times), np.repeat(column, times)
                    part = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                    yield some.iloc[row].assign(centre=index[column], part=part)

        return route

    def search(rows: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(wanted):
            centres, turn = shared.value
            ids, v, centre = rows["id"].to_numpy(np.int64), np.stack(rows["v"].to_numpy()), centres[int(rows["centre"].iloc[0])]
            codes = Block(rows["code"].tolist(), rows["norm"].to_numpy(), rows["f"].to_numpy())
            for query, q, reach in zip(wanted["id"].tolist(), wanted["v"], wanted["limit"].tolist(), strict=True):
                q = np.asarray(q, np.float64)
                middle, slack = codes.squares(turn @ (np.ldexp(q, shift) - centre))
                others = ids != query
                upper = np.where(others, middle + slack, np.inf)
                limit = np.partition(upper, k - 1)[k - 1] if len(upper) > k else np.inf
                limit = min(limit, math.ldexp(reach, shift) ** 2 * (1 + 1e-9) + 1e-14) if reach < math.inf else limit
                near = np.flatnonzero(others & ~(middle - slack > limit))
                exact = distances(v[near], q)
                first = np.lexsort((ids[near], exact))[:k]
                out.append(pd.DataFrame({"query_id": query, "vec_id": ids[near][first], "score": exact[first]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    def searched(wanted: DataFrame) -> DataFrame:
        wanted = materialised(wanted, "routes")
        # one row a block that is asked
        loads = wanted.groupBy("centre", "part").agg(F.ceil(F.count(F.lit(1)) / F.lit(QUERIES)).alias("groups"))
        wanted = wanted.join(F.broadcast(loads), ["centre", "part"]).withColumn("group", F.pmod(F.xxhash64("id"), F.col("groups"))).drop("groups")
        rows = coded.join(F.broadcast(loads), ["centre", "part"]).withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1))).drop("groups")
        keys = ["centre", "part", "group"]
        return rows.groupBy(*keys).cogroup(wanted.groupBy(*keys)).applyInPandas(search, FOUND)

    kinds = "id long, v array<double>, limit double, centre long, part long"
    first = materialised(best_of(searched(asked.withColumn("limit", F.lit(float("inf"))).mapInPandas(routed(True), kinds)), k), "first-hits")
    reach = first.groupBy(F.col("query_id").alias("id")).agg(F.when(F.count(F.lit(1)) >= k, F.max("score")).alias("limit"))
    rest = asked.join(reach, "id", "left").withColumn("limit", F.coalesce("limit", F.lit(float("inf")))).select("id", "v", "limit")
    if len(index) > 1:
        first = first.unionByName(searched(rest.mapInPandas(routed(False), kinds)))
    order = F.array_sort(F.collect_list(F.struct("score", "vec_id")))
    ranked = best_of(first, k).groupBy("query_id").agg(F.slice(order, 1, k).alias("near")).select("query_id", F.posexplode("near").alias("rank", "hit"))
    return ranked.select("query_id", (F.col("rank") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))
