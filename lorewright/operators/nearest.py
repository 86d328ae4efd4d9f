"""Exact search among unit vectors by centroids and radii: cells that the triangle inequality rules out are never opened."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lorewright.sources.scratch import Scratch

#: Rows that the centroids are fitted to at most, centroids at most, rows to a centroid, rounds of fitting; rows of a block and queries that meet it in one task.
SAMPLE, CENTROIDS, ROWS, ROUNDS = 20_000, 2048, 256, 5
BLOCK, QUERIES = 8192, 8192
#: What is allowed for rounding, in distances between unit vectors.
SLACK = 1e-9


def units(df: DataFrame, id_col: str, vector_col: str = "embedding") -> DataFrame:
    """(id, u) of the rows with a vector: u has length one. A zero vector is an error."""
    v = F.transform(vector_col, lambda x: x.cast("double"))
    size = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    rows = df.where(F.col(vector_col).isNotNull()).select(F.col(id_col).alias("id"), v.alias("v")).withColumn("size", size)
    wrong = F.raise_error(F.lit("zero vector has no cosine")).cast("double")
    return rows.withColumn("size", F.when(F.col("size") > 0, F.col("size")).otherwise(wrong)).select("id", F.transform("v", lambda x: x / F.col("size")).alias("u"))


def centroids(rows: DataFrame, count: int) -> np.ndarray:
    """Centroids of a bounded sample, chosen by a hash of the ids."""
    share = min(1.0, 0.8 * SAMPLE / max(count, 1))
    sample = rows.where(F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1 << 20)) < int(share * (1 << 20))).select("u").limit(SAMPLE).collect()
    points = np.array([r.u for r in sample])
    if not len(points):
        return np.array([r.u for r in rows.select("u").limit(1).collect()])
    out = points[np.random.default_rng(7).permutation(len(points))[: max(1, min(CENTROIDS, count // ROWS))]].copy()
    for _ in range(ROUNDS if len(out) > 1 else 0):
        own = apart(points, out).argmin(axis=1)
        total, n = np.zeros_like(out), np.bincount(own, minlength=len(out))
        np.add.at(total, own, points)
        out[n > 0] = total[n > 0] / n[n > 0, None]
    return out


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of `a` to all of `b`."""
    return np.sqrt(np.maximum((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * a @ b.T, 0.0))


class Cells:
    """Unit vectors (id, u, and others) in the cells of their nearest centroids, cells in blocks; what a query needs to choose cells is of bounded size."""

    def __init__(self, rows: DataFrame, scratch: Scratch, name: str):
        spark = rows.sparkSession
        self.scratch, self.columns = scratch, rows.columns
        rows = scratch.write(rows, name)
        self.count = rows.count()
        points = centroids(rows, self.count) if self.count else np.zeros((1, 1))
        shared = spark.sparkContext.broadcast(points)

        def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    d = apart(np.stack(batch["u"].to_numpy()), shared.value)
                    own = d.argmin(axis=1)
                    yield batch.assign(cell=own.astype(np.int32), away=d[np.arange(len(own)), own])

        kinds = ", ".join(f"{n} {t}" for n, t in rows.dtypes)
        table = scratch.write(rows.mapInPandas(placed, f"{kinds}, cell int, away double"), f"{name}-cells")
        # one row a cell, CENTROIDS at most; small cells share a block, a large one has blocks of its own
        held = table.groupBy("cell").agg(F.max("away").alias("radius"), F.count(F.lit(1)).alias("n")).orderBy("cell").collect()
        cells = np.array([r.cell for r in held], np.int64)
        blocks, room = [], 0
        for r in held:
            if r.n > room:
                blocks.append(blocks[-1] + 1 if blocks else 0)
                room = max(BLOCK - r.n, 0)
            else:
                blocks.append(blocks[-1])
                room -= r.n
        parts = [-(-r.n // BLOCK) for r in held]
        first = np.unique(np.array(blocks, np.int64), return_index=True)[1]
        self.routes = spark.sparkContext.broadcast((points[cells] if len(cells) else points[:0], np.array([r.radius for r in held]), first, np.array(parts, np.int64)[first], cells))
        placing = spark.createDataFrame([(int(r.cell), b, int(p)) for r, b, p in zip(held, blocks, parts, strict=True)], "cell int, block int, parts long")
        self.table = table.join(F.broadcast(placing), "cell").withColumn("part", F.pmod(F.xxhash64(F.col("id").cast("string")), F.col("parts")).cast("int")).drop("parts")

    def met(self, queries: DataFrame, search, schema: str, which: str = "all") -> DataFrame:
        """What search(rows, queries) gives for each cell of each block and the queries (id, u, reach, and others) that may find a row within `reach` of them in it.

        search has the cell's rows in the order of `away` and queries with `from_centre`. which: "first" sends a query to its nearest cell alone, "rest" to the others. A
        query is sent to a block once, however many cells it opens there.
        """
        routes = self.routes

        def opened(d: np.ndarray, home: np.ndarray, numbers: np.ndarray, radius: np.ndarray, reach: np.ndarray) -> np.ndarray:
            """Which queries (rows of `d`, the distances to the centres of cells `numbers`) open which cells."""
            own = home[:, None] == numbers
            if which == "first":
                return own
            near = d - radius <= reach[:, None] + SLACK
            return near & ~own if which == "rest" else near

        def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            points, radius, first, parts, cells = routes.value
            for batch in batches:
                for begin in range(0, len(batch), 256):
                    some = batch.iloc[begin : begin + 256]
                    d = apart(np.stack(some["u"].to_numpy()), points)
                    home = d.argmin(axis=1)
                    wanted = opened(d, home, np.arange(len(cells)), radius, some["reach"].to_numpy())
                    row, block = np.nonzero(np.logical_or.reduceat(wanted, first, axis=1))
                    times = parts[block]
                    row, block = np.repeat(row, times), np.repeat(block, times)
                    part = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                    for at in range(0, len(row), BLOCK):
                        k = slice(at, at + BLOCK)
                        yield some.iloc[row[k]].assign(block=block[k].astype(np.int32), part=part[k].astype(np.int32), home=home[row[k]].astype(np.int32))

        kinds = ", ".join(f"{n} {t}" for n, t in queries.dtypes)
        if not self.count:
            return queries.sparkSession.createDataFrame([], schema)
        asked = self.scratch.write(queries.mapInPandas(route, f"{kinds}, block int, part int, home int"), "asked")
        # one row a block that is asked
        loads = asked.groupBy("block", "part").agg(F.ceil(F.count(F.lit(1)) / F.lit(QUERIES)).alias("groups"))
        asked = asked.join(F.broadcast(loads), ["block", "part"]).withColumn("dealt", F.pmod(F.xxhash64(F.col("id").cast("string")), F.col("groups"))).drop("groups")
        rows = self.table.join(F.broadcast(loads), ["block", "part"]).withColumn("dealt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1))).drop("groups")

        def both(rows: pd.DataFrame, some: pd.DataFrame) -> pd.DataFrame:
            points, radius, _, _, cells = routes.value
            if not len(rows) or not len(some):
                return search(rows, some.assign(from_centre=0.0))
            numbers = np.searchsorted(cells, np.sort(rows["cell"].unique()))
            d = apart(np.stack(some["u"].to_numpy()), points[numbers])
            wanted = opened(d, some["home"].to_numpy(), numbers, radius[numbers], some["reach"].to_numpy())
            of = dict(tuple(rows.sort_values("away").groupby("cell")))
            out = [search(of[cells[c]].reset_index(drop=True), some[wanted[:, k]].assign(from_centre=d[wanted[:, k], k])) for k, c in enumerate(numbers) if wanted[:, k].any()]
            out = [found for found in out if len(found)]
            return pd.concat(out, ignore_index=True) if out else search(rows[:0], some[:0].assign(from_centre=0.0))

        keys = ["block", "part", "dealt"]
        return rows.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(both, schema)


def best(queries: DataFrame, stored: DataFrame, scratch: Scratch) -> DataFrame:
    """(key, id, similarity, looked): the row of `stored` (id, u) of largest cosine for each query (id, u), of equals the smallest id; looked counts the rows compared with.

    A query first searches the cell whose centroid is nearest, which bounds its distance to the best; then those cells alone in which a row may be as near. Within a cell
    only rows whose distance to the centroid differs from the query's by no more than the bound are compared. Nothing is estimated.
    """
    cells = Cells(stored, scratch, "stored")
    kinds = dict(queries.dtypes)["id"], dict(stored.dtypes)["id"]
    schema = f"key {kinds[0]}, id {kinds[1]}, similarity double, looked long"

    def search(rows: pd.DataFrame, some: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(some):
            away, ids, u = rows["away"].to_numpy(), rows["id"].to_numpy(), np.stack(rows["u"].to_numpy())
            low = np.searchsorted(away, (some["from_centre"] - some["reach"]).to_numpy() - SLACK)
            high = np.searchsorted(away, (some["from_centre"] + some["reach"]).to_numpy() + SLACK, "right")
            for key, q, a, z in zip(some["id"], some["u"], low.tolist(), high.tolist(), strict=True):
                if a < z:
                    value = (u[a:z] * q).sum(axis=1)
                    ties = ids[a:z][value == value.max()]
                    out.append((key, min(ties), value.max(), z - a))
        return pd.DataFrame(out, columns=["key", "id", "similarity", "looked"]).astype({"similarity": float, "looked": "int64"})

    everywhere = queries.withColumn("reach", F.lit(2.0).cast("double"))
    first = scratch.write(cells.met(everywhere, search, schema, "first"), "first")
    found = first.groupBy(F.col("key").alias("id")).agg(F.max("similarity").alias("s"))
    reach = F.coalesce(F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.col("s"))) + SLACK, F.lit(2.0))
    rest = cells.met(queries.join(found, "id", "left").select("id", "u", reach.alias("reach")), search, schema, "rest")
    both = scratch.write(first.unionByName(rest), "found")
    looked = both.groupBy("key").agg(F.sum("looked").alias("looked"))
    order = Window.partitionBy("key").orderBy(F.desc("similarity"), "id")
    return both.drop("looked").withColumn("_r", F.row_number().over(order)).where("_r = 1").drop("_r").join(looked, "key")


def links(queries: DataFrame, stored: DataFrame, threshold: float, scratch: Scratch) -> DataFrame:
    """Links (a, b) that join, through each other, every query (id, u, scope) and row of `stored` (id, u, scope) of equal scope whose cosine is `threshold` or more.

    Only pairs that join what was apart in their block come out, so there are fewer links than queries and rows, however many pairs are near each other.
    """
    cells = Cells(stored, scratch, "near")
    kind = dict(queries.dtypes)["id"]

    def search(rows: pd.DataFrame, some: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(some):
            ids, u, scope = rows["id"].to_numpy(), np.stack(rows["u"].to_numpy()), rows["scope"].to_numpy()
            keys, asked, scopes = some["id"].to_numpy(), np.stack(some["u"].to_numpy()), some["scope"].to_numpy()
            group = np.arange(len(rows))
            for begin in range(0, len(some), 512):
                close = asked[begin : begin + 512] @ u.T >= threshold - SLACK
                for k in np.flatnonzero(close.any(axis=1)):
                    near = np.flatnonzero(close[k] & (scope == scopes[begin + k]))
                    groups, first = np.unique(group[near], return_index=True)
                    out += [(keys[begin + k], ids[near[j]]) for j in first if ids[near[j]] != keys[begin + k]]
                    if len(groups) > 1:
                        group[np.isin(group, groups)] = groups[0]
        return pd.DataFrame(out, columns=["a", "b"])

    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    return cells.met(queries.withColumn("reach", F.lit(reach)), search, f"a {kind}, b {kind}")
