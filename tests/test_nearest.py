"""Exact search in cells and sequential decisions against plain loops."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lorewright.operators import graph, nearest, reconcile
from lorewright.sources.scratch import Scratch

VECTORS = "id long, embedding array<double>"


def clustered(seed, n, clusters=40, dims=16, spread=0.03):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((clusters, dims))
    return [(k, (centres[rng.integers(clusters)] + spread * rng.standard_normal(dims)).tolist()) for k in range(n)]


def plain_best(queries, stored):
    u = {i: np.array(v) / np.linalg.norm(v) for i, v in stored}
    return {k: min((-round(float(u[i] @ (np.array(v) / np.linalg.norm(v))), 9), i) for i in u)[1] for k, v in queries}


@pytest.mark.parametrize("n,spread", [(30, 0.03), (6000, 0.03), (3000, 3.0)])
def test_best(spark, n, spread):
    stored, queries = clustered(1, n, spread=spread), clustered(1, n + 150, spread=spread)[n:]
    with Scratch(spark, "test") as scratch:
        got = nearest.best(nearest.units(spark.createDataFrame(queries, VECTORS), "id"), nearest.units(spark.createDataFrame(stored, VECTORS), "id"), scratch).collect()
        assert {r.key: r.id for r in got} == plain_best(queries, stored)
        if n > 1000 and spread < 1:
            assert sum(r.looked for r in got) < 0.1 * len(queries) * n


def test_ties_and_empty_sides(spark):
    stored = spark.createDataFrame([(9, [2.0, 0.0]), (10, [1.0, 0.0]), (3, [0.0, 1.0]), (2, None)], VECTORS)
    incoming = spark.createDataFrame([(1, [3.0, 0.0]), (2, None)], "key long, embedding array<double>")
    assert [tuple(r) for r in reconcile.best_matches(incoming, stored).collect()] == [(1, 9, 1.0)]
    assert reconcile.best_matches(incoming, stored.limit(0)).count() == 0 == reconcile.best_matches(incoming.limit(0), stored).count()
    with pytest.raises(Exception, match="zero vector"):
        reconcile.best_matches(incoming, spark.createDataFrame([(1, [0.0, 0.0])], VECTORS))


def test_links_join_all_that_is_near(spark):
    """Components of the links are those of all near pairs, though far fewer links come out."""
    rows = clustered(4, 700, clusters=25, spread=0.06)
    u = {i: np.array(v) / np.linalg.norm(v) for i, v in rows}
    parent = {i: i for i in u}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    pairs = 0
    for i in u:
        for j in range(i):
            if u[i] @ u[j] >= 0.97:
                pairs += 1
                parent[max(root(i), root(j))] = min(root(i), root(j))
    frame = nearest.units(spark.createDataFrame(rows, VECTORS), "id").withColumn("scope", F.lit("x"))
    with Scratch(spark, "test") as scratch:
        links = scratch.write(nearest.links(frame, frame, 0.97, scratch), "links")
        found = {r.node: r.component for r in graph.components(links, scratch).collect()}
        count = links.count()
    assert {i: found.get(i, i) for i in u} == {i: root(i) for i in u}
    assert count <= 2 * len(rows) < pairs


@pytest.mark.parametrize("edges", [[(k, k + 1) for k in range(60)], [(0, k) for k in range(1, 40)] + [(50, k) for k in range(51, 70)] + [(5, 5)], [(9, 3), (3, 9), (4, 9), (1, 2)]])
def test_components(spark, edges):
    with Scratch(spark, "test") as scratch:
        got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long"), scratch).collect()}
    want = {n: n for e in edges if e[0] != e[1] for n in e}
    for _ in want:
        for a, b in edges:
            if a != b:
                want[a] = want[b] = min(want[a], want[b])
    assert got == want


def plain_fold(incoming, stored, threshold=0.85):
    """One loop over all rows."""
    entries = [(str(i), h, v) for i, h, v in sorted(stored)]
    out = {}
    unit = lambda v: np.array(v) / np.linalg.norm(v)
    for key, text, v in sorted(incoming):
        same = [k for k, e in enumerate(entries) if text is not None and e[1] == text]
        sims = [-2.0 if e[2] is None or v is None else float(unit(e[2]) @ unit(v)) for e in entries]
        k = int(np.argmax(sims)) if sims else -1
        if same:
            out[key] = ("IGUAL", entries[same[0]][0])
        elif k >= 0 and sims[k] >= threshold:
            out[key] = ("CAMBIADO", entries[k][0])
            entries[k] = (entries[k][0], text, v)
        else:
            out[key] = ("NUEVO", None)
            entries.append((f"new:{key}", text, v))
    return out


@pytest.mark.parametrize("seed,n,texts", [(1, 120, 200), (2, 300, 12), (3, 200, 3), (4, 80, 1)])
def test_decisions_in_order(spark, seed, n, texts):
    """Few texts make long runs of one hash, many vectors near each other long chains of changes; some rows lack a text or a vector."""
    rng = random.Random(seed)
    rows = clustered(seed, n, clusters=12, dims=6, spread=0.35)
    made = [(k, None if rng.random() < 0.04 else f"t{rng.randrange(texts)}", None if rng.random() < 0.05 else v) for k, v in rows]
    stored, incoming = [r for r in made if r[0] % 4 == 0], [(k * 10**15, t, v) for k, t, v in made if k % 4]
    frame = spark.createDataFrame(stored, "id long, hash_normalizado string, embedding array<double>").withColumn("hash_normalizado", F.sha2("hash_normalizado", 256))
    got = reconcile.decide_in_order(spark.createDataFrame(incoming, "key long, texto string, embedding array<double>"), frame, "key").collect()
    assert len(got) == len(incoming) and {r.key: (r.decision, r.chiste_id) for r in got} == plain_fold(incoming, stored)


def test_order_is_not_the_key(spark):
    rows = [("b", 3, "y", [1.0, 0.0]), ("a", 9, "x", [1.0, 0.01]), ("c", 1, "x", [1.0, 0.01])]
    none = spark.createDataFrame([], "id string, hash_normalizado string, embedding array<double>")
    got = reconcile.decide_in_order(spark.createDataFrame(rows, "key string, t int, texto string, embedding array<double>"), none, "t").collect()
    assert {r.key: (r.decision, r.chiste_id) for r in got} == {"c": ("NUEVO", None), "b": ("CAMBIADO", "new:c"), "a": ("CAMBIADO", "new:c")}
    with pytest.raises(ValueError, match="depend"):
        reconcile.decide_in_order(none.selectExpr("id as key", "hash_normalizado as texto", "embedding"), none, "key", 0.0)


def test_a_query_is_sent_to_a_block_once(spark):
    stored, queries = clustered(1, 3000, spread=3.0), clustered(1, 3100, spread=3.0)[3000:]
    sent = []

    class Watched(Scratch):
        def write(self, df, name):
            out = super().write(df, name)
            sent.extend([out.count()] if name == "asked" else [])
            return out

    with Watched(spark, "test") as scratch:
        unit = lambda rows: nearest.units(spark.createDataFrame(rows, VECTORS), "id").withColumn("scope", F.lit(""))
        nearest.links(unit(queries), unit(stored), 0.3, scratch).count()
    assert sent == [len(queries)]
