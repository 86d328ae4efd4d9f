"""Nearest neighbours over the whole range of doubles, in several blocks, and packed estimates against plain products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lorewright.llm import search


def plain(rows, query, k):
    """(distance, id) of the k nearest by whole double precision, wide enough for any range."""
    v = {i: np.array(x, np.longdouble) for i, x in rows}
    out = sorted((np.sqrt(((x - v[query]) ** 2).sum()), i) for i, x in v.items() if i != query)
    return out[:k]


@pytest.mark.parametrize("scale", [1.0, 1e25, 1e-25, 1e300, 1e-200])
def test_any_range(spark, scale):
    rng = np.random.default_rng(3)
    rows = [(k, (rng.standard_normal(8) * scale).tolist()) for k in range(60)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = search.nearest(frame, frame.where("vec_id < 3"), 5, block=16).orderBy("query_id", "rank").collect()
    for q in range(3):
        want = plain(rows, q, 5)
        own = [r for r in got if r.query_id == q]
        assert [r.vec_id for r in own] == [i for _, i in want] and [r["rank"] for r in own] == [1, 2, 3, 4, 5]
        assert np.allclose([r.score for r in own], [float(d) for d, _ in want], rtol=1e-12, atol=0)


def test_large_and_small_together(spark):
    rows = [(0, [1e25, 2e25]), (1, [1e25, 2.5e25]), (2, [3e-25, 1e-25]), (3, [3e-25, 2e-25]), (4, [1.0, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = search.nearest(frame, frame.where("vec_id in (0, 2)"), 3).orderBy("query_id", "rank").collect()
    for q in (0, 2):
        want = plain(rows, q, 3)
        own = [r for r in got if r.query_id == q]
        assert [r.vec_id for r in own] == [i for _, i in want]
        assert np.allclose([r.score for r in own], [float(d) for d, _ in want], rtol=1e-12, atol=0)


def test_recall_over_many_blocks(spark):
    rng = np.random.default_rng(5)
    middle = rng.standard_normal((12, 32)) * 3
    v = np.concatenate([middle[rng.integers(0, 12, 2900)] + rng.standard_normal((2900, 32)), np.tile(middle[0], (100, 1))]).astype(np.float32)
    frame = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)], "vec_id long, embedding array<float>").withColumn("centre", F.lit("clash")).withColumn("part", F.lit(1))
    got = search.nearest(frame, frame.where("vec_id % 50 = 0"), 10, block=200).toPandas()
    hits = 0
    for q, g in got.groupby("query_id"):
        d = np.sqrt(((v.astype(float) - v[q].astype(float)) ** 2).sum(1))
        d[q] = np.inf
        hits += len(set(np.lexsort((np.arange(len(v)), d))[:10]) & set(g.vec_id))
    assert len(got) == 600 and hits >= 0.99 * 600


def test_estimates_are_within_their_bounds():
    rng = np.random.default_rng(1)
    v, q = rng.standard_normal((4000, 64)), rng.standard_normal(64)
    turn = search.rotation(64, 256, 2)
    norm = np.linalg.norm(v, axis=1)
    turned = (v / norm[:, None]) @ turn.T
    f = np.abs(turned).sum(1) / 16
    block = search.Block([c.tobytes() for c in np.packbits(turned > 0, axis=1)], norm, f)
    middle, slack = block.squares(turn @ q)
    exact = ((v - q) ** 2).sum(1)
    assert (np.abs(middle - exact) <= slack).mean() > 0.99
    # words looked at for a vector against multiplications of the whole product
    assert block.words.shape[0] * search.LEVELS + 64 * (middle - slack <= np.partition(middle + slack, 9)[9]).mean() < 64
