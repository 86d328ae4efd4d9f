"""Hard negatives against SQL and plain Python: many buckets, ties, spread norms, odd rows, and buckets skipped."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lorewright.llm import negatives
from tests.oracle import differences

SMALL = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, every=10):
    """The operator by definition, for unique ids."""
    good = [(i, l, [math.floor(256 * x) for x in v]) for i, v, l in rows if None not in (i, v, l) and v and all(x is not None and math.isfinite(x) for x in v)]
    sizes = pd.Series([len(v) for _, _, v in good]).value_counts()
    size = min(sizes[sizes == sizes.max()].index)
    good = [r for r in good if len(r[2]) == size]
    out = []
    for i, l, v in good:
        if i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j, m) for j, m, w in good if j != i)
            for s, j, _ in [x for x in scored if x[2] == l][:5]:
                found = [x for x in scored if x[2] != l and -80 * s <= -100 * x[0] <= -100 * s][:5]
                out += [(i, j, k + 1, x[1], -s, -x[0]) for k, x in enumerate(found)]
    return sorted(out)


def rows_of(seed, n, dims, spread, labels=3, step=None):
    rng = random.Random(seed)
    value = lambda: rng.gauss(0, 1) if step is None else rng.randint(-step, step) / 256
    return [(k, [x * (10 ** rng.uniform(-spread, 0)) for x in [value() + 0.5 for _ in range(dims)]], rng.randrange(labels)) for k in range(n)]


def got(df):
    return sorted(tuple(r) for r in df.collect())


def test_query(spark):
    same, ours, theirs = differences(entry.queries()["op13_norm_bucketed_negatives"](spark, SMALL), entry.oracle_sql()["op13_norm_bucketed_negatives"], SMALL)
    assert same and not ours and not theirs


@pytest.mark.parametrize("spread,bucket,step", [(0, 7, None), (2, 16, None), (0, 1000, 2), (0, 9, 2)])
def test_plain(spark, spread, bucket, step):
    """Small steps make many equal scores, which smaller ids win across buckets."""
    rows = rows_of(3, 150, 3, spread, step=step)
    frame = spark.createDataFrame(rows, SCHEMA)
    assert got(negatives.hard_negatives(frame, F.col("id") % 10 == 0, bucket=bucket)) == plain(rows)


def test_one_label_holds_most(spark):
    rows = [(k, v, 0 if k % 9 else 1) for k, v, _ in rows_of(4, 160, 4, 1)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert got(negatives.hard_negatives(frame, F.col("id") % 10 == 0, bucket=8)) == plain(rows)


def test_odd_rows(spark):
    rows = rows_of(5, 60, 2, 0) + [(100, None, 1), (110, [], 1), (120, [1.0, None], 1), (130, [float("nan"), 1.0], 1), (140, [float("inf"), 1.0], 1), (150, [1.0], 1), (160, [0.0, 0.0], 1), (170, [1.0, 1.0], None), (180, [-3.0, -3.0], 2), (None, [1.0, 1.0], 1)]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"norm": F.lit("x"), "anchor": F.lit(1), "bucket": F.lit(2), "id": F.lit(3)})
    assert got(negatives.hard_negatives(frame, F.col("id") % 10 == 0, bucket=10)) == plain(rows)


def test_empty_tables(spark):
    frame = spark.createDataFrame([], SCHEMA)
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert negatives.hard_negatives(frame, F.col("id") % 10 == 0).columns == columns and negatives.hard_negatives(frame, F.col("id") % 10 == 0).count() == 0
    some = spark.createDataFrame(rows_of(1, 20, 2, 0), SCHEMA)
    assert negatives.hard_negatives(some, F.col("id") > 1000).count() == 0
    alone = spark.createDataFrame([(0, [1.0], 1), (1, [1.0], 2)], SCHEMA)
    assert negatives.hard_negatives(alone, F.col("id") % 10 == 0).count() == 0


def test_repeated_ids(spark):
    """Rows that repeat an id each count as candidates, not for an anchor of that id; an anchor that stands twice is asked once."""
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.9, 0.0], 2)]
    found = got(negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("id") == 0))
    assert found == [(0, 1, 1, 2, 65536, 58880)] * 2


def test_large_components(spark):
    """Sums beyond the whole numbers of doubles are exact; those that may leave 64 bits are an error."""
    big = 2.0**22
    rows = [(k, [big + k / 256, big - k / 512, float(k)], k % 2) for k in range(40)]
    assert got(negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("id") % 10 == 0, bucket=6)) == plain(rows)
    with pytest.raises(ValueError, match="64 bits"):
        negatives.hard_negatives(spark.createDataFrame([(0, [1e200], 1), (1, [1.0], 1)], SCHEMA), F.col("id") == 0)


def test_buckets_are_skipped(spark, monkeypatch):
    """With spread norms an anchor goes to few buckets: routes are counted on the way."""
    rows = rows_of(9, 2000, 8, 0, labels=2)
    rows = [(k, [x * 0.997**k for x in v], l) for k, v, l in rows]
    routes = []
    plain_materialised = negatives.materialised

    def counted(df, name, *rest):
        out = plain_materialised(df, name, *rest)
        if name == "negative-routes":
            routes.append(out.count())
        return out

    monkeypatch.setattr(negatives, "materialised", counted)
    frame = spark.createDataFrame(rows, SCHEMA)
    found = got(negatives.hard_negatives(frame, F.col("id") % 100 == 0, bucket=20))
    assert sum(routes) < 0.5 * 20 * (50 + 100) and found == plain(rows, 100)
    assert np.isfinite([r[5] for r in found]).all()
