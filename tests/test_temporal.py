"""As-of and interval joins against plain loops: hot keys, ties, nulls, clashing names, intervals of any length."""

import random

import pytest

from lorewright.operators import temporal


@pytest.mark.parametrize("ranges,seed", [(64, 1), (3, 2), (1, 3)])
def test_as_of(spark, ranges, seed):
    """Most rows have one key; times repeat on both sides."""
    rng = random.Random(seed)
    key = lambda: rng.choice(["hot"] * 6 + ["a", "b", None])
    left = [(k, key(), rng.choice([None, *range(40)]), "old") for k in range(300)]
    right = [(k, key(), rng.choice([None, *range(5, 45)]), f"v{k}") for k in range(80)]
    want = {}
    for i, k, t, _ in left:
        found = [(s, j, v) for j, other, s, v in right if k is not None and other == k and None not in (s, t) and s <= t]
        want[i] = max(found)[2] if found else None
    one, two = spark.createDataFrame(left, "id int, k string, t int, v string"), spark.createDataFrame(right, "rid int, k string, t int, v string")
    got = temporal.as_of(one, two, "k", "t", ["v"], "rid", ranges)
    assert {r.id: r.v for r in got.collect()} == want and got.columns == ["id", "k", "t", "v"]
    assert temporal.as_of(one.limit(0), two, "k", "t", ["v"], "rid").count() == 0
    assert {r.v for r in temporal.as_of(one, two.limit(0), "k", "t", ["v"], "rid").collect()} == {None}


def test_as_of_keeps_repeats_and_nulls_of_values(spark):
    one = spark.createDataFrame([(1, 5), (1, 5)], "k int, t int")
    two = spark.createDataFrame([(1, 1, "x"), (1, 5, None)], "k int, t int, v string")
    assert [r.v for r in temporal.as_of(one, two, "k", "t", ["v"], "t").collect()] == [None, None]


@pytest.mark.parametrize("seed,longest", [(1, 3), (2, 60), (3, 100_000)])
def test_overlapping(spark, seed, longest):
    rng = random.Random(seed)

    def rows(n):
        out = []
        for i in range(n):
            a = rng.randrange(-500, 500)
            out.append((i, rng.choice([0, 0, 0, 1, None]), a, a + rng.choice([0, 1, 2, rng.randrange(longest), rng.randrange(longest)])))
        return [*out, (n, 0, None, 5), (n + 1, 0, 5, None), (n + 2, 0, 9, 3)]

    one, two = rows(120), rows(90)
    want = sorted((i, j) for i, k, a, z in one for j, o, b, y in two if k is not None and k == o and None not in (a, z, b, y) and a < z and b < y and a < y and b < z)
    left, right = spark.createDataFrame(one, "i int, k int, a long, z long"), spark.createDataFrame(two, "j int, k int, b long, y long")
    assert sorted((r.i, r.j) for r in temporal.overlapping(left, right, "k", "a", "z", "b", "y").collect()) == want
    assert temporal.overlapping(left.limit(0), right, "k", "a", "z", "b", "y").count() == 0
