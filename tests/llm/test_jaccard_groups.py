"""The n-gram Jaccard join on large groups of near copies, cut lists and edge cases, against all pairs."""

import random

import numpy as np
from pyspark.sql import functions as F

from lorewright.llm import jaccard
from tests.llm.test_brute_force import components_of, sets_of


def near_copies(n, words, changes, seed):
    """Texts of one template of which up to `changes` words differ; the template itself may be missing."""
    rng = random.Random(seed)
    base = [f"b{rng.randrange(5000)}" for _ in range(words)]
    out = []
    for k in range(n):
        w = list(base)
        for _ in range(rng.randint(1, changes)):
            w[rng.randrange(words)] = f"x{k}y{rng.randrange(9)}"
        out.append(" ".join(w))
    return out


def by_overlaps(texts):
    """Smallest index reached over links, by a matrix of all overlaps."""
    sets = sets_of(enumerate(texts))
    names = {s: k for k, s in enumerate(sorted(set().union(*sets.values())))}
    m = np.zeros((len(texts), len(names)), np.float32)
    for i, s in sets.items():
        m[i, [names[x] for x in s]] = 1
    both, n = m @ m.T, m.sum(axis=1)
    link = (100 * both >= 80 * (n[:, None] + n[None, :] - both)) & (n[:, None] > 0)
    out = np.arange(len(texts))
    while True:
        new = np.where(link, out[None, :], len(texts)).min(axis=1)
        new = np.minimum(out, new)
        if (new == out).all():
            return out
        out = new


def test_a_large_group_is_linear(spark):
    texts = near_copies(2000, 130, 5, 1)
    checked = []
    got = jaccard.classes_of_near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), checked=checked).toPandas()
    want = by_overlaps(texts)
    assert got.set_index("doc_id").component_id.sort_index().tolist() == want.tolist()
    assert sum(checked) < 10 * len(texts)


def test_cut_lists_lose_nothing(spark):
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(25)]
    texts = near_copies(150, 40, 2, 2) + near_copies(150, 130, 4, 3)
    for _ in range(200):
        w = vocabulary[: rng.randint(1, 22)]
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        texts.append(" ".join(w))
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    got = jaccard.classes_of_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), list_size=6).toPandas()
    want = components_of(sets_of(rows))
    assert {r.doc_id: r.component_id for r in got.itertuples()} == want


def test_hot_copies_enter_once(spark):
    texts = ["one two three four five six seven eight"] * 300 + [f"{k} b c d e f g h i j k l m n o p q r s t u v w x y z" for k in range(30)]
    got = jaccard.classes_of_near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).toPandas()
    want = components_of(sets_of(enumerate(texts)))
    assert {r.doc_id: r.component_id for r in got.itertuples()} == want


def test_jaccard_edges(spark):
    long = " ".join(f"v{k % 9973}w{k}" for k in range(120_000))
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (2, "A B C D E F"), (None, None), (3, None), (4, ""), (5, long), (6, long + " end"), (7, "a b c d e f"), (7, "a b c d e f"), (-8, "q")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for c in ("n", "n_shingles", "component_id", "h", "part", "mark", "a", "_h_n"):
        frame = frame.withColumn(c, F.lit("clash"))
    got = jaccard.classes_of_near_duplicates(frame).toPandas()
    found = {(None if r.doc_id != r.doc_id else int(r.doc_id)): (r.n_shingles, None if r.component_id != r.component_id else int(r.component_id)) for r in got.itertuples()}
    assert len(got) == len(rows)
    assert found[None][1] is None and got[got.doc_id.isna()].component_id.isna().all()
    assert found[2] == (2, 1) and found[7] == (2, 1) and found[3] == (0, 3) and found[4] == (0, 4) and found[-8] == (1, -8)
    assert found[5] == (119_996, 5) and found[6] == (119_997, 5)
    empty = jaccard.classes_of_near_duplicates(frame.where("false"))
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_shingles", "component_id"]
