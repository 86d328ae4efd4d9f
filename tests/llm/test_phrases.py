"""Collocations against brute force: SQL on the smallest documents, plain Python on odd rows, fragments cut anywhere and pivots with many homes."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry
from lorewright.llm import phrases
from tests.oracle import differences

SMALL = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts(rows):
    """(lang, phrase) -> count of phrases of one to three words."""
    out = Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            out.update((lang or "und", " ".join(w[i : i + k])) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    return out


def plain(rows, least=10, first=2000):
    """The operator by definition."""
    f = counts(rows)
    n = Counter()
    for (lang, p), a in f.items():
        n[lang] += a * (" " not in p)
    cands = {k: a for k, a in f.items() if " " in k[1] and a >= least}
    out = []
    for (lang, p), a in cands.items():
        longer = [b for (other, q), b in cands.items() if other == lang and len(q) > len(p) and f" {p} " in f" {q} "]
        if any(100 * b >= 50 * a for b in longer):
            continue
        w = p.split(" ")
        score, _, left, right = min((1000000 * a * a // (x * y), k, x, y) for k in range(1, len(w)) for x, y in [(f[lang, " ".join(w[:k])], f[lang, " ".join(w[k:])])])
        out.append((lang, p, a, left, right, n[lang], score))
    ranked = []
    for lang in n:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:first]
        ranked += [(r[0], k + 1, *r[1:]) for k, r in enumerate(own)]
    return sorted(ranked)


def texts(seed=5, n=300):
    rng = random.Random(seed)
    words = ["The", "the", "a", "ab", "é", "ab", "É", "x", "zz", "😀", "\x00", "a-b", "of it"]
    seps = [" ", "  ", "\t", ". ", ",", "\n", " \r ", "; ", "?", "\x0b", "\x0c"]
    return [(rng.choice(["en", "de", None, "und"]), "".join(rng.choice(words) + rng.choice(seps if rng.random() < 0.3 else [" "]) for _ in range(rng.randint(0, 60)))) for _ in range(n)]


def test_smallest_documents(spark):
    same, ours, theirs = differences(entry.queries()["op11_pivot_phrases"](spark, SMALL), entry.oracle_sql()["op11_pivot_phrases"], SMALL)
    assert same and not ours and not theirs


def test_odd_rows(spark):
    rows = [*texts(), (None, None), ("en", ""), ("en", " . , "), ("fr", "solo"), *[("fr", "w w w w")] * 12]
    frame = spark.createDataFrame([(k, lang, t, "x") for k, (lang, t) in enumerate(rows)], "doc_id long, lang string, text string, phrase string")
    got = sorted(tuple(r) for r in phrases.collocations(frame).collect())
    assert got == plain(rows)
    # overlapping counts of one word
    assert ("fr", 1, "w w w", 24, 48, 36, 49, 333333) in got or ("fr", 1, "w w", 36, 48, 48, 49, 562500) in got


def test_empty(spark):
    frame = spark.createDataFrame([], "doc_id long, lang string, text string")
    got = phrases.collocations(frame)
    assert got.count() == 0 and got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_few_rows_of_a_language(spark):
    rows = texts(8, 200)
    frame = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(tuple(r) for r in phrases.collocations(frame, least=3, first=4).collect()) == plain(rows, 3, 4)


@pytest.mark.parametrize("size,home", [(1 << 20, 1 << 18), (40, 7), (1, 1), (13, 50)])
def test_cut_anywhere_and_many_homes(size, home):
    """Texts longer than a chunk are cut between words, and a frequent pivot's fragments are dealt to many homes: the sums stay the same."""
    rows = [(lang or "und", t or "") for lang, t in texts(3, 60)] + [("en", "the a " * 200 + "ab. the x the")]
    want = {k: a for k, a in counts(rows).items() if " " in k[1]}
    sketch = np.zeros(1 << phrases.COUNTERS, np.int64)
    for (lang, w), a in counts(rows).items():
        if " " not in w:
            sketch[phrases.xxhash.xxh64_intdigest(w.encode(), phrases.seed(lang)) >> (64 - phrases.COUNTERS)] += a
    batches = [pa.record_batch([pa.array([r[0] for r in part]), pa.array([r[1] for r in part])], names=["lang", "text"]) for part in (rows[:7], rows[7:])]
    routed = [r for b in phrases.route(iter(batches), sketch, size, home) for r in b.to_pylist()]
    routed.sort(key=lambda r: (r["lang"], r["home"], r["salts"], r["pivot"]))
    table = pa.Table.from_pylist(routed, phrases.ROUTED)
    got = Counter()
    for b in phrases.mine(iter(table.to_batches(max_chunksize=5)), 1):
        for r in b.to_pylist():
            got[r["lang"], r["phrase"]] += r["a"]
    assert got == want
    if home == 1:
        assert max(r["salts"] for r in routed) > 100


def test_long_words_make_short_rows():
    rows = [("en", " ".join("w" * 5000 + str(k % 30) for k in range(600)))]
    sketch = np.full(1 << phrases.COUNTERS, 20, np.int64)
    batches = [pa.record_batch([pa.array(["en"]), pa.array([rows[0][1]])], names=["lang", "text"])]
    sizes = [len(r["lefts"]) + len(r["rights"]) for b in phrases.route(iter(batches), sketch) for r in b.to_pylist()]
    assert max(sizes) < phrases.ROW_BYTES + 30_000


def test_exact_scores(spark):
    """Products beyond 64 bits."""
    a, left, right = 123_456_789_012_345, 234_567_890_123_456, 345_678_901_234_567
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long").select(phrases.score(*map(phrases.F.col, ("a", "l", "r"))).alias("s")).first()
    assert row.s == 1000000 * a * a // (left * right)
