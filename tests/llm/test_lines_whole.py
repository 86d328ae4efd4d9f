"""Line dedup of whole documents: what the query returns, cut lists, shared ids and edge cases, against all pairs of lines."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lorewright.llm import lines

BLANK = " \t\r\f\v"


def close(a, b):
    """Whether two lines are within the edits allowed, by the plain table of distances."""
    if abs(len(a) - len(b)) > 2:
        return False
    allowed = 2 if min(len(a), len(b)) >= 60 else 1 if min(len(a), len(b)) >= 30 else 0
    d = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        p, d[0] = d[0], i
        for j, y in enumerate(b, 1):
            p, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, p + (x != y))
    return d[-1] <= allowed


def brute(texts):
    """(doc_id, line_no) of every line, and of the line that stays for it, by all pairs of distinct lines."""
    places = [(i, n, x.strip(BLANK)) for i, t in texts for n, x in enumerate((t or "").split("\n")) if x.strip(BLANK)]
    distinct = sorted({x for *_, x in places}, key=len)
    parent = {x: x for x in distinct}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, a in enumerate(distinct):
        for b in distinct[k + 1 :]:
            if len(b) - len(a) > 2:
                break
            if sum(x != y for x, y in zip(a[:8], b[:8], strict=False)) <= 6 or a[-8:] == b[-8:]:
                if close(a, b):
                    parent[find(a)] = find(b)
    first = {}
    for i, n, x in sorted(places):
        first.setdefault(find(x), (i, n))
    return {(i, n): first[find(x)] for i, n, x in places}


def sample(seed, n=60):
    """Documents of lines that differ by up to four characters, with equal ones among them."""
    rng = random.Random(seed)
    pool = ["".join(rng.choice("abcdé ") for _ in range(size)).strip() + "z" for size in (10, 29, 30, 31, 45, 59, 60, 61, 62, 90) for _ in range(3)]
    texts = []
    for k in range(n):
        rows = []
        for _ in range(rng.randint(0, 6)):
            x = list(rng.choice(pool))
            for _ in range(rng.randint(0, 4)):
                at = rng.randrange(len(x))
                x[at : at + rng.randint(0, 1)] = rng.choice(["", "x", "y"])
            rows.append("".join(x))
        texts.append((k, "\n".join(rows)))
    return texts


@pytest.mark.parametrize("list_size,id_bits", [(20_000, 63), (3, 63), (20_000, 6)])
def test_line_classes(spark, list_size, id_bits):
    texts = sample(list_size + id_bits)
    got = lines.line_classes(spark.createDataFrame(texts, "doc_id long, text string"), list_size=list_size, id_bits=id_bits).toPandas()
    assert {(r.doc_id, r.line_no): (r.keep_doc, r.keep_line) for r in got.itertuples()} == brute(texts)
    assert (got["first"] == ((got.doc_id == got.keep_doc) & (got.line_no == got.keep_line))).all()
    assert got.groupby("class").size().loc[got["class"]].tolist() == got.class_size.tolist()


def test_dropped_lines_and_deduplicated(spark):
    texts = [*sample(9), (900, None), (901, ""), (902, " \n\t\n")]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    for c in ("id", "line", "h", "part", "n", "check", "_gone", "class"):
        frame = frame.withColumn(c, F.lit("clash"))
    want = brute(texts)
    got = {r.doc_id: r for r in lines.dropped_lines(frame).collect()}
    assert set(got) == {i for i, _ in texts}
    for i, t in texts:
        own = {n: to for (d, n), to in want.items() if d == i}
        gone = sorted(n for n, to in own.items() if to != (i, n))
        assert (got[i].lines, got[i].kept, list(got[i].dropped)) == (len(own), len(own) - len(gone), gone)
        assert list(zip(got[i].keep_doc, got[i].keep_line, strict=True)) == [own[n] for n in gone]
    kept = {r.doc_id: r for r in lines.deduplicated(frame).collect()}
    for i, t in texts:
        want_text = None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if want.get((i, n), (i, n)) == (i, n))
        assert kept[i].text == want_text and kept[i]["class"] == "clash"


def test_query_has_every_document(spark):
    got = entry.queries()["op4_line_dedup"](spark, "/root/testdata/sf0.001").toPandas()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").toPandas()
    want = brute(list(zip(docs.doc_id.tolist(), docs.text, strict=True)))
    assert sorted(got.doc_id) == sorted(docs.doc_id)
    assert {(r.doc_id, n) for r in got.itertuples() for n in r.dropped} == {p for p, to in want.items() if p != to}


def test_line_edges(spark):
    rng = random.Random(1)
    long = "".join(rng.choice("abcdefgh ") for _ in range(100_000)).strip() + "q"
    changed = "Y" + long[1:50_000] + "X" + long[50_000:]
    rows = [(1, long), (2, changed), (3, "p" + changed + "z"), (None, "a line that has thirty characters"), (None, "a line that has thirty characterz"), (7, "same\nsame"), (7, "same\nsame"), (8, None)]
    got = {r.doc_id: r for r in lines.dropped_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert list(got[2].dropped) == [0] and list(got[2].keep_doc) == [1] and list(got[3].keep_doc) == [1]
    assert got[None].lines == 2 and got[None].dropped is None
    assert list(got[7].dropped) == [1, 1] and got[7].lines == 4 and got[8].lines == 0 and list(got[8].dropped) == []
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lines.dropped_lines(empty).count() == 0 and lines.deduplicated(empty).count() == 0


def test_pairs_of_long_lines_stay_within_memory():
    a = "ab" * 50_000
    assert lines.distances([a], [a[:70] + a[71:]]).tolist() == [1]
