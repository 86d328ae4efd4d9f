"""Raking against a plain loop, contradicting targets, null values, and the pipeline's margins at a larger size."""

import warnings

import numpy as np
import pytest
from pyspark.sql import functions as F

from lorewright.llm import mixing
from lorewright.llm.registry import MARGINS


def plain(cells, margins, sweeps=400):
    """Weights by the plain loop over a dictionary of cells."""
    total = sum(cells.values())
    w = {c: float(n) for c, n in cells.items()}
    names = list(margins)
    for _ in range(sweeps):
        for k, name in enumerate(names):
            for v, share in margins[name].items():
                own = [c for c in w if c[k] == v]
                now = sum(w[c] for c in own)
                for c in own:
                    w[c] *= share * total / now
    return w


def test_like_a_plain_loop(spark):
    rng = np.random.default_rng(4)
    margins = {"source": {f"s{k}": 1 / 30 for k in range(30)}, "lang": {"a": 0.5, "b": 0.3, None: 0.2}, "topic": {"x": 0.9, "y": 0.1}}
    cells = {(s, la, t): int(rng.integers(1, 1000)) for s in margins["source"] for la in margins["lang"] for t in margins["topic"]}
    frame = spark.createDataFrame([(*c, n) for c, n in cells.items()], "source string, lang string, topic string, tokens long")
    listed = {**margins, "lang": {"a": 0.5, "b": 0.3}}
    got = {(r.source, r.lang, r.topic): r.weight for r in mixing.fitted(frame, listed).collect()}
    want = plain(cells, margins)
    assert all(abs(got[c] - want[c]) < 1e-6 * want[c] for c in cells)


def test_contradicting_targets(spark):
    frame = spark.createDataFrame([("s", "a", "x", 10), ("t", "b", "y", 20)], "source string, lang string, topic string, tokens long")
    margins = {"source": {"s": 0.5}, "lang": {"a": 0.9}, "topic": {}}
    with pytest.raises(ValueError, match="contradict"):
        mixing.fitted(frame, margins)
    with warnings.catch_warnings(record=True) as said:
        warnings.simplefilter("always")
        assert mixing.fitted(frame, margins, unmet="warn").count() == 2
    assert any("contradict" in str(w.message) for w in said)


def test_no_python_worker_on_the_main_path(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = mixing.calibrated(docs, MARGINS, 0.5)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "ExistingRDD"))


def test_the_pipelines_sample_meets_all_margins(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    out = mixing.mixed(docs, MARGINS, keep_unlisted=True, unmet="warn").select("source", "lang", mixing.word_count(F.col("text")).alias("tokens"))
    out = out.withColumn("topic", mixing.length_topic(F.greatest("tokens", F.lit(1)))).toPandas()
    for name, listed in MARGINS.items():
        shares = out.groupby(name).tokens.sum() / out.tokens.sum()
        assert all(abs(shares[v] - share) < 0.01 for v, share in listed.items()), shares


def test_clashing_columns_and_long_texts(spark):
    rows = [(1, "word " * 200_000, "en", "src0"), (2, None, None, None), (2, "a b", "en", "none"), (None, "", "xx", "src1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for c in ("_rate", "_copies", "_copy", "_tokens", "_source", "tokens", "weight", "c0"):
        docs = docs.withColumn(c, F.lit("clash"))
    out = mixing.mixed(docs, MARGINS, keep_unlisted=True, unmet="warn")
    assert out.columns == docs.columns and {r["_rate"] for r in out.collect()} <= {"clash"}
    assert mixing.mixed(docs.where("false"), MARGINS).count() == 0
