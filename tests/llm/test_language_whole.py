"""Language ID: sums of code lengths in any order, bounded training texts, edge cases."""

import random

import numpy as np
from pyspark.sql import functions as F

from lorewright.llm import language


def test_sums_do_not_depend_on_how_texts_are_batched():
    rng = random.Random(1)
    model = language.trained({"a": ["abra cadabra " * 40], "b": ["zyx wvu zyx " * 40]})
    texts = ["".join(rng.choice("abrcdzyxwvu ü") for _ in range(rng.randint(1, 40_000))) for _ in range(40)] + ["abra " * 500_000]
    together = model.code_lengths(texts)
    assert all((model.code_lengths([t])[0] == x).all() for t, x in zip(texts, together, strict=True))
    half = np.array([model.code_lengths([t[: len(t) // 2]])[0] for t in texts])
    assert (half <= together).all()


def test_training_texts_take_chosen_rows_only(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_BYTES", 1000)
    rows = [(k, "word " * (20 + k % 7), "en" if k % 2 else "de") for k in range(300)] + [(900, None, "en"), (901, "x", None), (None, "word word", "fr"), (902, "word", "fr"), (902, "word", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("_size", F.lit("clash")).drop("_size")
    out = language.training_texts(docs, F.lit(True))
    assert set(out) == {"en", "de", "fr"} and all(1000 <= sum(map(len, out[x])) < 1000 + 140 for x in ("en", "de"))
    assert language.training_texts(docs.where("false"), F.lit(True)) == {}
    assert language.identified(docs.where("false"), out).count() == 0


def test_very_long_and_repeated_texts(spark):
    long = "zyx wvu " * 200_000
    rows = spark.createDataFrame([(1, long), (1, long), (2, "abra cadabra")], "doc_id long, text string").withColumn("bits", F.lit("clash"))
    got = [(r.doc_id, r.lang_pred) for r in language.identified(rows, {"a": ["abra cadabra " * 40], "b": ["zyx wvu zyx " * 40]}).orderBy("doc_id").collect()]
    assert got == [(1, "b"), (1, "b"), (2, "a")]
