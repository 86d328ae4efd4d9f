"""Hashes of texts with nothing in them: the query has a row for each, as its SQL has; a joke must not be blank."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from lorewright.functions import text
from lorewright.operators import reconcile
from lorewright.plans import registry

from .oracle import TABLES, differences

TEXTS = ["", " ", "\t\n\x0b\f\r ", " a\n", "a", None, "\xa0", "　a ", "\x1c", "\x85\t"]


def test_exact_hash_of_blank_texts(spark, tmp_path):
    for t in TABLES:
        if t != "documents":
            os.symlink(f"/root/testdata/sf0.001/{t}.parquet", tmp_path / f"{t}.parquet")
    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    made = registry.queries()["exact_hash"](spark, str(tmp_path))
    same, ours, theirs = differences(made, registry.oracle_sql()["exact_hash"], str(tmp_path))
    assert same and not ours and not theirs
    by_rule = [x if x is None else hashlib.sha256(x.strip(" \t\n\x0b\f\r").encode()).hexdigest() for x in TEXTS]
    assert [r.hash for r in made.orderBy("doc_id").collect()] == by_rule


def test_a_blank_joke_stays_an_error(spark):
    jokes = spark.createDataFrame([("　 a\xa0",), (None,)], "t string").select(text.exact_hash(F.col("t")).alias("h"))
    assert [r.h for r in jokes.collect()] == [hashlib.sha256(b"a").hexdigest(), None]
    blank = spark.createDataFrame([(1, "　 ", [1.0])], "key long, texto string, embedding array<double>")
    with pytest.raises(Exception, match="blank"):
        reconcile.decide(blank, spark.createDataFrame([], "id long, hash_normalizado string, embedding array<double>")).collect()


def test_long_texts_are_trimmed_without_arrays_of_their_places(spark):
    # btrim and rtrim hold eight bytes for each byte of a text
    assert "btrim" not in text.exact_hash(F.col("t"))._jc.toString() and "rtrim" not in text.exact_hash(F.col("t"))._jc.toString()
    ends = [a + "é x" + b for a in ("", "　\n") for b in ("", "  ", "\x1f", "\U0001f600\xa0")]
    rows = spark.createDataFrame([(x,) for x in ends], "t string").select(text.exact_hash(F.col("t")).alias("h"), F.sha2(text.strip(F.col("t")), 256).alias("s"))
    assert all(r.h == r.s for r in rows.collect())
