"""Toxicity: held-out labels, the same scores under any hash seed, other scripts, edge cases."""

import os
import subprocess
import sys
import zlib

import pandas as pd
from pyspark.sql import functions as F

from lorewright.llm import toxicity

LARGE = "/root/testdata/sf0.1"
SCRIPT = """
from lorewright.llm import toxicity
texts = [f"good day {k} sunny place {k % 7} again" for k in range(60)] + [f"you {k} blorgface thing {k % 5} now" for k in range(60)]
m = toxicity.trained(texts, [0] * 60 + [1] * 60)
print([x.hex() for x in m.chances(["what a blorgface", "what a blorgsface", "sunny day", "", "again now"], {}).tolist()])
"""


def test_held_out_labels():
    """Of the toxic labels, 42 % stand on texts with none of the words that the others share: nothing can learn these."""
    rows = pd.read_parquet(f"{LARGE}/documents.parquet").merge(pd.read_parquet(f"{LARGE}/labels.parquet"), on="doc_id").sort_values("doc_id")
    held = rows.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)
    model = toxicity.trained(rows[~held].text.tolist(), rows[~held].toxic.tolist())
    found = model.chances(rows[held].text.tolist(), {}) >= 0.7
    toxic = rows[held].toxic.to_numpy() == 1
    assert (found & toxic).sum() / toxic.sum() > 0.58
    assert (found & ~toxic).sum() <= 2


def test_scores_do_not_depend_on_the_hash_seed():
    out = {subprocess.run([sys.executable, "-c", SCRIPT], env={**os.environ, "PYTHONHASHSEED": seed}, capture_output=True, text=True, check=True).stdout for seed in "12"}
    assert len(out) == 1


def test_other_scripts():
    texts = [f"今日天気よい {k} 学校文章です 天気予報" for k in range(60)] + [f"お前 {k} 馬鹿野郎 です {k % 5}" for k in range(60)]
    model = toxicity.trained(texts, [0] * 60 + [1] * 60)
    s = model.chances(["これ 馬鹿野郎 だ", "これ 学校文章 だ", "文章です 天気予報 学校文章"], {})
    assert s[0] >= 0.7 and max(s[1:]) < 0.3


def test_whole_long_texts_empty_tables_and_clashing_columns(spark):
    texts = [f"good day {k} sunny place {k % 7} again" for k in range(60)] + [f"you {k} blorgface thing {k % 5} now" for k in range(60)]
    rows = spark.createDataFrame([(1, "good day " * 60_000 + "blorgface"), (2, "good day " * 60_000), (3, None)], "doc_id long, text string").withColumn("labels", F.lit("clash")).withColumn("worst", F.lit(1))
    got = {r.doc_id: r.score for r in toxicity.scored(rows, texts, [0] * 60 + [1] * 60).collect()}
    assert got[1] >= 0.7 and max(got[2], got[3]) < 0.3
    assert toxicity.scored(rows.where("false"), texts, [0] * 60 + [1] * 60).count() == 0


def test_training_rows_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "LEARNED", 500)
    docs = spark.createDataFrame([(k, "x" * 100) for k in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(20)] + [(3, None)], "doc_id long, toxic int")
    texts, _ = toxicity.training_rows(docs, labels, F.lit(True))
    assert len(texts) == 5
