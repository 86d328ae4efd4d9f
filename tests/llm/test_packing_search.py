"""The genetic search of packing against plain best fit, and token ids of the vocabulary's own library."""

import math
import random

import pytest
from pyspark.sql import functions as F

from lorewright.llm import packing
from lorewright.llm.common import materialised

SIZES = {"thirds": (500, 900), "wide": (300, 1400), "small": (60, 500)}


@pytest.mark.parametrize("name", SIZES)
def test_search_never_falls_behind_best_fit(name):
    rng = random.Random(name)
    lengths = [rng.randint(*SIZES[name]) for _ in range(1200)]
    plain = packing.filled(lengths, list(range(len(lengths))), [], 2048, 0.0, rng)
    best, born, first = packing.evolved(lengths, [], 2048, rng)
    assert sorted(i for b in best for i in b) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in b) <= 2048 for b in best)
    assert first == len(plain) and len(best) <= len(plain)
    if name == "thirds":
        assert born > 24 and len(best) < 0.95 * len(plain)


def test_report_counts_the_search(spark):
    rng = random.Random(2)
    rows = [(k, 0, 0, rng.randint(500, 900), 1) for k in range(1500)]
    report = []
    p = packing.packed(materialised(spark.createDataFrame(rows, packing.PIECES), "t"), report=report).toPandas()
    bound = math.ceil(sum(r[3] for r in rows) / 2048)
    assert report[0]["offspring"] > 0 and report[0]["migrations"] > 0 and report[0]["search"] < 0.95 * report[0]["best_fit"]
    assert bound <= p.sequence_id.nunique() <= 1.06 * bound


def test_large_ids_beside_null_ones(spark):
    import public_tokenizers

    rows = [((1 << 60) + 1, "a"), (None, "b"), (-5, "word " * 30_000), (-5, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("sequence_id", F.lit("clash")).withColumn("_block", F.lit(1))
    p = packing.pack_documents(frame, public_tokenizers.path("byte_bpe_50k.json")).collect()
    assert sum(r.doc_id == (1 << 60) + 1 for r in p) == 1 and sum(r.doc_id is None for r in p) == 1
    long = sorted((r.piece, r.length) for r in p if r.doc_id == -5 and r.length > 1)
    assert [n for _, n in long[1:]] == [2048] * (len(long) - 1) and sum(n for _, n in long) >= 30_001
    assert packing.pack_documents(frame.where("false"), public_tokenizers.path("byte_bpe_50k.json")).count() == 0
