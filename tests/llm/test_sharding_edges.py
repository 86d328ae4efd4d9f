"""Sharding of null, repeated and clashing rows, empty tables and very long texts."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lorewright.llm import sharding


def test_edges(spark):
    rows = [(None, "a"), (None, "b"), (7, "x"), (7, "x"), (7, "y"), (1 << 60, "z" * 2_000_000), (-3, None)]
    frame = spark.createDataFrame(rows, "_rank long, text string")
    for c in ("_bucket", "_scores", "_before", "_n", "_mark", "slot", "shard"):
        frame = frame.withColumn(c, F.lit("clash"))
    assigned = sharding.assigned(frame, "_rank", [1.0] * 4, 1.0)
    out = sharding.placed(assigned, "_rank")
    assert set(out.columns) == {*frame.columns, "grown_shard"} and out.count() == len(rows)
    got = out.collect()
    assert {r["_bucket"] for r in got} == {"clash"} and {r["_rank"] for r in got} == {None, 7, 1 << 60, -3}
    for key in (None, 7):
        assert len({r.shard for r in got if r["_rank"] == key}) == 1
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    again = {(r["_rank"], r.text, r.slot) for r in sharding.placed(assigned.repartition(5), "_rank").collect()}
    assert again == {(r["_rank"], r.text, r.slot) for r in got}
    with pytest.raises(ValueError):
        sharding.placed(assigned, "shard")
    with pytest.raises(ValueError):
        sharding.assigned(frame, "shard", [1.0])


def test_empty(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    out = entry.queries()["op9_rendezvous_sharding"](spark, str(tmp_path))
    assert out.count() == 0 and out.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
