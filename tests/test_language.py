"""Language by learned votes, on texts that were not learned from."""

from pyspark.sql import functions as F

from lorewright.functions import language


def test_learned_votes_tell_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    votes = language.learned_votes(docs.where("doc_id % 5 <> 0"))
    assert set(votes) == {"en", "de", "es", "fr"} and all(len(v) == 200 for v in votes.values())
    held = docs.where("doc_id % 5 = 0").select((language.detected(F.col("text"), votes) == F.col("lang")).alias("ok"))
    assert held.agg(F.avg(F.col("ok").cast("int"))).first()[0] > 0.97


def test_votes_of_nothing(spark):
    rows = spark.createDataFrame([(None, "x"), ("en", None), ("en", "")], "lang string, text string")
    assert language.learned_votes(rows) == {}
    got = spark.createDataFrame([(None,), ("",), ("the und the",), ("und the",), ("12",)], "t string").select(language.detected(F.col("t")).alias("x")).collect()
    assert [r.x for r in got] == ["und", "und", "en", "de", "und"]
