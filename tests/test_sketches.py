"""Merged statistics against one pass and exact figures."""

import pytest
from pyspark.sql import functions as F

from lorewright.functions import text
from lorewright.operators import sketches
from lorewright.sources.keyed import Keyed


def test_merged_is_one_pass(spark, tmp_path):
    base = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", F.posexplode(F.split("text", r"\. ")).alias("pos", "texto"))
    base = base.unionByName(spark.createDataFrame([(None, 0, None), (None, 1, "")], "doc_id long, pos int, texto string"))
    table = Keyed(spark, f"file://{tmp_path}/t")
    batch = F.col("doc_id") % 7
    assert sketches.stored(table, base.where("doc_id % 7 < 3"), batch) == {"nuevos": 3, "existentes": 0}
    # the null batch and the four that are left
    assert sketches.stored(table, base, batch) == {"nuevos": 5, "existentes": 3}
    assert sketches.stored(table, base, batch) == {"nuevos": 0, "existentes": 8}
    many = sketches.merged(table.read(sketches.COLUMNS)).first()
    one = sketches.merged(sketches.batch_rows(base, F.lit("all"))).first()
    q = [r.q for r in base.select(F.coalesce(text.quality(F.col("texto")), F.lit(0.0)).alias("q")).collect()]
    docs, texts = base.agg(F.countDistinct("doc_id"), F.countDistinct("texto")).first()
    for got in (many, one):
        assert got.num_fragmentos == len(q) and got.media == pytest.approx(sum(q) / len(q)) and (got.minimo, got.maximo) == (min(q), max(q))
        assert abs(got.num_documentos - docs) <= sketches.DISTINCT_BOUND * docs and abs(got.num_textos - texts) <= sketches.DISTINCT_BOUND * texts
        for rank, value in zip((0.1, 0.5, 0.9), got.cuantiles, strict=True):
            assert sum(x < value for x in q) / len(q) - sketches.RANK_BOUND <= rank <= sum(x <= value for x in q) / len(q) + sketches.RANK_BOUND


def test_no_fragments(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id long, texto string")
    table = Keyed(spark, f"file://{tmp_path}/t")
    assert sketches.stored(table, none, F.col("doc_id")) == {"nuevos": 0, "existentes": 0}
    got = sketches.merged(table.read(sketches.COLUMNS)).first()
    assert (got.num_fragmentos, got.media, got.minimo, got.maximo, got.num_documentos, got.num_textos, got.cuantiles) == (0, 0.0, 0.0, 0.0, 0, 0, None)
