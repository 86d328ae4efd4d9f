"""Versions: what the manifest lists is what was written; a failing task leaves nothing."""

import os

import pytest
from pyspark.sql import functions as F

from lorewright.sources import versions


def documents(spark, n, parts=3):
    return spark.range(0, n, 1, parts).select(F.col("id").alias("doc_id"), F.concat(F.lit("d"), "id").alias("nombre"), F.repeat(F.lit("x"), F.col("id").cast("int")).alias("contenido"), (F.col("id") % 4).alias("num_fragmentos"))


def save(df, root, **options):
    df.sparkSession.dataSource.register(versions.VersionSink)
    df.write.format("corpus_versions").option("path", root).options(**options).mode("append").save()


def test_versions_follow_each_other(spark, tmp_path):
    root = f"file://{tmp_path}/v"
    assert versions.manifest(root) is None
    save(documents(spark, 50), root)
    save(documents(spark, 7, 1), root, fileBytes="1")
    save(documents(spark, 0), root)
    assert [versions.manifest(root, n)["documentos"] for n in (1, 2, 3)] == [50, 7, 0] and versions.manifest(root, 4) is None
    assert versions.manifest(root, 1)["fragmentos"] == sum(k % 4 for k in range(50)) and len(versions.manifest(root, 1)["archivos"]) == 3
    rows = lambda n: sorted(tuple(r) for r in versions.read_version(spark, root, n).collect())
    assert rows(1) == sorted(tuple(r) for r in documents(spark, 50).collect()) and len(rows(2)) == 7 and rows(None) == rows(3) == []
    with pytest.raises(ValueError):
        versions.read_version(spark, root, 9)


def test_a_failing_task_leaves_no_version(spark, tmp_path):
    root = f"file://{tmp_path}/v"
    save(documents(spark, 5), root)
    before = sorted(os.listdir(tmp_path / "v/_datos"))
    broken = documents(spark, 50).withColumn("contenido", F.when(F.col("doc_id") == 49, F.raise_error(F.lit("broken"))).otherwise(F.col("contenido")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        save(broken, root)
    assert sorted(os.listdir(tmp_path / "v/_datos")) == before and versions.manifest(root)["version"] == 1
    assert sorted(x for x in os.listdir(tmp_path / "v") if x.endswith(".json")) == ["v1.json"]
    save(documents(spark, 6), root)
    assert versions.manifest(root)["version"] == 2 and versions.read_version(spark, root).count() == 6
    with pytest.raises(Exception, match="appended"):
        documents(spark, 1).write.format("corpus_versions").option("path", root).mode("overwrite").save()


def test_what_lost_drivers_left_is_found(spark, tmp_path):
    root = f"file://{tmp_path}/v"
    save(documents(spark, 5), root)
    (tmp_path / "v/_datos/lost").mkdir()
    (tmp_path / "v/_datos/lost/x.parquet").write_bytes(b"")
    assert versions.superseded(root) == ["lost"] and versions.superseded(root) == [] and versions.read_version(spark, root).count() == 5
