"""Appends that open only files that may hold their keys: counts of files, odd keys, broken appends, compaction."""

import pytest
from pyspark.sql import functions as F

from lorewright.sources import keyed
from lorewright.sources.keyed import Keyed

COLUMNS = "id long, t string"


def rows(spark, ids, t="x"):
    return spark.createDataFrame([(i, t) for i in ids], COLUMNS)


def put(table, df, key=None):
    return table.append(df, F.col("id") if key is None else key, [F.col("t")])


def test_ranges_and_filters_prune(spark, tmp_path):
    table = Keyed(spark, f"file://{tmp_path}/t")
    for k in range(6):
        assert put(table, rows(spark, range(k * 100, k * 100 + 100))) == {"nuevos": 100, "existentes": 0}
        # ascending keys lie in no file's range
        assert table.opened == 0
    assert put(table, rows(spark, [250, 251, 1000])) == {"nuevos": 1, "existentes": 2} and (table.opened, table.files) == (1, 6)
    # in the range of every file, held by none
    for k in range(3):
        put(table, rows(spark, [-1 - k, 5000 + k]))
    assert put(table, rows(spark, [1500])) == {"nuevos": 1, "existentes": 0} and table.opened <= 1 < table.files
    assert table.read(COLUMNS).count() == table.read(COLUMNS).select("id").distinct().count() == 608


def test_too_many_pairs_to_ask(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed, "PAIRS", 10)
    table = Keyed(spark, f"file://{tmp_path}/t")
    put(table, rows(spark, range(0, 200, 2)))
    assert put(table, rows(spark, range(100, 150))) == {"nuevos": 25, "existentes": 25} and table.opened == 1


def test_keys_of_any_kind(spark, tmp_path):
    data = [(1, None, "b"), (1, None, "a"), (None, "x", "c"), (None, None, "d"), (2, "", "e")]
    df = spark.createDataFrame(data, "a int, b string, lote string")
    table = Keyed(spark, f"file://{tmp_path}/t")
    key = F.struct("a", "b")
    assert table.append(df, key, [F.col("lote")]) == {"nuevos": 4, "existentes": 1}
    assert table.append(df, key, [F.col("lote")]) == {"nuevos": 0, "existentes": 5}
    assert {r.lote for r in table.read("a int, b string, lote string").collect()} == {"a", "c", "d", "e"}
    one = Keyed(spark, f"file://{tmp_path}/u")
    assert one.append(df, F.col("b"), [F.col("lote")])["nuevos"] == 3 and one.append(df, F.col("b"), [F.col("lote")])["nuevos"] == 0
    assert one.append(df.limit(0), F.col("b"), [F.col("lote")]) == {"nuevos": 0, "existentes": 0}


def test_rows_are_worked_out_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        seen.add(1)
        return "t"

    table = Keyed(spark, f"file://{tmp_path}/t")
    put(table, spark.range(0, 50, 1, 2).select("id", counted.asNondeterministic()("id").alias("t")))
    assert seen.value == 50


def test_a_broken_append_leaves_no_rows(spark, tmp_path, monkeypatch):
    table = Keyed(spark, f"file://{tmp_path}/t")
    put(table, rows(spark, range(10)))
    monkeypatch.setattr(keyed, "places", lambda *_: F.array(F.raise_error(F.lit("stop")).cast("long")))
    with pytest.raises(Exception, match="stop"):
        put(table, rows(spark, range(100, 120)))
    monkeypatch.undo()
    assert table.read(COLUMNS).count() == 10
    assert put(table, rows(spark, range(100, 120))) == {"nuevos": 20, "existentes": 0} and table.read(COLUMNS).count() == 30


def test_compaction(spark, tmp_path):
    table = Keyed(spark, f"file://{tmp_path}/t")
    for k in range(4):
        put(table, rows(spark, range(k, 40, 4), f"t{k}"))
    before = sorted(map(tuple, table.read(COLUMNS).collect()))
    assert table.compacted(COLUMNS, F.col("id")) == 4 and table.compacted(COLUMNS, F.col("id")) == 0
    assert sorted(map(tuple, table.read(COLUMNS).collect())) == before and table.index().count() == 1
    assert put(table, rows(spark, [3, 77])) == {"nuevos": 1, "existentes": 1}
