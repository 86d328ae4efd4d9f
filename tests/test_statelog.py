"""State from a log of changes against dictionaries in plain Python: any version, points, snapshots, partial changes, broken writes."""

import datetime
import random

import pytest

from lorewright.sources.statelog import CHANGE, StateLog

COLUMNS = "id string, a long, b string"
CHANGES = "id string, a long, b string, fin boolean, dados array<string>, ts timestamp"
START = datetime.datetime(2024, 1, 1)


def test_every_version_is_as_a_fold_says(spark, tmp_path):
    rng, table = random.Random(3), StateLog(spark, f"file://{tmp_path}/t", COLUMNS, buckets=4)
    state, states = {}, [{}]
    for n in range(1, 8):
        rows = []
        for key in rng.sample([None, "", *map(str, range(12))], 6):
            names, gone, ts = rng.choice([["a"], ["b"], ["a", "b"], []]), rng.random() < 0.25, START + datetime.timedelta(hours=n)
            rows.append((key, rng.choice([None, n]), rng.choice([None, f"b{n}"]), gone, names, ts))
            a, b, _ = state.get(key, (None, None, None))
            state[key] = None if gone else (rows[-1][1] if "a" in names else a, rows[-1][2] if "b" in names else b, ts)
            if gone:
                del state[key]
        assert table.append(spark.createDataFrame(rows, CHANGES), "ts", "fin", "dados") == n
        states.append(dict(state))
        if n in (3, 6):
            assert table.compact() == n and table.compact() == 0
    for n, expected in enumerate(states):
        assert {r.id: (r.a, r.b, r.updated_at) for r in table.as_of(n).collect()} == expected
    assert len(table.folders(3)) == 1 and len(table.folders(5)) == 3 and len(table.folders()) == 2
    for key in (None, "", "3", "none"):
        assert [(r.a, r.b, r.updated_at) for r in table.point(key)] == ([states[-1][key]] if key in states[-1] else [])
    assert {r.id for r in table.point("1", "2", None)} == {k for k in ("1", "2", None) if k in states[-1]}
    with pytest.raises(ValueError):
        table.as_of(8)


def test_a_point_read_opens_its_bucket_alone(spark, tmp_path):
    table = StateLog(spark, f"file://{tmp_path}/t", COLUMNS, buckets=8)
    table.append(spark.range(400).selectExpr("cast(id as string) id", "id a", "'x' b"))
    table.append(spark.createDataFrame([("7", 70)], "id string, a long"))
    one = table.as_of(None, ["7"])
    assert [(r.a, r.b) for r in one.collect()] == [(70, "x")]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "_bucket" in plan.split("PartitionFilters: [", 1)[1].split("]")[0]
    assert [(r.version, r.cambiados) for r in table.history("7").orderBy("version").collect()] == [(1, ["a", "b"]), (2, ["a"])]


def test_errors_and_broken_writes(spark, tmp_path):
    table = StateLog(spark, f"file://{tmp_path}/t", COLUMNS, buckets=2)
    assert table.as_of().count() == 0 and table.last() == 0 and table.point("x") == [] and table.history("x").count() == 0 and table.compact() == 0
    with pytest.raises(ValueError, match="columns"):
        table.append(spark.createDataFrame([("x", 1)], "id string, other long"))
    with pytest.raises(Exception, match="twice"):
        table.append(spark.createDataFrame([("x", 1), ("x", 1)], "id string, a long"))
    assert table.last() == 0 and table.as_of().count() == 0
    assert table.append(spark.createDataFrame([], "id string, a long")) == 1 and table.as_of().count() == 0
    assert table.append(spark.createDataFrame([("x", 1)], "id string, a long")) == 2
    assert sum(1 for f in (tmp_path / "t").iterdir() if f.name.startswith(f"lote={CHANGE}")) >= 2 and [r.a for r in table.as_of().collect()] == [1]
    assert table.point("x")[0].updated_at is not None
