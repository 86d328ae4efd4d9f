"""The folder stream against sets in plain Python: snapshots that repeat, change and come late, restarts, and odd rows."""

import random

import pytest
from pyspark.sql import functions as F

from lorewright.sources import folder_stream
from lorewright.sources.folder_stream import FolderStream, FolderStreamSource

COLUMNS = "file_id string, name string, modified_time string, mime_type string"


def listing(spark, rows):
    return spark.createDataFrame([(i, f"n{i}", t, "text/plain") for i, t in rows], COLUMNS)


def run(spark, root, out, checkpoint):
    spark.dataSource.register(FolderStreamSource)
    rows = spark.readStream.format("folder_pages").option("path", root).load()
    q = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


@pytest.mark.parametrize("together", [False, True])
def test_snapshots(spark, tmp_path, together):
    rng = random.Random(7)
    root, out, checkpoint = (f"file://{tmp_path}/{x}" for x in ("in", "out", "check"))
    held, first = [], {}
    for n in range(1, 5):
        # late files have times before the mark, some files change, all the others are listed again
        held = [(i, t if rng.random() < 0.9 else f"2025-{n:02d}") for i, t in held] + [(f"{n}-{k}", f"20{rng.randrange(10, 30)}-01") for k in range(60)]
        if n == 3:
            held += held[:20]
        for state in held:
            first.setdefault(state, n)
        folder_stream.write_pages(listing(spark, held), root, n, 25)
        if not together:
            run(spark, root, out, checkpoint)
    if together:
        run(spark, root, out, checkpoint)
    got = [((r.file_id, r.modified_time), r.toma) for r in spark.read.parquet(out).collect()]
    assert len(got) == len(set(got)) and dict(got) == first


def test_plan_prunes(spark, tmp_path):
    root = f"file://{tmp_path}/in"
    folder_stream.write_pages(listing(spark, [(f"{k:03d}", f"2020-{k:03d}") for k in range(100)]), root, 1, 10)
    reader = FolderStream({"path": root})
    start = reader.latestOffset()
    assert (start["modified_time"], start["id"]) == ("2020-099", "099")
    # files after the mark ask no earlier page, a late one asks those around it
    folder_stream.write_pages(listing(spark, [(f"{k:03d}", f"2021-{k:03d}") for k in range(10)]), root, 2, 10)
    assert all(not p.earlier for p in reader.partitions(start, reader.latestOffset()) if reader.ranges[p.path][0] > "2021")
    middle = reader.latestOffset()
    folder_stream.write_pages(listing(spark, [("late", "2020-055")]), root, 3, 10)
    (page,) = reader.partitions(middle, reader.latestOffset())
    assert len(page.earlier) == 1 and [b.num_rows for b in reader.read(page)] == [1]
    assert reader.partitions(reader.latestOffset(), reader.latestOffset()) == []


def test_empty_unfinished_and_null(spark, tmp_path):
    root, out, checkpoint = (f"file://{tmp_path}/{x}" for x in ("in", "out", "check"))
    assert FolderStream({"path": root}).latestOffset() == {"modified_time": "", "id": "", "page": ""}
    folder_stream.write_pages(listing(spark, []), root, 1)
    folder_stream.write_pages(listing(spark, [(None, None), ("a", None), ("a", None), (None, "t")]), root, 2)
    folder_stream.write_pages(listing(spark, [("b", "t")]), root, 3)
    (tmp_path / "in/toma=000003/_SUCCESS").unlink()
    run(spark, root, out, checkpoint)
    read = lambda: {(r.file_id, r.modified_time, r.toma) for r in spark.read.parquet(out).collect()}
    assert read() == {("", "", 2), ("a", "", 2), ("", "t", 2)}
    (tmp_path / "in/toma=000003/_SUCCESS").touch()
    run(spark, root, out, checkpoint)
    assert read() == {("", "", 2), ("a", "", 2), ("", "t", 2), ("b", "t", 3)}
    assert spark.read.parquet(out).where(F.col("name").isNull()).count() == 0
