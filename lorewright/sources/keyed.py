"""Append-only tables that know, for each of their files, which keys it may hold: an append opens those files alone that may hold one of its own."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lorewright.operators.relational import latest
from lorewright.sources.scratch import Scratch

#: Bits of a Bloom filter for each key, and places that a key sets; (key, file) pairs up to which filters are asked.
BITS, PLACES, PAIRS = 12, 4, 20_000_000


class Keyed:
    """A Parquet folder of batches, `lote=<id>`, with an index of its files below `_keys`.

    The index has a row for each file, with its number of rows and its range of keys, and beside it the words of the file's Bloom filter. The index
    rows of a batch are written last, in one file: they are the commit, and what a broken append left behind belongs to no table. One
    writer at a time per table is assumed. Null keys are keys like others.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        #: Files opened for their keys and files of the table, in the last append.
        self.opened, self.files = 0, 0

    def there(self, path: str) -> bool:
        """True if a path exists, on whatever file system."""
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def index(self, kind: str | None = None) -> DataFrame | None:
        """(file, n, words, low, high) of the files that belong to the table, without the ranges if `kind` (of the key) isn't given; None if nothing was ever written."""
        folder = f"{self.path}/_keys/index"
        if not self.there(folder):
            return None
        ranges = f", low {kind}, high {kind}" if kind else ""
        rows = self.spark.read.schema(f"file string, n long, words long{ranges}").parquet(folder)
        gone = rows.where("n < 0").select("file")
        return rows.where("n >= 0").join(gone, "file", "left_anti")

    def opened_rows(self, files: Sequence[str], columns: str) -> DataFrame:
        """The rows of some of the table's files."""
        return self.spark.read.schema(columns).parquet(*[f"{self.path}/{f}" for f in files])

    def read(self, columns: str) -> DataFrame:
        """The table; empty with these columns if nothing was ever written. The list of its files comes to the driver."""
        index = self.index()
        files = [r.file for r in index.select("file").collect()] if index is not None else []
        files = [f for f in files if self.there(f"{self.path}/{f}")]
        return self.opened_rows(files, columns) if files else self.spark.createDataFrame([], columns)

    def may_hold(self, keys: DataFrame, kind: str, count: int) -> list[str]:
        """Files in whose range a key of `keys` (_k) lies and whose filter has all of its places; by range alone if there are too many pairs to ask."""
        index = self.index(kind)
        if index is None or not count:
            return []
        ends = keys.agg(F.min("_k").alias("l"), F.max("_k").alias("h"))
        files = index.join(F.broadcast(ends), (F.col("low") <= F.col("h")) & (F.col("high") >= F.col("l"))).select("file", "words", "low", "high")
        near = [r.file for r in files.select("file").collect()]
        self.files = index.count()
        if not near or count * len(near) > PAIRS:
            return near
        lots = sorted({f.split("/", 1)[0] for f in near})
        words = self.spark.read.schema("file string, word long, bits long").parquet(*[f"{self.path}/_keys/filters/{lot}" for lot in lots])
        pairs = keys.join(F.broadcast(files), (F.col("_k") >= F.col("low")) & (F.col("_k") <= F.col("high"))).select("_k", "file", "words")
        asked = pairs.select("_k", "file", F.explode(places(F.col("_k"), F.col("words"))).alias("place")).withColumn("word", F.shiftright("place", 6))
        hits = asked.join(words, ["file", "word"]).where(F.expr("shiftright(bits, cast(place & 63 as int)) & 1") == 1)
        full = hits.groupBy("file", "_k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == PLACES)
        return [r.file for r in full.select("file").distinct().collect()]

    def append(self, rows: DataFrame, key: Column, order: list[Column]) -> dict[str, int]:
        """Appends the rows whose key the table lacks, the first of each key in `order`; counts of new and existing ones. A rerun writes nothing.

        `rows` are worked out once. Of the files that may hold one of their keys the key's columns are read, and of no other file anything.
        """
        columns = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes)
        with Scratch(self.spark, "append") as scratch:
            seen = Observation()
            batch = scratch.write(latest(rows.observe(seen, F.count(F.lit(1)).alias("n")).withColumn("_k", F.struct(key.alias("k"))), ["_k"], order), "batch")
            kind, count = dict(batch.dtypes)["_k"], batch.count()
            if not count:
                return {"nuevos": 0, "existentes": 0}
            total = seen.get["n"]
            files = self.may_hold(batch.select("_k"), kind, count)
            self.opened = len(files)
            if files:
                held = self.opened_rows(files, columns).select(F.struct(key.alias("k")).alias("_held"))
                batch = batch.join(held, F.col("_k").eqNullSafe(F.col("_held")), "left_anti")
            new = self.write(batch.repartitionByRange("_k").drop("_k"), key, kind)
        return {"nuevos": new, "existentes": total - new}

    def write(self, rows: DataFrame, key: Column, kind: str, gone: Sequence[str] = ()) -> int:
        """Writes a batch, then its filters, then its index rows, with those of files that it replaces; the number of rows."""
        lot = f"lote={uuid.uuid4().hex}"
        columns = rows.schema
        rows.write.parquet(f"{self.path}/{lot}")
        stored = self.spark.read.schema(columns).parquet(f"{self.path}/{lot}")
        keys = stored.select(F.struct(key.alias("k")).cast(kind).alias("_k"), F.concat(F.lit(f"{lot}/"), F.element_at(F.split("_metadata.file_path", "/"), -1)).alias("file"))
        about = keys.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.min("_k").alias("low"), F.max("_k").alias("high")).withColumn("words", F.ceil(F.col("n") * BITS / 64))
        with Scratch(self.spark, "index") as scratch:
            return self.commit(scratch.write(about.select("file", "n", "words", "low", "high"), "about"), keys, lot, gone)

    def commit(self, index: DataFrame, keys: DataFrame, lot: str, gone: Sequence[str]) -> int:
        """Writes the filters of a batch that stands in its folder, then its index rows."""
        n = index.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
        if not n and not gone:
            Scratch(self.spark, "none").drop(f"{self.path}/{lot}")
            return 0
        made = keys.join(F.broadcast(index.select("file", "words")), "file").select("file", F.explode(places(F.col("_k"), F.col("words"))).alias("place"))
        made.groupBy("file", F.shiftright("place", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits")).write.parquet(f"{self.path}/_keys/filters/{lot}")
        if gone:
            index = index.unionByName(self.spark.createDataFrame([(f, -1) for f in gone], "file string, n long"), allowMissingColumns=True)
        index.coalesce(1).write.mode("append").parquet(f"{self.path}/_keys/index")
        return n or 0

    def compacted(self, columns: str, key: Column, least: int = 100_000) -> int:
        """Joins the files of fewer than `least` rows in one batch and returns how many there were. The old ones leave the table with the commit; readers that began before it may still have them open, so they are not deleted."""
        index = self.index()
        small = [r.file for r in index.where(F.col("n") < least).select("file").collect()] if index is not None else []
        if len(small) > 1:
            rows = self.opened_rows(small, columns).withColumn("_k", F.struct(key.alias("k")))
            self.write(rows.repartitionByRange("_k").drop("_k"), key, dict(rows.dtypes)["_k"], small)
        return len(small) if len(small) > 1 else 0


def places(key: Column, words: Column) -> Column:
    """The places that a key sets in a filter of so many words."""
    return F.array(*[F.pmod(F.xxhash64(key, F.lit(k)), words * 64) for k in range(PLACES)])
