"""Helpers that the training-data operators share."""

from __future__ import annotations

import gc
import os
import re
import sys
import tempfile
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A key that holds more than this share of all rows is treated apart; there are at most 1 / HOT_SHARE such keys.
HOT_SHARE = 1 / 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """`text` with A-Z alone lower-cased; pure ASCII takes the fast built-in."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in spark.checkpoint.dir; one of our own only where it is unset and all runs on one machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='lorewright-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


#: Settings of what goes to a Python worker at once, and the bytes of it at most where a table is written.
BATCH, BYTES = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = "4m"


def materialised(df: DataFrame, name: str, batch: int | None = None) -> DataFrame:
    """`df` written once to the shared folder and read back: lineage is cut and a lost executor costs no recomputation.

    batch: rows that go to a Python worker at once while it is written, BATCH_BYTES of them at most; the session's own settings are put back.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = {name: spark.conf.get(name) for name in (BATCH, BYTES)}
    try:
        spark.conf.set(BYTES, BATCH_BYTES)
        if batch:
            spark.conf.set(BATCH, str(batch))
        df.write.option("compression", "zstd").parquet(path)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Deletes what materialised() wrote for `df`, once nothing reads it any more."""
    jvm = df.sparkSession.sparkContext._jvm
    for f in df.inputFiles()[:1]:
        path = jvm.org.apache.hadoop.fs.Path(f).getParent()
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def collected(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished steps now, not when the driver next happens to collect garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shipped(spark: SparkSession) -> None:
    """Makes this package importable on the executors when the path that the driver uses does not reach them."""
    root = str(Path(__file__).resolve().parents[2])
    reach = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root in reach or os.getcwd() == root or getattr(spark.sparkContext, "_lorewright_shipped", False):
        return
    out = f"{tempfile.mkdtemp(prefix='lorewright-')}/lorewright.zip"
    with zipfile.ZipFile(out, "w") as z:
        for p in sorted(Path(root, "lorewright").rglob("*.py")):
            z.write(p, p.relative_to(root))
    spark.sparkContext.addPyFile(out)
    if out in sys.path:
        sys.path.remove(out)
    spark.sparkContext._lorewright_shipped = True


def hex_number(text: Column, digits: int) -> Column:
    """The first `digits` (15 at most) hex digits of md5(text) as a long: a hash that any SQL engine reproduces."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def attached(rows: DataFrame, table: DataFrame, key: str, count: str, limit: int, spread: str) -> DataFrame:
    """`rows` left-joined to `table` on `key` (unique in `table`, no other column in common), with no task that holds a hot key's rows.

    `count` is the number of rows of a key: keys over `limit` (rows / limit of them at most, which the caller chooses small) are
    broadcast; the rest meet in a shuffle, in which the rows that have found their key already are dealt by column `spread`.
    """
    others = [c for c in table.columns if c != key]
    hot = F.broadcast(table.where(F.col(count) > limit).select(F.col(key).alias("_hk"), *[F.col(c).alias(f"_h_{c}") for c in others]))
    cold = table.where(F.col(count) <= limit).select(F.col(key).alias("_ck"), *[F.col(c).alias(f"_c_{c}") for c in others])
    kind = dict(rows.dtypes)[key]
    other = F.xxhash64(F.col(spread))
    other = F.unhex(F.hex(other)) if kind == "binary" else other.cast(kind)
    rows = rows.join(hot, F.col(key) == F.col("_hk"), "left")
    rows = rows.withColumn("_k", F.when(F.col(f"_h_{count}").isNull(), F.col(key)).otherwise(other)).join(cold, F.col("_k") == F.col("_ck"), "left")
    found = [F.when(F.col(f"_h_{count}").isNotNull(), F.col(f"_h_{c}")).otherwise(F.col(f"_c_{c}")).alias(c) for c in others]
    return rows.select(*[c for c in rows.columns if not c.startswith(("_h", "_c", "_k"))], *found)


def with_whole_ids(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, nil, text) for Python workers: a null id is 0 with nil set, since a null among longs would make pandas' column one of doubles."""
    whole = F.col(id_col).cast("long")
    return docs.select(F.coalesce(whole, F.lit(0).cast("long")).alias("doc_id"), whole.isNull().alias("nil"), F.col(text_col).alias("text"))


def bit_filter(ids: DataFrame, bit: Callable[[int], Column], count: int, most: int) -> np.ndarray:
    """Bits in which bit(size), a number below 1 << size, of every row of `ids` is set: 16 bits a row for `count` rows, 1 << `most` of them at most."""
    size = min(max(16, (16 * count).bit_length()), most)
    rows = ids.select((bit(size) + 1).alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect()
    out = np.zeros(1 << size, bool)
    for k, found in rows:
        out[(k - 1) << 15 : k << 15] = np.unpackbits(np.frombuffer(bytes(found), np.uint8), bitorder="little")
    return np.packbits(out)


def dealt(spark: SparkSession) -> int:
    """Partitions that lists are dealt to."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8)


def sorted_lists(rows: DataFrame, *by: str) -> DataFrame:
    """Rows dealt by list (h) and block (part), each task's in order."""
    return rows.repartition(dealt(rows.sparkSession), "h", "part").sortWithinPartitions("h", "part", *by)


def beside(pairs: DataFrame, values: DataFrame) -> DataFrame:
    """For pairs (a, b) and values (id, and others): rows (a, deal, other, b, the others), in which an a with its values comes before its partners with theirs.

    The values are brought to each pair's b, and a's come once to each of the blocks that its partners are dealt to. No row holds the values of
    both ends and no task all partners of an id of many pairs.
    """
    n = dealt(pairs.sparkSession)
    others = [c for c in values.columns if c != "id"]
    rows = pairs.withColumn("deal", F.pmod(F.xxhash64("b"), F.lit(max(64, n))))
    hubs = rows.select("a", "deal").distinct().join(values.withColumnRenamed("id", "a"), "a").select("a", "deal", F.lit(False).alias("other"), F.col("a").alias("b"), *others)
    partners = rows.join(values.withColumnRenamed("id", "b"), "b").select("a", "deal", F.lit(True).alias("other"), "b", *others)
    return hubs.unionByName(partners).repartition(n, "a", "deal").sortWithinPartitions("a", "deal", "other")


#: Counters of the sketch of key frequencies, and counters in a row of it.
BITS, ROW = 20, 4096


def counted(sketch: np.ndarray, keys: np.ndarray) -> None:
    """Counts 64-bit keys in a sketch by their first bits."""
    np.add(sketch, np.bincount((keys >> np.uint64(64 - BITS)).astype(np.int64), minlength=1 << BITS), out=sketch, casting="unsafe")


def frequency_classes(rows: DataFrame) -> np.ndarray:
    """For each counter of the sketches of all tasks (block, counts: a compressed row), 0 if it holds no more than chance puts there, else the binary logarithm of the rest."""

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch["block"].tolist(), batch["counts"], strict=True):
                held[block] = held.get(block, 0) + np.frombuffer(zlib.decompress(counts), np.uint32).astype(np.int64)
        yield pd.DataFrame({"block": list(held), "counts": [x.tobytes() for x in held.values()]}).astype({"block": "int32"})

    total = np.zeros(1 << BITS, np.int64)
    for block, counts in rows.select("block", "counts").repartition(32, "block").mapInPandas(summed, "block int, counts binary").collect():
        total[block * ROW : (block + 1) * ROW] = np.frombuffer(counts, np.int64)
    mean = max(1.0, float(np.median(total)))
    rest = total - mean - 8 * np.sqrt(mean)
    return np.where(rest >= 16, np.log2(np.maximum(rest, 1)).astype(np.uint8), 0).astype(np.uint8)


def compressed(sketch: np.ndarray) -> list[bytes]:
    """Rows of a sketch."""
    return [zlib.compress(r.tobytes(), 1) for r in sketch.reshape(-1, ROW)]


def classes_of(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Frequency classes of 64-bit keys."""
    return table[(keys.view(np.uint64) >> np.uint64(64 - BITS)).astype(np.int64)].astype(np.int64)


def blocks(c: np.ndarray, size: int) -> np.ndarray:
    """Blocks of about `size` entries that a list of frequency class c is dealt to; 1: it stays whole."""
    return np.maximum(1, (2 << c) // size)


def lists(batches: Iterator[pd.DataFrame], columns: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """Entries of whole lists (or blocks of lists), of a stream sorted by list (h) and block (part): some lists at a time, none cut."""
    rest = None
    for batch in batches:
        x = {c: batch[c].to_numpy() for c in columns}
        if rest is not None:
            x = {c: np.concatenate([rest[c], x[c]]) for c in columns}
        if not len(x["h"]):
            continue
        last = np.flatnonzero((x["h"] != x["h"][-1]) | (x["part"] != x["part"][-1]))
        cut = int(last[-1]) + 1 if len(last) else 0
        rest = {c: v[cut:] for c, v in x.items()}
        if cut:
            yield {c: v[:cut] for c, v in x.items()}
    if rest is not None and len(rest["h"]):
        yield rest


def bounds(x: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """First entries of the lists, and their sizes."""
    first = np.flatnonzero(np.concatenate([[True], (x["h"][1:] != x["h"][:-1]) | (x["part"][1:] != x["part"][:-1])]))
    return first, np.diff(np.concatenate([first, [len(x["h"])]]))


def probing(rows: DataFrame, classes, size: int, limit: int, kinds: str) -> DataFrame:
    """Entries (h, part, id, comp and others) of open lists, with probe; in a cut list those outside its largest component also probe each other block."""
    cut = rows.where("part >= 0")
    shares = cut.groupBy("h", "comp").agg(F.count(F.lit(1)).alias("c"))
    mains = shares.groupBy("h").agg(F.max_by("comp", F.struct("c", "comp")).alias("main"), F.sum("c").alias("many"))
    cut = attached(cut, materialised(mains, "main-components"), "h", "many", limit, "id").where("main <> comp").select(*rows.columns, F.lit(True).alias("probe"))

    def everywhere(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = classes.value
        for batch in batches:
            times = blocks(classes_of(batch["h"].to_numpy(np.int64), table), size)
            for begin in range(0, len(batch), 64):
                part, n = batch.iloc[begin : begin + 64], times[begin : begin + 64]
                row = np.repeat(np.arange(len(part)), n)
                to = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                other = to != part["part"].to_numpy()[row]
                yield part.iloc[row[other]].assign(part=to[other])

    return rows.withColumn("probe", F.lit(False)).unionByName(cut.mapInPandas(everywhere, f"{kinds}, probe boolean"))
