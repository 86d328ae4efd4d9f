"""A table as a log of changes: each append is a version, snapshots are taken now and then, and the state as of any version is read from one snapshot and the changes after it.

Changes and snapshots lie in folders by bucket of the key's hash, so that a point read opens its key's bucket alone. A row of the log is the commit of a version
or a snapshot and is written last; what a broken write left is in none. One writer at a time is assumed.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = "kind string, version long, lot string, buckets int, at timestamp"
CHANGE, SNAPSHOT = "cambios", "foto"
OWN = "_set array<string>, _gone boolean, updated_at timestamp"
#: Tasks that may share a bucket's rows in a write.
PARTS = 16


class StateLog:
    """State by key. `columns` is the schema without updated_at, the key among it; `buckets` counts only for a table's first write. Null is a key like any other."""

    def __init__(self, spark: SparkSession, path: str, columns: str, key: str = "id", buckets: int = 64):
        self.spark, self.path, self.columns, self.key, self.first_buckets = spark, path.rstrip("/"), columns, key, buckets
        self.schema = spark.createDataFrame([], columns).schema
        self.values = [f.name for f in self.schema if f.name != key]

    def log(self) -> list:
        """Rows of the log: as many as there were writes, whatever the table's size."""
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_log")
        if not p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
            return []
        return self.spark.read.schema(LOG).parquet(f"{self.path}/_log").collect()

    def last(self) -> int:
        """The last version; 0 if nothing was ever written."""
        return max((r.version for r in self.log() if r.kind == CHANGE), default=0)

    def bucket(self, key: Column, buckets: int) -> Column:
        """The bucket of a key."""
        return F.pmod(F.xxhash64(key.cast(self.schema[self.key].dataType)), F.lit(buckets)).cast("int")

    def write(self, rows: DataFrame, kind: str, version: int, buckets: int) -> None:
        """Writes rows by bucket, then their row of the log."""
        lot = f"lote={kind}-{version:012d}-{uuid.uuid4().hex}"
        rows = rows.withColumn("_bucket", self.bucket(F.col(self.key), buckets))
        part = F.pmod(F.shiftright(F.xxhash64(F.col(self.key)), 32), F.lit(PARTS))
        rows.repartition("_bucket", part).write.partitionBy("_bucket").parquet(f"{self.path}/{lot}")
        entry = self.spark.range(1).select(F.lit(kind).alias("kind"), F.lit(version).cast("long").alias("version"), F.lit(lot).alias("lot"), F.lit(buckets).alias("buckets"), F.current_timestamp().alias("at"))
        entry.coalesce(1).write.mode("append").parquet(f"{self.path}/_log")

    def append(self, changes: DataFrame, at: str | None = None, gone: str | None = None, present: str | None = None) -> int:
        """Appends one version and returns its number.

        `changes` has the key and some of the table's columns; those that it lacks stay as they are (null in a new row). Three more columns may be named: `at` is updated_at
        (by default now); where `gone` holds, the row leaves the state, and what comes back later starts from nulls; `present` is an array of the names of columns
        that a row sets, for rows that don't set all that `changes` has. Other columns, and a key that occurs twice, are errors.
        """
        unknown = set(changes.columns) - {f.name for f in self.schema} - {at, gone, present}
        if unknown or self.key not in changes.columns:
            raise ValueError(f"not the table's columns: {sorted(unknown) or [self.key]}")
        given = [c for c in self.values if c in changes.columns]
        log = self.log()
        buckets = log[0].buckets if log else self.first_buckets
        everything, some = (F.array(*map(F.lit, names)).cast("array<string>") for names in (self.values, given))
        touched = F.array_intersect(some, F.coalesce(F.col(present), some)) if present else some
        at = F.col(at) if at else F.current_timestamp()
        gone = F.coalesce(F.col(gone), F.lit(False)) if gone else F.lit(False)
        made = [F.when(~gone, F.col(c)).cast(self.schema[c].dataType).alias(c) if c in given else F.lit(None).cast(self.schema[c].dataType).alias(c) for c in self.values]
        rows = changes.select(
            F.col(self.key).cast(self.schema[self.key].dataType).alias(self.key), *made, F.when(gone, everything).otherwise(touched).alias("_set"), gone.alias("_gone"),
            at.cast("timestamp").alias("updated_at"),
        )
        once = rows.groupBy(self.key).agg(*[F.first(c).alias(c) for c in rows.columns if c != self.key], F.count(F.lit(1)).alias("_n"))
        once = once.where(F.when(F.col("_n") > 1, F.raise_error(F.lit("a key occurs twice in one version")).cast("boolean")).otherwise(True)).drop("_n")
        version = max((r.version for r in log if r.kind == CHANGE), default=0) + 1
        self.write(once, CHANGE, version, buckets)
        return version

    def parts(self, version: int | None) -> tuple[list[str], list[tuple[int, str]], int]:
        """(folders of the latest snapshot up to a version, (version, folder) of the changes after it, buckets)."""
        log = self.log()
        newest = max((r.version for r in log if r.kind == CHANGE), default=0)
        version = newest if version is None else version
        if not 0 <= version <= newest:
            raise ValueError(f"there is no version {version}, the last one is {newest}")
        shots = sorted((r.version, r.lot) for r in log if r.kind == SNAPSHOT and r.version <= version)
        since = shots[-1][0] if shots else 0
        deltas = sorted((r.version, r.lot) for r in log if r.kind == CHANGE and since < r.version <= version)
        return [shots[-1][1]] if shots else [], deltas, log[0].buckets if log else self.first_buckets

    def folders(self, version: int | None = None) -> list[str]:
        """The folders that the state as of a version is read from."""
        shot, deltas, _ = self.parts(version)
        return shot + [lot for _, lot in deltas]

    def as_of(self, version: int | None = None, keys: Sequence | None = None) -> DataFrame:
        """The state (columns, updated_at) after a version, by default the last; of some keys alone if given, from their buckets only.

        Each column is the one last set. Changes are combined before they are exchanged; a snapshot with no changes after it is read as it is.
        """
        shot, deltas, buckets = self.parts(version)
        names = [f.name for f in self.schema]
        read = lambda lots, own: self.spark.read.schema(f"{self.columns}, {own}, lote string, _bucket int").option("basePath", self.path).parquet(*[f"{self.path}/{x}" for x in lots])

        def wanted(rows: DataFrame) -> DataFrame:
            if keys is None:
                return rows
            chosen = {r[0] for r in self.spark.createDataFrame([(k,) for k in keys], f"k {self.schema[self.key].dataType.simpleString()}").select(self.bucket(F.col("k"), buckets)).distinct().collect()}
            hit = F.col(self.key).isin([k for k in keys if k is not None])
            hit = F.coalesce(hit, F.lit(False)) | F.col(self.key).isNull() if None in keys else hit
            return rows.where(F.col("_bucket").isin(sorted(chosen))).where(hit)

        base = wanted(read(shot, "updated_at timestamp")).select(*names, "updated_at") if shot else self.spark.createDataFrame([], f"{self.columns}, updated_at timestamp")
        if not deltas:
            return base
        changed = wanted(read([lot for _, lot in deltas], OWN))
        changed = changed.withColumn("_version", F.regexp_extract("lote", r"-(\d+)-", 1).cast("long")).select(*names, "_version", "_set", "_gone", "updated_at")
        old = base.select(*names, F.lit(0).cast("long").alias("_version"), F.array(*map(F.lit, self.values)).cast("array<string>").alias("_set"), F.lit(False).alias("_gone"), "updated_at")
        rows = old.unionByName(changed)
        latest = [F.max_by(F.col(c), F.when(F.array_contains("_set", c), F.col("_version"))).alias(c) for c in self.values]
        ends = rows.groupBy(self.key).agg(*latest, F.max_by("_gone", "_version").alias("_gone"), F.max_by("updated_at", "_version").alias("updated_at"))
        return ends.where("not _gone").select(*names, "updated_at")

    def point(self, *keys) -> list:
        """The rows of some keys as they are now; those that there aren't are left out."""
        return self.as_of(None, list(keys)).collect()

    def compact(self) -> int:
        """Takes a snapshot of the last version and returns its number; 0 if there is nothing new to take. Earlier versions stay readable."""
        shot, deltas, buckets = self.parts(None)
        if not deltas:
            return 0
        self.write(self.as_of(), SNAPSHOT, deltas[-1][0], buckets)
        return deltas[-1][0]

    def history(self, key) -> DataFrame:
        """(version, set, gone, columns, updated_at) of every change of a key, from its bucket alone."""
        log = self.log()
        lots = [r.lot for r in log if r.kind == CHANGE]
        names = [f.name for f in self.schema]
        if not lots:
            return self.spark.createDataFrame([], f"version long, cambiados array<string>, borrado boolean, {self.columns}, updated_at timestamp")
        rows = self.spark.read.schema(f"{self.columns}, {OWN}, lote string, _bucket int").option("basePath", self.path).parquet(*[f"{self.path}/{x}" for x in lots])
        mine = F.lit(key).cast(self.schema[self.key].dataType)
        bucket = self.spark.range(1).select(self.bucket(mine, log[0].buckets)).first()[0]
        version = F.regexp_extract("lote", r"-(\d+)-", 1).cast("long").alias("version")
        return rows.where(F.col("_bucket") == bucket).where(F.col(self.key).eqNullSafe(mine)).select(version, F.col("_set").alias("cambiados"), F.col("_gone").alias("borrado"), *names, "updated_at")
