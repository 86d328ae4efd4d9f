"""Stored tables: idempotent appends, object capture, versions, pending and processed rows."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lorewright.functions import keys
from lorewright.sources.keyed import Keyed

BRONZE = "id string, bucket string, object_path string, drive_file_id string, modified_time string, hash_md5 string, origen string, created_at timestamp"


class Store:
    """Layered Parquet tables under one root: `<root>/<schema>/<table>`. In flat mode the schema is left out of the path.

    Tables are append-only. One writer at a time per table is assumed, as for any Parquet folder; a v2 table format lifts that.
    """

    def __init__(self, spark: SparkSession, root: str, flat: bool = False):
        self.spark, self.root, self.flat = spark, root.rstrip("/"), flat

    def path(self, schema: str, table: str) -> str:
        """A table's folder."""
        return f"{self.root}/{table}" if self.flat else f"{self.root}/{schema}/{table}"

    def exists(self, path: str) -> bool:
        """True if a path is there, on whatever file system."""
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def read(self, schema: str, table: str, columns: str) -> DataFrame:
        """A table; empty with these columns if it was never written."""
        return Keyed(self.spark, self.path(schema, table)).read(columns)

    def append_new(self, rows: DataFrame, schema: str, table: str, key: Column, order: list[Column]) -> dict[str, int]:
        """Appends the rows whose key isn't stored, the first of each key in `order`; counts of new and existing ones. A rerun writes nothing.

        The rows are worked out once, and of the stored files only those are opened that may hold one of their keys (see sources.keyed).
        """
        return Keyed(self.spark, self.path(schema, table)).append(rows, key, order)

    def capture(self, files: DataFrame, layer: str, flow: str) -> dict[str, int]:
        """Stores files (name, content, drive_file_id, modified_time): the objects first, then the rows that name them.

        Drive id and time come together or not at all. Objects are keyed by path and never written twice; the row's key is id
        and time with a drive id, else the hash.
        """
        bucket, schema, table = keys.destination(layer, flow)
        both = F.col("drive_file_id").isNull() == F.col("modified_time").isNull()
        ok = F.when(both, F.col("drive_file_id")).otherwise(F.raise_error(F.lit("drive id and modified time come together")).cast("string"))
        rows = files.withColumn("drive_file_id", ok).withColumn("hash_md5", F.md5("content"))
        rows = rows.withColumn("object_path", keys.object_path(F.col("drive_file_id"), F.col("modified_time"), F.col("hash_md5"), F.col("name")))
        objects = rows.select(F.lit(bucket).alias("bucket"), "object_path", "content")
        self.append_new(objects, "objects", bucket, F.struct("bucket", "object_path"), [F.md5("content")])
        meta = rows.select(
            F.sha2(F.concat_ws("/", F.lit(table), "object_path"), 256).alias("id"), F.lit(bucket).alias("bucket"), "object_path", "drive_file_id", "modified_time", "hash_md5",
            keys.origin(F.col("drive_file_id")).alias("origen"), F.current_timestamp().alias("created_at"),
        )
        return self.append_new(meta, schema, table, keys.idempotency_key(F.col("drive_file_id"), F.col("modified_time"), F.col("hash_md5")), [F.col("object_path")])

    def next_version(self) -> int:
        """One more than the largest finished version; unfinished ones may be used again."""
        pattern = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/v*/manifest.json")
        found = pattern.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern) or []
        numbers = [str(f.getPath().getParent().getName())[1:] for f in found]
        return max([int(n) for n in numbers if n.isdigit()], default=0) + 1

    def write_version(self, documents: DataFrame, statistics: DataFrame, version: int | None = None) -> str:
        """Writes rendered documents (nombre, contenido, fuente, num_fragmentos), their statistics, and the manifest last, which makes the version final. A final one is never overwritten."""
        version = self.next_version() if version is None else version
        base = f"{self.root}/v{version}"
        if self.exists(f"{base}/manifest.json"):
            raise ValueError(f"version {version} is final")
        documents.write.mode("overwrite").parquet(f"{base}/documents")
        statistics.write.mode("overwrite").parquet(f"{base}/stats")
        counts = self.spark.read.parquet(f"{base}/documents").agg(F.count(F.lit(1)).alias("documents"), F.sum("num_fragmentos").alias("fragments")).first()
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/manifest.json")
        out = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).create(path, True)
        out.write(bytearray(json.dumps({"version": version, "documents": counts[0], "fragments": counts[1]}).encode()))
        out.close()
        return base

    def mark_processed(self, ids: DataFrame, schema: str, table: str) -> dict[str, int]:
        """Appends (id, procesado_at) to the side table of a Bronze table, which itself is never changed."""
        rows = ids.select("id", F.current_timestamp().alias("procesado_at"))
        return self.append_new(rows, schema, f"{table}_procesados", F.col("id"), [F.col("id")])

    def unprocessed(self, rows: DataFrame, schema: str, table: str, id_type: str = "long") -> DataFrame:
        """Rows of a Bronze table without a processed mark."""
        done = self.read(schema, f"{table}_procesados", f"id {id_type}, procesado_at timestamp")
        return rows.join(done, "id", "left_anti")


def updated(table: DataFrame, changes: DataFrame, key: str, allowed: tuple[str, ...]) -> DataFrame:
    """`table` with the changed columns of `changes` (key and some of `allowed`) and nothing else touched; other columns are an error."""
    names = [c for c in changes.columns if c != key]
    if set(names) - set(allowed):
        raise ValueError(f"columns that may not be updated: {sorted(set(names) - set(allowed))}")
    new = changes.select(key, *[F.col(c).alias(f"_n_{c}") for c in names], F.lit(True).alias("_hit"))
    joined = table.join(new, key, "left")
    return joined.select(*[F.when(F.col("_hit"), F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c) if c in names else F.col(c) for c in table.columns])


def run_summary(parsed: DataFrame, ignored: DataFrame) -> DataFrame:
    """One row: procesados, fallidos, ignorados, and version_dir, always null."""
    counts = parsed.agg(F.count_if(F.col("error").isNull()).alias("procesados"), F.count_if(F.col("error").isNotNull()).alias("fallidos"))
    return counts.crossJoin(ignored.agg(F.count(F.lit(1)).alias("ignorados"))).withColumn("version_dir", F.lit(None).cast("string"))
