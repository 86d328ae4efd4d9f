"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


class Scratch:
    """A run's own folder below spark.checkpoint.dir, deleted with close() or at the end of a with block.

    Where that setting is unset, a folder of its own is made on a single machine; on a cluster it is an error.
    """

    def __init__(self, spark: SparkSession, name: str):
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
                raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            root = f"file://{tempfile.mkdtemp(prefix='lorewright-')}"
        self.spark, self.root = spark, f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """`df` written once and read back: lineage is cut, a lost executor costs no recomputation, and nothing is worked out twice."""
        path = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, path: str) -> None:
        """Deletes a folder."""
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

    def close(self) -> None:
        """Deletes all that was written."""
        self.drop(self.root)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.close()
