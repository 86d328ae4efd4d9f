"""A versioned sink in two phases: tasks write files and report them, the driver's manifest makes them a version.

`df.write.format("corpus_versions").option("path", root).mode("append").save()` writes each partition to Parquet files of the run's own folder below `_datos`. A task's
message has the names of its files, their rows, fragments and bytes. The commit writes `v<N>.json`, which lists them, N being one more than the largest there is; a version is
what its manifest lists, so files of tries that failed, or of lost executors, are in none. An aborted write deletes its folder. One writer at a time per root is assumed.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from lorewright.sources.folder_stream import opened

COLUMNS = "doc_id long, nombre string, contenido string, num_fragmentos long"
#: Bytes after which a task begins another file.
FILE_BYTES = 256 << 20


@dataclass
class Written(WriterCommitMessage):
    """What a task wrote: files with their rows, fragments and bytes."""

    files: list[dict] = field(default_factory=list)


def numbers(disk: fs.FileSystem, root: str) -> list[int]:
    """Numbers of the versions that have a manifest."""
    names = [x.base_name for x in disk.get_file_info(fs.FileSelector(root, allow_not_found=True))]
    return sorted(int(m[1]) for m in map(re.compile(r"v(\d+)\.json").fullmatch, names) if m)


class VersionWriter(DataSourceArrowWriter):
    """Writes a version."""

    def __init__(self, options: Mapping[str, str]):
        self.root, self.size = options["path"], int(options.get("fileBytes", FILE_BYTES))
        self.run = f"_datos/{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """A task's files; what it began is deleted if it fails."""
        disk, root = opened(self.root)
        disk.create_dir(f"{root}/{self.run}", recursive=True)
        out, made, writer, entry = Written(), [], None, None

        def end() -> None:
            writer.close()
            entry["bytes"] = disk.get_file_info(f"{root}/{entry['archivo']}").size
            out.files.append(entry)

        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                if writer is None:
                    entry, held = {"archivo": f"{self.run}/{uuid.uuid4().hex}.parquet", "documentos": 0, "fragmentos": 0}, 0
                    made.append(f"{root}/{entry['archivo']}")
                    writer = pq.ParquetWriter(made[-1], batch.schema, filesystem=disk, compression="zstd")
                writer.write_batch(batch)
                held += batch.nbytes
                entry["documentos"] += batch.num_rows
                entry["fragmentos"] += sum(x or 0 for x in batch.column("num_fragmentos").to_pylist())
                if held >= self.size:
                    end()
                    writer = None
            if writer is not None:
                end()
        except BaseException:
            if writer is not None:
                writer.close()
            for path in made:
                disk.delete_file(path)
            raise
        return out

    def commit(self, messages: list[Written | None]) -> None:
        """Writes the manifest under a name of its own and moves it to its place."""
        disk, root = opened(self.root)
        files = sorted((f for m in messages if m for f in m.files), key=lambda f: f["archivo"])
        number = max(numbers(disk, root), default=0) + 1
        about = {"version": number, **{k: sum(f[k] for f in files) for k in ("documentos", "fragmentos", "bytes")}, "archivos": files}
        disk.create_dir(root, recursive=True)
        with disk.open_output_stream(f"{root}/_{self.run[7:]}.json") as f:
            f.write(json.dumps(about).encode())
        disk.move(f"{root}/_{self.run[7:]}.json", f"{root}/v{number}.json")

    def abort(self, messages: list[Written | None]) -> None:
        """Deletes all that the run wrote."""
        disk, root = opened(self.root)
        if disk.get_file_info(f"{root}/{self.run}").type == fs.FileType.Directory:
            disk.delete_dir(f"{root}/{self.run}")


class VersionSink(DataSource):
    """The sink's format."""

    @classmethod
    def name(cls) -> str:
        """Format name."""
        return "corpus_versions"

    def schema(self) -> str:
        """Columns."""
        return COLUMNS

    def writer(self, schema, overwrite: bool) -> VersionWriter:
        """Batch writer; a version is never overwritten."""
        if overwrite:
            raise ValueError("versions are appended, not overwritten")
        return VersionWriter(self.options)


def manifest(root: str, version: int | None = None) -> dict | None:
    """The manifest of a version, the last one by default; None if there is none."""
    disk, path = opened(root)
    found = numbers(disk, path)
    if not found or (version is not None and version not in found):
        return None
    with disk.open_input_stream(f"{path}/v{version or found[-1]}.json") as f:
        return json.loads(f.read())


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The documents of a version, the last one by default, by Spark's own reader; a version that there isn't is an error."""
    about = manifest(root, version)
    if about is None:
        raise ValueError(f"no version {version or ''} under {root}")
    files = [f"{root.rstrip('/')}/{f['archivo']}" for f in about["archivos"]]
    return spark.read.schema(COLUMNS).parquet(*files) if files else spark.createDataFrame([], COLUMNS)


def superseded(root: str) -> list[str]:
    """Deletes the folders below `_datos` that no manifest names, as lost drivers leave them, and returns their names. Not to be called beside a writer."""
    disk, path = opened(root)
    named = {f["archivo"].split("/")[1] for n in numbers(disk, path) for f in manifest(root, n)["archivos"]}
    gone = [x for x in disk.get_file_info(fs.FileSelector(f"{path}/_datos", allow_not_found=True)) if x.base_name not in named]
    for x in gone:
        disk.delete_dir(x.path)
    return sorted(x.base_name for x in gone)
