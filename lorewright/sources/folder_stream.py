"""A folder's listing as a stream: pages are partitions, the offset is the greatest (modified time, id) with the last page, and late files are seen once.

A listing is kept as snapshots (`toma=000001`, ...), each a folder of Parquet pages in order of (modified time, id), written by write_pages(). A page never
changes, and a snapshot counts once its _SUCCESS file is there. A file's state is its (id, modified time): a changed file is a new state, and
a state belongs to the first page that has it, whether it came in order or late.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "file_id string, name string, modified_time string, mime_type string, toma int"
FIELDS = ["file_id", "name", "modified_time", "mime_type"]
PLACE = "lugar"


def write_pages(listing: DataFrame, root: str, number: int, size: int = 1000) -> None:
    """Writes a listing (file_id, name, modified_time, mime_type) as snapshot `number`, in pages of `size` rows at most. Null ids and times count as empty; repeated rows stay and are told apart by the reader."""
    rows = listing.select(*[F.coalesce(c, F.lit("")).alias(c) if c in ("file_id", "modified_time") else F.col(c) for c in FIELDS])
    rows = rows.withColumn(PLACE, F.concat("modified_time", F.lit("\u0000"), "file_id"))
    rows.repartitionByRange(PLACE).sortWithinPartitions(PLACE).write.option("maxRecordsPerFile", size).parquet(f"{root.rstrip('/')}/toma={number:06d}")


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it. It must be one that Python can reach."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    found, inner = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    return found, inner.rstrip("/")


@dataclass
class Page(InputPartition):
    """A page, and the earlier ones in whose range some of its files may lie, latest first."""

    path: str
    earlier: list[str]


class FolderStream(DataSourceStreamReader):
    """Plans from footers alone; a page's task looks its files up in the earlier pages that overlap it, until none is left to ask for."""

    def __init__(self, options: Mapping[str, str]):
        self.root = options["path"]
        #: First and last place of each page by its name, in order of snapshot and page.
        self.ranges: dict[str, tuple[str, str]] = {}

    def known(self) -> dict[str, tuple[str, str]]:
        """Ranges of all pages of finished snapshots; footers that were read before aren't read again."""
        disk, root = opened(self.root)
        taken = [x for x in disk.get_file_info(fs.FileSelector(root, allow_not_found=True)) if x.base_name.startswith("toma=")]
        for folder in sorted(taken, key=lambda x: x.base_name):
            inside = {x.base_name: x.path for x in disk.get_file_info(fs.FileSelector(folder.path))}
            if "_SUCCESS" not in inside:
                continue
            for name in sorted(x for x in inside if x.endswith(".parquet")):
                key = f"{folder.base_name}/{name}"
                if key not in self.ranges:
                    found = page_range(disk, inside[name])
                    if found:
                        self.ranges[key] = found
        return self.ranges

    def initialOffset(self) -> dict:  # noqa: N802  names given by the API
        """Before every file."""
        return {"modified_time": "", "id": "", "page": ""}

    def latestOffset(self) -> dict:  # noqa: N802
        """The greatest place seen so far and the last page."""
        pages = self.known()
        if not pages:
            return self.initialOffset()
        time, _, file_id = max(high for _, high in pages.values()).partition("\u0000")
        return {"modified_time": time, "id": file_id, "page": max(pages)}

    def partitions(self, start: dict, end: dict) -> list[Page]:
        """The pages after `start` up to `end`."""
        pages = {k: v for k, v in self.known().items() if k <= end["page"]}
        mark = f"{start['modified_time']}\u0000{start['id']}"
        old = sorted((k for k in pages), reverse=True)
        out = []
        for key in sorted(k for k in pages if k > start["page"]):
            low, high = pages[key]
            # what lies after the mark is in no page that was read before it
            near = [k for k in old if k < key and pages[k][0] <= high and pages[k][1] >= low and (k > start["page"] or low <= mark)]
            out.append(Page(key, near))
        return out

    def read(self, partition: Page) -> Iterator[pa.RecordBatch]:
        """Files of a page that no earlier one has, one row for each state."""
        disk, root = opened(self.root)
        rows = pq.read_table(disk.open_input_file(f"{root}/{partition.path}"), columns=[*FIELDS, PLACE])
        first: dict[str, int] = {}
        for k, place in enumerate(rows[PLACE].to_pylist()):
            first.setdefault(place, k)
        for path in partition.earlier:
            if not first:
                return
            places = pq.read_table(disk.open_input_file(f"{root}/{path}"), columns=[PLACE], filters=[(PLACE, ">=", min(first)), (PLACE, "<=", max(first))])[PLACE]
            for place in pc.unique(places).to_pylist():
                first.pop(place, None)
        kept = rows.select(FIELDS).take(pa.array(sorted(first.values()), pa.int64()))
        taken = pa.array([int(partition.path[5:11])] * len(kept), pa.int32())
        yield from kept.append_column("toma", taken).combine_chunks().to_batches()


def page_range(disk: fs.FileSystem, path: str) -> tuple[str, str] | None:
    """First and last place of a page, from its footer where that has them; None for an empty page."""
    with disk.open_input_file(path) as f:
        file = pq.ParquetFile(f)
        about, at = file.metadata, file.schema_arrow.get_field_index(PLACE)
        if not about.num_rows:
            return None
        stats = [about.row_group(k).column(at).statistics for k in range(about.num_row_groups)]
        if all(s is not None and s.has_min_max for s in stats):
            return min(s.min for s in stats), max(s.max for s in stats)
        both = pc.min_max(file.read([PLACE])[PLACE]).as_py()
        return both["min"], both["max"]


class FolderStreamSource(DataSource):
    """spark.readStream.format("folder_pages").option("path", <root of the snapshots>)."""

    @classmethod
    def name(cls) -> str:
        """Format name."""
        return "folder_pages"

    def schema(self) -> str:
        """Columns."""
        return SCHEMA

    def streamReader(self, schema) -> FolderStream:  # noqa: N802
        """Stream reader."""
        return FolderStream(self.options)
