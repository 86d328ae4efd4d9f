"""A cloud folder as a data source: listing with pushed-down MIME types, download or export, names by output type."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition

#: MIME types taken (and what each is exported as, if it is), and the extension of each output type.
DOCX = "application/vnd.openxmlformats-officedocument.wordprocessingml.document"
THEORY_TYPES = {"application/pdf": None, DOCX: None, "application/epub+zip": None, "text/plain": None, "application/vnd.google-apps.document": DOCX}
HISTORIC_TYPES = {DOCX: None, "application/vnd.google-apps.document": DOCX}
EXTENSIONS = {"application/pdf": ".pdf", DOCX: ".docx", "application/epub+zip": ".epub", "text/plain": ".txt"}
SCHEMA = "file_id string, name string, modified_time string, mime_type string, mime_salida string, nombre_local string"


def checked(types: Mapping[str, str | None], extensions: Mapping[str, str] = EXTENSIONS) -> dict[str, str]:
    """Output type of each MIME type taken; one without a known extension is an error, before any plan is made."""
    out = {k: v or k for k, v in types.items()}
    unknown = sorted(v for v in out.values() if v not in extensions)
    if unknown:
        raise ValueError(f"no extension is known for {unknown}")
    return out


def folder_query(folder: str, types: Mapping[str, str | None]) -> str:
    """The listing query: files of a folder that aren't in the bin and have one of these types."""
    kinds = " or ".join(f"mimeType='{t}'" for t in types)
    return f"'{folder}' in parents and trashed=false and ({kinds})"


def with_local_names(listing: DataFrame, types: Mapping[str, str | None]) -> DataFrame:
    """`listing` (file_id, name, modified_time, mime_type) of the types taken plus mime_salida and nombre_local."""
    outputs = checked(types)
    kind = F.create_map(*[x for k, v in outputs.items() for x in (F.lit(k), F.lit(v))])
    ends = F.create_map(*[x for k, v in EXTENSIONS.items() for x in (F.lit(k), F.lit(v))])
    taken = listing.where(F.col("mime_type").isin(*outputs)).withColumn("mime_salida", F.try_element_at(kind, F.col("mime_type")))
    return taken.withColumn("nombre_local", local_name(F.col("name"), F.try_element_at(ends, F.col("mime_salida"))))


def local_name(name: Column, extension: Column) -> Column:
    """`name`, with the extension unless it ends so in any case."""
    return F.when(F.endswith(F.lower(name), extension), name).otherwise(F.concat(name, extension))


def new_files(listing: DataFrame, state: DataFrame) -> DataFrame:
    """Files whose (file_id, modified_time) isn't in the state."""
    return listing.join(state.select("file_id", "modified_time"), ["file_id", "modified_time"], "left_anti")


class Page(InputPartition):
    """One page of the listing: its files, so that no executor opens the listing again."""

    def __init__(self, files: list[dict]):
        self.files = files


class FolderReader(DataSourceReader):
    """Reads pages of a JSON listing; equality and IN filters on the type narrow it before rows are made."""

    def __init__(self, options: Mapping[str, str]):
        self.path, self.size = options["path"], int(options.get("pageSize", "100"))
        self.types = set(json.loads(options["types"])) if "types" in options else set(THEORY_TYPES)

    def pushFilters(self, filters):  # noqa: N802  name given by the API
        """Takes filters on mime_type; the others go back."""
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("mime_type",):
                self.types &= {f.value}
            elif isinstance(f, In) and f.attribute == ("mime_type",):
                self.types &= set(f.value)
            else:
                yield f

    def rows(self) -> list[dict]:
        """Files taken, by name."""
        with open(self.path, encoding="utf-8") as f:
            files = json.load(f)
        return sorted((x for x in files if x["mimeType"] in self.types and not x.get("trashed")), key=lambda x: (x["name"], x["id"]))

    def partitions(self):
        """One per page; the listing is read and sorted once, on the driver."""
        rows = self.rows()
        return [Page(rows[k : k + self.size]) for k in range(0, len(rows), self.size)]

    def read(self, partition) -> Iterator[tuple]:
        """Rows of a page."""
        outputs = checked({t: THEORY_TYPES.get(t) for t in self.types})
        for x in partition.files:
            out = outputs[x["mimeType"]]
            end = EXTENSIONS[out]
            yield (x["id"], x["name"], x["modifiedTime"], x["mimeType"], out, x["name"] if x["name"].lower().endswith(end) else x["name"] + end)


class FolderSource(DataSource):
    """spark.read.format("cloud_folder").option("path", <listing.json>): a listing exported by the service's client. The network stays outside."""

    @classmethod
    def name(cls) -> str:
        """Format name."""
        return "cloud_folder"

    def schema(self) -> str:
        """Columns."""
        return SCHEMA

    def reader(self, schema) -> FolderReader:
        """Batch reader."""
        return FolderReader(self.options)


def folder_option(settings: Mapping[str, str], given: str | None = None, key: str = "DRIVE_FOLDER_ID") -> str:
    """The folder by argument, else by settings; none is an error."""
    found = given or settings.get(key)
    if not found:
        raise RuntimeError(f"{key} is not set")
    return found
