"""File sources: incremental scans, parsing by extension, stored objects."""

from __future__ import annotations

import io
import json
import posixpath
import re
import zipfile
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Extensions with a parser and the kind of source they give; characters a page under which a PDF's text is taken by OCR.
KINDS = {".txt": "transcripcion_curso", ".pdf": "teoria", ".docx": "teoria", ".epub": "teoria"}
OCR_BELOW = 30
WORD_NS = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def scan(spark: SparkSession, root: str, recursive: bool = False) -> DataFrame:
    """Every file under `root`: path, name, ext (lower case), md5, length, content. A missing folder gives no rows."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    schema = "path string, name string, ext string, md5 string, length long, content binary"
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], schema)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(root)
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    return files.select("path", F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))).alias("name"), F.lower(F.regexp_extract("path", r"(\.[^./]*)$", 1)).alias("ext"), F.md5("content").alias("md5"), "length", "content")


def changed(files: DataFrame, state: DataFrame, key: str = "path") -> DataFrame:
    """Files whose md5 isn't the recorded one (state: key, md5). key="name" is the compatible mode, in which names of two folders collide."""
    return files.join(state.select(key, "md5"), [key, "md5"], "left_anti")


def marked_documents(spark: SparkSession, root: str, state: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(name, content of the marked Markdown files directly in `root` that are new or changed since `state`, the state to keep once they are dealt with)."""
    found = scan(spark, root).where("ext = '.md'")
    fresh = found if state is None else changed(found, state)
    return fresh.select("name", F.decode("content", "UTF-8").alias("content")).orderBy("name"), found.select("path", "md5")


def eligible(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(files with a parser plus tipo_fuente, the others)."""
    kind = F.lit(None).cast("string")
    for ext, value in KINDS.items():
        kind = F.when(F.col("ext") == ext, value).otherwise(kind)
    marked = files.withColumn("tipo_fuente", kind)
    return marked.where("tipo_fuente is not null"), marked.where("tipo_fuente is null").withColumn("tipo_fuente", F.lit("teoria"))


def needs_ocr(text, pages, below: int = OCR_BELOW):
    """True where a document has pages and less than `below` characters on each, by strip."""
    bare = F.length(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)^\s+|\s+$", ""))
    return F.when(pages <= 0, F.lit(False)).otherwise(bare / pages < below)


def merged_pages(pages):
    """Pages of text as one: stripped, empty ones left out, parted by a blank line."""
    return F.array_join(F.filter(F.transform(pages, lambda p: F.regexp_replace(p, r"(?U)^\s+|\s+$", "")), lambda p: p != ""), "\n\n")


class _Text(HTMLParser):
    """Text of an XHTML page: blocks on lines of their own, scripts and styles left out."""

    BLOCKS = {"p", "div", "br", "li", "tr", "h1", "h2", "h3", "h4", "h5", "h6", "section", "title", "blockquote"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.off = 0

    def handle_starttag(self, tag, attrs):
        self.off += tag in ("script", "style", "head")
        if tag in self.BLOCKS:
            self.out.append("\n")

    def handle_endtag(self, tag):
        self.off -= tag in ("script", "style", "head") and self.off > 0
        if tag in self.BLOCKS:
            self.out.append("\n")

    def handle_data(self, data):
        if not self.off:
            self.out.append(re.sub(r"\s+", " ", data))


def html_text(html: str) -> str:
    """Text of a page, blank lines collapsed."""
    parser = _Text()
    parser.feed(html)
    lines = [x.strip() for x in "".join(parser.out).split("\n")]
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip()


def docx_paragraphs(content: bytes) -> list[list[tuple[str | None, str]]]:
    """Paragraphs of a DOCX, tables and links included, as runs (colour or None, text)."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        root = ElementTree.fromstring(z.read("word/document.xml"))
    plain = {f"{WORD_NS}tab": "\t", f"{WORD_NS}br": "\n"}
    out = []
    for paragraph in root.iter(f"{WORD_NS}p"):
        runs = []
        for run in paragraph.iter(f"{WORD_NS}r"):
            colour = run.find(f"{WORD_NS}rPr/{WORD_NS}color")
            text = "".join((x.text or "") if x.tag == f"{WORD_NS}t" else plain.get(x.tag, "") for x in run)
            if text:
                runs.append((None if colour is None else colour.get(f"{WORD_NS}val"), text))
        out.append(runs)
    return out


def docx_runs(content: bytes) -> str:
    """Paragraphs of a DOCX as JSON: for each its runs, of each its colour and text."""
    return json.dumps(docx_paragraphs(content))


def docx_text(content: bytes) -> str:
    """Text of a DOCX, paragraphs parted by blank lines."""
    return "\n\n".join(x for x in ("".join(t for _, t in runs).strip() for runs in docx_paragraphs(content)) if x)


def epub_text(content: bytes) -> str:
    """Text of an EPUB, its pages in the order of the spine and parted by blank lines."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        local = lambda e: e.tag.rpartition("}")[2]
        container = ElementTree.fromstring(z.read("META-INF/container.xml"))
        package = next(e.get("full-path") for e in container.iter() if local(e) == "rootfile")
        tree = ElementTree.fromstring(z.read(package))
        items = {e.get("id"): e.get("href") for e in tree.iter() if local(e) == "item"}
        order = [items[e.get("idref")] for e in tree.iter() if local(e) == "itemref" and e.get("idref") in items]
        base = posixpath.dirname(package)
        pages = [html_text(z.read(posixpath.normpath(posixpath.join(base, href))).decode("utf-8", "replace")) for href in order]
    return "\n\n".join(p for p in pages if p)


def pdf_text(content: bytes) -> tuple[str, int]:
    """Text and pages of a PDF, by whichever reader is installed; none is a dependency."""
    try:
        from pypdf import PdfReader
    except ImportError as e:
        raise RuntimeError("no PDF reader is installed") from e
    pages = [p.extract_text() or "" for p in PdfReader(io.BytesIO(content)).pages]
    return "\n\n".join(pages), len(pages)


def default_parsers() -> dict[str, Callable[[bytes], str]]:
    """Parser of each extension: bytes to text."""
    return {".txt": lambda b: b.decode("utf-8"), ".docx": docx_text, ".epub": epub_text, ".pdf": lambda b: pdf_text(b)[0]}


def parse(files: DataFrame, parsers: dict[str, Callable[[bytes], str]] | None = None) -> DataFrame:
    """(path, name, ext, md5, tipo_fuente, text, error) of eligible files: one that fails has an error and no text, and the rest go on."""
    table = parsers or default_parsers()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, errors = [], []
            for ext, content in zip(batch["ext"], batch["content"], strict=True):
                try:
                    texts.append(table[ext](bytes(content)))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001  a broken file is a row of the result
                    texts.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield batch.drop(columns="content").assign(text=texts, error=errors)

    cols = files.select("path", "name", "ext", "md5", "tipo_fuente", "content")
    return cols.mapInPandas(run, "path string, name string, ext string, md5 string, tipo_fuente string, text string, error string")


def coloured_runs(files: DataFrame) -> DataFrame:
    """(doc_id: path, para, run, color, texto) of DOCX files; a paragraph without runs has one null run."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"], strict=True):
                for k, runs in enumerate(docx_paragraphs(bytes(content))):
                    rows += [(path, k, j, c, t) for j, (c, t) in enumerate(runs)] or [(path, k, 0, None, None)]
            yield pd.DataFrame(rows, columns=["doc_id", "para", "run", "color", "texto"])

    return files.select("path", "content").mapInPandas(run, "doc_id string, para int, run int, color string, texto string")
