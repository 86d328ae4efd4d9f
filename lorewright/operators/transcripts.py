"""Transcripts: line grammar, speaker runs, dominant speaker."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lorewright.functions.text import strip

#: Fixed value: the grammar of a line.
LINE = r"(?U)^\[([\d.]+)s\]\s+(SPEAKER_\d+):\s*(.*)$"


def parse_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per line that isn't blank: id, pos, seconds, speaker, texto, ok (false where the line doesn't follow the grammar)."""
    lines = docs.select(id_col, F.posexplode(F.split(text_col, r"\r?\n", -1)).alias("pos", "line")).withColumn("line", strip(F.col("line"))).where("line <> ''")
    ok = F.col("line").rlike(LINE)
    part = lambda k: F.when(ok, F.regexp_extract("line", LINE, k))
    return lines.select(id_col, "pos", part(1).try_cast("double").alias("seconds"), part(2).alias("speaker"), strip(part(3)).alias("texto"), ok.alias("ok"))


def speaker_runs(lines: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, run, speaker, texto): consecutive lines of one speaker joined by a blank."""
    order = Window.partitionBy(id_col).orderBy("pos")
    change = (~F.lag("speaker").over(order).eqNullSafe(F.col("speaker"))).cast("long")
    frame = lines.withColumn("_change", F.coalesce(change, F.lit(1))).withColumn("run", F.sum("_change").over(order) - F.first("_change").over(order))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "texto"))), lambda x: x["texto"]), " ")
    return frame.groupBy(id_col, "run").agg(F.min("speaker").alias("speaker"), joined.alias("texto"))


def dominant_speaker(lines: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, speaker): the one with the most characters; of equals the first to speak."""
    sums = lines.groupBy(id_col, "speaker").agg(F.sum(F.length("texto")).alias("_n"), F.min("pos").alias("_first"))
    return sums.groupBy(id_col).agg(F.max_by("speaker", F.struct(F.col("_n"), -F.col("_first"))).alias("speaker"))


def parse_transcripts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(parsed: id, texto, speaker_dominante; rejected: id, lines that break the grammar). A document with a bad line, or without lines, is rejected."""
    lines = parse_lines(docs, id_col, text_col)
    bad = lines.where(~F.col("ok")).groupBy(id_col).agg(F.count(F.lit(1)).alias("bad_lines"))
    empty = docs.select(id_col).join(lines.select(id_col).distinct(), id_col, "left_anti").select(id_col, F.lit(0).cast("long").alias("bad_lines"))
    rejected = bad.unionByName(empty)
    good = lines.join(bad.select(id_col), id_col, "left_anti")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("run", "texto"))), lambda x: x["texto"]), "\n\n")
    texts = speaker_runs(good, id_col).groupBy(id_col).agg(joined.alias("texto"))
    return texts.join(dominant_speaker(good, id_col).withColumnRenamed("speaker", "speaker_dominante"), id_col), rejected
