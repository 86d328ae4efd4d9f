"""Coloured runs to marked text, its guard, and windows of marked text."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lorewright.functions import markup, text

RUNS = "doc_id long, para int, run int, color string, texto string"


def bridged(df: DataFrame, id_cols: list[str], order: str) -> DataFrame:
    """Segments (id_cols, seg, tag, texto) of runs in `order`: neighbours of one tag merge, and blank untagged runs between two of one tag join them.

    The tag that a blank untagged run stands between is that of the last and the next other run.
    """
    w = Window.partitionBy(*id_cols).orderBy(order)
    solid = F.when(F.col("tag").isNotNull() | (text.strip(F.col("texto")) != ""), F.struct("tag"))
    before = F.last(solid, True).over(w.rowsBetween(Window.unboundedPreceding, 0))["tag"]
    after = F.first(solid, True).over(w.rowsBetween(0, Window.unboundedFollowing))["tag"]
    frame = df.withColumn("_tag", F.when(F.col("tag").isNotNull(), F.col("tag")).when(text.strip(F.col("texto")) == "", F.when(before == after, before)))
    change = F.coalesce((~F.lag(F.struct("_tag")).over(w).eqNullSafe(F.struct("_tag"))).cast("long"), F.lit(1))
    frame = frame.withColumn("_change", change).withColumn("seg", F.sum("_change").over(w))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, "texto"))), lambda x: x["texto"]), "")
    return frame.groupBy(*id_cols, "seg").agg(F.first("_tag").alias("tag"), joined.alias("texto"))


def marked_text(runs: DataFrame) -> DataFrame:
    """(doc_id, markdown) of coloured runs (doc_id, para, run, color, texto; a paragraph without runs has a null run).

    Runs merge within a paragraph; paragraphs are parted by a blank line, which a span of one tag that ends one and begins the next
    keeps inside; an empty paragraph closes it. Three or more line ends become two; the ends are bare, with one final line end.
    """
    tagged = runs.withColumn("tag", markup.colour_tag(F.col("color"))).withColumn("texto", F.coalesce("texto", F.lit("")))
    merged = bridged(tagged, ["doc_id", "para"], "run")
    solid = F.max((text.strip(F.col("texto")) != "").cast("int")).over(Window.partitionBy("doc_id", "para")) == 1
    merged = merged.withColumn("_solid", solid)
    pieces = merged.where("_solid").select("doc_id", "para", "seg", "tag", "texto")
    paras = merged.select("doc_id", "para", "_solid").distinct()
    first = F.min("para").over(Window.partitionBy("doc_id"))
    previous_solid = F.lag("_solid").over(Window.partitionBy("doc_id").orderBy("para"))
    #: the separator before an empty paragraph, or after one, closes a span: it isn't a bridge
    gaps = paras.withColumn("_first", first).withColumn("_bridge", F.col("_solid") & previous_solid).where("para > _first")
    gaps = gaps.select("doc_id", "para", F.lit(0).cast("long").alias("seg"), F.lit(None).cast("string").alias("tag"), F.when(F.col("_bridge"), "\n\n").otherwise("\n\n\u0000").alias("texto"))
    flat = pieces.unionByName(gaps).withColumn("place", F.struct("para", "seg"))
    whole = bridged(flat, ["doc_id"], "place")
    spans = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seg", "tag", "texto"))), lambda x: markup.span(x["tag"], x["texto"])), "")
    joined = whole.groupBy("doc_id").agg(spans.alias("markdown"))
    bare = F.regexp_replace(F.translate(F.col("markdown"), "\u0000", ""), r"\n{3,}", "\n\n")
    return joined.select("doc_id", F.concat(text.strip(bare), F.lit("\n")).alias("markdown"))


def round_trip(runs: DataFrame, marked: DataFrame) -> DataFrame:
    """(doc_id, tag, expected, found, ok): word characters of each colour in the runs, and inside the tags of the marked text."""
    tags = [markup.PUNCH, markup.ASIDE]
    expected = runs.withColumn("tag", markup.colour_tag(F.col("color"))).where("tag is not null").groupBy("doc_id", "tag").agg(F.sum(text.letters_and_digits(F.col("texto"))).alias("expected"))
    found = marked.select("doc_id", F.explode(F.array(*[F.struct(F.lit(t).alias("tag"), markup.tagged_letters(F.col("markdown"), t).cast("long").alias("found")) for t in tags])).alias("x")).select("doc_id", "x.tag", "x.found")
    both = found.join(expected, ["doc_id", "tag"], "full")
    both = both.select("doc_id", "tag", F.coalesce("expected", F.lit(0)).alias("expected"), F.coalesce("found", F.lit(0)).alias("found"))
    return both.withColumn("ok", F.col("expected") == F.col("found"))


def segment(docs: DataFrame, id_col: str = "doc_id", text_col: str = "markdown") -> DataFrame:
    """(id, pos, ventana, remate, chistoides) of every window of marked text."""
    found = docs.select(id_col, F.posexplode(markup.windows(F.col(text_col))).alias("pos", "ventana"))
    return found.withColumns({"remate": markup.punch_line(F.col("ventana")), "chistoides": markup.asides(F.col("ventana"))})


def cut_setups(windows: DataFrame, quoted: str = "inicio") -> DataFrame:
    """`windows` plus texto, texto_marcado, contiene_chistoide, inicio_localizado: each window from where the quoted setup begins, whole if it isn't found."""
    place = markup.setup_place(F.col("ventana"), F.col(quoted))
    marked = F.when(place.isNull(), F.col("ventana")).otherwise(F.substr("ventana", place + 1))
    return windows.withColumn("texto_marcado", marked).withColumns({"texto": text.without_marks(F.col("texto_marcado")), "contiene_chistoide": F.size("chistoides") > 0, "inicio_localizado": place.isNotNull()})
