"""From documents to fragments and back: split, classify, clean, describe, group, render."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lorewright.functions import documents, text


def split_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """One row per sentence: id, the columns of `keep`, pos (from 0), texto, subtipo."""
    found = docs.select(id_col, *keep, F.posexplode(text.sentences(F.col(text_col))).alias("pos", "texto"))
    return found.withColumn("subtipo", text.subtype(F.col("texto")))


def clean_fragments(fragments: DataFrame) -> DataFrame:
    """`fragments` with texto cleaned by subtype."""
    return fragments.withColumn("texto", text.cleaned(F.col("texto"), F.col("subtipo")))


def localised(fragments: DataFrame, language: Column, translate=None, target: str = "es") -> DataFrame:
    """`fragments` plus idioma_original, idioma_fragmento, traducido; `translate` is a column function (text, language) for those that need it."""
    frame = fragments.withColumn("idioma_original", F.coalesce(language, F.lit("und")))
    frame = frame.withColumn("traducido", text.needs_translation(F.col("subtipo"), F.col("idioma_original"), target))
    if translate is not None:
        frame = frame.withColumn("texto", F.when(F.col("traducido"), translate(F.col("texto"), F.col("idioma_original"))).otherwise(F.col("texto")))
    return frame.withColumn("idioma_fragmento", F.when(F.col("traducido"), target).otherwise(F.col("idioma_original")))


def paragraphs(fragments: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Paragraphs in order (id, paragraph, texto): runs of explanations joined by a blank, each example alone."""
    order = Window.partitionBy(id_col).orderBy("pos")
    alone = F.col("subtipo") == text.EXAMPLE
    frame = fragments.withColumn("_starts", (alone | F.coalesce(F.lag(alone).over(order), F.lit(True))).cast("long"))
    frame = frame.withColumn("paragraph", F.sum("_starts").over(order) - 1)
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "texto"))), lambda x: x["texto"]), " ")
    return frame.groupBy(id_col, "paragraph").agg(joined.alias("texto"))


def document_quality(fragments: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document: num_fragmentos, quality (mean of the fragments'), hay_ejemplo."""
    score = text.quality(F.col("texto"))
    return fragments.groupBy(id_col).agg(F.count(F.lit(1)).alias("num_fragmentos"), F.avg(score).alias("quality"), F.bool_or(F.col("subtipo") == text.EXAMPLE).alias("hay_ejemplo"))


def silver_summary(fragments: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document: quality, whether any fragment was translated, the first fragment's language, the number of fragments."""
    score = text.quality(F.col("texto"))
    return fragments.groupBy(id_col).agg(F.avg(score).alias("quality_score"), F.bool_or("traducido").alias("traducido"), F.min_by("idioma_original", "pos").alias("idioma_original"), F.count(F.lit(1)).alias("num_fragmentos"))


def render_documents(fragments: DataFrame, facts: DataFrame | None = None, id_col: str = "doc_id") -> DataFrame:
    """(id, contenido) of every document: `fragments` in order under a header from `facts` (fuente, tipo_fuente, autor, licencia).

    Without `facts` the fragments carry these columns themselves, so that no join is needed.
    """
    item = F.struct("pos", "texto", "subtipo", "idioma_original", "idioma_fragmento")
    carried = [] if facts is not None else [F.first(c).alias(c) for c in ("fuente", "tipo_fuente", "autor", "licencia")]
    grouped = fragments.groupBy(id_col).agg(F.sort_array(F.collect_list(item)).alias("fragmentos"), *carried)
    whole = documents.rendered(F.col("fragmentos"), F.col("fuente"), F.col("tipo_fuente"), F.col("autor"), F.coalesce("licencia", F.lit(documents.LICENCE)))
    rows = grouped if facts is None else grouped.join(facts, id_col)
    return rows.select(id_col, whole.alias("contenido"))


def parse_documents(rendered: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, contenido, cuerpo, metadatos, fragmentos_meta) of rendered documents."""
    frame = rendered.withColumn("_parts", documents.parts(F.col("contenido")))
    return frame.select(id_col, "contenido", F.col("_parts.body").alias("cuerpo"), documents.header_fields(F.col("_parts.head")).alias("metadatos"), documents.header_fragments(F.col("_parts.head")).alias("fragmentos_meta"))


def chunk_documents(rendered: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, chunk_index, chunk) of rendered documents."""
    return rendered.select(id_col, F.posexplode(documents.chunks(F.col("contenido"))).alias("chunk_index", "chunk"))


def version_statistics(fragments: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document and, with a null id, for the version: fragments, documents, mean, least and greatest quality; 0 without fragments."""
    scored = fragments.withColumn("_q", text.quality(F.col("texto")))
    out = scored.groupingSets([[id_col], []], id_col).agg(
        F.grouping(id_col).cast("boolean").alias("total"), F.count(F.lit(1)).alias("num_fragmentos"), F.countDistinct(F.col(id_col)).alias("num_documentos"),
        F.coalesce(F.avg("_q"), F.lit(0.0)).alias("media"), F.coalesce(F.min("_q"), F.lit(0.0)).alias("minimo"), F.coalesce(F.max("_q"), F.lit(0.0)).alias("maximo"),
    )
    return out


def file_names(docs: DataFrame, source: Column, id_col: str = "doc_id") -> DataFrame:
    """`docs` plus nombre, no name twice: the slug of the source, with -2, -3 ... for repeats in order of id.

    Where slugs themselves end in such a number, the repeats of what stands before it are numbered after the largest of them.
    """
    base = docs.withColumn("_slug", text.slug(source))
    numbered = base.select(F.regexp_extract("_slug", r"^(.+)-\d{1,9}$", 1).alias("_slug"), F.regexp_extract("_slug", r"-(\d{1,9})$", 1).try_cast("long").alias("_k"))
    taken = numbered.where("_slug <> ''").groupBy("_slug").agg((F.max("_k") - 1).alias("_moved"))
    n = F.row_number().over(Window.partitionBy("_slug").orderBy(id_col))
    frame = base.withColumn("_n", n).join(taken, "_slug", "left")
    name = F.concat_ws("-", "_slug", (F.col("_n") + F.greatest(F.coalesce("_moved", F.lit(0)), F.lit(0))).cast("string"))
    return frame.withColumn("nombre", F.when(F.col("_n") == 1, F.col("_slug")).otherwise(name)).select(*docs.columns, "nombre")
