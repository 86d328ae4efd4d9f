"""Version statistics that merge: each batch of documents leaves one row of exact sums and sketches, and a version's numbers come from those rows alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorewright.functions import text
from lorewright.sources.keyed import Keyed

#: Registers of a distinct count (2^LG) and size of a quantile sketch: standard errors of about 1.04 / 2^(LG / 2) of the count and 1.7 / K of the rank.
LG, K = 12, 400
#: Errors that the two stay within with a probability of over 0.999.
DISTINCT_BOUND, RANK_BOUND = 0.06, 0.02
COLUMNS = "lote string, num_fragmentos long, suma double, minimo double, maximo double, documentos binary, textos binary, calidad binary"


def batch_rows(fragments: DataFrame, batch: Column, id_col: str = "doc_id") -> DataFrame:
    """(COLUMNS) of fragments (id, texto) by batch: one row each, combined before the exchange, so a batch with a third of all rows is one row a task. A null batch is a batch; null texts have quality 0."""
    rows = fragments.select(batch.cast("string").alias("lote"), F.col(id_col).cast("string").alias("_id"), "texto", F.coalesce(text.quality(F.col("texto")), F.lit(0.0)).alias("_q"))
    return rows.groupBy("lote").agg(
        F.count(F.lit(1)).alias("num_fragmentos"), F.sum("_q").alias("suma"), F.min("_q").alias("minimo"), F.max("_q").alias("maximo"),
        F.hll_sketch_agg("_id", LG).alias("documentos"), F.hll_sketch_agg("texto", LG).alias("textos"), F.kll_sketch_agg_double("_q", K).alias("calidad"),
    )


def stored(table: Keyed, fragments: DataFrame, batch: Column, id_col: str = "doc_id") -> dict[str, int]:
    """Stores the rows of the batches that the table lacks; counts of new and existing ones. A batch is told by its name: its documents never change."""
    return table.append(batch_rows(fragments, batch, id_col), F.col("lote"), [F.col("num_fragmentos")])


def merged(rows: DataFrame, ranks: tuple[float, ...] = (0.1, 0.5, 0.9)) -> DataFrame:
    """One row: num_fragmentos, media, minimo, maximo (exact; 0 without fragments), num_documentos and num_textos (estimates), cuantiles (an array, null without fragments)."""
    found = rows.agg(
        F.coalesce(F.sum("num_fragmentos"), F.lit(0)).alias("num_fragmentos"), F.sum("suma").alias("_s"), F.coalesce(F.min("minimo"), F.lit(0.0)).alias("minimo"), F.coalesce(F.max("maximo"), F.lit(0.0)).alias("maximo"),
        F.hll_sketch_estimate(F.hll_union_agg("documentos")).alias("num_documentos"), F.hll_sketch_estimate(F.hll_union_agg("textos")).alias("num_textos"), F.kll_merge_agg_double("calidad").alias("_k"),
    )
    none = F.col("num_fragmentos") == 0
    quantiles = F.when(~none, F.array(*[F.kll_sketch_get_quantile_double("_k", F.lit(r)) for r in ranks]))
    return found.select("num_fragmentos", F.when(none, 0.0).otherwise(F.col("_s") / F.col("num_fragmentos")).alias("media"), "minimo", "maximo", F.coalesce("num_documentos", F.lit(0)).alias("num_documentos"), F.coalesce("num_textos", F.lit(0)).alias("num_textos"), quantiles.alias("cuantiles"))
