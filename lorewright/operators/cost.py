"""Cost of a model run before it is made, and the gate that allows it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorewright.functions.text import token_estimate, without_marks
from lorewright.operators.marking import segment

#: The token limit and the price of a million tokens without other settings.
TOKEN_LIMIT, EUROS_PER_MILLION = 1_000_000, 0.10
#: What stands before a window in the two prompts; callers pass their own.
SEGMENT_PROMPT = "Where does the setup of the joke that ends this passage begin? Quote its first words.\n\n"
STRUCTURE_PROMPT = "Give topic, structure, state, a suggestion and a normal form of this joke as JSON.\n\n"


def estimate(docs: DataFrame, segment_prompt: str = SEGMENT_PROMPT, structure_prompt: str = STRUCTURE_PROMPT, euros_per_million: float = EUROS_PER_MILLION, count=token_estimate, id_col: str = "doc_id", text_col: str = "markdown") -> DataFrame:
    """One row: documents, calls and tokens of either prompt over all windows, tokens in all, euros. `count` is a column function."""
    windows = segment(docs, id_col, text_col)
    sums = windows.agg(
        F.count(F.lit(1)).alias("llamadas_segmentador"),
        F.coalesce(F.sum(count(F.concat(F.lit(segment_prompt), "ventana"))), F.lit(0)).alias("tokens_segmentador"),
        F.coalesce(F.sum(count(F.concat(F.lit(structure_prompt), without_marks(F.col("ventana"))))), F.lit(0)).alias("tokens_silver"),
    )
    whole = docs.agg(F.count(F.lit(1)).alias("documentos")).crossJoin(sums).withColumn("llamadas_silver", F.col("llamadas_segmentador"))
    whole = whole.withColumn("tokens_totales", F.col("tokens_segmentador") + F.col("tokens_silver"))
    return whole.withColumn("coste_eur_estimado", F.col("tokens_totales") / 1e6 * F.lit(float(euros_per_million)))


def limits(token_limit: int | None = None, euro_limit: float | None = None, settings: Mapping[str, str] | None = None) -> tuple[int, float | None]:
    """Limits by argument, else by settings (HISTORICO_COSTE_MAX_TOKENS, HISTORICO_COSTE_MAX_EUR), else the default and none."""
    settings = settings or {}
    tokens = token_limit if token_limit is not None else int(settings.get("HISTORICO_COSTE_MAX_TOKENS") or TOKEN_LIMIT)
    euros = euro_limit if euro_limit is not None else float(settings["HISTORICO_COSTE_MAX_EUR"]) if settings.get("HISTORICO_COSTE_MAX_EUR") else None
    return tokens, euros


def gate(estimated: DataFrame, token_limit: int = TOKEN_LIMIT, euro_limit: float | None = None) -> DataFrame:
    """`estimated` plus permitir and razon: refused only over a limit; exactly at it passes."""
    tokens = F.col("tokens_totales") > token_limit
    euros = F.lit(False) if euro_limit is None else F.col("coste_eur_estimado") > euro_limit
    reason = F.when(tokens, "tokens").when(euros, "euros").otherwise("ok")
    return estimated.withColumn("permitir", ~(tokens | euros)).withColumn("razon", reason)
