"""Free labels resolved against a table of names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorewright.functions.text import folded_name, strip

#: The answer for "none fits", proposals tried at most, and the state of a queued candidate.
NO_MATCH, TRIES, PENDING = "SIN_MATCH", 3, "pendiente"


def match(rows: DataFrame, table: DataFrame, proposed: str, *keys: str) -> DataFrame:
    """(keys, id) of rows whose proposal is a number equal to an id, or a name equal to one but for case and white space; of several the smallest id.

    Null, blank and NO_MATCH proposals, numbers beyond a long and malformed ones match nothing.
    """
    keys = keys or ("key",)
    p = strip(F.col(proposed))
    good = rows.where(p.isNotNull() & ~p.isin("", NO_MATCH)).select(*keys, p.alias("_p"))
    numeric = F.col("_p").rlike(r"^-*\d+$")
    ids = table.select(F.concat(F.lit("#"), F.col("id").cast("string")).alias("_n"), "id")
    names = table.groupBy(folded_name(F.col("nombre")).alias("_n")).agg(F.min("id").alias("id")).select(F.concat(F.lit("="), "_n").alias("_n"), "id")
    number = F.concat(F.lit("#"), F.col("_p").try_cast("long").cast("string"))
    asked = good.withColumn("_n", F.when(numeric, number).otherwise(F.concat(F.lit("="), folded_name(F.col("_p")))))
    return asked.join(ids.unionByName(names), "_n").select(*keys, "id")


def resolve(rows: DataFrame, table: DataFrame, proposals: Sequence[str], key: str = "key", label: str = "texto", kind: str = "tema") -> tuple[DataFrame, DataFrame]:
    """(resolved: key, id or null, intentos; queue: tipo, texto, estado) after the proposal columns in turn, TRIES at most.

    All tries meet the table in one join, and each row keeps its first hit: the same as trying what is still unmatched again, in one
    pass instead of three. What stays unmatched is queued for review, once per row.
    """
    if kind not in ("tema", "tecnica"):
        raise ValueError(f"unknown kind {kind!r}")
    tries = rows.select(key, F.posexplode(F.array(*proposals[:TRIES])).alias("_k", "_try"))
    hits = match(tries, table, "_try", key, "_k").groupBy(key).agg(F.min_by("id", "_k").alias("id"), (F.min("_k") + 1).alias("intentos"))
    both = rows.select(key, F.col(label).alias("texto")).join(hits, key, "left")
    resolved = both.select(key, "id", F.coalesce("intentos", F.lit(min(len(proposals), TRIES))).alias("intentos"))
    return resolved, both.where("id is null").select(F.lit(kind).alias("tipo"), "texto", F.lit(PENDING).alias("estado"))
