"""Language by ranked profiles of letter trigrams: each language's most frequent ones as a table, joined with those of a document by an out-of-place distance."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lorewright.functions.language import UNDETERMINED

#: Trigrams of a profile; letters of a run that are one piece; profile rows up to which the table is broadcast.
SIZE, PIECE, BROADCAST = 400, 64, 1_000_000
#: Bytes of text that a task counts: its trigrams take about sixty times as much memory.
TASK_BYTES = 4 << 20


def trigrams(rows: DataFrame, key: str, text_col: str) -> DataFrame:
    """(key, gram, n): trigrams of the lower-cased runs of letters, each with a blank on both sides; a run of over PIECE letters counts as pieces.

    Runs are counted first and cut after, so that a frequent word is cut once for each key.
    """
    runs = F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(rf"\p{{L}}{{1,{PIECE}}}"), F.lit(0))
    words = rows.select(key, F.explode(runs).alias("_w")).groupBy(key, "_w").agg(F.count(F.lit(1)).alias("_n"))
    padded = words.select(key, F.concat(F.lit(" "), "_w", F.lit(" ")).alias("_w"), "_n")
    cut = padded.select(key, "_w", "_n", F.explode(F.sequence(F.lit(1), F.length("_w") - 2)).alias("_k"))
    return cut.groupBy(key, F.substr("_w", F.col("_k"), F.lit(3)).alias("gram")).agg(F.sum("_n").alias("n"))


def ranked(counts: DataFrame, key: str, size: int) -> DataFrame:
    """(key, gram, puesto from 0) of the most frequent trigrams of each key; of equals the first by bytes."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), "gram")) - 1
    return counts.withColumn("puesto", place).where(F.col("puesto") < size).select(key, "gram", "puesto")


def learned(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """(lang, gram, puesto): the profile of each language of labelled texts, over all of them; rows without a label teach nothing.

    Counts are combined before they are exchanged, so a language with a third of all rows is as many rows as it has trigrams.
    """
    rows = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("_text"))
    return ranked(trigrams(rows, "lang", "_text"), "lang", size)


def detected(docs: DataFrame, profiles: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, margin: float = 0.01) -> DataFrame:
    """(id, lang, distancia, segunda) of every document: the language whose profile is least out of place, its distance and that of the next one.

    A document's distance to a language adds, for each trigram of its own profile, how far the two ranks are apart, and `size` where the language lacks it; what
    is returned is its share of the greatest possible one, in millionths, rounded down. The language is "und" where there are no letters (the distances are null then), where the
    best distance is the greatest possible one, and where the next best is closer than `margin`; a lone profile needs no margin. Equal distances give the first name, which a
    margin over 0 leaves to "und". Rows that share an id are one document; a null id is an id like any other.

    Texts are exchanged once, by id, into as many parts as there are TASK_BYTES of them, so that a task's memory doesn't grow with the input; counting, ranking and
    adding up follow in place. Profiles are a bounded table; they are broadcast up to BROADCAST rows and
    joined by trigram beyond.
    """
    held = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    own = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).repartition(max(1, -(-held // TASK_BYTES)), "_id")
    mine = ranked(trigrams(own, "_id", "_text"), "_id", size).withColumn("most", F.count(F.lit(1)).over(Window.partitionBy("_id")) * size)
    about = profiles.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("lang").alias("langs")).first()
    table = profiles.select("lang", "gram", F.col("puesto").alias("_p"))
    hits = mine.join(F.broadcast(table) if about.rows <= BROADCAST else table, "gram", "left")
    # what a shared trigram saves against one that the language lacks; the row without a language has the trigrams that none has
    saved = hits.groupBy("_id", "lang").agg(F.sum(F.lit(size) - F.abs(F.col("puesto") - F.col("_p"))).alias("s"), F.max("most").alias("most"))
    each = F.when(F.col("lang").isNotNull(), F.struct((-F.col("s")).alias("s"), "lang"))
    tops = saved.groupBy("_id").agg(F.sort_array(F.collect_list(each)).alias("x"), F.max("most").alias("most"))
    ids = docs.select(F.col(id_col).alias("_id")).distinct()
    found = null_safe(ids, tops)
    share = lambda s: F.floor((F.col("most") - s) * F.lit(1_000_000) / F.col("most")).cast("long")
    nth = lambda k: F.coalesce(-F.get("x", F.lit(k))["s"], F.lit(0))
    second = share(nth(1)) if about.langs > 1 else F.lit(None).cast("long")
    best = found.select(F.col("_id").alias(id_col), F.get("x", F.lit(0))["lang"].alias("_best"), share(nth(0)).alias("distancia"), second.alias("segunda"))
    sure = F.col("_best").isNotNull() & (F.col("segunda").isNull() | (F.col("segunda") - F.col("distancia") >= round(margin * 1_000_000)))
    return best.select(id_col, F.when(sure, F.col("_best")).otherwise(UNDETERMINED).alias("lang"), "distancia", "segunda")


def null_safe(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join by _id in which null is a value."""
    other = right.withColumnRenamed("_id", "_other")
    return left.join(other, F.col("_id").eqNullSafe(F.col("_other")), "left").drop("_other")
