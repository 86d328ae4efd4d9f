"""Language detection by votes of words, given or learned from labelled texts; other models are injected as column functions in its place."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .text import bound, words

UNDETERMINED = "und"
VOTES = {
    "de": ("der", "und", "das", "mit", "die", "nicht"),
    "en": ("the", "of", "and", "that", "for", "with"),
    "es": ("los", "del", "las", "que", "el", "por"),
    "fr": ("les", "des", "dans", "est", "une", "pour"),
}


def detected(text: Column, votes: Mapping[str, tuple[str, ...]] = VOTES) -> Column:
    """The language with the most votes, of equals the first by name; "und" without any, and for null."""
    names = sorted(votes)

    def one_of(listed: tuple[str, ...]):
        return lambda word: word.isin(*listed)

    def counted(found: Column) -> Column:
        return F.struct(*[F.size(F.filter(found, one_of(votes[x]))).alias(f"n{k}") for k, x in enumerate(names)])

    def first(n: Column) -> Column:
        counts = [n[f"n{k}"] for k in range(len(names))]
        top = F.greatest(*counts, F.lit(0))
        out = F.lit(UNDETERMINED)
        for x, count in reversed(list(zip(names, counts, strict=True))):
            out = F.when(count == top, x).otherwise(out)
        return F.when(top <= 0, UNDETERMINED).otherwise(out)

    return F.coalesce(bound(bound(words(text), counted), first), F.lit(UNDETERMINED))


def learned_votes(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", size: int = 200) -> dict[str, tuple[str, ...]]:
    """For each language of labelled texts, the `size` words whose share of its words most exceeds their share elsewhere: votes for detected().

    Words are counted over all texts and combined before the exchange; only the chosen words come to the driver. A language that
    occurs with no label gets no votes.
    """
    known = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.explode(words(F.col(text_col))).alias("word"))
    counts = known.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("all"))
    whole = counts.groupBy("word").agg(F.sum("n").alias("everywhere"))
    everything = totals.agg(F.sum("all")).first()[0] or 1
    shares = counts.join(F.broadcast(totals), "lang").join(whole, "word")
    gain = F.col("n") / F.col("all") - (F.col("everywhere") - F.col("n")) / F.greatest(F.lit(everything) - F.col("all"), F.lit(1))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("gain"), "word"))
    best = shares.withColumn("gain", gain).where("gain > 0").withColumn("k", rank).where(F.col("k") <= size)
    out: dict[str, list[str]] = {}
    for r in best.select("lang", "word").orderBy("lang", "k").collect():
        out.setdefault(r.lang, []).append(r.word)
    return {lang: tuple(found) for lang, found in out.items()}
