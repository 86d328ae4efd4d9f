"""Exact dedup: group by a 128-bit content hash, compare bytes inside each group, keep one stable id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HOT_SHARE, ascii_lower, materialised


def duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """One row per row of `docs`: its id, keep_id (the smallest or, with keep="max", largest id of the equal texts), group_size, kept, text_sha256.

    Texts are equal when their bytes are, after lower-casing A-Z; null counts as empty. The grouping key is the MD5 and the
    text itself, so Spark compares bytes within a hash group and two texts that share an MD5 stay apart. Partial aggregation
    shrinks a group of copies to one row per map task, whatever its size. Ids find their group by MD5 and SHA-256 together,
    without the text; the few groups that hold over HOT_SHARE of all rows (1 / HOT_SHARE of them at most) are broadcast, and
    the rest meet in a shuffle. Rows with a null id join their group and are kept only if no member has an id. Rows that repeat
    an id and its text all count in group_size and are kept together. Columns other than the two named are never read.
    """
    keys = docs.select(F.col(id_col).alias("doc_id"), ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).alias("body")).select(
        "doc_id", "body", F.unhex(F.md5("body")).alias("h"), F.unhex(F.sha2("body", 256)).alias("sha")
    )
    best = (F.max if keep == "max" else F.min)("doc_id")
    groups = (
        keys.groupBy("h", "body")
        .agg(F.count(F.lit(1)).alias("n"), best.alias("keep"))
        .where("n > 1")
        .select(F.col("h").alias("gh"), F.unhex(F.sha2("body", 256)).alias("gsha"), "n", "keep")
    )
    groups = materialised(groups, "exact-groups")
    limit = max(1, int(docs.count() * HOT_SHARE))
    hot = F.broadcast(groups.where(F.col("n") > limit).select(F.col("gh").alias("hh"), F.col("gsha").alias("hsha"), F.col("n").alias("hn"), F.col("keep").alias("hkeep")))
    cold = groups.where(F.col("n") <= limit)
    rows = keys.drop("body").join(hot, (F.col("h") == F.col("hh")) & (F.col("sha") == F.col("hsha")), "left")
    #: rows of hot groups have found theirs; their key only spreads them
    key = F.when(F.col("hn").isNull(), F.col("h")).otherwise(F.unhex(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    rows = rows.withColumn("k", key).join(cold, (F.col("k") == F.col("gh")) & (F.col("sha") == F.col("gsha")), "left")
    size, keep_id = F.coalesce("hn", "n"), F.when(F.col("hn").isNotNull(), F.col("hkeep")).when(F.col("n").isNotNull(), F.col("keep")).otherwise(F.col("doc_id"))
    return rows.select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.coalesce(size, F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """The rows of `docs` that stay, all columns unchanged. Rows that repeat a kept id and its text stay together.

    The dropped rows decide, not the kept ones, since they are fewer. A row is known by its id and its text's SHA-256 together: an id,
    null among them, can stand on several texts of which only some are copies.
    """
    gone = duplicate_classes(docs, id_col, text_col, keep).where(~F.col("kept")).select(F.col("doc_id").alias("_gone"), F.unhex("text_sha256").alias("_gone_sha")).distinct()
    sha = F.unhex(F.sha2(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))), 256))
    return docs.join(gone, (sha == F.col("_gone_sha")) & F.col(id_col).eqNullSafe(F.col("_gone")), "left_anti")
