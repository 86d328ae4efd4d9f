"""From raw documents to packed training sequences: language ID, exact dedup, near-duplicate join, mixing, packing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorewright.llm import common, exact_dedup, jaccard, language, mixing, packing
from lorewright.llm.registry import MARGINS, fold, tokenizer

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language can't be told: null texts and texts without letters."""
    # whole texts go to Python workers in all stages: the rest of the session sends them in batches that are bounded by bytes
    spark.conf.set(common.BYTES, common.BATCH_BYTES)
    texts = language.training_texts(docs, fold(5) != 0)
    return language.identified(docs, texts).where(F.col("lang_pred") != language.UNDETERMINED).select(*COLUMNS)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest doc_id stays."""
    return exact_dedup.deduplicated(docs, keep="max").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates, the document with the smallest doc_id stays.

    Null texts and texts without words are in no component, and rows without an id always stay. Rows that repeat an id stay or go together.
    """
    gone = jaccard.classes_of_near_duplicates(docs).where("doc_id <> component_id").select(F.col("doc_id").alias("_gone"))
    return docs.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti").select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Samples documents by rates calibrated to the targets of source, language and topic; one whose rate is over 1 is repeated.

    Null and unlisted languages keep their own share: language ID has let these documents in. Null texts count as one token and null
    sources as a source; rows that repeat an id are sampled alike. Targets that contradict each other on these rows are met as nearly as they can be, with a warning.
    """
    return mixing.mixed(docs, MARGINS, keep_unlisted=True, unmet="warn").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of every document, their sequences and places there.

    Null texts are a piece with the end alone; repeated rows have pieces of their own.
    """
    return packing.pack_documents(docs, tokenizer(), 2048, 0)


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near_copies),
    ("mixing", mix),
    ("packing", pack),
]
#: Language ID, the join's components and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of `sf_dir`; each result is written as Parquet and read again. What one stage wrote goes once the next is written."""
    docs, before = common.table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = f"{common.scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        if before is not None:
            common.dropped(before)
        docs = before = spark.read.parquet(path)
    return docs
