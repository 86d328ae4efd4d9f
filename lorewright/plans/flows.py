"""The theory flow end to end, and its chunks and checks; runs with models and state are in plans.runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorewright.functions import language, text
from lorewright.operators import fragments, relational, transcripts, validate
from lorewright.sources import files
from lorewright.sources.store import BRONZE, Store

SILVER = BRONZE + ", origen_hash_md5 string, quality_score double, traducido boolean, idioma_original string, num_fragmentos long, contenido string"
CHUNKS = "doc_id string, version_corpus string, chunk_index int, chunk string, embedding array<double>"


def hashed_vector(value: Column, dims: int = 16) -> Column:
    """A vector of word counts by hash: the offline default for an embedder."""
    return F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda k: F.size(F.filter(text.words(value), lambda w: F.pmod(F.xxhash64(w), F.lit(dims)) == k)).cast("double"))


def theory(store: Store, root: str, state: DataFrame | None = None, detect=language.detected, translate=None) -> dict[str, DataFrame | dict]:
    """Files under `root` to Bronze and Silver: parse, split, clean, language, quality, render; the state is what is returned as "state", to keep after all sinks.

    A file that fails, or a transcript that breaks the grammar, is in "failed" and stops nothing. A rerun stores nothing new.
    """
    spark = store.spark
    found = files.scan(spark, root, recursive=True)
    fresh = found if state is None else files.changed(found, state)
    good, ignored = files.eligible(fresh)
    captured = store.capture(good.select("name", "content", F.lit(None).cast("string").alias("drive_file_id"), F.lit(None).cast("string").alias("modified_time")), "bronze", "teoria")
    parsed = files.parse(good).cache()
    ok = parsed.where("error is null")
    spoken, rejected = transcripts.parse_transcripts(ok.where("ext = '.txt'"), "path", "text")
    texts = spoken.select("path", "texto").unionByName(ok.where("ext <> '.txt'").select("path", F.col("text").alias("texto")))
    frags = fragments.clean_fragments(fragments.split_documents(texts, "path", "texto"))
    frags = fragments.localised(frags, detect(F.col("texto")), translate)
    facts = ok.select("path", text.title(F.col("name")).alias("fuente"), "tipo_fuente", F.lit(None).cast("string").alias("autor"), F.lit(None).cast("string").alias("licencia"), F.col("md5").alias("origen_hash_md5"))
    whole = fragments.render_documents(frags, facts, "path").join(fragments.silver_summary(frags, "path"), "path").join(facts.select("path", "fuente", "origen_hash_md5"), "path")
    name = F.concat(text.slug(F.col("fuente")), F.lit(".md"))
    rows = whole.withColumn("hash_md5", F.md5("contenido")).withColumn("object_path", F.concat_ws("/", F.lit("local_legacy"), "hash_md5", name))
    null = F.lit(None).cast("string")
    silver = rows.select(
        F.sha2(F.concat_ws("/", F.lit("silver"), "object_path"), 256).alias("id"), F.lit("silver-teoria").alias("bucket"), "object_path", null.alias("drive_file_id"), null.alias("modified_time"), "hash_md5",
        F.lit("local_legacy").alias("origen"), F.current_timestamp().alias("created_at"), "origen_hash_md5", "quality_score", "traducido", "idioma_original", "num_fragmentos", "contenido",
    )
    stored = store.append_new(silver, "silver", "teoria_documentos", F.col("hash_md5"), [F.col("object_path")])
    failed = parsed.where("error is not null").select("path", "error").unionByName(rejected.select("path", F.lit("transcript grammar").alias("error")))
    return {"bronze": captured, "silver": stored, "failed": failed, "ignored": ignored.select("path"), "state": found.select("path", "md5")}


def ingest(store: Store, version: str = "v1", embed: Callable[[Column], Column] = hashed_vector) -> dict[str, int]:
    """Chunks and vectors of the Silver documents that have none; vectors are made only for new chunks."""
    silver = relational.latest(store.read("silver", "teoria_documentos", SILVER), ["origen_hash_md5"], [F.desc("created_at"), F.asc("id")])
    have = store.read("gold", "teoria_chunks", CHUNKS).where(F.col("version_corpus") == version).select(F.col("doc_id").alias("_done"))
    todo = relational.pending(silver, have, silver["id"] == have["_done"])
    chunks = fragments.chunk_documents(todo.withColumn("doc_id", F.col("id"))).withColumn("version_corpus", F.lit(version)).withColumn("embedding", embed(F.col("chunk")))
    key = F.struct("doc_id", "version_corpus", "chunk_index")
    return store.append_new(chunks.select("doc_id", "version_corpus", "chunk_index", "chunk", "embedding"), "gold", "teoria_chunks", key, [F.col("chunk")])


def validation(store: Store) -> DataFrame:
    """All content checks and the lineage and key checks of the latest Silver rows: (check, ok, fallos)."""
    silver = relational.latest(store.read("silver", "teoria_documentos", SILVER), ["origen_hash_md5"], [F.desc("created_at"), F.asc("id")])
    parsed = fragments.parse_documents(silver.select("object_path", "contenido"), "object_path").withColumnRenamed("object_path", "path")
    bronze = store.read("bronze", "teoria_documentos", BRONZE)
    found = validate.content_checks(parsed).unionByName(validate.has_bronze(silver, bronze)).unionByName(validate.unique_keys(silver, "claves_unicas"))
    return validate.summary(found, (*validate.CONTENT_CHECKS, "silver_tiene_bronze_teoria", "claves_unicas"))
