"""Checks of a corpus: each gives one row per failure (check, key, detail); no rows mean it passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorewright.functions import documents
from lorewright.functions.text import bound
from lorewright.operators.relational import orphans, repeated_keys

#: What a timestamp and a speaker tag look like.
TIMESTAMP, SPEAKER = r"\[\d+(?:\.\d+)?s\]", r"SPEAKER_\d+:"


def failures(rows: DataFrame, check: str, key: Column, detail: Column) -> DataFrame:
    """Rows as failures of a check."""
    return rows.select(F.lit(check).alias("check"), key.cast("string").alias("key"), detail.cast("string").alias("detail"))


def no_timestamps(docs: DataFrame) -> DataFrame:
    """Documents (path, contenido) with a timestamp left."""
    return failures(docs.where(F.col("contenido").rlike(TIMESTAMP)), "sin_timestamps", F.col("path"), F.regexp_extract("contenido", TIMESTAMP, 0))


def no_speakers(docs: DataFrame) -> DataFrame:
    """Documents with a speaker tag left."""
    return failures(docs.where(F.col("contenido").rlike(SPEAKER)), "sin_speaker_tags", F.col("path"), F.regexp_extract("contenido", SPEAKER, 0))


def complete_header(docs: DataFrame) -> DataFrame:
    """Parsed documents (path, metadatos, fragmentos_meta) that lack a document field, any fragment, or a fragment's field."""
    missing = lambda m, keys: F.array_except(F.array(*map(F.lit, keys)), F.coalesce(F.map_keys(m), F.array().cast("array<string>")))
    doc = docs.withColumn("_m", missing(F.col("metadatos"), documents.DOCUMENT_KEYS)).where(F.size("_m") > 0)
    none = docs.where(F.size("fragmentos_meta") == 0)
    each = docs.select("path", F.posexplode("fragmentos_meta").alias("k", "f")).withColumn("_m", missing(F.col("f"), documents.FRAGMENT_KEYS)).where(F.size("_m") > 0)
    name = "cabecera_completa"
    out = failures(doc, name, F.col("path"), F.array_join("_m", ","))
    out = out.unionByName(failures(none, name, F.col("path"), F.lit("fragmentos")))
    return out.unionByName(failures(each, name, F.col("path"), F.concat(F.col("k").cast("string"), F.lit(":"), F.array_join("_m", ","))))


def word_bounds(docs: DataFrame, least: int = documents.LEAST_WORDS, most: int = documents.MOST_WORDS) -> DataFrame:
    """Documents (path, cuerpo) with too few or too many words."""
    counted = docs.select("path", documents.word_count(F.col("cuerpo")).alias("n"))
    few = failures(counted.where(F.col("n") < least), "min_palabras", F.col("path"), F.col("n"))
    return few.unionByName(failures(counted.where(F.col("n") > most), "max_palabras", F.col("path"), F.col("n")))


def no_duplicates(docs: DataFrame) -> DataFrame:
    """MD5s that several documents share, with their sorted paths: one row per path, so a large group is no large value."""
    hashed = docs.select("path", F.md5("contenido").alias("h"))
    many = hashed.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return failures(hashed.join(many, "h"), "sin_duplicados", F.col("h"), F.col("path"))


def duplicate_groups(docs: DataFrame) -> DataFrame:
    """(hash, rutas) of documents with equal content, paths sorted."""
    return docs.groupBy(F.md5("contenido").alias("hash")).agg(F.sort_array(F.collect_list("path")).alias("rutas")).where(F.size("rutas") > 1)


def allowed_languages(docs: DataFrame) -> DataFrame:
    """Fragments whose original or own language is missing or outside the allowed ones."""
    each = docs.select("path", F.posexplode("fragmentos_meta").alias("k", "f"))
    fields = F.explode(F.array(*[F.struct(F.lit(n).alias("n"), F.try_element_at("f", F.lit(n)).alias("v")) for n in ("idioma_original", "idioma_fragmento")]))
    bad = each.select("path", "k", fields.alias("x")).where(~F.coalesce(F.col("x.v").isin(*documents.LANGUAGES), F.lit(False)))
    return failures(bad, "idiomas_permitidos", F.col("path"), F.concat_ws(":", F.col("k").cast("string"), "x.n", F.coalesce("x.v", F.lit("null"))))


def objects_match(rows: DataFrame, objects: DataFrame) -> DataFrame:
    """Rows (bucket, object_path, hash_md5) whose object (bucket, object_path, content) is missing or has another hash."""
    have = objects.select("bucket", "object_path", F.md5("content").alias("_h"))
    bad = rows.join(have, ["bucket", "object_path"], "left").where(~F.col("_h").eqNullSafe(F.col("hash_md5")))
    return failures(bad, "fila_objeto_coherente", F.col("object_path"), F.when(F.col("_h").isNull(), "missing").otherwise("hash"))


def has_bronze(silver: DataFrame, bronze: DataFrame) -> DataFrame:
    """Silver rows whose origin hash no Bronze row has; null is a value."""
    return failures(orphans(silver, bronze, [("origen_hash_md5", "hash_md5")]), "silver_tiene_bronze_teoria", F.col("object_path"), F.col("origen_hash_md5"))


def has_bronze_pair(silver: DataFrame, bronze: DataFrame) -> DataFrame:
    """Silver rows whose drive id and time no Bronze row has; null is a value."""
    bad = orphans(silver, bronze, [("drive_file_id", "drive_file_id"), ("modified_time", "modified_time")])
    return failures(bad, "silver_tiene_bronze_historico", F.col("object_path"), F.concat_ws("@", "drive_file_id", "modified_time"))


def has_object(rows: DataFrame, listing: DataFrame, check: str) -> DataFrame:
    """Rows without an object in the listing (bucket, object_path)."""
    return failures(orphans(rows, listing, [("bucket", "bucket"), ("object_path", "object_path")]), check, F.col("object_path"), F.col("bucket"))


def unique_keys(rows: DataFrame, check: str) -> DataFrame:
    """Idempotency keys that several rows hold."""
    return failures(repeated_keys(rows), check, F.col("key"), F.array_join("ids", ","))


def content_checks(parsed: DataFrame) -> DataFrame:
    """The seven checks of parsed documents (path, contenido, cuerpo, metadatos, fragmentos_meta), as the functions above have them.

    Six of them look at one document each, so one pass makes all their failures; only duplicates need an exchange.
    """
    return document_checks(parsed).unionByName(no_duplicates(parsed))


def document_checks(parsed: DataFrame, checks: Sequence[str] | None = None) -> DataFrame:
    """Those of `checks` (all, if None) that look at one parsed document each, in one pass."""
    asked = lambda name: checks is None or name in checks
    none = F.array().cast("array<struct<check: string, detail: string>>")

    def one(check: str, detail: Column) -> Column:
        return F.struct(F.lit(check).alias("check"), detail.cast("string").alias("detail"))

    def when(bad: Column, check: str, detail: Column) -> Column:
        return F.when(bad, F.array(one(check, detail))).otherwise(none)

    def lacking(m: Column, keys: tuple[str, ...]) -> Column:
        return F.array_except(F.array(*map(F.lit, keys)), F.coalesce(F.map_keys(m), F.array().cast("array<string>")))

    def bounds(n: Column) -> Column:
        return F.concat(*[when(bad, name, n) for bad, name in ((n < documents.LEAST_WORDS, "min_palabras"), (n > documents.MOST_WORDS, "max_palabras")) if asked(name)])

    def header(missing: Column) -> Column:
        return when(F.size(missing) > 0, "cabecera_completa", F.array_join(missing, ","))

    def fields(f: Column, k: Column) -> Column:
        return bound(lacking(f, documents.FRAGMENT_KEYS), lambda m: when(F.size(m) > 0, "cabecera_completa", F.concat(k.cast("string"), F.lit(":"), F.array_join(m, ","))))

    def languages(f: Column, k: Column) -> Column:
        def of(name: str) -> Column:
            value = F.try_element_at(f, F.lit(name))
            return when(~F.coalesce(value.isin(*documents.LANGUAGES), F.lit(False)), "idiomas_permitidos", F.concat_ws(":", k.cast("string"), F.lit(name), F.coalesce(value, F.lit("null"))))

        return F.concat(of("idioma_original"), of("idioma_fragmento"))

    def each(f: Column, k: Column) -> Column:
        return F.concat(*[of(f, k) for of, name in ((fields, "cabecera_completa"), (languages, "idiomas_permitidos")) if asked(name)])

    found = []
    for name, pattern in (("sin_timestamps", TIMESTAMP), ("sin_speaker_tags", SPEAKER)):
        if asked(name):
            found.append(when(F.col("contenido").rlike(pattern), name, F.regexp_extract("contenido", pattern, 0)))
    if asked("cabecera_completa"):
        found += [bound(lacking(F.col("metadatos"), documents.DOCUMENT_KEYS), header), when(F.size("fragmentos_meta") == 0, "cabecera_completa", F.lit("fragmentos"))]
    if asked("min_palabras") or asked("max_palabras"):
        found.append(bound(documents.word_count(F.col("cuerpo")), bounds))
    if asked("cabecera_completa") or asked("idiomas_permitidos"):
        found.append(F.coalesce(F.flatten(F.transform("fragmentos_meta", each)), none))
    return parsed.select(F.col("path").cast("string").alias("key"), F.explode(F.concat(*found)).alias("x")).select("x.check", "key", "x.detail")


def summary(found: DataFrame, checks: tuple[str, ...]) -> DataFrame:
    """One row per check: (check, ok, fallos); a check without failures passes, also on no rows."""
    counts = found.groupBy("check").agg(F.count(F.lit(1)).alias("fallos"))
    names = found.sparkSession.createDataFrame([(c,) for c in checks], "check string")
    return names.join(counts, "check", "left").select("check", F.col("fallos").isNull().alias("ok"), F.coalesce("fallos", F.lit(0)).alias("fallos"))


CONTENT_CHECKS = ("sin_timestamps", "sin_speaker_tags", "cabecera_completa", "min_palabras", "max_palabras", "sin_duplicados", "idiomas_permitidos")
