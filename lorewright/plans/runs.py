"""Runs that keep state in the store: historic documents, pending messages, backfill, whole validation.

What a model answered is written to the store before anything reads it, so no step and no lost executor asks a model twice within a run, and a
document or message is marked as done only after all that came of it is written.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorewright.functions import contracts
from lorewright.operators import cost, fragments, marking, reconcile, relational, taxonomy, validate
from lorewright.plans.flows import CHUNKS, SILVER, hashed_vector
from lorewright.sources import catalog, files
from lorewright.sources.statelog import StateLog
from lorewright.sources.store import BRONZE, Store

JOKES = "id string, texto_normalizado string, hash_normalizado string, embedding array<double>, tipo_fuente string, tema_id long, tecnica_id long, estado string, version_actual int"
REVISIONS = "chiste_id string, version int, contenido string, estructura_detectada string, estado string, sugerencias_mejora string"
DONE = "doc_id string, md5 string, procesado_at timestamp"
#: Results of a run: all done, some rows failed, nothing could be done.
OK, SOME_FAILED, NOT_RUN = 0, 1, 2


def kept(store: Store, rows: DataFrame, name: str) -> DataFrame:
    """`rows` written to a folder of their own in the store, and read from there."""
    path = store.path("work", f"{name}-{uuid.uuid4().hex}")
    rows.write.parquet(path)
    return store.spark.read.schema(rows.schema).parquet(path)


def joke_log(store: Store) -> StateLog:
    """The joke table as a log of changes: each turn is a version."""
    return StateLog(store.spark, store.path("gold", "chistes"), JOKES, "id", 16)


def jokes_of(store: Store) -> DataFrame:
    """The joke table as it is now, from its last snapshot and the changes after it."""
    return joke_log(store).as_of().drop("updated_at")


def told(store: Store, rows: DataFrame, ask: Callable[[Column], Column], name: str) -> DataFrame:
    """`rows` (key, texto) with the fields of the model's answers and error."""
    answers = rows.select("key", "texto", contracts.answer(ask(contracts.structure_prompt(F.col("texto")))).alias("a"))
    return kept(store, answers.select("key", "texto", "a.*"), name)


def filed(store: Store, rows: DataFrame, propose: Callable[[Column], Column], kind: str, table: str, label: str) -> DataFrame:
    """(key, id) of the names that labels resolve to in at most TRIES attempts; a later one asks only about what is unmatched. What stays so is queued."""
    names = catalog.listed(store, table)
    listing = F.lit([r.nombre for r in names.orderBy("id").collect()] or [""])
    left, found = rows.select("key", F.col(label).alias("texto")), None
    for attempt in range(1, taxonomy.TRIES + 1):
        prompt = contracts.label_prompt(F.col("texto"), kind, attempt, listing)
        answers = kept(store, left.withColumn("p", contracts.answer(propose(prompt), contracts.LABEL_FIELDS, {})["nombre"]), f"{kind}-{attempt}")
        hits = taxonomy.match(answers, names, "p").select("key", "id")
        found = hits if found is None else found.unionByName(hits)
        left = answers.select("key", "texto").join(hits, "key", "left_anti")
    catalog.queued(store, left.select(F.lit(kind).alias("tipo"), "texto"))
    return rows.select("key").join(found, "key", "left")


def written(store: Store, rows: DataFrame, ask, propose, kind: str, against: tuple[str, ...], embed=hashed_vector, name: str = "chistes") -> tuple[DataFrame, DataFrame]:
    """(decisions, keys with an error) after texts (key, texto) are structured, filed, reconciled with jokes of the kinds `against`, and stored."""
    answered = told(store, rows, ask, name)
    good = answered.where("error is null")
    topics = filed(store, good, propose, "tema", "temas", "tema").withColumnRenamed("id", "tema_id")
    techniques = filed(store, good, propose, "tecnica", "tecnicas", "estructura").withColumnRenamed("id", "tecnica_id")
    facts = good.select("key", F.col("texto_normalizado").alias("texto"), "estado", "estructura", "sugerencias").join(topics, "key").join(techniques, "key")
    facts = kept(store, facts.withColumn("embedding", embed(F.col("texto"))), f"{name}-hechos")
    jokes = jokes_of(store)
    decided = kept(store, reconcile.decide(facts.select("key", "texto", "embedding"), reconcile.candidates(jokes, against)), f"{name}-decisiones")
    after, revisions = reconcile.route(jokes, decided, facts, kind)
    after = kept(store, after, f"{name}-despues")
    changed = after.join(jokes.select("id", F.col("version_actual").alias("_v")), "id", "left").where(~F.col("_v").eqNullSafe(F.col("version_actual"))).drop("_v")
    store.append_new(revisions.select([c.split()[0] for c in REVISIONS.split(", ")]), "gold", "revisiones", F.struct("chiste_id", "version"), [F.col("contenido")])
    if changed.take(1):
        joke_log(store).append(changed.select([c.split()[0] for c in JOKES.split(", ")]))
    return decided, answered.where("error is not null").select("key", "error")


def sync_and_mark(store: Store, root: str) -> dict:
    """Coloured DOCX files under `root`: captured in Bronze, marked, guarded, and stored in Silver with the numbers of their marks. A file that fails goes no further and stops no other."""
    found = files.scan(store.spark, root, recursive=True).where("ext = '.docx'")
    null = F.lit(None).cast("string")
    bronze = store.capture(found.select("name", "content", null.alias("drive_file_id"), null.alias("modified_time")), "bronze", "historico")
    parsed = kept(store, files.parse(found.withColumn("tipo_fuente", F.lit("historico")), {".docx": files.docx_runs}), "leidos")
    paragraphs = parsed.where("error is null").select(F.col("path").alias("doc_id"), F.posexplode(F.from_json("text", "array<array<array<string>>>")).alias("para", "runs"))
    coloured = kept(store, paragraphs.select("doc_id", "para", F.posexplode_outer("runs").alias("run", "x")).select("doc_id", "para", F.coalesce("run", F.lit(0)).alias("run"), F.get("x", 0).alias("color"), F.get("x", 1).alias("texto")), "tiradas")
    marked = kept(store, marking.marked_text(coloured), "marcado")
    bad = marking.round_trip(coloured, marked).where("not ok").select(F.col("doc_id").alias("path")).distinct()
    good = marked.withColumnRenamed("doc_id", "path").join(bad, "path", "left_anti").join(parsed.select("path", F.col("md5").alias("origen_hash_md5")), "path")
    tags = {name: F.regexp_count("markdown", F.lit(rf"\[{tag}\]")).cast("long") for name, tag in (("remates", "REMATE"), ("chistoides", "CHISTOIDE"))}
    rows = good.withColumns(tags).select("path", "origen_hash_md5", F.md5("markdown").alias("hash_md5"), "remates", "chistoides", F.col("markdown").alias("contenido"))
    silver = store.append_new(rows, "silver", "historico_marcados", F.struct("path", "origen_hash_md5"), [F.col("hash_md5")])
    failed = parsed.where("error is not null").select("path", "error").unionByName(bad.withColumn("error", F.lit("the marks lost text")))
    return {"bronze": bronze, "silver": silver, "failed": failed, "exit": SOME_FAILED if failed.take(1) else OK}


def pending_documents(store: Store, runs: DataFrame) -> DataFrame:
    """Runs of the documents that were never finished in this state: a document is known by its id and the hash of its coloured runs."""
    state = runs.groupBy("doc_id").agg(F.md5(F.to_json(F.sort_array(F.collect_list(F.struct("para", "run", "color", "texto"))))).alias("md5"))
    done = store.read("silver", "historico_estado", DONE).select(F.col("doc_id").alias("_d"), F.col("md5").alias("_m"))
    fresh = state.join(done, (F.col("doc_id").cast("string") == F.col("_d")) & (F.col("md5") == F.col("_m")), "left_anti")
    return runs.join(fresh, "doc_id")


def preview(store: Store, runs: DataFrame, token_limit: int = cost.TOKEN_LIMIT, euro_limit: float | None = None) -> DataFrame:
    """The gate's decision on what is pending. Nothing is written and no state changes."""
    return cost.gate(cost.estimate(marking.marked_text(pending_documents(store, runs).drop("md5"))), token_limit, euro_limit)


def historic(store: Store, runs: DataFrame, quote: Callable[[Column], Column], ask, propose, embed=hashed_vector, token_limit: int = cost.TOKEN_LIMIT) -> dict:
    """Pending documents (coloured runs) marked, guarded, segmented, structured, filed, reconciled and stored.

    A document that fails the guard, or of which any joke has no good answer, is in "failed" and stays pending; the others' state is
    written last. If the gate refuses, no model is asked. A rerun does nothing more.
    """
    todo = pending_documents(store, runs)
    hashes = todo.select("doc_id", "md5").distinct()
    todo = todo.drop("md5")
    marked = kept(store, marking.marked_text(todo), "marcado")
    bad = marking.round_trip(todo, marked).where("not ok").select("doc_id").distinct()
    good = marked.join(bad, "doc_id", "left_anti")
    failed = bad.select(F.col("doc_id").cast("string").alias("key"), F.lit("the marks lost text").alias("error"))
    if not cost.gate(cost.estimate(good), token_limit).first().permitir:
        return {"exit": NOT_RUN, "jokes": 0, "failed": failed, "finished": 0}
    answers = marking.segment(good).withColumn("a", contracts.answer(quote(contracts.segment_prompt(F.col("ventana"))), contracts.SEGMENT_FIELDS, {}))
    windows = kept(store, answers.withColumns({"inicio": F.col("a.inicio"), "error": F.col("a.error")}).drop("a"), "ventanas")
    key = F.concat_ws("#", F.col("doc_id").cast("string"), F.lpad(F.col("pos").cast("string"), 6, "0")).alias("key")
    rows = marking.cut_setups(windows.where("error is null")).select("doc_id", key, "texto")
    decided, wrong = written(store, rows.select("key", "texto"), ask, propose, "propio_historico", reconcile.JOKE_KINDS, embed)
    wrong = kept(store, wrong.unionByName(windows.where("error is not null").select(key, "error")), "errores")
    broken = wrong.join(windows.select(key, F.col("doc_id").cast("string").alias("doc_id")), "key").select("doc_id").distinct()
    finished = good.select(F.col("doc_id").cast("string").alias("doc_id")).join(broken, "doc_id", "left_anti")
    state = finished.join(hashes.select(F.col("doc_id").cast("string").alias("doc_id"), "md5"), "doc_id").withColumn("procesado_at", F.current_timestamp())
    count = store.append_new(state, "silver", "historico_estado", F.struct("doc_id", "md5"), [F.col("md5")])["nuevos"]
    failed = failed.unionByName(wrong)
    return {"exit": SOME_FAILED if failed.take(1) else OK, "jokes": decided.count(), "failed": failed, "finished": count}


def messages(store: Store, rows: DataFrame, ask, propose, embed=hashed_vector, table: str = "chistes_telegram") -> dict:
    """Stored messages (id, texto) without a processed mark, structured, filed, reconciled with historic jokes only, and stored; the good ones are marked last, the others stay pending."""
    pending = store.unprocessed(rows, "bronze", table)
    decided, wrong = written(store, pending.select(F.col("id").cast("string").alias("key"), "texto"), ask, propose, "propio", ("propio_historico",), embed, "mensajes")
    done = decided.select(F.col("key").cast("long").alias("id"))
    marked = store.mark_processed(done, "bronze", table)["nuevos"]
    failures = wrong.count()
    return {"exit": SOME_FAILED if failures else OK, "procesados": marked, "fallidos": failures, "failed": wrong}


def backfill(store: Store, roots: list[str], flow: str = "teoria") -> dict[str, int]:
    """Every file under `roots` into Bronze: vistos, nuevos, existentes, fallidos, exit. A root that can't be read counts as failed and stops nothing."""
    out = {"vistos": 0, "nuevos": 0, "existentes": 0, "fallidos": 0}
    null = F.lit(None).cast("string")
    for root in roots:
        try:
            if not store.exists(root):
                raise FileNotFoundError(root)
            found = files.scan(store.spark, root, recursive=True)
            seen = found.count()
            counts = store.capture(found.select("name", "content", null.alias("drive_file_id"), null.alias("modified_time")), "bronze", flow)
        except Exception as e:  # noqa: BLE001 - whatever a file system says
            print(f"backfill: {root}: {type(e).__name__}")
            out["fallidos"] += 1
            continue
        out["vistos"] += seen
        out["nuevos"] += counts["nuevos"]
        out["existentes"] += counts["existentes"]
    return out | {"exit": NOT_RUN if out["fallidos"] == len(roots) else SOME_FAILED if out["fallidos"] else OK}


ALL_CHECKS = (*validate.CONTENT_CHECKS, "fila_objeto_coherente", "bronze_tiene_objeto", "silver_tiene_bronze_teoria", "silver_tiene_bronze_historico", "claves_unicas")


def validation(store: Store) -> tuple[DataFrame, int]:
    """(check, ok, fallos) of all checks of the theory documents: content, stored objects, lineage by hash and by drive id and time, keys; and the exit, 0 only if all pass.

    The lineage by drive id holds for rows that have one. Checks of no rows pass.
    """
    silver = relational.latest(store.read("silver", "teoria_documentos", SILVER), ["origen_hash_md5"], [F.desc("created_at"), F.asc("id")])
    parsed = fragments.parse_documents(silver.select("object_path", "contenido"), "object_path").withColumnRenamed("object_path", "path")
    bronze = store.read("bronze", "teoria_documentos", BRONZE)
    objects = store.read("objects", "bronze-teoria", "bucket string, object_path string, content binary")
    found = validate.content_checks(parsed).unionByName(validate.objects_match(bronze, objects)).unionByName(validate.has_object(bronze, objects, "bronze_tiene_objeto"))
    found = found.unionByName(validate.has_bronze(silver, bronze)).unionByName(validate.has_bronze_pair(silver.where("drive_file_id is not null"), bronze)).unionByName(validate.unique_keys(silver, "claves_unicas"))
    checks = validate.summary(found, ALL_CHECKS)
    return checks, OK if not checks.where("not ok").take(1) else SOME_FAILED


def ingest_numbers(store: Store, version: str = "v1") -> dict[str, int]:
    """Documents and chunks of a version that are stored."""
    row = store.read("gold", "teoria_chunks", CHUNKS).where(F.col("version_corpus") == version).agg(F.countDistinct("doc_id"), F.count(F.lit(1))).first()
    return {"documentos": row[0], "chunks": row[1]}
