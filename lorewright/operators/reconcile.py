"""Reconciliation of incoming jokes with stored ones, and the writes that follow."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lorewright.functions import text
from lorewright.operators import graph, nearest
from lorewright.sources.scratch import Scratch

#: Decisions, the similarity from which a joke is a changed one, kinds and states of jokes.
SAME, CHANGED, NEW = "IGUAL", "CAMBIADO", "NUEVO"
SIMILAR_FROM = 0.85
JOKE_KINDS = ("propio", "propio_historico")
JOKE_STATES = ("idea_suelta", "con_estructura", "rematado")


def candidates(jokes: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """(id, hash_normalizado, embedding) of the jokes of these kinds; none and unknown kinds are errors."""
    if not kinds or set(kinds) - set(JOKE_KINDS):
        raise ValueError(f"kinds must be some of {JOKE_KINDS}: {kinds}")
    return jokes.where(F.col("tipo_fuente").isin(*kinds)).select("id", "hash_normalizado", "embedding")


def hash_matches(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """(key, chiste_id) for incoming rows (key, hash_normalizado) with an equal stored hash: the smallest id."""
    return incoming.join(stored, "hash_normalizado").groupBy("key").agg(F.min("id").alias("chiste_id"))


def best_matches(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """(key, chiste_id, similitud): the stored vector of largest cosine for every incoming one (key, embedding); of equals the smallest id.

    Stored rows lie in cells around centroids, and an incoming row opens only the cells that may hold a better one than it has (see operators.nearest). Null
    vectors on either side have no match; a zero vector is an error.
    """
    with Scratch(incoming.sparkSession, "best-match") as scratch:
        found = nearest.best(nearest.units(incoming, "key"), nearest.units(stored, "id"), scratch)
        return Scratch(incoming.sparkSession, "best").write(found.select("key", F.col("id").alias("chiste_id"), F.col("similarity").alias("similitud")), "rows")


def decide(incoming: DataFrame, stored: DataFrame, threshold: float = SIMILAR_FROM) -> DataFrame:
    """(key, decision, hash_normalizado, chiste_id, similitud) of incoming rows (key, texto, embedding) against stored ones.

    Equal hashes are IGUAL with similarity 1. Only the others go on to the vectors: from `threshold` on CAMBIADO, else NUEVO with neither id nor similarity.
    """
    rows = incoming.withColumn("hash_normalizado", text.exact_hash(F.col("texto")))
    same = hash_matches(rows.select("key", "hash_normalizado"), stored).withColumn("_same", F.lit(True))
    rest = rows.join(same, "key", "left_anti")
    near = best_matches(rest.select("key", "embedding"), stored.select("id", "embedding")).where(F.col("similitud") >= threshold)
    known = same.select("key", "chiste_id", F.lit(1.0).alias("similitud"), F.lit(SAME).alias("decision")).unionByName(near.withColumn("decision", F.lit(CHANGED)))
    return rows.join(known, "key", "left").select("key", F.coalesce("decision", F.lit(NEW)).alias("decision"), "hash_normalizado", "chiste_id", "similitud")


def decide_in_order(incoming: DataFrame, stored: DataFrame, order: str, threshold: float = SIMILAR_FROM) -> DataFrame:
    """decide() where each incoming row (key, texto, embedding), once routed, is a candidate for the next in `order`; a `bucket` column on both sides, if there is one, keeps buckets apart.

    Ids of new rows are "new:" and their key. A changed row takes its own text and vector from then on. Of stored rows with equal hashes or cosines the
    smallest id counts, stored ones before new ones; null texts and null vectors equal nothing.

    Two incoming rows can depend on each other only through a chain of rows that are equal by hash or near each other, or near one stored row. The chains' components are
    folded in order, each apart and many side by side. A component with nothing but one incoming row is new without a fold. Within a stretch of `order`, rows of a component that repeat the hash
    of the one before are the same as its joke, and only the first goes to the fold, so a text that repeats very often is a few rows there. What
    one task holds is the entries of one component: a component grows only where rows do depend on each other.
    """
    if threshold <= 0:
        raise ValueError("rows whose cosine is 0 or less would depend on each other")
    with Scratch(incoming.sparkSession, "in-order") as scratch:
        return Scratch(incoming.sparkSession, "decisions").write(_decided(incoming, stored, order, threshold, scratch), "rows")


def _decided(incoming: DataFrame, stored: DataFrame, order: str, threshold: float, scratch: Scratch) -> DataFrame:
    kind = dict(incoming.dtypes)["key"]
    scope = lambda df: F.col("bucket").cast("string") if "bucket" in df.columns else F.lit("")

    def named(df: DataFrame) -> DataFrame:
        """With the nodes of text and of vector, which equal ones share."""
        made = F.transform("embedding", lambda x: x.cast("double"))
        df = df.withColumns({"scope": scope(df), "embedding": made})
        part = F.concat(F.length(F.coalesce("scope", F.lit(""))).cast("string"), F.lit(":"), F.coalesce("scope", F.lit("")))
        return df.withColumns({"by_text": F.concat(F.lit("h"), F.sha2(F.concat(part, "hash_normalizado"), 256)), "by_vector": F.concat(F.lit("v"), F.sha2(F.concat(part, F.to_json(F.struct("embedding"))), 256))}).withColumn("by_vector", F.when(F.col("embedding").isNotNull(), F.col("by_vector")))

    rows = named(incoming.withColumn("hash_normalizado", text.exact_hash(F.col("texto"))).withColumn("at", F.col(order)).drop("id"))
    rows = scratch.write(rows.select("key", "at", "hash_normalizado", "embedding", "scope", "by_text", "by_vector"), "incoming")
    known = scratch.write(named(stored.select("id", "hash_normalizado", "embedding", *(["bucket"] if "bucket" in stored.columns else []))).select("id", "hash_normalizado", "embedding", "scope", "by_text", "by_vector"), "known")
    vectors = lambda df: df.where("by_vector is not null").select("by_vector", F.coalesce("scope", F.lit("")).alias("scope"), "embedding").dropDuplicates(["by_vector"])
    new, all_ = vectors(rows), vectors(rows.unionByName(known, allowMissingColumns=True))
    unit = lambda df: nearest.units(df, "by_vector").join(df.select(F.col("by_vector").alias("id"), "scope"), "id")
    near = nearest.links(unit(new), unit(all_), threshold, scratch)
    same = rows.select("by_text", "by_vector").unionByName(known.select("by_text", "by_vector")).where("by_text is not null and by_vector is not null").select(F.col("by_text").alias("a"), F.col("by_vector").alias("b")).distinct()
    groups = scratch.write(graph.components(same.unionByName(near), scratch), "groups")

    def grouped(df: DataFrame, alone: Column) -> DataFrame:
        node = F.coalesce("by_vector", "by_text", alone)
        return df.withColumn("node", node).join(groups, "node", "left").withColumn("component", F.coalesce("component", "node")).drop("node")

    own = F.concat(F.lit("k"), F.col("key").cast("string"))
    # stretches of `order`: a row is the head of a run unless the one before it in its component and stretch has the same hash
    laid = scratch.write(grouped(rows, own).repartitionByRange("at", "key").withColumn("stretch", F.spark_partition_id()), "laid")
    within = Window.partitionBy("component", "stretch").orderBy("at", "key")
    head = ~F.col("hash_normalizado").eqNullSafe(F.lag("hash_normalizado").over(within)) | F.col("hash_normalizado").isNull()
    runs = scratch.write(laid.withColumn("head", head).withColumn("run", F.sum(F.col("head").cast("int")).over(within)), "runs")
    heads = runs.where("head")
    kept = grouped(known, F.concat(F.lit("s"), F.col("id").cast("string"))).join(heads.select("component").distinct(), "component", "left_semi")
    alone = heads.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where("n = 1").join(kept, "component", "left_anti").select("component", F.lit(True).alias("alone"))
    heads = scratch.write(heads.join(alone, "component", "left"), "heads")
    entries = kept.select("component", F.lit(True).alias("stored"), "id", F.lit(None).cast(dict(rows.dtypes)["at"]).alias("at"), F.lit(None).cast(kind).alias("key"), F.col("id").cast("string").alias("name"), "hash_normalizado", "embedding", F.lit(0).alias("stretch"), F.lit(0).cast("long").alias("run"))
    asked = heads.where("alone is null").select("component", F.lit(False).alias("stored"), F.lit(None).cast(dict(known.dtypes)["id"]).alias("id"), "at", "key", F.col("key").cast("string").alias("name"), "hash_normalizado", "embedding", "stretch", "run")
    both = entries.unionByName(asked).repartition("component").sortWithinPartitions("component", F.desc("stored"), "id", "at", "key").drop("id", "at", "key")
    folded = both.mapInPandas(lambda batches: fold(batches, threshold), "component string, stretch int, run long, key string, decision string, chiste_id string, similitud double")
    folded = folded.withColumn("key", F.col("key").cast(kind))
    single = heads.where("alone").select("component", "stretch", "run", "key", F.lit(NEW).alias("decision"), F.lit(None).cast("string").alias("chiste_id"), F.lit(None).cast("double").alias("similitud"))
    found = scratch.write(folded.unionByName(single), "folded")
    again = runs.where("not head").select("component", "stretch", "run", F.col("key").alias("_key")).join(found, ["component", "stretch", "run"])
    again = again.select(F.col("_key").alias("key"), F.lit(SAME).alias("decision"), F.coalesce("chiste_id", F.concat(F.lit("new:"), F.col("key").cast("string"))).alias("chiste_id"), F.lit(1.0).alias("similitud"))
    return found.select("key", "decision", "chiste_id", "similitud").unionByName(again)


def fold(batches: Iterator[pd.DataFrame], threshold: float) -> Iterator[pd.DataFrame]:
    """Decisions of the rows of each component in order, its stored rows first; one component's entries are held at a time."""
    import numpy as np

    component, ids, hashes, units = None, [], {}, np.zeros((0, 0))
    last: list[str | None] = []

    def put(k: int, hash_: str | None, unit) -> None:
        """Entry `k` takes a hash and a vector; of entries with one hash the smallest number counts."""
        nonlocal units
        if k < len(last):
            if last[k] is not None:
                hashes[last[k]].discard(k)
            last[k] = hash_
        else:
            last.append(hash_)
        if hash_ is not None:
            hashes.setdefault(hash_, set()).add(k)
        if unit is not None and units.shape[1] != len(unit):
            units = np.zeros((max(16, len(last)), len(unit)))
        if k >= len(units) and units.shape[1]:
            units = np.concatenate([units, np.zeros((max(16, len(units)), units.shape[1]))])
        if units.shape[1]:
            units[k] = 0.0 if unit is None else unit

    for batch in batches:
        out = []
        for r in batch.itertuples(index=False):
            if r.component != component:
                component, ids, hashes, last, units = r.component, [], {}, [], np.zeros((0, 0))
            vector = None if r.embedding is None else np.asarray(r.embedding, float)
            unit = None if vector is None else vector / np.linalg.norm(vector)
            if r.stored:
                ids.append(r.name)
                put(len(ids) - 1, r.hash_normalizado, unit)
                continue
            sims = (units[: len(ids)] * unit).sum(axis=1) if unit is not None and units.shape[1] == len(unit) and ids else []
            k = int(np.argmax(sims)) if len(sims) else -1
            if r.hash_normalizado is not None and hashes.get(r.hash_normalizado):
                k, decision, value = min(hashes[r.hash_normalizado]), SAME, 1.0
            elif k >= 0 and sims[k] >= threshold:
                decision, value = CHANGED, float(sims[k])
                put(k, r.hash_normalizado, unit)
            else:
                k, decision, value = len(ids), NEW, None
                ids.append(f"new:{r.name}")
                put(k, r.hash_normalizado, unit)
            out.append((r.component, r.stretch, r.run, r.name, decision, None if decision == NEW else ids[k], value))
        yield pd.DataFrame(out, columns=["component", "stretch", "run", "key", "decision", "chiste_id", "similitud"]).astype({"similitud": float})


def route(jokes: DataFrame, decided: DataFrame, facts: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """(jokes after the writes, revisions appended) for decisions (key, decision, hash_normalizado, chiste_id) and facts (key, texto, embedding, estado, tema_id, tecnica_id, estructura, sugerencias).

    IGUAL writes nothing. NUEVO adds a joke at version 1 with the key as id. CAMBIADO overwrites text, hash, vector, state and version, keeps the
    kind, and keeps topic and technique where the new ones are null. Several changes of one joke get versions in order of key; the last one stands.
    """
    if kind not in JOKE_KINDS:
        raise ValueError(f"kind must be one of {JOKE_KINDS}: {kind}")
    rows = decided.where(F.col("decision") != SAME).join(facts, "key").withColumn("estado", text.in_closed_set(F.col("estado"), JOKE_STATES, "estado"))
    structure = F.to_json(F.struct(F.col("estructura").alias("descripcion"), "tecnica_id"), {"ignoreNullFields": "false"})
    kind_of_id = dict(jokes.dtypes)["id"]
    new = rows.where(F.col("decision") == NEW).withColumn("id", F.col("key").cast(kind_of_id)).withColumn("version", F.lit(1))
    order = Window.partitionBy("id").orderBy("key")
    changed = rows.where(F.col("decision") == CHANGED).withColumn("id", F.col("chiste_id").cast(kind_of_id))
    changed = changed.join(jokes.select("id", F.coalesce("version_actual", F.lit(1)).alias("_v")), "id").withColumn("version", (F.col("_v") + F.row_number().over(order)).cast("int"))
    cols = ["id", "version", "texto", "hash_normalizado", "embedding", "estado", "tema_id", "tecnica_id", "estructura", "sugerencias"]
    written = new.select(*cols).unionByName(changed.select(*cols))
    revisions = written.select(F.col("id").alias("chiste_id"), "version", F.col("texto").alias("contenido"), structure.alias("estructura_detectada"), "estado", F.col("sugerencias").alias("sugerencias_mejora"))
    last = changed.groupBy("id").agg(F.max_by(F.struct("texto", "hash_normalizado", "embedding", "estado"), "version").alias("n"), F.max("version").alias("_version"), F.max_by("tema_id", F.when(F.col("tema_id").isNotNull(), F.col("version"))).alias("_tema"), F.max_by("tecnica_id", F.when(F.col("tecnica_id").isNotNull(), F.col("version"))).alias("_tecnica"))
    merged = jokes.join(last, "id", "left")
    hit = F.col("_version").isNotNull()
    pick = lambda c, n: F.when(hit, F.col(f"n.{n}")).otherwise(F.col(c)).alias(c)
    merged = merged.select("id", pick("texto_normalizado", "texto"), pick("hash_normalizado", "hash_normalizado"), pick("embedding", "embedding"), "tipo_fuente", F.coalesce("_tema", "tema_id").alias("tema_id"), F.coalesce("_tecnica", "tecnica_id").alias("tecnica_id"), pick("estado", "estado"), F.coalesce("_version", "version_actual").alias("version_actual"))
    added = new.select("id", F.col("texto").alias("texto_normalizado"), "hash_normalizado", "embedding", F.lit(kind).alias("tipo_fuente"), "tema_id", "tecnica_id", "estado", F.col("version").alias("version_actual"))
    return merged.unionByName(added), revisions
