"""Queries of validation, cost, message updates, events and files over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lorewright.functions import keys
from lorewright.operators import cost, relational, temporal, validate
from lorewright.plans.binding import fragments_sql, load, register, strip_sql
from lorewright.plans.queries_relational import _MARKED, marked, rendered
from lorewright.sources import files, folder_stream, listing, versions
from lorewright.sources.keyed import Keyed
from lorewright.sources.scratch import Scratch
from lorewright.sources.statelog import StateLog
from lorewright.sources.store import Store
from lorewright.streaming import pending, updates

QUERIES: dict = {}
query = lambda name, sql=None: register(QUERIES, name, sql)
_PATH = "doc_id::VARCHAR"


def parsed(spark, sf_dir):
    """Documents as parsed ones: some with timestamps, speaker tags, missing fields and other languages."""
    docs = load(spark, sf_dir, "documents")
    k = F.col("doc_id")
    body = F.when(k % 11 == 0, F.concat(F.lit("[12.5s] "), "text")).when(k % 13 == 0, F.concat(F.lit("SPEAKER_07: "), "text")).otherwise(F.col("text"))
    head = F.create_map(F.lit("fuente"), F.col("source"), F.lit("tipo_fuente"), F.lit("teoria"), F.lit("licencia"), F.lit("personal_only"))
    meta = F.when(k % 5 == 0, head).otherwise(F.map_concat(head, F.create_map(F.lit("autor"), F.lit("x"))))
    one = F.create_map(F.lit("subtipo"), F.lit("explicacion"), F.lit("idioma_original"), F.col("lang"), F.lit("idioma_fragmento"), F.lit("es"))
    fragments = F.when(k % 17 == 0, F.array().cast("array<map<string,string>>")).when(k % 19 == 0, F.array(F.map_filter(one, lambda n, v: n != "subtipo"))).otherwise(F.array(one))
    return docs.select(k.cast("string").alias("path"), body.alias("contenido"), body.alias("cuerpo"), meta.alias("metadatos"), fragments.alias("fragmentos_meta"))


_BODY = "p AS (SELECT doc_id, doc_id::VARCHAR AS key, lang, CASE WHEN doc_id % 11 = 0 THEN '[12.5s] ' || text WHEN doc_id % 13 = 0 THEN 'SPEAKER_07: ' || text ELSE text END AS body FROM documents)"
_CHECKS = {
    "sin_timestamps": "SELECT 'sin_timestamps' AS \"check\", key, '[12.5s]' AS detail FROM p WHERE doc_id % 11 = 0",
    "sin_speaker_tags": "SELECT 'sin_speaker_tags', key, 'SPEAKER_07:' FROM p WHERE doc_id % 13 = 0 AND doc_id % 11 <> 0",
    "cabecera_completa": "SELECT 'cabecera_completa', key, 'autor' FROM p WHERE doc_id % 5 = 0 UNION ALL SELECT 'cabecera_completa', key, 'fragmentos' FROM p WHERE doc_id % 17 = 0 UNION ALL SELECT 'cabecera_completa', key, '0:subtipo' FROM p WHERE doc_id % 19 = 0 AND doc_id % 17 <> 0",
    "palabras": "SELECT CASE WHEN n < 100 THEN 'min_palabras' ELSE 'max_palabras' END, key, n::VARCHAR FROM (SELECT key, len(regexp_extract_all(body, '[^\\s]+')) AS n FROM p) WHERE n < 100 OR n > 50000",
    "sin_duplicados": "SELECT 'sin_duplicados', md5(body), key FROM p WHERE md5(body) IN (SELECT md5(body) FROM p GROUP BY 1 HAVING count(*) > 1)",
    "idiomas_permitidos": "SELECT 'idiomas_permitidos', key, '0:idioma_original:' || lang FROM p WHERE doc_id % 17 <> 0 AND lang NOT IN ('es', 'en')",
}
_ALL_CHECKS = " UNION ALL ".join(_CHECKS.values())


@query("validate_content", f"WITH {_BODY} {_ALL_CHECKS}")
def validate_content(spark, sf_dir):
    """Failures of the seven content checks."""
    return validate.content_checks(parsed(spark, sf_dir))


@query("validate_summary", f"""WITH {_BODY}, f AS ({_ALL_CHECKS}), c AS (SELECT unnest({list(validate.CONTENT_CHECKS)!r}) AS "check")
SELECT c."check", count(f.key) = 0 AS ok, count(f.key) AS fallos FROM c LEFT JOIN f ON f."check" = c."check" GROUP BY c."check" """)
def validate_summary(spark, sf_dir):
    """Each check's verdict."""
    return validate.summary(validate.content_checks(parsed(spark, sf_dir)), validate.CONTENT_CHECKS)


def stored_rows(spark, sf_dir):
    """Pages as stored rows; some with another hash."""
    pages = load(spark, sf_dir, "pages")
    k = F.col("page_id")
    return pages.select(F.lit("silver-teoria").alias("bucket"), F.concat(F.lit("p/"), k.cast("string")).alias("object_path"), F.when(k % 9 == 0, F.lit("0")).otherwise(F.md5("html")).alias("hash_md5"), F.when(k % 4 == 0, F.lit(None).cast("string")).otherwise(F.md5("url")).alias("origen_hash_md5"), F.when(k % 2 == 0, F.substring("url", 1, 22)).alias("drive_file_id"), F.when(k % 2 == 0, F.lit("t")).alias("modified_time"))


def objects(spark, sf_dir):
    """Objects of pages; every seventh is missing."""
    return load(spark, sf_dir, "pages").where("page_id % 7 <> 0").select(F.lit("silver-teoria").alias("bucket"), F.concat(F.lit("p/"), F.col("page_id").cast("string")).alias("object_path"), F.encode("html", "UTF-8").alias("content"))


@query("validate_objects", """SELECT 'fila_objeto_coherente' AS "check", 'p/' || page_id AS key, CASE WHEN page_id % 7 = 0 THEN 'missing' ELSE 'hash' END AS detail FROM pages WHERE page_id % 7 = 0 OR page_id % 9 = 0""")
def validate_objects(spark, sf_dir):
    """Rows whose object is missing or differs."""
    return validate.objects_match(stored_rows(spark, sf_dir), objects(spark, sf_dir))


@query("validate_topology", """
WITH r AS (SELECT page_id, 'p/' || page_id AS path, CASE WHEN page_id % 4 = 0 THEN NULL ELSE md5(url) END AS o, CASE WHEN page_id % 2 = 0 THEN substr(url, 1, 22) END AS d, CASE WHEN page_id % 9 = 0 THEN '0' ELSE md5(html) END AS h FROM pages)
SELECT 'silver_tiene_bronze_teoria' AS "check", path AS key, o AS detail FROM r WHERE o IS NULL OR o NOT IN (SELECT md5(url) FROM pages WHERE page_id % 3 <> 0)
UNION ALL SELECT 'silver_tiene_objeto', path, 'silver-teoria' FROM r WHERE page_id % 7 = 0
UNION ALL SELECT 'claves_unicas', any_value(coalesce(d, h)), string_agg(path, ',' ORDER BY path) FROM r GROUP BY d IS NULL, coalesce(d, h) HAVING count(*) > 1""")
def validate_topology(spark, sf_dir):
    """Lineage, object and key checks of stored rows."""
    rows = stored_rows(spark, sf_dir)
    bronze = load(spark, sf_dir, "pages").where("page_id % 3 <> 0").select(F.md5("url").alias("hash_md5"))
    out = validate.has_bronze(rows, bronze).unionByName(validate.has_object(rows, objects(spark, sf_dir), "silver_tiene_objeto"))
    return out.unionByName(validate.unique_keys(rows, "claves_unicas"))


_COST = f"""{_MARKED}, c AS (SELECT (SELECT count(*) FROM documents) AS documentos, count(*) AS llamadas_segmentador,
  sum(ceil(({len(cost.SEGMENT_PROMPT)} + length(ventana)) / 4.0))::BIGINT AS tokens_segmentador,
  sum(ceil(({len(cost.STRUCTURE_PROMPT)} + length({strip_sql("regexp_replace(ventana, '\\[/?(?:REMATE|CHISTOIDE)\\]', '', 'g')")})) / 4.0))::BIGINT AS tokens_silver, count(*) AS llamadas_silver FROM win),
t AS (SELECT *, tokens_segmentador + tokens_silver AS tokens_totales FROM c)"""


@query("cost_estimate", f"WITH {_COST} SELECT *, round(tokens_totales / 1e6 * 0.1, 6) AS coste_eur_estimado FROM t")
def cost_estimate(spark, sf_dir):
    """Calls, tokens and euros of a run over marked documents."""
    return cost.estimate(marked(spark, sf_dir)).withColumn("coste_eur_estimado", F.round("coste_eur_estimado", 6))


@query("budget_gate", f"WITH {_COST} SELECT tokens_totales, tokens_totales <= 1000000 AS permitir, CASE WHEN tokens_totales > 1000000 THEN 'tokens' ELSE 'ok' END AS razon FROM t")
def budget_gate(spark, sf_dir):
    """The gate's decision on that run."""
    return cost.gate(cost.estimate(marked(spark, sf_dir))).select("tokens_totales", "permitir", "razon")


def raw_updates(spark, sf_dir):
    """Events as message updates: some are no messages, some empty, some repeat another's id."""
    e = load(spark, sf_dir, "events")
    k = F.col("event_id")
    chat = F.struct((F.col("user_id") % 50).alias("id"))
    message = F.struct(F.when(k % 6 == 0, "").otherwise(F.concat(F.lit("/chiste "), "event_type", F.lit(" @somebody "), k.cast("string"))).alias("text"), F.unix_timestamp("ts").alias("date"), chat.alias("chat"))
    return e.select(F.to_json(F.struct(F.when(k % 10 == 9, k - 9).otherwise(k).alias("update_id"), F.when(k % 7 != 0, message).alias("message"))).alias("value"))


_UPDATES = """u AS (SELECT event_id, CASE WHEN event_id % 10 = 9 THEN event_id - 9 ELSE event_id END AS id, CASE WHEN event_id % 7 <> 0 AND event_id % 6 <> 0 THEN '/chiste ' || event_type || ' @somebody ' || event_id END AS texto, user_id % 50 AS chat, date_trunc('second', ts) AS t FROM events)"""


@query("update_extract", f"WITH {_UPDATES} SELECT id AS telegram_update_id, CASE WHEN texto IS NOT NULL THEN chat END AS chat_id, texto AS texto_raw, CASE WHEN texto IS NOT NULL THEN t END AS timestamp_telegram FROM u")
def update_extract(spark, sf_dir):
    """Fields of every update."""
    return updates.extracted(raw_updates(spark, sf_dir)).drop("value")


@query("synchronous_leg", f"""
WITH {_UPDATES}, s AS (SELECT *, CASE WHEN texto IS NULL THEN 'ignorado' WHEN chat >= 20 THEN 'no_autorizado' WHEN id % 15 = 0 THEN 'duplicado' END AS o FROM u),
r AS (SELECT *, row_number() OVER (PARTITION BY id, o IS NULL ORDER BY t, texto) AS n FROM s)
SELECT id AS telegram_update_id, texto AS texto_raw, coalesce(o, CASE WHEN n > 1 THEN 'duplicado' ELSE 'aceptado' END) AS estado,
  CASE WHEN o IS NULL AND n = 1 THEN {strip_sql("regexp_replace(regexp_replace(texto, '^/[A-Za-z0-9_]+\\s*', ''), '@[A-Za-z][A-Za-z0-9_]{4,31}\\b', '', 'g')")} END AS texto_limpio FROM r""")
def synchronous_leg(spark, sf_dir):
    """Outcome and clean text of every update, against stored ids and an allow-list."""
    bronze = load(spark, sf_dir, "events").where("event_id % 15 = 0").select(F.col("event_id").alias("telegram_update_id"))
    found = updates.synchronous_leg(raw_updates(spark, sf_dir), bronze, list(range(20)))
    return found.select("telegram_update_id", "texto_raw", "estado", "texto_limpio")


@query("pruned_appends", """
WITH e AS (SELECT event_id AS id, event_id // 3 AS clave, event_type AS texto, CASE WHEN event_id % 100 = 99 THEN 9 ELSE floor(event_id * 9 / (SELECT max(event_id) + 1 FROM events)) END AS lote FROM events)
SELECT id, clave, texto FROM e QUALIFY row_number() OVER (PARTITION BY clave ORDER BY lote, id) = 1""")
def pruned_appends(spark, sf_dir):
    """What a keyed table holds after ten appends, of which the last repeats keys of all the others."""
    e = load(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.floor(F.col("event_id") / 3).alias("clave"), F.col("event_type").alias("texto"))
    size = e.agg(F.max("id") + 1).first()[0]
    lot = F.when(F.col("id") % 100 == 99, 9).otherwise(F.floor(F.col("id") * 9 / size))
    table = Keyed(spark, Scratch(spark, "appends").root)
    for k in range(10):
        table.append(e.where(lot == k), F.col("clave"), [F.col("id")])
    return table.read("id long, clave long, texto string")


_TURNED = """c AS (SELECT user_id, event_id, event_type, value, ts, floor(event_id * 6 / (SELECT max(event_id) + 1 FROM events))::BIGINT + 1 AS v FROM events QUALIFY row_number() OVER (PARTITION BY user_id, v ORDER BY event_id DESC) = 1),
t AS (SELECT unnest([2, 3, 5, 6])::BIGINT AS turno),
s AS (SELECT turno, user_id, arg_max({'x': CASE WHEN event_id % 5 > 0 THEN event_type END}, v) FILTER (event_id % 3 > 0 OR event_id % 5 = 0).x AS event_type, arg_max({'x': CASE WHEN event_id % 5 > 0 THEN value END}, v).x AS value, arg_max(event_id % 5 = 0, v) AS gone, max_by(ts, v) AS updated_at FROM c JOIN t ON v <= turno GROUP BY ALL)"""


@query("state_as_of", f"WITH {_TURNED} SELECT turno, user_id, event_type, value, updated_at FROM s WHERE NOT gone")
def state_as_of(spark, sf_dir):
    """The state of all users after the second, third, fifth and last of six turns of changes: some set one column, some end a user; a snapshot is taken after the third and the fourth."""
    e = load(spark, sf_dir, "events")
    size = e.agg(F.max("event_id") + 1).first()[0]
    turns = relational.latest(e.withColumn("turno", F.floor(F.col("event_id") * 6 / size) + 1), ["user_id", "turno"], [F.desc("event_id")])
    k = F.col("event_id")
    names = F.when(k % 3 == 0, F.array(F.lit("value"))).otherwise(F.array(F.lit("event_type"), F.lit("value")))
    turns = turns.select("turno", "user_id", "event_type", "value", "ts", (k % 5 == 0).alias("fin"), names.alias("dados"))
    scratch = Scratch(spark, "state")
    turns = scratch.write(turns, "turns")
    table = StateLog(spark, f"{scratch.root}/table", "user_id long, event_type string, value double", "user_id", 8)
    for n in range(1, 7):
        table.append(turns.where(F.col("turno") == n).drop("turno"), "ts", "fin", "dados")
        if n in (3, 4):
            table.compact()
    states = [table.as_of(n).withColumn("turno", F.lit(n).cast("long")) for n in (2, 3, 5, 6)]
    return states[0].unionByName(states[1]).unionByName(states[2]).unionByName(states[3])


_PAGES = "p AS (SELECT page_id, 'f' || page_id AS file_id, url AS name, '2024-' || lpad((page_id * 7919 % 1000)::VARCHAR, 4, '0') AS m FROM pages)"


@query("folder_snapshots", f"""
WITH {_PAGES}, u AS (SELECT file_id, name, m, 1 AS toma FROM p WHERE page_id % 3 > 0 UNION ALL SELECT file_id, name, CASE WHEN page_id % 5 = 0 THEN '2025-' || m ELSE m END, 2 FROM p)
SELECT file_id, name, m AS modified_time, min(toma) AS toma FROM u GROUP BY ALL""")
def folder_snapshots(spark, sf_dir):
    """States of all pages as files of a folder that a stream saw in two snapshots: the second lists them again, with late ones and changed ones. A run each."""
    k = F.col("page_id")
    time = F.concat(F.lit("2024-"), F.lpad((k * 7919 % 1000).cast("string"), 4, "0"))
    found = load(spark, sf_dir, "pages").select(k, F.concat(F.lit("f"), k.cast("string")).alias("file_id"), F.col("url").alias("name"), time.alias("modified_time"), F.lit("text/html").alias("mime_type"))
    root = Scratch(spark, "folder").root
    spark.dataSource.register(folder_stream.FolderStreamSource)
    again = found.withColumn("modified_time", F.when(k % 5 == 0, F.concat(F.lit("2025-"), "modified_time")).otherwise(F.col("modified_time")))
    for n, rows in ((1, found.where(k % 3 > 0)), (2, again)):
        folder_stream.write_pages(rows, f"{root}/in", n)
        stream = spark.readStream.format("folder_pages").option("path", f"{root}/in").load()
        stream.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(folder_stream.SCHEMA).parquet(f"{root}/out").select("file_id", "name", "modified_time", "toma")


@query("versioned_documents", """
WITH d AS (SELECT doc_id, 'd' || doc_id || '.md' AS nombre, text, len(text) - len(replace(text, chr(10), '')) + 1 AS n FROM documents),
m AS (SELECT 1 AS version, * FROM d WHERE doc_id % 2 = 0 UNION ALL SELECT 2, * FROM d)
SELECT version, doc_id, nombre, md5(text) AS md5, n AS num_fragmentos, count(*) OVER (PARTITION BY version) AS documentos, sum(n) OVER (PARTITION BY version)::BIGINT AS fragmentos FROM m""")
def versioned_documents(spark, sf_dir):
    """Documents of two versions as they are read back, with what their manifests say."""
    k = F.col("doc_id")
    lines = F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1
    docs = load(spark, sf_dir, "documents").select(k, F.concat(F.lit("d"), k.cast("string"), F.lit(".md")).alias("nombre"), F.col("text").alias("contenido"), lines.cast("long").alias("num_fragmentos"))
    root, out = Scratch(spark, "versions").root, None
    spark.dataSource.register(versions.VersionSink)
    for n, rows in ((1, docs.where(k % 2 == 0)), (2, docs)):
        rows.write.format("corpus_versions").option("path", root).mode("append").save()
        about = versions.manifest(root, n)
        facts = [F.lit(about[c]).cast("long").alias(c) for c in ("documentos", "fragmentos")]
        found = versions.read_version(spark, root, n).select(F.lit(n).alias("version"), "doc_id", "nombre", F.md5("contenido").alias("md5"), "num_fragmentos", *facts)
        out = found if out is None else out.unionByName(found)
    return out


@query("replayed_messages", """
WITH m AS (SELECT event_id AS id, event_id % 6 AS fallos, least(event_id % 6 + 1, 4) AS n, ts FROM events),
o AS (SELECT id, CASE WHEN fallos < 4 THEN 'procesado' ELSE 'abandonado' END AS estado, n::INTEGER AS intentos, CASE WHEN fallos >= 4 THEN 'fallo ' || n END AS error, ts + INTERVAL 10 MINUTE * (2 ** (n - 1) - 1)::INTEGER AS resuelto_at FROM m)
SELECT * FROM o WHERE intentos = 1 OR resuelto_at <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 HOUR FROM events)""")
def replayed_messages(spark, sf_dir):
    """Outcomes of all events as messages that fail some times, as far as the watermark has come at the end of the stream."""
    root, found = Scratch(spark, "replay").root, load(spark, sf_dir, "events")
    found.select(F.col("event_id").alias("id"), (F.col("event_id") % 6).cast("string").alias("texto"), "ts").write.parquet(f"{root}/in")
    rows = spark.readStream.schema(spark.read.parquet(f"{root}/in").schema).parquet(f"{root}/in")

    def attempt(some):
        return [None if int(t) < n else f"fallo {n}" for t, n in zip(some["texto"], some["intentos"], strict=True)]

    store = Store(spark, f"{root}/store")
    pending.replay_stream(store, rows, attempt, f"{root}/checkpoint").awaitTermination()
    return store.read("bronze", "chistes_telegram_resueltos", pending.OUTCOME)


@query("as_of_join", """
SELECT a.event_id, a.user_id, b.event_id AS compra_id, b.value AS compra FROM events a ASOF LEFT JOIN (SELECT user_id, ts, arg_max(event_id, event_id) AS event_id, arg_max(value, event_id) AS value FROM events WHERE event_id % 4 = 0 GROUP BY user_id, ts) b
ON a.user_id = b.user_id AND a.ts >= b.ts WHERE a.event_id % 4 <> 0""")
def as_of_join(spark, sf_dir):
    """For three events of four, the same user's latest one of the others not after it."""
    e = load(spark, sf_dir, "events")
    right = e.where("event_id % 4 = 0").select("user_id", "ts", F.col("event_id").alias("compra_id"), F.col("value").alias("compra"))
    return temporal.as_of(e.where("event_id % 4 <> 0").select("event_id", "user_id", "ts"), right, "user_id", "ts", ["compra_id", "compra"], "compra_id").drop("ts")


_SPANS = """s AS (SELECT doc_id, unnest(list_transform(range(0, length(text) // 97 + 1), lambda i: i)) AS i, length(text) AS n FROM documents),
asides AS (SELECT doc_id, i * 97 AS a, i * 97 + 1 + (i * 31) % 40 AS z FROM s), windows AS (SELECT doc_id, i * 97 - 20 AS b, i * 97 + CASE WHEN i % 11 = 0 THEN 900 ELSE 30 END AS y FROM s WHERE i % 2 = 0)"""


@query("asides_in_windows", f"WITH {_SPANS} SELECT doc_id, a, z, b, y FROM asides JOIN windows USING (doc_id) WHERE a < y AND b < z")
def asides_in_windows(spark, sf_dir):
    """Asides of all documents and the windows that they overlap, by offsets."""
    docs = load(spark, sf_dir, "documents").select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.length("text") / 97))).alias("i"))
    asides = docs.select("doc_id", (F.col("i") * 97).alias("a"), (F.col("i") * 97 + 1 + F.col("i") * 31 % 40).alias("z"))
    windows = docs.where("i % 2 = 0").select("doc_id", (F.col("i") * 97 - 20).alias("b"), (F.col("i") * 97 + F.when(F.col("i") % 11 == 0, 900).otherwise(30)).alias("y"))
    return temporal.overlapping(asides, windows, "doc_id", "a", "z", "b", "y")


@query("pending_events", "SELECT event_id AS id, event_type AS texto_raw FROM events WHERE event_id % 3 <> 1")
def pending_events(spark, sf_dir):
    """Events without a processed mark."""
    e = load(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("texto_raw"))
    done = e.where("id % 3 = 1").select(F.col("id").alias("_done"))
    return relational.pending(e, done, F.col("id") == F.col("_done"))


_NFD = "text || ' e' || chr(769) || 'l n' || chr(771) || 'u'"


@query("message_nfc", f"SELECT conv_id * 1000 + turn AS id, {strip_sql(f'nfc_normalize({_NFD})')} AS texto FROM conversations")
def message_nfc(spark, sf_dir):
    """Clean texts of messages in which letters and their accents stand apart."""
    rows = load(spark, sf_dir, "conversations")
    body = F.concat(F.lit("/chiste "), "text", F.lit(" e\u0301l n\u0303u"))
    message = F.struct(body.alias("text"), F.lit(0).alias("date"), F.struct(F.lit(1).alias("id")).alias("chat"))
    raw = rows.select(F.to_json(F.struct((F.col("conv_id") * 1000 + F.col("turn")).alias("update_id"), message.alias("message"))).alias("value"))
    none = spark.createDataFrame([], "telegram_update_id long")
    return updates.synchronous_leg(raw, none, [1]).select(F.col("telegram_update_id").alias("id"), F.col("texto_limpio").alias("texto"))


@query("sliding_window", """
SELECT w AS inicio, event_type, count(*) AS n, round(sum(value), 4) AS total
FROM (SELECT *, unnest([time_bucket(INTERVAL 30 MINUTE, ts), time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE]) AS w FROM events) GROUP BY 1, 2""")
def sliding_window(spark, sf_dir):
    """Counts and sums of hours that begin every half hour."""
    w = updates.windowed(load(spark, sf_dir, "events"), "sliding", "1 hour", "30 minutes")
    return w.select(F.col("w.start").alias("inicio"), "event_type", "n", F.round("total", 4).alias("total"))


@query("bronze_pairs", """
WITH r AS (SELECT 'p/' || page_id AS path, CASE WHEN page_id % 2 = 0 THEN substr(url, 1, 22) END AS d, CASE WHEN page_id % 2 = 0 THEN 't' END AS m FROM pages),
b AS (SELECT substr(url, 1, 22) AS d, CASE WHEN page_id % 5 = 0 THEN 'u' ELSE 't' END AS m FROM pages WHERE page_id % 3 <> 0)
SELECT 'silver_tiene_bronze_historico' AS "check", path AS key, concat_ws('@', d, m) AS detail FROM r WHERE d IS NULL OR NOT EXISTS (SELECT 1 FROM b WHERE b.d = r.d AND b.m = r.m)""")
def bronze_pairs(spark, sf_dir):
    """Stored rows whose drive id and time no Bronze row has together."""
    pages = load(spark, sf_dir, "pages").where("page_id % 3 <> 0")
    bronze = pages.select(F.substring("url", 1, 22).alias("drive_file_id"), F.when(F.col("page_id") % 5 == 0, "u").otherwise("t").alias("modified_time"))
    return validate.has_bronze_pair(stored_rows(spark, sf_dir), bronze)


@query("allow_list", "SELECT event_id, user_id FROM events WHERE user_id IN (1, 2, 3, 5, 8, 13)")
def allow_list(spark, sf_dir):
    """Events of listed users."""
    allowed = updates.allow_list(" 1, 2,3 ,5,8,13,")
    return load(spark, sf_dir, "events").where(F.col("user_id").isin(*allowed)).select("event_id", "user_id")


@query("tumbling_window", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS inicio, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def tumbling_window(spark, sf_dir):
    """Hourly counts and sums."""
    w = updates.windowed(load(spark, sf_dir, "events"), "tumbling", "1 hour")
    return w.select(F.col("w.start").alias("inicio"), "event_type", "n", F.round("total", 4).alias("total"))


@query("session_window", """
WITH l AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 10 MINUTE THEN 0 ELSE 1 END AS b FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)),
s AS (SELECT *, sum(b) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS k FROM l)
SELECT min(ts) AS inicio, event_type, count(*) AS n, round(sum(value), 4) AS total FROM s GROUP BY event_type, k""")
def session_window(spark, sf_dir):
    """Sessions of events ten minutes apart at most."""
    w = updates.windowed(load(spark, sf_dir, "events"), "session", "10 minutes")
    return w.select(F.col("w.start").alias("inicio"), "event_type", "n", F.round("total", 4).alias("total"))


_MIME = "CASE s_suppkey % 4 WHEN 0 THEN 'application/pdf' WHEN 1 THEN 'application/vnd.google-apps.document' WHEN 2 THEN 'image/png' ELSE 'text/plain' END"


@query("folder_listing", f"""
WITH f AS (SELECT 'f' || s_suppkey AS file_id, CASE WHEN s_suppkey % 8 = 0 THEN s_name || '.PDF' ELSE s_name END AS name, 't' || s_nationkey AS modified_time, {_MIME} AS mime_type, s_suppkey AS k FROM supplier)
SELECT file_id, name, modified_time, CASE k % 4 WHEN 0 THEN 'application/pdf' WHEN 1 THEN '{listing.DOCX}' ELSE 'text/plain' END AS mime_salida,
  CASE WHEN k % 8 = 0 THEN name WHEN k % 4 = 0 THEN name || '.pdf' WHEN k % 4 = 1 THEN name || '.docx' ELSE name || '.txt' END AS nombre_local
FROM f WHERE k % 4 <> 2 AND k % 5 <> 0""")
def folder_listing(spark, sf_dir):
    """Files of a listing that are taken and not yet known, with output types and local names."""
    k = F.col("s_suppkey")
    mime = F.when(k % 4 == 0, "application/pdf").when(k % 4 == 1, "application/vnd.google-apps.document").when(k % 4 == 2, "image/png").otherwise("text/plain")
    name = F.when(k % 8 == 0, F.concat("s_name", F.lit(".PDF"))).otherwise(F.col("s_name"))
    found = load(spark, sf_dir, "supplier").select(F.concat(F.lit("f"), k.cast("string")).alias("file_id"), name.alias("name"), F.concat(F.lit("t"), F.col("s_nationkey").cast("string")).alias("modified_time"), mime.alias("mime_type"), k.alias("k"))
    fresh = listing.new_files(found, found.where("k % 5 = 0"))
    return listing.with_local_names(fresh, listing.THEORY_TYPES).select("file_id", "name", "modified_time", "mime_salida", "nombre_local")


@query("incremental_scan", "SELECT 'd' || doc_id || '.txt' AS path, md5(text) AS md5 FROM documents WHERE NOT (doc_id % 2 = 0 AND doc_id % 6 <> 0)")
def incremental_scan(spark, sf_dir):
    """Files that are new or changed since the state was written: it has half of them, and every sixth with another hash."""
    rows = load(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"), F.md5("text").alias("md5"))
    state = rows.where("doc_id % 2 = 0").select("path", F.when(F.col("doc_id") % 6 == 0, F.lit("old")).otherwise(F.col("md5")).alias("md5"))
    return files.changed(rows, state).select("path", "md5")


@query("parser_dispatch", """
WITH e AS (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN '.TXT' WHEN 1 THEN '.pdf' WHEN 2 THEN '.Epub' WHEN 3 THEN '.docx' ELSE '.xls' END AS x FROM documents)
SELECT doc_id, lower(x) AS ext, CASE lower(x) WHEN '.txt' THEN 'transcripcion_curso' ELSE 'teoria' END AS tipo_fuente, lower(x) <> '.xls' AS elegible FROM e""")
def parser_dispatch(spark, sf_dir):
    """Kind of source by extension; files without a parser are set aside."""
    k = F.col("doc_id")
    name = F.concat(F.lit("/a.b/f"), F.when(k % 5 == 0, ".TXT").when(k % 5 == 1, ".pdf").when(k % 5 == 2, ".Epub").when(k % 5 == 3, ".docx").otherwise(".xls"))
    rows = load(spark, sf_dir, "documents").select("doc_id", F.lower(F.regexp_extract(name, r"(\.[^./]*)$", 1)).alias("ext"))
    good, other = files.eligible(rows)
    return good.withColumn("elegible", F.lit(True)).unionByName(other.withColumn("elegible", F.lit(False)))


@query("ocr_decision", f"SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN false ELSE length({strip_sql('text')}) / (doc_id % 9 * 10)::DOUBLE < 30 END AS ocr FROM documents")
def ocr_decision(spark, sf_dir):
    """Whether a document of so many pages needs OCR."""
    return load(spark, sf_dir, "documents").select("doc_id", files.needs_ocr(F.col("text"), F.col("doc_id") % 9 * 10).alias("ocr"))


@query("ocr_page_merge", f"WITH l AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: {strip_sql('x')}), lambda x: x <> '') AS l FROM documents) SELECT doc_id, array_to_string(l, chr(10) || chr(10)) AS texto FROM l")
def ocr_page_merge(spark, sf_dir):
    """Lines taken as OCR pages, merged."""
    return load(spark, sf_dir, "documents").select("doc_id", files.merged_pages(F.split("text", "\n", -1)).alias("texto"))


@query("destination_lookup", "SELECT flow, layer, layer || '-' || flow AS bucket, layer AS \"schema\", flow || '_documentos' AS \"table\" FROM (VALUES ('teoria'), ('historico')) f(flow), (VALUES ('bronze'), ('silver')) l(layer)")
def destination_lookup(spark, sf_dir):
    """Where each layer and flow is stored."""
    rows = [(flow, layer, *keys.destination(layer, flow)) for layer, flow in keys.DESTINATIONS]
    return spark.createDataFrame(rows, "flow string, layer string, bucket string, schema string, `table` string")


@query("header_check", None)
def header_check(spark, sf_dir):
    """Rendered documents read back and checked: those in other languages than the allowed ones fail."""
    from lorewright.operators.fragments import parse_documents

    p = parse_documents(rendered(spark, sf_dir)).withColumn("path", F.col("doc_id").cast("string"))
    return validate.document_checks(p, ("min_palabras", "max_palabras", "idiomas_permitidos", "cabecera_completa", "sin_timestamps"))


QUERIES["header_check"] = (header_check, f"""
WITH {fragments_sql("concat('Bueno, el caso, el caso, digamos, no cambia. Por ejemplo, o sea, bueno, esto. Eh, sigue ', text)")}, d AS (SELECT * FROM documents),
f AS (SELECT frag.doc_id, frag.pos, lang FROM frag JOIN d USING (doc_id)), w AS (SELECT doc_id, sum(len(regexp_extract_all(texto, '[^\\s]+'))) AS n FROM frag GROUP BY doc_id)
SELECT 'min_palabras' AS "check", doc_id::VARCHAR AS key, n::VARCHAR AS detail FROM w WHERE n < 100
UNION ALL SELECT 'max_palabras', doc_id::VARCHAR, n::VARCHAR FROM w WHERE n > 50000
UNION ALL SELECT 'idiomas_permitidos', doc_id::VARCHAR, pos || ':idioma_original:' || lang FROM f WHERE lang NOT IN ('en', 'es')
UNION ALL SELECT 'idiomas_permitidos', doc_id::VARCHAR, '1:idioma_fragmento:' || lang FROM d WHERE lang NOT IN ('en', 'es')""")
