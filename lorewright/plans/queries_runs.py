"""Queries of what runs with models and state are made of: prompts, contracts of answers, names, candidates, marked documents, the gate's preview."""

from __future__ import annotations

from pyspark.sql import functions as F

from lorewright.functions import contracts
from lorewright.operators import cost, marking, taxonomy
from lorewright.plans import runs
from lorewright.plans.binding import load, register, strip_sql
from lorewright.sources import catalog
from lorewright.sources.scratch import Scratch
from lorewright.sources.store import Store

QUERIES: dict = {}
query = lambda name, sql=None: register(QUERIES, name, sql)
quoted = lambda s: "'" + s.replace("'", "''") + "'"


@query("model_prompts", f"""
SELECT doc_id, md5({quoted(cost.STRUCTURE_PROMPT)} || text) AS estructura, md5({quoted(cost.SEGMENT_PROMPT)} || text) AS segmento,
  md5('Name the tema of this joke in a few words.' || chr(10) || chr(10) || text) AS libre,
  md5('Name the tema of this joke in a few words.' || chr(10) || chr(10) || text || chr(10) || chr(10) || 'Choose one of these, or answer {taxonomy.NO_MATCH}:' || chr(10) || '- ' || source || chr(10) || '- otro') AS cerrado FROM documents""")
def model_prompts(spark, sf_dir):
    """Hashes of all prompts about every document."""
    t, names = F.col("text"), F.array("source", F.lit("otro"))
    prompts = {"estructura": contracts.structure_prompt(t), "segmento": contracts.segment_prompt(t), "libre": contracts.label_prompt(t, "tema", 1), "cerrado": contracts.label_prompt(t, "tema", 2, names)}
    return load(spark, sf_dir, "documents").select("doc_id", *[F.md5(p).alias(n) for n, p in prompts.items()])


@query("model_answers", """
WITH a AS (SELECT *, doc_id % 8 AS k FROM documents)
SELECT doc_id, CASE WHEN k IN (0, 7) THEN md5(text) END AS texto, CASE WHEN k IN (0, 7) THEN source END AS tema, CASE WHEN k IN (0, 7) THEN 'rematado' END AS estado,
  CASE k WHEN 1 THEN 'tema is missing' WHEN 2 THEN 'estado: unknown value acabado' WHEN 3 THEN 'no JSON' WHEN 4 THEN 'no object' WHEN 5 THEN 'no JSON' WHEN 6 THEN 'tema is no string' END AS error,
  CASE WHEN k IN (0, 7) THEN left(text, 20) END AS inicio, CASE k WHEN 3 THEN 'no JSON' WHEN 4 THEN 'no object' WHEN 5 THEN 'no JSON' ELSE CASE WHEN k IN (0, 7) THEN NULL ELSE 'inicio is missing' END END AS error_inicio FROM a""")
def model_answers(spark, sf_dir):
    """Answers about every document, most of them broken in one of six ways, as the two contracts take them."""
    k = F.col("doc_id") % 8
    good = k.isin(0, 7)
    tema = F.when(k == 6, F.to_json(F.struct(F.lit(7).alias("tema")))).when(k != 1, F.to_json(F.struct(F.col("source").alias("tema"))))
    rest = F.to_json(F.struct(F.col("text").alias("texto_normalizado"), F.lit("lista").alias("estructura"), F.when(k == 2, "acabado").otherwise("rematado").alias("estado"), F.lit("").alias("sugerencias"), F.when(good, F.left("text", F.lit(20))).alias("inicio"), F.when(k == 7, "x").alias("otro")))
    whole = F.when(tema.isNull(), rest).otherwise(F.concat(F.substr(rest, F.lit(1), F.length(rest) - 1), F.lit(","), F.substr(tema, F.lit(2))))
    raw = F.when(k == 3, F.lit(None).cast("string")).when(k == 4, F.lit("[1]")).when(k == 5, F.concat(F.lit("The joke: "), "text")).otherwise(whole)
    docs = load(spark, sf_dir, "documents").withColumn("a", contracts.answer(raw)).withColumn("b", contracts.answer(raw, contracts.SEGMENT_FIELDS, {}))
    return docs.select("doc_id", F.md5("a.texto_normalizado").alias("texto"), "a.tema", "a.estado", "a.error", "b.inicio", F.col("b.error").alias("error_inicio"))


@query("names_filed", """
WITH a AS (SELECT DISTINCT source AS nombre FROM documents WHERE doc_id % 2 = 0 AND source IS NOT NULL), b AS (SELECT source AS nombre FROM documents UNION SELECT lang FROM documents),
c AS (SELECT nombre FROM b WHERE nombre IS NOT NULL AND nombre NOT IN (SELECT nombre FROM a))
SELECT row_number() OVER (ORDER BY nombre) AS id, nombre FROM a UNION ALL SELECT (SELECT count(*) FROM a) + row_number() OVER (ORDER BY nombre), nombre FROM c""")
def names_filed(spark, sf_dir):
    """Topics after sources of half of the documents, then sources and languages of all of them are added, and once more."""
    docs = load(spark, sf_dir, "documents")
    store = Store(spark, Scratch(spark, "names").root)
    every = docs.select(F.col("source").alias("nombre")).unionByName(docs.select(F.col("lang").alias("nombre")))
    catalog.added(store, "temas", docs.where("doc_id % 2 = 0"), "source")
    catalog.added(store, "temas", every)
    catalog.added(store, "temas", every)
    return catalog.listed(store, "temas")


@query("candidate_states", """
WITH c AS (SELECT DISTINCT coalesce(source, '') || '/' || coalesce(lang, 'und') AS texto, coalesce(lang, 'und') AS l, coalesce(source, '') AS s FROM documents)
SELECT 'tema' AS tipo, texto, CASE WHEN s = (SELECT min(s) FROM c) THEN 'rechazado' WHEN l = 'en' THEN 'aprobado' ELSE 'pendiente' END AS estado FROM c""")
def candidate_states(spark, sf_dir):
    """Candidates by state after all documents' pairs of source and language are queued twice, the English ones approved, and then those of the first source rejected."""
    source, lang = F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("und"))
    rows = load(spark, sf_dir, "documents").select(F.lit("tema").alias("tipo"), F.concat_ws("/", source, lang).alias("texto"), lang.alias("l"), source.alias("s"))
    store = Store(spark, Scratch(spark, "candidates").root)
    catalog.queued(store, rows.select("tipo", "texto"))
    catalog.queued(store, rows.select("tipo", "texto"))
    known = catalog.in_state(store).select("id", "texto")
    catalog.moved(store, known.where(F.endswith("texto", F.lit("/en"))), "aprobado")
    least = rows.agg(F.min("s")).first()[0] or ""
    catalog.moved(store, known.where(F.startswith("texto", F.lit(least + "/"))), "rechazado")
    states = [catalog.in_state(store, s).select("tipo", "texto", "estado") for s in catalog.STATES]
    return states[0].unionByName(states[1]).unionByName(states[2])


def coloured_turns(spark, sf_dir):
    """Conversations as coloured documents: a turn is a paragraph, its words two runs of one colour, red, dark red or none by turn, between two plain runs."""
    words = F.trim(F.regexp_replace("text", r"\P{L}+", " "))
    first = F.regexp_extract("w", r"^(\S+ )", 1)
    rows = load(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").cast("int").alias("para"), words.alias("w"))
    colour = F.when(F.col("para") % 3 == 0, "FF0000").when(F.col("para") % 3 == 1, "980000")
    one = lambda k, t, c: F.struct(F.lit(k).alias("run"), c.alias("color"), t.alias("texto"))
    none = F.lit(None).cast("string")
    parts = F.array(one(0, F.lit("ini "), none), one(1, first, colour), one(2, F.substr("w", F.length(first) + 1), colour), one(3, F.lit(" fin"), none))
    return rows.select("doc_id", "para", F.explode(parts).alias("x")).select("doc_id", "para", "x.run", "x.color", "x.texto")


_MARKDOWN = """w AS (SELECT conv_id AS doc_id, turn, trim(regexp_replace(text, '[^\\p{L}]+', ' ', 'g')) AS w FROM conversations),
p AS (SELECT doc_id, turn, 'ini ' || CASE WHEN w = '' OR turn % 3 = 2 THEN w WHEN turn % 3 = 0 THEN '[REMATE]' || w || '[/REMATE]' ELSE '[CHISTOIDE]' || w || '[/CHISTOIDE]' END || ' fin' AS p FROM w),
d AS (SELECT doc_id, string_agg(p, chr(10) || chr(10) ORDER BY turn) || chr(10) AS markdown FROM p GROUP BY doc_id)"""


@query("markdown_assembly", f"WITH {_MARKDOWN} SELECT doc_id, markdown FROM d")
def markdown_assembly(spark, sf_dir):
    """The marked Markdown of all conversations."""
    return marking.marked_text(coloured_turns(spark, sf_dir))


@query("gate_preview", f"""
WITH {_MARKDOWN}, v AS (SELECT unnest(regexp_extract_all(markdown, '(?s)(.*?\\[REMATE\\].*?\\[/REMATE\\])')) AS v FROM d WHERE doc_id % 3 > 0),
c AS (SELECT (SELECT count(*) FROM d WHERE doc_id % 3 > 0) AS documentos, count(*) AS llamadas_segmentador, coalesce(sum(ceil(({len(cost.SEGMENT_PROMPT)} + length(v)) / 4.0)), 0)::BIGINT AS tokens_segmentador,
  coalesce(sum(ceil(({len(cost.STRUCTURE_PROMPT)} + length({strip_sql("regexp_replace(v, '\\[/?(?:REMATE|CHISTOIDE)\\]', '', 'g')")})) / 4.0)), 0)::BIGINT AS tokens_silver FROM v)
SELECT documentos, llamadas_segmentador, tokens_segmentador, tokens_silver, tokens_segmentador + tokens_silver <= 20000 AS permitir FROM c""")
def gate_preview(spark, sf_dir):
    """The gate's decision, at 20,000 tokens, on the conversations that are not finished: every third one is, in this state."""
    store, found = Store(spark, Scratch(spark, "preview").root), coloured_turns(spark, sf_dir)
    known = runs.pending_documents(store, found).select(F.col("doc_id").cast("string").alias("doc_id"), "md5").distinct()
    store.append_new(known.where("cast(doc_id as long) % 3 = 0").withColumn("procesado_at", F.current_timestamp()), "silver", "historico_estado", F.struct("doc_id", "md5"), [F.col("md5")])
    return runs.preview(store, found, 20_000).select("documentos", "llamadas_segmentador", "tokens_segmentador", "tokens_silver", "permitir")
