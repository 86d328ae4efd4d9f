"""Queries of the relational operators over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lorewright.functions import markup, text, vectors
from lorewright.operators import fragments, marking, reconcile, relational, sketches, taxonomy, transcripts, validate
from lorewright.plans.binding import PREFIX, SUBTYPE_SQL, fragments_sql, load, quality_sql, register, words_sql
from lorewright.sources.keyed import Keyed
from lorewright.sources.scratch import Scratch

QUERIES: dict = {}
query = lambda name, sql=None: register(QUERIES, name, sql)


@query("latest_per_key", """
SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS r FROM orders) WHERE r = 1""")
def latest_per_key(spark, sf_dir):
    """Each customer's latest order."""
    return relational.latest(load(spark, sf_dir, "orders"), ["o_custkey"], [F.desc("o_orderdate"), F.asc("o_orderkey")]).select("o_custkey", "o_orderkey", "o_orderdate")


@query("pending_anti_join", "SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def pending_anti_join(spark, sf_dir):
    """Documents without a label."""
    docs, done = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels").select(F.col("doc_id").alias("done"))
    return relational.pending(docs, done, docs["doc_id"] == done["done"]).select("doc_id", "lang")


@query("pending_incomplete", """
WITH n AS (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1), e AS (SELECT l_orderkey, count(*) AS expected FROM lineitem GROUP BY 1)
SELECT l_orderkey, expected FROM e LEFT JOIN n USING (l_orderkey) WHERE coalesce(n, 0) < expected""")
def pending_incomplete(spark, sf_dir):
    """Orders of which some lines aren't done: the stricter pending rule."""
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag")
    expected = lines.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("expected"))
    return relational.incomplete(expected, "expected", lines.where("l_returnflag <> 'R'"), "l_orderkey", "l_orderkey")


_SILVER = "(SELECT doc_id AS id, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE md5(text) END AS origen_hash_md5 FROM documents)"
_BRONZE = "(SELECT md5(text) AS hash_md5 FROM documents WHERE doc_id % 3 <> 0)"


@query("lineage_check", f"SELECT id, origen_hash_md5 FROM {_SILVER} s WHERE NOT EXISTS (SELECT 1 FROM {_BRONZE} b WHERE b.hash_md5 IS NOT DISTINCT FROM s.origen_hash_md5)")
def lineage_check(spark, sf_dir):
    """Silver rows whose origin no Bronze row has; null is a value."""
    docs = load(spark, sf_dir, "documents").withColumn("h", F.md5("text"))
    silver = docs.select(F.col("doc_id").alias("id"), F.when(F.col("doc_id") % 7 != 0, F.col("h")).alias("origen_hash_md5"))
    return relational.orphans(silver, docs.where("doc_id % 3 <> 0").select(F.col("h").alias("hash_md5")), [("origen_hash_md5", "hash_md5")])


@query("lineage_pair_check", """
WITH s AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey END AS k, o_orderpriority AS t FROM orders),
b AS (SELECT o_custkey AS k, o_orderpriority AS t FROM orders WHERE o_orderstatus = 'F')
SELECT id, k, t FROM s WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.k IS NOT DISTINCT FROM s.k AND b.t IS NOT DISTINCT FROM s.t)""")
def lineage_pair_check(spark, sf_dir):
    """Rows whose pair of values no finished row has."""
    orders = load(spark, sf_dir, "orders")
    s = orders.select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey")).alias("k"), F.col("o_orderpriority").alias("t"))
    b = orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k"), F.col("o_orderpriority").alias("t"))
    return relational.orphans(s, b, [("k", "k"), ("t", "t")])


@query("unique_keys", """
WITH r AS (SELECT doc_id, doc_id % 4 = 0 AS legacy, CASE WHEN doc_id % 4 = 0 THEN md5(text) ELSE source END AS key, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE lang END AS time FROM documents)
SELECT legacy, key, time, count(*) AS n, list_sort(list(doc_id::VARCHAR)) AS ids FROM r GROUP BY legacy, key, time HAVING count(*) > 1""")
def unique_keys(spark, sf_dir):
    """Idempotency keys that several rows hold, in both modes."""
    docs = load(spark, sf_dir, "documents")
    rows = docs.select(F.col("doc_id").alias("id"), F.when(F.col("doc_id") % 4 != 0, F.col("source")).alias("drive_file_id"), F.when(F.col("doc_id") % 4 != 0, F.col("lang")).alias("modified_time"), F.md5("text").alias("hash_md5"))
    return relational.repeated_keys(rows, "id")


@query("lookup_or_create", """
WITH d AS (SELECT row_number() OVER (ORDER BY source) AS id, source AS nombre FROM (SELECT DISTINCT source FROM documents WHERE doc_id % 10 = 0 AND source < 'src3')),
n AS (SELECT (SELECT max(id) FROM d) + row_number() OVER (ORDER BY source) AS id, source AS nombre FROM (SELECT DISTINCT source FROM documents WHERE source NOT IN (SELECT nombre FROM d)))
SELECT doc_id, source, id FROM documents JOIN (SELECT * FROM d UNION ALL SELECT * FROM n) x ON x.nombre = documents.source""")
def lookup_or_create(spark, sf_dir):
    """Documents with their source's key; sources that the dimension lacks get new ones."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "source")
    known = docs.where("doc_id % 10 = 0 and source < 'src3'").select(F.col("source").alias("nombre")).distinct()
    dim = relational.numbered(known, [F.col("nombre")], "id")
    return relational.with_keys(docs, dim, "source")[0].select("doc_id", "source", "id")


@query("candidate_filter", "SELECT vec_id AS id, 'h' || vec_id AS hash_normalizado FROM embeddings WHERE (CASE WHEN label % 2 = 0 THEN 'propio' ELSE 'propio_historico' END) IN ('propio_historico')")
def candidate_filter(spark, sf_dir):
    """Candidates of one kind."""
    jokes = load(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.concat(F.lit("h"), F.col("vec_id").cast("string")).alias("hash_normalizado"), "embedding", F.when(F.col("label") % 2 == 0, "propio").otherwise("propio_historico").alias("tipo_fuente"))
    return reconcile.candidates(jokes, ("propio_historico",)).select("id", "hash_normalizado")


@query("duplicate_groups", "SELECT md5(text) AS hash, list_sort(list(doc_id::VARCHAR)) AS rutas FROM documents GROUP BY 1 HAVING count(*) > 1")
def duplicate_groups(spark, sf_dir):
    """Documents with equal content."""
    return validate.duplicate_groups(load(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("path"), F.col("text").alias("contenido")))


@query("foreign_keys", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 20)")
def foreign_keys(spark, sf_dir):
    """Lines whose supplier isn't in the dimension."""
    suppliers = load(spark, sf_dir, "supplier").where("s_nationkey < 20")
    return relational.foreign(load(spark, sf_dir, "lineitem"), "l_suppkey", suppliers, "s_suppkey").select("l_orderkey", "l_linenumber")


@query("new_rows", """
SELECT o_custkey, o_orderpriority, min(o_orderkey) AS o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM orders s WHERE s.o_orderstatus = 'F' AND s.o_custkey = o.o_custkey AND s.o_orderpriority = o.o_orderpriority) GROUP BY 1, 2""")
def new_rows(spark, sf_dir):
    """One row of each key that isn't stored."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    rows = orders.drop("o_orderstatus")
    return relational.new_rows(rows, orders.where("o_orderstatus = 'F'"), ["o_custkey", "o_orderpriority"]).select("o_custkey", "o_orderpriority", "o_orderkey")


def rendered(spark, sf_dir):
    """Every document rendered from its fragments, with markers put in."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.concat(F.lit(PREFIX), "text").alias("text"))
    facts = {"fuente": F.concat(F.lit('a "quoted\\" '), "source"), "tipo_fuente": F.lit("teoria"), "autor": F.lit(None).cast("string"), "licencia": F.lit(None).cast("string")}
    found = fragments.split_documents(docs, keep=["lang", "source"]).withColumns(facts)
    return fragments.render_documents(fragments.localised(found, F.col("lang")))


_RENDER = f"""
{fragments_sql(f"concat({PREFIX!r}, text)")},
s AS (SELECT f.doc_id, f.pos, f.texto, {SUBTYPE_SQL} AS subtipo, d.lang FROM frag f JOIN documents d USING (doc_id)),
l AS (SELECT *, CASE WHEN subtipo <> 'ejemplo' AND lang <> 'es' THEN 'es' ELSE lang END AS own FROM s),
r AS (SELECT doc_id, '---' || chr(10) || 'fuente: "' || replace(replace('a "quoted\\" ' || any_value(source), '\\', '\\\\'), '"', '\\"') || '"' || chr(10) || 'autor: null' || chr(10) || 'tipo_fuente: "teoria"' || chr(10) || 'licencia: "personal_only"' || chr(10) || 'fragmentos:' || chr(10)
  || string_agg('  - subtipo: "' || subtipo || '"' || chr(10) || '    idioma_original: "' || l.lang || '"' || chr(10) || '    idioma_fragmento: "' || own || '"', chr(10) ORDER BY pos) || chr(10) || '---' || chr(10) || chr(10)
  || string_agg(texto, chr(10) || chr(10) ORDER BY pos) || chr(10) AS contenido FROM l JOIN documents USING (doc_id) GROUP BY doc_id)"""


@query("render_yaml", f"WITH {_RENDER.lstrip()} SELECT doc_id, contenido FROM r")
def render_yaml(spark, sf_dir):
    """Rendered documents."""
    return rendered(spark, sf_dir)


@query("parse_yaml", f"""WITH {_RENDER.lstrip()}
SELECT r.doc_id, 'a "quoted\\" ' || source AS fuente, NULL::VARCHAR AS autor, count(*) AS fragmentos, count(*) FILTER (subtipo = 'ejemplo') AS ejemplos, min(own) AS idioma
FROM r JOIN l USING (doc_id) JOIN documents d ON d.doc_id = r.doc_id GROUP BY r.doc_id, source""")
def parse_yaml(spark, sf_dir):
    """Fields read back from rendered documents."""
    p = fragments.parse_documents(rendered(spark, sf_dir))
    each = lambda name: F.transform("fragmentos_meta", lambda f: F.try_element_at(f, F.lit(name)))
    of = lambda name: F.try_element_at("metadatos", F.lit(name)).alias(name)
    examples = F.size(F.filter(each("subtipo"), lambda s: s == "ejemplo")).cast("long")
    return p.select("doc_id", of("fuente"), of("autor"), F.size("fragmentos_meta").cast("long").alias("fragmentos"), examples.alias("ejemplos"), F.array_min(each("idioma_fragmento")).alias("idioma"))


@query("chunk_body", f"WITH {_RENDER.lstrip()}, c AS (SELECT doc_id, string_split(trim(string_agg(texto, chr(10) || chr(10) ORDER BY pos), chr(10)), chr(10) || chr(10)) AS l FROM l GROUP BY doc_id) SELECT doc_id, unnest(l) AS chunk, (generate_subscripts(l, 1) - 1)::INTEGER AS chunk_index FROM c")
def chunk_body(spark, sf_dir):
    """Chunks of rendered documents."""
    return fragments.chunk_documents(rendered(spark, sf_dir))


@query("version_stats", f"""
WITH {fragments_sql()}, q AS (SELECT doc_id, {quality_sql('w')} AS q FROM (SELECT doc_id, {words_sql('texto')} AS w FROM frag))
SELECT doc_id, grouping(doc_id) = 1 AS total, count(*) AS num_fragmentos, count(DISTINCT doc_id) AS num_documentos, round(avg(q), 6) AS media, round(min(q), 6) AS minimo, round(max(q), 6) AS maximo FROM q GROUP BY GROUPING SETS ((doc_id), ())""")
def version_stats(spark, sf_dir):
    """Statistics per document and for the version."""
    found = fragments.version_statistics(fragments.split_documents(load(spark, sf_dir, "documents")))
    return found.withColumns({c: F.round(c, 6) for c in ("media", "minimo", "maximo")})


@query("merged_statistics", f"""
WITH {fragments_sql()}, q AS (SELECT doc_id, {quality_sql('w')} AS q FROM (SELECT doc_id, {words_sql('texto')} AS w FROM frag))
SELECT unnest(['documentos', 'textos', 'rango 0.1', 'rango 0.5', 'rango 0.9']) AS medida, n AS num_fragmentos, round(media, 6) AS media, round(minimo, 6) AS minimo, round(maximo, 6) AS maximo, true AS dentro
FROM (SELECT count(*) AS n, coalesce(avg(q), 0) AS media, coalesce(min(q), 0) AS minimo, coalesce(max(q), 0) AS maximo FROM q)""")
def merged_statistics(spark, sf_dir):
    """A version's statistics from the stored rows of ten batches, seven of them offered twice, and whether each estimate is within its bound of the exact figure."""
    found = fragments.split_documents(load(spark, sf_dir, "documents")).select("doc_id", "texto")
    scratch = Scratch(spark, "sketches")
    table, batch, ranks = Keyed(spark, f"{scratch.root}/table"), F.col("doc_id") % 10, (0.1, 0.5, 0.9)
    sketches.stored(table, found.where(batch < 7), batch)
    sketches.stored(table, found, batch)
    got = scratch.write(sketches.merged(table.read(sketches.COLUMNS), ranks), "merged")
    texts = found.groupBy("texto").agg(F.count(F.lit(1)).alias("n"), F.coalesce(text.quality(F.col("texto")), F.lit(0.0)).alias("q"))
    near = lambda c, n: F.abs(F.col(c) - F.col(n)) <= F.col(n) * sketches.DISTINCT_BOUND
    below = [F.sum(F.when(F.col("q") < F.col("cuantiles")[k], F.col("n")).otherwise(0)).alias(f"l{k}") for k in range(3)]
    upto = [F.sum(F.when(F.col("q") <= F.col("cuantiles")[k], F.col("n")).otherwise(0)).alias(f"h{k}") for k in range(3)]
    exact = texts.crossJoin(F.broadcast(got.select("cuantiles"))).agg(F.count(F.lit(1)).alias("textos"), F.sum("n").alias("all"), *below, *upto)
    whole = got.crossJoin(F.broadcast(exact)).crossJoin(F.broadcast(found.agg(F.countDistinct("doc_id").alias("documentos"))))
    inside = lambda k, r: (F.col(f"l{k}") / F.col("all") - sketches.RANK_BOUND <= r) & (F.col(f"h{k}") / F.col("all") + sketches.RANK_BOUND >= r)
    verdicts = [("documentos", near("num_documentos", "documentos")), ("textos", near("num_textos", "textos")), *[(f"rango {r}", inside(k, r)) for k, r in enumerate(ranks)]]
    rows = whole.select("num_fragmentos", *[F.round(c, 6).alias(c) for c in ("media", "minimo", "maximo")], F.explode(F.array(*[F.struct(F.lit(n).alias("medida"), ok.alias("dentro")) for n, ok in verdicts])).alias("x"))
    return rows.select("x.medida", "num_fragmentos", "media", "minimo", "maximo", "x.dentro")


@query("silver_summary", f"""
WITH {fragments_sql()}, q AS (SELECT f.doc_id, pos, d.lang, {SUBTYPE_SQL} <> 'ejemplo' AND d.lang <> 'es' AS t, {words_sql('texto')} AS w FROM frag f JOIN documents d USING (doc_id))
SELECT doc_id, round(avg({quality_sql('w')}), 6) AS quality_score, bool_or(t) AS traducido, arg_min(lang, pos) AS idioma_original, count(*) AS num_fragmentos FROM q GROUP BY doc_id""")
def silver_summary(spark, sf_dir):
    """Document quality, translation flag, first language and fragment count."""
    docs = load(spark, sf_dir, "documents")
    found = fragments.split_documents(docs).join(docs.select("doc_id", "lang"), "doc_id")
    return fragments.silver_summary(fragments.localised(found, F.col("lang"))).withColumn("quality_score", F.round("quality_score", 6))


@query("name_collision_suffix", """
WITH s AS (SELECT doc_id, trim(regexp_replace(lower(source || ' ' || lang), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM documents),
n AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY doc_id) AS n FROM s) SELECT doc_id, CASE WHEN n = 1 THEN slug ELSE slug || '-' || n END AS nombre FROM n""")
def name_collision_suffix(spark, sf_dir):
    """File names with a number for repeats."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    return fragments.file_names(docs, F.concat_ws(" ", "source", "lang")).select("doc_id", "nombre")


def transcript_texts(spark, sf_dir):
    """Conversations as transcripts: roles are speakers, turns are seconds."""
    line = F.format_string("[%d.5s] SPEAKER_%02d: %s", F.col("turn"), F.when(F.col("role") == "user", 0).otherwise(1), F.regexp_replace("text", "\\s+", " "))
    rows = load(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), "turn", line.alias("line"))
    return rows.groupBy("doc_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", "line"))), lambda x: x["line"]), "\n").alias("text"))


_TURNS = """t AS (SELECT conv_id AS doc_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos, turn, CASE WHEN role = 'user' THEN 'SPEAKER_00' ELSE 'SPEAKER_01' END AS speaker, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS texto FROM conversations)"""
_RUNS = f"""{_TURNS}, c AS (SELECT *, CASE WHEN lag(speaker) OVER w IS DISTINCT FROM speaker THEN 1 ELSE 0 END AS b FROM t WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
g AS (SELECT *, sum(b) OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS run FROM c), r AS (SELECT doc_id, run::BIGINT AS run, min(speaker) AS speaker, string_agg(texto, ' ' ORDER BY pos) AS texto FROM g GROUP BY ALL)"""


@query("parse_lines", f"WITH {_TURNS} SELECT doc_id, pos::INTEGER AS pos, turn + 0.5 AS seconds, speaker, texto, true AS ok FROM t")
def parse_lines(spark, sf_dir):
    """Transcript lines."""
    return transcripts.parse_lines(transcript_texts(spark, sf_dir))


@query("speaker_runs", f"WITH {_RUNS} SELECT doc_id, run, speaker, texto FROM r")
def speaker_runs(spark, sf_dir):
    """Runs of one speaker."""
    return transcripts.speaker_runs(transcripts.parse_lines(transcript_texts(spark, sf_dir)))


_DOMINANT = "d AS (SELECT doc_id, arg_max(speaker, (n, -f)) AS speaker FROM (SELECT doc_id, speaker, sum(length(texto)) AS n, min(pos) AS f FROM t GROUP BY ALL) GROUP BY doc_id)"


@query("dominant_speaker", f"WITH {_TURNS}, {_DOMINANT} SELECT doc_id, speaker FROM d")
def dominant_speaker(spark, sf_dir):
    """Each transcript's dominant speaker."""
    return transcripts.dominant_speaker(transcripts.parse_lines(transcript_texts(spark, sf_dir)))


@query("parse_transcripts", f"WITH {_RUNS}, {_DOMINANT} SELECT doc_id, string_agg(texto, chr(10) || chr(10) ORDER BY run) AS texto, any_value(d.speaker) AS speaker_dominante FROM r JOIN d USING (doc_id) GROUP BY doc_id")
def parse_transcripts(spark, sf_dir):
    """Whole transcripts."""
    return transcripts.parse_transcripts(transcript_texts(spark, sf_dir))[0]


@query("transcript_rejects", f"WITH {_TURNS} SELECT doc_id, count(*) AS bad_lines FROM t WHERE turn % 3 = 2 GROUP BY doc_id")
def transcript_rejects(spark, sf_dir):
    """Transcripts with lines that break the grammar: every third speaker is unknown."""
    texts = transcript_texts(spark, sf_dir).withColumn("text", F.regexp_replace("text", "(?m)^(\\[(?:\\d*[258]|2)\\.5s\\]) SPEAKER_\\d+", "$1 DESCONOCIDO"))
    return transcripts.parse_transcripts(texts)[1]




@query("colour_class", f"""
WITH c AS (SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'auto' WHEN p_partkey % 5 = 1 THEN 'FF0000' WHEN p_partkey % 5 = 2 THEN '98' || lower(lpad(to_hex(p_partkey % 256), 2, '0')) || '10' ELSE upper(substr(md5(p_name), 1, 6)) END AS x FROM part),
n AS (SELECT p_partkey, x, ('0x' || substr(x, 1, 2))::INTEGER AS r, ('0x' || substr(x, 3, 2))::INTEGER AS g, ('0x' || substr(x, 5, 2))::INTEGER AS b FROM c WHERE x <> 'auto')
SELECT c.p_partkey, c.x AS color, CASE WHEN g < 90 AND b < 90 AND r >= 200 THEN 'REMATE' WHEN g < 90 AND b < 90 AND r >= 120 THEN 'CHISTOIDE' END AS tag FROM c LEFT JOIN n USING (p_partkey)""")
def colour_class(spark, sf_dir):
    """Colours of parts and their tags."""
    k = F.col("p_partkey")
    colour = F.when(k % 5 == 0, "auto").when(k % 5 == 1, "FF0000").when(k % 5 == 2, F.concat(F.lit("98"), F.lpad(F.hex(k % 256), 2, "0"), F.lit("10"))).otherwise(F.upper(F.substring(F.md5("p_name"), 1, 6)))
    frame = load(spark, sf_dir, "part").select("p_partkey", F.when(k % 5 == 2, F.lower(colour)).otherwise(colour).alias("color"))
    return frame.withColumn("tag", markup.colour_tag(F.col("color")))


def marked(spark, sf_dir):
    """Documents in which the last words of every fourth sentence are a punch line and those of every fourth after it an aside."""
    found = fragments.split_documents(load(spark, sf_dir, "documents"))
    body = F.when(F.col("pos") % 4 == 3, F.concat(F.lit("Y [REMATE] "), "texto", F.lit("[/REMATE]"))).when(F.col("pos") % 4 == 1, F.concat(F.lit("[CHISTOIDE]"), "texto", F.lit(" [/CHISTOIDE]"))).otherwise(F.col("texto"))
    rows = found.select("doc_id", "pos", body.alias("b"))
    return rows.groupBy("doc_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "b"))), lambda x: x["b"]), " ").alias("markdown"))


_MARKED = f"""{fragments_sql()},
b AS (SELECT doc_id, pos, texto, CASE pos % 4 WHEN 3 THEN 'Y [REMATE] ' || texto || '[/REMATE]' WHEN 1 THEN '[CHISTOIDE]' || texto || ' [/CHISTOIDE]' ELSE texto END AS b FROM frag),
m AS (SELECT doc_id, pos // 4 AS k, min(pos) AS p, count(*) AS n, string_agg(b, ' ' ORDER BY pos) AS v, max(CASE WHEN pos % 4 = 3 THEN texto END) AS r, list(texto ORDER BY pos) FILTER (pos % 4 = 1) AS c FROM b GROUP BY doc_id, pos // 4),
win AS (SELECT doc_id, k::INTEGER AS pos, CASE WHEN k > 0 THEN ' ' ELSE '' END || v AS ventana, r AS remate, c AS chistoides FROM m WHERE n = 4)"""


@query("windows", f"WITH {_MARKED} SELECT doc_id, pos, ventana, remate FROM win")
def windows(spark, sf_dir):
    """Candidate windows of marked documents."""
    return marking.segment(marked(spark, sf_dir)).select("doc_id", "pos", "ventana", "remate")


@query("chistoide_meta", f"WITH {_MARKED} SELECT doc_id, pos, chistoides FROM win")
def chistoide_meta(spark, sf_dir):
    """Asides of every window."""
    return marking.segment(marked(spark, sf_dir)).select("doc_id", "pos", "chistoides")


@query("setup_locator", f"WITH {_MARKED} SELECT doc_id, pos, true AS inicio_localizado, length(trim(regexp_replace(substr(ventana, position('Y [REMATE]' IN ventana)), '\\[/?(?:REMATE|CHISTOIDE)\\]', '', 'g')))::INTEGER AS n FROM win")
def setup_locator(spark, sf_dir):
    """Windows cut at a quoted setup that is written with other white space."""
    found = marking.segment(marked(spark, sf_dir)).withColumn("inicio", F.lit(" Y \n  [REMATE] "))
    return marking.cut_setups(found).select("doc_id", "pos", "inicio_localizado", F.length("texto").alias("n"))




def coloured(spark, sf_dir):
    """Conversations as coloured runs: a conversation is a document, a turn a paragraph, its words in threes the runs."""
    rows = load(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").cast("int").alias("para"), F.posexplode(F.regexp_extract_all("text", F.lit("(?:\\S+\\s*){1,3}"), F.lit(0))).alias("run", "texto"))
    k = (F.col("run") + F.col("para")) % 5
    return rows.select("doc_id", "para", "run", F.when(k == 0, "FF0000").when(k == 1, "980000").alias("color"), "texto")


@query("roundtrip", """
WITH w AS (SELECT conv_id AS doc_id, turn AS para, regexp_extract_all(text, '(?:[^ \\t\\n\\f\\r]+[ \\t\\n\\f\\r]*){1,3}') AS l FROM conversations),
r AS (SELECT doc_id, (i - 1 + para) % 5 AS k, l[i] AS texto FROM (SELECT *, unnest(range(1, len(l) + 1)) AS i FROM w)),
e AS (SELECT doc_id, CASE k WHEN 0 THEN 'REMATE' ELSE 'CHISTOIDE' END AS tag, sum(length(regexp_replace(texto, '[^\\p{L}\\p{M}\\p{Nd}_]', '', 'g'))) AS n FROM r WHERE k IN (0, 1) GROUP BY ALL),
a AS (SELECT DISTINCT conv_id AS doc_id, t.tag FROM conversations, (VALUES ('REMATE'), ('CHISTOIDE')) t(tag))
SELECT doc_id, tag, coalesce(n, 0)::BIGINT AS expected, coalesce(n, 0)::BIGINT AS found, true AS ok FROM a LEFT JOIN e USING (doc_id, tag)""")
def roundtrip(spark, sf_dir):
    """Word characters of each colour before and after marking: the guard holds for every document."""
    runs = coloured(spark, sf_dir)
    return marking.round_trip(runs, marking.marked_text(runs)).select("doc_id", "tag", F.col("expected").cast("long").alias("expected"), F.col("found").cast("long").alias("found"), "ok")


@query("cosine_pairs", """
SELECT a.vec_id AS a, b.vec_id AS b, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS cosine FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def cosine_pairs(spark, sf_dir):
    """Cosine of each vector and the next."""
    e = load(spark, sf_dir, "embeddings")
    a, b = e.select(F.col("vec_id").alias("a"), F.col("embedding").alias("x")), e.select((F.col("vec_id") - 1).alias("a"), F.col("vec_id").alias("b"), F.col("embedding").alias("y"))
    return a.join(b, "a").select("a", "b", F.round(vectors.cosine(F.col("x"), F.col("y")), 6).alias("cosine"))


@query("vector_parse", "SELECT vec_id, len(embedding)::INTEGER AS dims, round(list_sum(embedding::DOUBLE[]), 4) AS total FROM embeddings")
def vector_parse(spark, sf_dir):
    """Vectors written as text and read back."""
    v = vectors.parsed(F.to_json("embedding"))
    return load(spark, sf_dir, "embeddings").select("vec_id", v.alias("v")).select("vec_id", F.size("v").alias("dims"), F.round(F.aggregate("v", F.lit(0.0), lambda s, x: s + x), 4).alias("total"))


def incoming_and_stored(spark, sf_dir):
    """Every fifth vector as incoming, the others as stored; texts of every tenth are those of stored ones."""
    e = load(spark, sf_dir, "embeddings")
    name = lambda k: F.concat(F.lit("joke "), k.cast("string"))
    k = F.col("vec_id")
    incoming = e.where("vec_id % 5 = 0").select(k.alias("key"), F.when(k % 10 == 0, name(k + 1)).otherwise(name(k)).alias("texto"), "embedding")
    stored = e.where("vec_id % 5 <> 0").select(k.alias("id"), F.sha2(name(k), 256).alias("hash_normalizado"), "embedding")
    return incoming, stored


_BEST = """p AS (SELECT a.vec_id AS key, b.vec_id AS id, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS s FROM embeddings a, embeddings b WHERE a.vec_id % 5 = 0 AND b.vec_id % 5 <> 0),
best AS (SELECT key, id, s FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY s DESC, id) AS r FROM p) WHERE r = 1)"""


@query("best_match", f"WITH {_BEST} SELECT key, id AS chiste_id, round(s, 6) AS similitud FROM best")
def best_match(spark, sf_dir):
    """The stored vector nearest to each incoming one."""
    incoming, stored = incoming_and_stored(spark, sf_dir)
    return reconcile.best_matches(incoming, stored).withColumn("similitud", F.round("similitud", 6))


@query("hash_match", "SELECT a.vec_id AS key, b.vec_id AS chiste_id FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1 WHERE a.vec_id % 10 = 0")
def hash_match(spark, sf_dir):
    """Incoming rows with an equal stored hash."""
    incoming, stored = incoming_and_stored(spark, sf_dir)
    return reconcile.hash_matches(incoming.select("key", F.sha2("texto", 256).alias("hash_normalizado")), stored)


_DECIDE = f"""{_BEST}, h AS (SELECT a.vec_id AS key, b.vec_id AS id FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1 WHERE a.vec_id % 10 = 0),
d AS (SELECT a.vec_id AS key, CASE WHEN h.id IS NOT NULL THEN 'IGUAL' WHEN s >= 0.4 THEN 'CAMBIADO' ELSE 'NUEVO' END AS decision, CASE WHEN h.id IS NOT NULL THEN h.id WHEN s >= 0.4 THEN best.id END AS chiste_id,
  round(CASE WHEN h.id IS NOT NULL THEN 1.0 WHEN s >= 0.4 THEN s END, 6) AS similitud FROM embeddings a LEFT JOIN h ON h.key = a.vec_id LEFT JOIN best ON best.key = a.vec_id WHERE a.vec_id % 5 = 0)"""


@query("decision", f"WITH {_DECIDE} SELECT * FROM d")
def decision(spark, sf_dir):
    """IGUAL, CAMBIADO or NUEVO for every incoming row, at a threshold that the data reaches."""
    incoming, stored = incoming_and_stored(spark, sf_dir)
    return reconcile.decide(incoming, stored, 0.4).withColumn("similitud", F.round("similitud", 6)).drop("hash_normalizado")


_NEAR = """m AS (SELECT a.vec_id AS k, a.embedding::DOUBLE[] AS own, b.embedding::DOUBLE[] AS base FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id - a.vec_id % 10),
rows AS (SELECT k, sha256('joke ' || CASE WHEN k % 7 = 0 THEN k - k % 10 ELSE k // 4 * 1000 END) AS h,
  CASE WHEN k % 3 = 0 OR k % 5 IN (0, 4) THEN own WHEN k % 5 = 3 THEN [0.75 * x[2] + 0.4 * x[1] FOR x IN list_zip(own, base)] ELSE [0.95 * x[2] + 0.2 * x[1] FOR x IN list_zip(own, base)] END AS v FROM m)"""


def near_each_other(spark, sf_dir):
    """Vectors in order, every third stored; many of the others are near an earlier one or have an earlier one's text."""
    e = load(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("k"), F.col("embedding").cast("array<double>").alias("own"))
    base = e.select(F.col("k").alias("b"), F.col("own").alias("base"))
    k, mixed = F.col("k"), lambda x, y: F.zip_with("base", "own", lambda b, o: F.lit(x) * b + F.lit(y) * o)
    rows = e.join(base, F.col("b") == k - k % 10)
    texto = F.concat(F.lit("joke "), F.when(k % 7 == 0, k - k % 10).otherwise(F.floor(k / 4) * 1000).cast("string"))
    rows = rows.select("k", texto.alias("texto"), F.when((k % 3 == 0) | (k % 5).isin(0, 4), F.col("own")).when(k % 5 == 3, mixed(0.75, 0.4)).otherwise(mixed(0.95, 0.2)).alias("embedding"))
    return rows.where("k % 3 <> 0").withColumnRenamed("k", "key"), rows.where("k % 3 = 0").select(k.alias("id"), F.sha2("texto", 256).alias("hash_normalizado"), "embedding")


@query("sequential_reconciliation", f"""
WITH RECURSIVE {_NEAR}, inc AS (SELECT row_number() OVER (ORDER BY k) AS n, k AS key, h, v FROM rows WHERE k % 3 <> 0),
fold AS (
  SELECT 0::BIGINT AS n, (SELECT list({{'id': k::VARCHAR, 'h': h, 'v': v}} ORDER BY k) FROM rows WHERE k % 3 = 0) AS entries, NULL::BIGINT AS key, NULL::VARCHAR AS decision, NULL::VARCHAR AS chiste_id, NULL::DOUBLE AS similitud
  UNION ALL
  SELECT n, CASE WHEN same IS NOT NULL THEN entries WHEN top >= 0.85 THEN list_transform(entries, lambda s, i: CASE WHEN i = near THEN {{'id': s.id, 'h': h, 'v': v}} ELSE s END)
      ELSE list_append(entries, {{'id': 'new:' || key, 'h': h, 'v': v}}) END,
    key, CASE WHEN same IS NOT NULL THEN 'IGUAL' WHEN top >= 0.85 THEN 'CAMBIADO' ELSE 'NUEVO' END,
    CASE WHEN same IS NOT NULL THEN entries[same].id WHEN top >= 0.85 THEN entries[near].id END, CASE WHEN same IS NOT NULL THEN 1.0 WHEN top >= 0.85 THEN top END
  FROM (SELECT *, list_max(sims) AS top, list_position(sims, list_max(sims)) AS near FROM (
    SELECT i.n, f.entries, i.key, i.h, i.v, list_position(list_transform(f.entries, lambda s: s.h), i.h) AS same, list_transform(f.entries, lambda s: list_cosine_similarity(s.v, i.v)) AS sims
    FROM fold f JOIN inc i ON i.n = f.n + 1)))
SELECT key, decision, chiste_id, round(similitud, 6) AS similitud FROM fold WHERE n > 0""")
def sequential_reconciliation(spark, sf_dir):
    """Each incoming row decided in order of its key; once routed, it is a candidate for the next."""
    incoming, stored = near_each_other(spark, sf_dir)
    return reconcile.decide_in_order(incoming, stored, "key").withColumn("similitud", F.round("similitud", 6))


def routed(spark, sf_dir):
    """Jokes and revisions after routing the decisions."""
    incoming, stored = incoming_and_stored(spark, sf_dir)
    jokes = stored.select("id", F.concat(F.lit("joke "), F.col("id").cast("string")).alias("texto_normalizado"), "hash_normalizado", "embedding", F.lit("propio_historico").alias("tipo_fuente"), (F.col("id") % 3).alias("tema_id"), F.lit(7).cast("long").alias("tecnica_id"), F.lit("rematado").alias("estado"), F.lit(2).alias("version_actual"))
    k = F.col("key")
    facts = incoming.select("key", "texto", "embedding", F.lit("idea_suelta").alias("estado"), F.when(k % 2 == 1, k).alias("tema_id"), F.lit(None).cast("long").alias("tecnica_id"), F.lit("callback").alias("estructura"), F.lit("corta").alias("sugerencias"))
    decided = reconcile.decide(incoming, stored, 0.4)
    return reconcile.route(jokes, decided, facts, "propio")


_ROUTE = f"""{_DECIDE}, ch AS (SELECT key, chiste_id AS id, 2 + row_number() OVER (PARTITION BY chiste_id ORDER BY key) AS version FROM d WHERE decision = 'CAMBIADO'),
lastv AS (SELECT id, max(version) AS version, arg_max(key, version) AS key, arg_max(key, version) FILTER (key % 2 = 1) AS tema FROM ch GROUP BY id)"""


@query("reconcile_routing", f"""WITH {_ROUTE}
SELECT e.vec_id AS id, CASE WHEN l.key IS NULL THEN 'joke ' || e.vec_id ELSE 'joke ' || l.key END AS texto_normalizado, 'propio_historico' AS tipo_fuente, coalesce(l.tema, e.vec_id % 3) AS tema_id, 7 AS tecnica_id,
  CASE WHEN l.key IS NULL THEN 'rematado' ELSE 'idea_suelta' END AS estado, coalesce(l.version, 2)::INTEGER AS version_actual FROM embeddings e LEFT JOIN lastv l ON l.id = e.vec_id WHERE e.vec_id % 5 <> 0
UNION ALL SELECT key, 'joke ' || key, 'propio', CASE WHEN key % 2 = 1 THEN key END, NULL, 'idea_suelta', 1 FROM d WHERE decision = 'NUEVO'""")
def reconcile_routing(spark, sf_dir):
    """The joke table after all writes."""
    return routed(spark, sf_dir)[0].drop("embedding", "hash_normalizado")


@query("revision_history", f"""WITH {_ROUTE}
SELECT id AS chiste_id, version::INTEGER AS version, 'joke ' || key AS contenido, '{{"descripcion":"callback","tecnica_id":null}}' AS estructura_detectada FROM ch
UNION ALL SELECT key, 1, 'joke ' || key, '{{"descripcion":"callback","tecnica_id":null}}' FROM d WHERE decision = 'NUEVO'""")
def revision_history(spark, sf_dir):
    """Revisions appended."""
    return routed(spark, sf_dir)[1].select("chiste_id", "version", "contenido", "estructura_detectada")


def proposals(spark, sf_dir):
    """Three proposals for each part, and the nations as a table of names."""
    k = F.col("p_partkey")
    rows = load(spark, sf_dir, "part").select(k.alias("key"), F.col("p_type").alias("texto"), F.when(k % 4 == 0, F.concat(F.lit("  "), (k % 40).cast("string"))).when(k % 4 == 1, "SIN_MATCH").when(k % 4 == 2, "--5").alias("p1"), F.when(k % 3 == 0, F.concat(F.lit("name "), (k % 9).cast("string"))).alias("p2"), F.when(k % 5 == 0, F.concat(F.lit(" NAME   "), (k % 50).cast("string"))).otherwise("nothing").alias("p3"))
    table = load(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("id"), F.concat(F.lit("Name "), F.col("n_nationkey").cast("string")).alias("nombre"))
    return rows, table


_TAXONOMY = """m AS (SELECT p_partkey AS key, p_type, CASE WHEN p_partkey % 4 = 0 AND p_partkey % 40 < 25 THEN p_partkey % 40 END AS a, CASE WHEN p_partkey % 3 = 0 THEN p_partkey % 9 END AS b, CASE WHEN p_partkey % 5 = 0 AND p_partkey % 50 < 25 THEN p_partkey % 50 END AS c FROM part)"""


@query("id_match", f"WITH {_TAXONOMY} SELECT key, a AS id FROM m WHERE a IS NOT NULL")
def id_match(spark, sf_dir):
    """Numeric proposals against ids."""
    rows, table = proposals(spark, sf_dir)
    return taxonomy.match(rows, table, "p1")


@query("name_match", f"WITH {_TAXONOMY} SELECT key, c AS id FROM m WHERE c IS NOT NULL")
def name_match(spark, sf_dir):
    """Proposals by name, in other case and spacing."""
    rows, table = proposals(spark, sf_dir)
    return taxonomy.match(rows, table, "p3")


@query("three_pass_resolver", f"WITH {_TAXONOMY} SELECT key, coalesce(a, b, c) AS id, CASE WHEN a IS NOT NULL THEN 1 WHEN b IS NOT NULL THEN 2 ELSE 3 END AS intentos FROM m")
def three_pass_resolver(spark, sf_dir):
    """Three proposals in turn."""
    rows, table = proposals(spark, sf_dir)
    return taxonomy.resolve(rows, table, ["p1", "p2", "p3"])[0]


@query("candidate_queue", f"WITH {_TAXONOMY} SELECT 'tema' AS tipo, p_type AS texto, 'pendiente' AS estado FROM m WHERE coalesce(a, b, c) IS NULL")
def candidate_queue(spark, sf_dir):
    """Labels queued for review."""
    rows, table = proposals(spark, sf_dir)
    return taxonomy.resolve(rows, table, ["p1", "p2", "p3"])[1]


