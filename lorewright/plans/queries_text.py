"""Queries of the text functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lorewright.functions import keys, text
from lorewright.operators import fragments, profiles
from lorewright.plans.binding import (
    PREFIX, RUNS, SUBTYPE_SQL, WORD, clause_sql, cleaned_sql, filler_sql, fragments_sql, load, quality_sql, register, repeats_sql, strip_sql, tidy_sql, words_sql,
)

QUERIES: dict = {}
query = lambda name, sql=None: register(QUERIES, name, sql)
_LETTERS = "regexp_replace(text, '[^\\p{L}]+', ' ', 'g')"


def injected(spark, sf_dir):
    """Documents with PREFIX before each text."""
    return load(spark, sf_dir, "documents").select("doc_id", "lang", F.concat(F.lit(PREFIX), "text").alias("text"))


@query("sentence_split", f"WITH {fragments_sql()} SELECT doc_id, pos, texto FROM frag")
def sentence_split(spark, sf_dir):
    """Every sentence of every document."""
    return fragments.split_documents(load(spark, sf_dir, "documents")).select("doc_id", "pos", "texto")


@query("subtype_classify", f"WITH {fragments_sql(f'concat(chr(10), {PREFIX!r}, text)')} SELECT doc_id, pos, {SUBTYPE_SQL} AS subtipo FROM frag")
def subtype_classify(spark, sf_dir):
    """Every sentence's subtype, with markers put in."""
    return fragments.split_documents(injected(spark, sf_dir)).select("doc_id", "pos", "subtipo")


@query("filler_removal", f"SELECT doc_id, {filler_sql(f'concat({PREFIX!r}, text)')} AS texto FROM documents")
def filler_removal(spark, sf_dir):
    """Whole texts without fillers."""
    return injected(spark, sf_dir).select("doc_id", text.without_fillers(F.col("text")).alias("texto"))


@query("clause_dedup", f"WITH t AS (SELECT doc_id, concat({PREFIX!r}, text) AS x FROM documents), s AS MATERIALIZED (SELECT doc_id, string_split(x, ',') AS parts FROM t) SELECT doc_id, {clause_sql('parts')} AS texto FROM s")
def clause_dedup(spark, sf_dir):
    """Whole texts without repeated clauses."""
    return injected(spark, sf_dir).select("doc_id", text.without_repeated_clauses(F.col("text")).alias("texto"))


@query("word_dedup", f"""
WITH t AS (SELECT doc_id, string_split(trim({_LETTERS}), ' ') AS w FROM documents)
SELECT doc_id, array_to_string(list_filter(w, lambda x, i: i = 1 OR lower(x) <> lower(w[i - 1])), ' ') AS texto FROM t""")
def word_dedup(spark, sf_dir):
    """Texts' letters-only words without consecutive repeats."""
    bare = F.trim(F.regexp_replace("text", "[^\\p{L}]+", " "))
    return load(spark, sf_dir, "documents").select("doc_id", text.without_repeated_words(bare).alias("texto"))


@query("space_punct", f"""
WITH r AS MATERIALIZED (SELECT doc_id, regexp_extract_all(replace(replace(concat(' , ', text), '. ', ' ,, .  '), 'th', ',, , th'), '{RUNS}') AS runs FROM documents), t AS (SELECT doc_id, {tidy_sql('runs')} AS x FROM r)
SELECT doc_id, CASE WHEN x = '' THEN x WHEN regexp_matches(x, '[.!?]$') THEN y ELSE y || '.' END AS texto
FROM (SELECT doc_id, x, CASE WHEN regexp_matches(x, '^\\p{{L}}') THEN upper(x[1]) || x[2:] ELSE x END AS y FROM t)""")
def space_punct(spark, sf_dir):
    """Whole texts tidied after blanks and commas were put in."""
    rough = F.replace(F.replace(F.concat(F.lit(" , "), "text"), F.lit(". "), F.lit(" ,, .  ")), F.lit("th"), F.lit(",, , th"))
    return load(spark, sf_dir, "documents").select("doc_id", text.tidied(rough).alias("texto"))


_CLEAN_STEP = f"""
s AS MATERIALIZED (SELECT doc_id, string_split({filler_sql("concat('bueno, el caso, el caso, ', trim(" + _LETTERS + "))")}, ',') AS parts FROM documents),
c AS (SELECT doc_id, {clause_sql('parts')} AS x FROM s),
d AS (SELECT doc_id, list_transform(string_split(x, ','), lambda p: array_to_string(list_filter(string_split(p, ' '), lambda w, i: i = 1 OR w = '' OR lower(w) <> lower(string_split(p, ' ')[i - 1])), ' ')) AS p FROM c),
r AS MATERIALIZED (SELECT doc_id, regexp_extract_all(array_to_string(p, ','), '{RUNS}') AS runs FROM d), e AS (SELECT doc_id, {tidy_sql('runs')} AS x FROM r)"""


@query("clean_fragment", f"WITH {_CLEAN_STEP.lstrip()} SELECT doc_id, CASE WHEN x = '' THEN x ELSE upper(x[1]) || x[2:] || '.' END AS texto FROM e")
def clean_fragment(spark, sf_dir):
    """Whole letters-only texts through all cleaning steps."""
    body = F.concat(F.lit("bueno, el caso, el caso, "), F.trim(F.regexp_replace("text", "[^\\p{L}]+", " ")))
    return load(spark, sf_dir, "documents").select("doc_id", text.cleaned(body, F.lit("explicacion")).alias("texto"))


@query("word_dedup_whole", f"WITH w AS MATERIALIZED (SELECT doc_id, regexp_extract_all(text, '{WORD}') AS words, regexp_split_to_array(text, '{WORD}') AS gaps FROM documents) SELECT doc_id, {repeats_sql('words', 'gaps')} AS texto FROM w")
def word_dedup_whole(spark, sf_dir):
    """Whole texts, punctuation and digits with them, without consecutive repeats of words."""
    return load(spark, sf_dir, "documents").select("doc_id", text.without_repeated_words(F.col("text")).alias("texto"))


@query("clean_whole", f"WITH t AS (SELECT doc_id, concat({PREFIX!r}, text) AS texto FROM documents), {cleaned_sql('t', 'doc_id')} SELECT doc_id, x AS texto FROM limpio")
def clean_whole(spark, sf_dir):
    """Whole texts, punctuation and digits with them, through all cleaning steps."""
    return injected(spark, sf_dir).select("doc_id", text.cleaned(F.col("text"), F.lit("explicacion")).alias("texto"))


@query("quality_score", f"WITH t AS (SELECT doc_id, {words_sql('text')} AS w FROM documents) SELECT doc_id, round({quality_sql('w')}, 6) AS quality, len(w)::INTEGER AS words FROM t")
def quality_score(spark, sf_dir):
    """Every document's quality."""
    frame = load(spark, sf_dir, "documents").withColumn("w", text.words(F.col("text")))
    return frame.select("doc_id", F.round(text.quality_of(F.col("w")), 6).alias("quality"), F.size("w").alias("words"))


@query("quality_parts", f"""
WITH t AS (SELECT doc_id, {words_sql('text')} AS w FROM documents)
SELECT doc_id, round(len(w) / (len(w) + 25.0), 6) AS length_score, CASE WHEN len(w) = 0 THEN 0.0 ELSE round(len(list_distinct(w)) / len(w)::DOUBLE, 6) END AS diversity FROM t""")
def quality_parts(spark, sf_dir):
    """Length score and diversity of every document."""
    w = text.words(F.col("text"))
    frame = load(spark, sf_dir, "documents").select("doc_id", w.alias("w"))
    return frame.select("doc_id", F.round(text.length_score(F.size("w")), 6).alias("length_score"), F.round(text.diversity(F.col("w")), 6).alias("diversity"))


@query("document_quality", f"""
WITH {fragments_sql()}, q AS (SELECT doc_id, {words_sql('texto')} AS w, {SUBTYPE_SQL} AS subtipo FROM frag)
SELECT doc_id, count(*) AS num_fragmentos, round(avg({quality_sql('w')}), 6) AS quality, bool_or(subtipo = 'ejemplo') AS hay_ejemplo FROM q GROUP BY doc_id""")
def document_quality(spark, sf_dir):
    """Fragments and mean quality of every document."""
    found = fragments.document_quality(fragments.split_documents(load(spark, sf_dir, "documents")))
    return found.withColumn("quality", F.round("quality", 6))


@query("translation_decision", f"""
WITH {fragments_sql(f'concat({PREFIX!r}, text)')}, s AS (SELECT f.doc_id, f.pos, {SUBTYPE_SQL} AS subtipo, d.lang FROM frag f JOIN documents d USING (doc_id))
SELECT doc_id, pos, lang AS idioma_original, subtipo <> 'ejemplo' AND lang <> 'es' AS traducido, CASE WHEN subtipo <> 'ejemplo' AND lang <> 'es' THEN 'es' ELSE lang END AS idioma_fragmento FROM s""")
def translation_decision(spark, sf_dir):
    """Every fragment's languages and whether it is translated."""
    docs = injected(spark, sf_dir)
    found = fragments.split_documents(docs, keep=["lang"])
    return fragments.localised(found, F.col("lang")).select("doc_id", "pos", "idioma_original", "traducido", "idioma_fragmento")


@query("paragraph_grouping", f"""
WITH {fragments_sql(f'concat({PREFIX!r}, text)')}, s AS (SELECT *, {SUBTYPE_SQL} = 'ejemplo' AS e FROM frag),
g AS (SELECT *, CASE WHEN e OR coalesce(lag(e) OVER o, true) THEN 1 ELSE 0 END AS b FROM s WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
h AS (SELECT *, sum(b) OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS paragraph FROM g)
SELECT doc_id, paragraph::BIGINT AS paragraph, string_agg(texto, ' ' ORDER BY pos) AS texto FROM h GROUP BY ALL""")
def paragraph_grouping(spark, sf_dir):
    """Paragraphs of every document."""
    return fragments.paragraphs(fragments.split_documents(injected(spark, sf_dir)))


@query("language_whitelist", "SELECT lang, count(*) AS n, lang IN ('en', 'es') AS permitido FROM documents GROUP BY lang")
def language_whitelist(spark, sf_dir):
    """Documents by language, and whether it is allowed."""
    return load(spark, sf_dir, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n")).withColumn("permitido", F.col("lang").isin("en", "es"))


@query("slug", "SELECT page_id, coalesce(nullif(trim(regexp_replace(lower(url), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'documento') AS slug FROM pages")
def slug(spark, sf_dir):
    """Slugs of the pages' addresses."""
    return load(spark, sf_dir, "pages").select("page_id", text.slug(F.col("url")).alias("slug"))


@query("title", """
WITH s AS (SELECT page_id, regexp_replace(regexp_extract(url, '([^/]*)$', 1), '(.)\\.[^.]*$', '\\1') AS s FROM pages)
SELECT page_id, CASE WHEN trim(translate(s, '_-', '  ')) = '' THEN s ELSE trim(translate(s, '_-', '  ')) END AS title FROM s""")
def title(spark, sf_dir):
    """Titles from the last part of the pages' addresses."""
    return load(spark, sf_dir, "pages").select("page_id", text.title(F.col("url")).alias("title"))


@query("name_normalise", f"SELECT p_partkey, regexp_replace(lower({strip_sql('p_name')}), '\\s+', ' ', 'g') AS name FROM part")
def name_normalise(spark, sf_dir):
    """Folded names of parts."""
    return load(spark, sf_dir, "part").select("p_partkey", text.folded_name(F.col("p_name")).alias("name"))


@query("exact_hash", f"SELECT doc_id, sha256({strip_sql('text')}) AS hash FROM documents")
def exact_hash(spark, sf_dir):
    """SHA-256 of every text, blank ones too, stripped of the white space that its SQL strips."""
    return load(spark, sf_dir, "documents").select("doc_id", text.stripped_hash(F.col("text"), text.ASCII_WHITE).alias("hash"))


@query("message_preclean", f"""
SELECT conv_id, turn, {strip_sql("regexp_replace(regexp_replace(concat('/chiste@some_bot  ', text, ' @someone_1 @abc'), '^/[A-Za-z0-9_]+(?:@[A-Za-z0-9_]+)?\\s*', ''), '@[A-Za-z][A-Za-z0-9_]{4,31}\\b', '', 'g')")} AS texto
FROM conversations""")
def message_preclean(spark, sf_dir):
    """Messages without the command and mention put in."""
    body = F.concat(F.lit("/chiste@some_bot  "), "text", F.lit(" @someone_1 @abc"))
    return load(spark, sf_dir, "conversations").select("conv_id", "turn", text.message_body(body).alias("texto"))


@query("mark_strip", f"SELECT doc_id, {strip_sql("regexp_replace('[REMATE]' || text || '[/CHISTOIDE] ', '\\[/?(?:REMATE|CHISTOIDE)\\]', '', 'g')")} AS texto FROM documents")
def mark_strip(spark, sf_dir):
    """Texts without the marks put in."""
    return load(spark, sf_dir, "documents").select("doc_id", text.without_marks(F.concat(F.lit("[REMATE]"), "text", F.lit("[/CHISTOIDE] "))).alias("texto"))


@query("token_estimate", "SELECT conv_id, turn, CASE WHEN length(text) = 0 THEN 0 ELSE ceil(length(text) / 4.0)::BIGINT END AS tokens FROM conversations")
def token_estimate(spark, sf_dir):
    """Estimated tokens of every message."""
    return load(spark, sf_dir, "conversations").select("conv_id", "turn", text.token_estimate(F.col("text")).alias("tokens"))


@query("secret_mask", "SELECT s_suppkey, CASE WHEN length(s_name) <= 4 THEN '***' ELSE '***' || right(s_name, 4) END AS masked FROM supplier")
def secret_mask(spark, sf_dir):
    """Masked names of suppliers."""
    return load(spark, sf_dir, "supplier").select("s_suppkey", text.masked(F.col("s_name")).alias("masked"))


@query("alphanumeric_count", "SELECT doc_id, length(regexp_replace(text, '[^\\p{L}\\p{M}\\p{Nd}_]', '', 'g')) AS n FROM documents")
def alphanumeric_count(spark, sf_dir):
    """Word characters of every document."""
    return load(spark, sf_dir, "documents").select("doc_id", text.letters_and_digits(F.col("text")).cast("long").alias("n"))


@query("content_md5", "SELECT doc_id, md5(text) AS md5 FROM documents")
def content_md5(spark, sf_dir):
    """MD5 of every text."""
    return load(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("md5"))


@query("object_path", """
SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'local_legacy/' || md5(html) || '/' || n ELSE 'drive/' || 'f' || page_id || '/' || translate('2026-01-02T03:04:05Z', '-:', '') || '/' || n END AS object_path,
  CASE WHEN page_id % 3 = 0 THEN 'local_legacy' ELSE 'drive' END AS origen
FROM (SELECT *, regexp_replace(url, '[^A-Za-z0-9._-]', '_', 'g') AS n FROM pages)""")
def object_path(spark, sf_dir):
    """Object paths of pages, a third of them without a drive id."""
    drive = F.when(F.col("page_id") % 3 != 0, F.concat(F.lit("f"), F.col("page_id").cast("string")))
    frame = load(spark, sf_dir, "pages").withColumn("d", drive)
    path = keys.object_path(F.col("d"), F.lit("2026-01-02T03:04:05Z"), F.md5("html"), F.col("url"))
    return frame.select("page_id", path.alias("object_path"), keys.origin(F.col("d")).alias("origen"))


@query("sanitise_name", "SELECT page_id, regexp_replace(url, '[^A-Za-z0-9._-]', '_', 'g') AS name FROM pages")
def sanitise_name(spark, sf_dir):
    """Safe names of pages."""
    return load(spark, sf_dir, "pages").select("page_id", keys.safe_name(F.col("url")).alias("name"))


@query("compact_time", "SELECT event_id, translate(strftime(ts, '%Y-%m-%dT%H:%M:%SZ'), '-:', '') AS t FROM events")
def compact_time(spark, sf_dir):
    """Compact times of events."""
    return load(spark, sf_dir, "events").select("event_id", keys.compact_time(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("t"))


@query("language_detect", f"""
WITH w AS (SELECT doc_id, {words_sql('text')} AS w FROM documents),
s AS (SELECT doc_id, len(list_filter(w, lambda x: x IN ('the', 'of', 'and', 'that', 'for', 'with'))) AS en, len(list_filter(w, lambda x: x IN ('los', 'del', 'las', 'que', 'el', 'por'))) AS es,
  len(list_filter(w, lambda x: x IN ('les', 'des', 'dans', 'est', 'une', 'pour'))) AS fr, len(list_filter(w, lambda x: x IN ('der', 'und', 'das', 'mit', 'die', 'nicht'))) AS de FROM w)
SELECT doc_id, CASE WHEN greatest(en, es, fr, de) = 0 THEN 'und' WHEN de = greatest(en, es, fr, de) THEN 'de' WHEN en = greatest(en, es, fr, de) THEN 'en' WHEN es = greatest(en, es, fr, de) THEN 'es' ELSE 'fr' END AS lang FROM s""")
def language_detect(spark, sf_dir):
    """Each document's language by votes of common words: a default for the injected detector."""
    from lorewright.functions.language import detected

    return load(spark, sf_dir, "documents").select("doc_id", detected(F.col("text")).alias("lang"))


_GRAMS = """w AS (SELECT doc_id, lang, unnest(regexp_extract_all(lower(text), '\\p{L}{1,64}')) AS w FROM documents), g AS (SELECT doc_id, lang, w, unnest(range(1, length(w) + 1)) AS k FROM w),
gram AS (SELECT doc_id, lang, substr(' ' || w || ' ', k, 3) AS gram FROM g)"""


@query("language_profiles", f"""
WITH {_GRAMS}, a AS (SELECT lang, gram, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, gram) - 1 AS p FROM gram WHERE lang IS NOT NULL AND doc_id % 5 <> 0 GROUP BY lang, gram QUALIFY p < 400),
d AS (SELECT doc_id, gram, row_number() OVER (PARTITION BY doc_id ORDER BY count(*) DESC, gram) - 1 AS p FROM gram GROUP BY doc_id, gram QUALIFY p < 400),
n AS (SELECT doc_id, count(*) * 400 AS most FROM d GROUP BY doc_id), l AS (SELECT DISTINCT lang FROM a),
h AS (SELECT doc_id, a.lang, sum(400 - abs(d.p - a.p)) AS s FROM d JOIN a USING (gram) GROUP BY ALL),
x AS (SELECT n.doc_id, l.lang, coalesce(s, 0) AS s, floor((most - coalesce(s, 0)) * 1000000 / most)::BIGINT AS z, s IS NOT NULL AS hit, row_number() OVER (PARTITION BY n.doc_id ORDER BY coalesce(s, 0) DESC, s IS NULL, l.lang) AS r FROM n CROSS JOIN l LEFT JOIN h ON h.doc_id = n.doc_id AND h.lang = l.lang),
b AS (SELECT doc_id, max(lang) FILTER (r = 1 AND hit) AS lang, max(z) FILTER (r = 1) AS distancia, max(z) FILTER (r = 2) AS segunda FROM x GROUP BY doc_id)
SELECT documents.doc_id, CASE WHEN b.lang IS NOT NULL AND coalesce(segunda - distancia >= 10000, true) THEN b.lang ELSE 'und' END AS lang, distancia, segunda FROM documents LEFT JOIN b USING (doc_id)""")
def language_profiles(spark, sf_dir):
    """Each document's language by the trigram profiles of four documents of five."""
    docs = load(spark, sf_dir, "documents")
    return profiles.detected(docs, profiles.learned(docs.where("doc_id % 5 <> 0")))
