"""Queries opN_<name> of the training-data operators, with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import bpe, common, exact_dedup, jaccard, language, lines, mixing, negatives, packing, phrases, search, secrets, sharding, toxicity

UPPER, LOWER = common.UPPER, common.UPPER.lower()


#: Targets of the mixture, as shares of all tokens; what isn't listed divides the rest by its tokens.
MARGINS = {
    "source": {"src0": 0.15, "src1": 0.08},
    "lang": {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1},
    "topic": {"brief": 0.05, "article": 0.6, "book": 0.35},
}


def fold(k: int):
    """crc32 of the doc_id as text, modulo k."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % k


def op1_secret_scan(spark, sf_dir):
    """Every candidate string of every document and the forest's verdict."""
    docs = common.table(spark, sf_dir, "documents")
    words = secrets.dictionary(docs)
    found = secrets.scanned(docs, secrets.trained(spark, words), words)
    return found.select("doc_id", "begin", F.length("value").cast("long").alias("length"), F.sha2("value", 256).alias("value_sha256"), F.round("chance", 6).alias("chance"), "is_secret")


def op2_raked_mixture(spark, sf_dir):
    """Every document's cell, calibrated rate and copies in a mixture of half the corpus's tokens."""
    found = mixing.calibrated(common.table(spark, sf_dir, "documents"), MARGINS, 0.5, unmet="warn")
    return found.select("doc_id", F.col("_source").alias("source"), F.col("_lang").alias("lang"), F.col("_topic").alias("topic"), F.col("_tokens").alias("tokens"), F.round("_rate", 6).alias("rate"), F.col("_copies").alias("copies"))


def op3_ngram_jaccard(spark, sf_dir):
    """Every document's shingle count and component of near duplicates."""
    return jaccard.classes_of_near_duplicates(common.table(spark, sf_dir, "documents"))


def op4_line_dedup(spark, sf_dir):
    """Every document's number of lines, of lines kept, and the numbers of the lines dropped."""
    return lines.dropped_lines(common.table(spark, sf_dir, "documents"))


def op5_ppm_language(spark, sf_dir):
    """Every document's predicted language; those whose fold of five is 0 are never learned from."""
    docs = common.table(spark, sf_dir, "documents")
    texts = language.training_texts(docs, fold(5) != 0)
    found = language.identified(docs.select("doc_id", (fold(5) == 0).alias("held_out"), "text"), texts)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def tokenizer() -> str:
    """The vocabulary file of the packing query."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op6_genetic_packing(spark, sf_dir):
    """Every token piece of every document, its sequence and its place there."""
    return packing.pack_documents(common.table(spark, sf_dir, "documents"), tokenizer(), 2048, 0)


def op7_subsequence_toxicity(spark, sf_dir):
    """Every document's chance of being toxic; labels of fold 1 of three are never learned."""
    docs = common.table(spark, sf_dir, "documents")
    texts, labels = toxicity.training_rows(docs, common.table(spark, sf_dir, "labels"), fold(3) != 1)
    found = toxicity.scored(docs.select("doc_id", (fold(3) == 1).alias("held_out"), "text"), texts, labels)
    return found.select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op8_rotated_codes(spark, sf_dir):
    """The ten vectors nearest to each of every hundredth vector."""
    vectors = common.table(spark, sf_dir, "embeddings")
    return search.nearest(vectors, vectors.where("vec_id % 100 = 0"), 10)


def op9_rendezvous_sharding(spark, sf_dir):
    """Every document's shard of 40, its place there, and its shard of 41."""
    docs = common.table(spark, sf_dir, "documents")
    body = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(body) + 16).cast("long").alias("size"), F.crc32(body).alias("text_crc32"), F.lit("key").alias("law"))
    return sharding.placed(sharding.assigned(rows, "doc_id", [1.0] * 40, 1.0), "doc_id").select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op10_exact_dedup(spark, sf_dir):
    """Every document's class of equal texts; the largest doc_id stays."""
    return exact_dedup.duplicate_classes(common.table(spark, sf_dir, "documents"), keep="max")


def op11_pivot_phrases(spark, sf_dir):
    """Each language's first 2000 collocations."""
    return phrases.collocations(common.table(spark, sf_dir, "documents"))


def op12_backtracking_bpe(spark, sf_dir):
    """Every document's number of tokens, and digests of its ids and of the bytes that they decode to."""
    import public_tokenizers

    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).drop("text")


def op13_norm_bucketed_negatives(spark, sf_dir):
    """Hard negatives of each of every hundredth vector and its positives; every seventh vector has another label than the table's."""
    other = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return negatives.hard_negatives(common.table(spark, sf_dir, "embeddings").withColumn("label", other), F.col("id") % 100 == 0)


OP10_SQL = f"""
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS body FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, sha256(body) AS text_sha256
FROM t WINDOW g AS (PARTITION BY body)
"""


OP11_SQL = rf"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS body FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(body, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, k, unnest([array_to_string(w[i : i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase FROM w, (VALUES (1), (2), (3)) AS sizes(k)),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL),
totals AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= 10),
cuts AS (SELECT c.*, unnest(range(1, k)) AS cut FROM c),
parts AS (SELECT *, array_to_string(w[1:cut], ' ') AS head, array_to_string(w[cut + 1 :], ' ') AS tail FROM cuts),
scored AS (
  SELECT p.lang, p.phrase, p.a, p.cut, x.a AS l, y.a AS r, (1000000 * p.a::HUGEINT * p.a) // (x.a::HUGEINT * y.a) AS score
  FROM parts p JOIN f x ON x.lang = p.lang AND x.phrase = p.head AND x.k = p.cut JOIN f y ON y.lang = p.lang AND y.phrase = p.tail AND y.k = p.k - p.cut),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a FROM c WHERE k = 3),
longer AS (SELECT lang, phrase, max(a) AS most FROM inside GROUP BY ALL),
kept AS (SELECT s.* FROM lowest s LEFT JOIN longer USING (lang, phrase) WHERE most IS NULL OR 100 * most < 50 * s.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

OP13_SQL = """
WITH good AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
rows AS (SELECT * FROM good WHERE len(v) = (SELECT len(v) FROM good GROUP BY len(v) ORDER BY count(*) DESC, len(v) LIMIT 1)),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER w::INTEGER AS rank, n.vec_id AS negative_id, positive_score, n.score AS negative_score
FROM positives p JOIN scores n USING (anchor_id) WHERE NOT n.same AND 100 * n.score BETWEEN 80 * positive_score AND 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY n.score DESC, n.vec_id) QUALIFY row_number() OVER w <= 5
"""


def mixture_sql(sweeps: int = mixing.SWEEPS) -> str:
    """The mixture's SQL: the sweeps are a recursive query over the cells."""
    wants, joins = [], []
    for name, listed in MARGINS.items():
        cases = " ".join(f"WHEN {name} = '{value}' THEN {share}::DOUBLE" for value, share in listed.items())
        left = max(0.0, 1.0 - sum(listed.values()))
        wants.append(f"""
{name}_0 AS (SELECT {name}, sum(tokens)::DOUBLE AS n, CASE {cases} END AS want FROM cells GROUP BY {name}),
{name}_1 AS (SELECT {name}, coalesce(want, n / sum(n) FILTER (want IS NULL) OVER () * {left!r}) AS want FROM {name}_0),
{name}_t AS (SELECT {name}, want / sum(want) OVER () AS t_{name} FROM {name}_1),""")
        joins.append(f"JOIN {name}_t USING ({name})")
    inner = "source, lang, topic, t_source, t_lang, t_topic, tokens, total"
    step = "raked WHERE k < " + str(sweeps)
    for name in MARGINS:
        step = f"(SELECT {inner}, k, w * t_{name} * total / sum(w) OVER (PARTITION BY {name}) AS w FROM {step})"
    return f"""
WITH RECURSIVE marked AS (
  SELECT doc_id, coalesce(source, 'none') AS source, coalesce(lang, 'none') AS lang,
    greatest(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')), 1) AS tokens FROM documents),
named AS (SELECT *, CASE WHEN tokens < 60 THEN 'brief' WHEN tokens < 600 THEN 'article' ELSE 'book' END AS topic FROM marked),
cells AS (SELECT source, lang, topic, sum(tokens) AS tokens FROM named GROUP BY ALL),{"".join(wants)}
raked AS (
  SELECT {inner.replace(", total", "")}, sum(tokens) OVER ()::DOUBLE AS total, 0 AS k, tokens::DOUBLE AS w FROM cells {" ".join(joins)}
  UNION ALL
  SELECT {inner}, k + 1, w FROM {step}),
rates AS (SELECT source, lang, topic, w / tokens * 0.5 AS rate FROM raked WHERE k = {sweeps})
SELECT n.doc_id, n.source, n.lang, n.topic, n.tokens, round(r.rate, 6) AS rate,
  (floor(r.rate) + (((('0x' || substr(md5('mix:' || coalesce(n.doc_id::VARCHAR, '')), 1, 12))::BIGINT + 0.5) / 281474976710656.0) < r.rate - floor(r.rate))::INTEGER)::BIGINT AS copies
FROM named n JOIN rates r USING (source, lang, topic)
"""


def queries():
    """Queries by name."""
    return {"op1_secret_scan": op1_secret_scan, "op2_raked_mixture": op2_raked_mixture, "op3_ngram_jaccard": op3_ngram_jaccard, "op4_line_dedup": op4_line_dedup, "op5_ppm_language": op5_ppm_language, "op6_genetic_packing": op6_genetic_packing, "op7_subsequence_toxicity": op7_subsequence_toxicity, "op8_rotated_codes": op8_rotated_codes, "op9_rendezvous_sharding": op9_rendezvous_sharding, "op10_exact_dedup": op10_exact_dedup, "op11_pivot_phrases": op11_pivot_phrases, "op12_backtracking_bpe": op12_backtracking_bpe, "op13_norm_bucketed_negatives": op13_norm_bucketed_negatives}


def oracle_sql():
    """DuckDB SQL by query name, where SQL can express it."""
    return {"op2_raked_mixture": mixture_sql(), "op10_exact_dedup": OP10_SQL, "op11_pivot_phrases": OP11_SQL, "op13_norm_bucketed_negatives": OP13_SQL}
