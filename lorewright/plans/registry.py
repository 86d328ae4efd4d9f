"""Registry of the engine's own queries and their DuckDB SQL, gathered from the modules that hold them."""

from __future__ import annotations

from lorewright.operators import fragments
from lorewright.plans import queries_flows, queries_relational, queries_runs, queries_text
from lorewright.plans.binding import SUBTYPE_SQL, cleaned_sql, fragments_sql, quality_sql, words_sql

MODULES = (queries_text, queries_relational, queries_flows, queries_runs)


def flagship(spark, sf_dir):
    """Fragments, mean quality and example flag of every document: split, classify, clean, score, aggregate."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return fragments.document_quality(fragments.clean_fragments(fragments.split_documents(docs)))


FLAGSHIP_SQL = f"""
WITH {fragments_sql()}, s AS (SELECT doc_id, pos, texto, {SUBTYPE_SQL} AS subtipo FROM frag), e AS (SELECT * FROM s WHERE subtipo <> 'ejemplo'), {cleaned_sql('e', 'doc_id, pos')},
q AS (SELECT s.doc_id, s.subtipo, {words_sql('coalesce(limpio.x, s.texto)')} AS w FROM s LEFT JOIN limpio ON limpio.doc_id = s.doc_id AND limpio.pos = s.pos)
SELECT doc_id, count(*) AS num_fragmentos, avg({quality_sql('w')}) AS quality, bool_or(subtipo = 'ejemplo') AS hay_ejemplo FROM q GROUP BY doc_id"""


def queries():
    """Queries by name."""
    return {name: q for m in MODULES for name, (q, _) in m.QUERIES.items()} | {"flagship": flagship}


def oracle_sql():
    """DuckDB SQL by query name."""
    return {name: sql for m in MODULES for name, (_, sql) in m.QUERIES.items() if sql} | {"flagship": FLAGSHIP_SQL}
