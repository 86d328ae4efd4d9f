"""How queries are bound to the test tables, and SQL fragments that their oracles share."""

from __future__ import annotations

from collections.abc import Callable

from lorewright.functions.text import FUNCTION_WORDS

#: Fillers, a repeated clause and an example marker put before each text, as the test texts have none.
PREFIX = "Bueno, el caso, el caso, digamos, no cambia. Por ejemplo, o sea, bueno, esto. Eh, sigue "
#: White space that DuckDB strips.
WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def register(table: dict[str, tuple[Callable, str | None]], name: str, sql: str | None = None):
    """Decorator: enters a query and its SQL under a name."""

    def enter(f):
        table[name] = (f, sql)
        return f

    return enter


def load(spark, sf_dir: str, name: str):
    """One input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def strip_sql(x: str) -> str:
    """SQL of functions.text.strip()."""
    return f"trim({x}, {WS})"


def split_sql(x: str) -> str:
    """SQL of functions.text.sentences(): ellipses are guarded, stops before white space become cuts."""
    guarded = f"regexp_replace({strip_sql(x)}, '(\\.\\.)(\\s+)', '\\1' || chr(2) || '\\2', 'g')"
    cut = f"regexp_replace({guarded}, '([.!?])\\s+', '\\1' || chr(1), 'g')"
    return f"list_filter(list_transform(string_split(replace({cut}, chr(2), ''), chr(1)), lambda s: {strip_sql('s')}), lambda s: s <> '')"


def fragments_sql(text: str = "text", name: str = "frag", source: str = "documents") -> str:
    """CTE of split_documents() without the subtype."""
    return f"""{name} AS (SELECT doc_id, unnest(l) AS texto, (generate_subscripts(l, 1) - 1)::INTEGER AS pos
  FROM (SELECT doc_id, {split_sql(text)} AS l FROM {source}))"""


SUBTYPE_SQL = "CASE WHEN " + " OR ".join(f"contains(lower(texto), '{m}')" for m in ("un ejemplo", "por ejemplo", "algo así como", "algo asi como")) + " THEN 'ejemplo' ELSE 'explicacion' END"


def filler_sql(x: str) -> str:
    """SQL of functions.text.without_fillers(); a boundary is the lack of a letter, digit or _ on a side."""
    edge = "[^\\p{L}\\p{M}\\p{N}_]"
    for word in ("o sea", "bueno", "digamos", "esto es", "eh", "básicamente"):
        x = f"regexp_replace({x}, '(?i)(^|{edge}){word}(?:,|({edge})|$)', '\\1\\2', 'g')"
    for tag in ("vale", "no"):
        x = f"regexp_replace({x}, '(?i)¿\\s*{tag}\\s*\\?', '', 'g')"
    return x


def clause_sql(parts: str) -> str:
    """SQL of functions.text.without_repeated_clauses(), of a column of clauses."""
    norm = lambda c: f"lower({strip_sql(c)})"
    return f"array_to_string(list_filter({parts}, lambda c, i: i = 1 OR {norm('c')} = '' OR {norm('c')} <> {norm(f'{parts}[i - 1]')}), ',')"


def tidy_sql(runs: str) -> str:
    """SQL of functions.text.tidied() without capital and stop, of a column of runs: commas, white space, and the rest."""
    blank = f"CASE WHEN {runs}[i + 1][1] IN (',', '.', '!', '?') THEN '' WHEN len(r) > 1 THEN ' ' ELSE r END"
    made = f"list_transform({runs}, lambda r, i: CASE WHEN r[1] = ',' THEN repeat(',', (len(r) - len(replace(r, ',', '')) + 1) // 2) WHEN {strip_sql('r')} = '' THEN {blank} ELSE r END)"
    return f"trim(array_to_string({made}, ''), ',' || {WS})"


WORD = "[\\p{L}\\p{M}\\p{Nd}_]+"


#: Pattern of the runs that tidy_sql() takes.
RUNS = ",(?:\\s*,)*|\\s+|[^\\s,]+"


def repeats_sql(words: str, gaps: str) -> str:
    """SQL of functions.text.without_repeated_words(), of columns of the words and of what parts them."""
    part = f"CASE WHEN i > 1 AND lower(w) = lower({words}[i - 1]) AND {gaps}[i] <> '' AND {strip_sql(f'{gaps}[i]')} = '' THEN '' ELSE {gaps}[i] || w END"
    return f"coalesce(array_to_string(list_transform({words}, lambda w, i: {part}), ''), '') || {gaps}[len({gaps})]"


def cleaned_sql(source: str, keys: str) -> str:
    """CTEs of functions.text.cleaned() for explanations: `source` has `keys` and texto; the result is `limpio` with `keys` and x. Lists that lambdas name are columns, made once a text."""
    finish = "CASE WHEN x = '' OR regexp_matches(x, '[.!?]$') THEN y ELSE y || '.' END"
    return f"""c1 AS MATERIALIZED (SELECT {keys}, string_split({filler_sql('texto')}, ',') AS parts FROM {source}), c2 AS MATERIALIZED (SELECT {keys}, {clause_sql('parts')} AS x FROM c1),
w AS MATERIALIZED (SELECT {keys}, regexp_extract_all(x, '{WORD}') AS words, regexp_split_to_array(x, '{WORD}') AS gaps FROM c2), c3 AS MATERIALIZED (SELECT {keys}, {repeats_sql('words', 'gaps')} AS x FROM w),
r AS MATERIALIZED (SELECT {keys}, regexp_extract_all(x, '{RUNS}') AS runs FROM c3), c4 AS MATERIALIZED (SELECT {keys}, {tidy_sql('runs')} AS x FROM r),
c5 AS (SELECT {keys}, x, CASE WHEN regexp_matches(x, '^\\p{{L}}') THEN upper(x[1]) || x[2:] ELSE x END AS y FROM c4),
limpio AS (SELECT {keys}, {finish} AS x FROM c5)"""


def words_sql(x: str) -> str:
    """SQL of functions.text.words()."""
    return f"list_transform(regexp_extract_all({x}, '\\p{{L}}+'), lambda w: lower(w))"


def quality_sql(w: str) -> str:
    """SQL of functions.text.quality_of(), of a column of words."""
    stop = "[" + ", ".join(f"'{x}'" for x in FUNCTION_WORDS) + "]"
    n = f"len({w})::DOUBLE"
    return f"""CASE WHEN len({w}) = 0 THEN 0.0 ELSE greatest(0.0, least(1.0, 0.4 * ({n} / ({n} + 25)) + 0.3 * (len(list_distinct({w})) / {n})
  + 0.3 * (len(list_filter({w}, lambda x: NOT list_contains({stop}, x))) / {n}))) END"""
