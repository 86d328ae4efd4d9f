"""Rendered documents: a quoted header, then fragments parted by blank lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import bound, in_closed_set, strip

#: Kinds of source, default licence, header keys, languages and word counts that pass validation.
SOURCE_KINDS = ("teoria", "transcripcion_curso")
LICENCE = "personal_only"
DOCUMENT_KEYS = ("fuente", "autor", "tipo_fuente", "licencia")
FRAGMENT_KEYS = ("subtipo", "idioma_original", "idioma_fragmento")
LANGUAGES = ("en", "es")
LEAST_WORDS, MOST_WORDS = 100, 50_000


def scalar(value: Column) -> Column:
    """A header value: null, or quoted with backslashes and quotes escaped."""
    text = F.replace(F.replace(value.cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.when(value.isNull(), "null").otherwise(F.concat(F.lit('"'), text, F.lit('"')))


def rendered(fragments: Column, source: Column, kind: Column, author: Column, licence: Column) -> Column:
    """A whole document from array<struct<texto, subtipo, idioma_original, idioma_fragmento>>; no fragments or an unknown kind are errors."""
    head = [F.lit("---")]
    for key, value in zip(DOCUMENT_KEYS, (source, author, in_closed_set(kind, SOURCE_KINDS, "tipo_fuente"), licence), strict=True):
        head.append(F.concat(F.lit(f"{key}: "), scalar(value)))
    head.append(F.lit("fragmentos:"))

    def item(f: Column) -> Column:
        lines = [F.concat(F.lit(("  - " if k == 0 else "    ") + f"{key}: "), scalar(f[key])) for k, key in enumerate(FRAGMENT_KEYS)]
        return F.concat_ws("\n", *lines)

    whole = F.concat(
        F.concat_ws("\n", *head), F.lit("\n"), F.array_join(F.transform(fragments, item), "\n"), F.lit("\n---\n\n"),
        F.array_join(F.transform(fragments, lambda f: f["texto"]), "\n\n"), F.lit("\n"),
    )
    return F.when(F.coalesce(F.size(fragments), F.lit(0)) > 0, whole).otherwise(F.raise_error(F.lit("a document without fragments")).cast("string"))


def unscalar(value: Column) -> Column:
    """Inverse of scalar() but for a backslash before a quote; what isn't quoted stays as it is."""

    def read(v: Column) -> Column:
        inner = F.replace(F.replace(F.substr(v, F.lit(2), F.length(v) - 2), F.lit('\\"'), F.lit('"')), F.lit("\\\\"), F.lit("\\"))
        quoted = F.startswith(v, F.lit('"')) & F.endswith(v, F.lit('"')) & (F.length(v) >= 2)
        return F.when(v == "null", F.lit(None).cast("string")).when(quoted, inner).otherwise(v)

    return bound(strip(value), read)


def parts(content: Column) -> Column:
    """struct<head, body>: without a header, the head is empty and the body is everything."""
    cut = F.split(content, "---\n", 3)
    ok = (F.size(cut) == 3) & (F.get(cut, 0) == "")
    body = F.when(ok, F.regexp_replace(F.get(cut, 2), r"^\n", "")).otherwise(content)
    return F.struct(F.when(ok, F.get(cut, 1)).otherwise("").alias("head"), body.alias("body"))


def pairs(lines: Column) -> Column:
    """map of `key: value` lines; lines without a colon are left out and of equal keys the last counts."""
    good = F.transform(F.filter(lines, lambda x: F.locate(":", x) > 0), lambda x: F.struct(strip(F.substring_index(x, ":", 1)).alias("key"), F.substr(x, F.locate(":", x) + 1).alias("x")))
    value = lambda found: F.map_from_entries(F.transform(found, lambda e: F.struct(e["key"].alias("key"), unscalar(e["x"]).alias("value"))))

    def last(found: Column, keys: Column) -> Column:
        return F.filter(found, lambda e, k: ~F.array_contains(F.slice(keys, k + 2, F.greatest(F.size(keys) - k, F.lit(0))), e["key"]))

    def distinct(found: Column) -> Column:
        # keys as a list are worked out once, and places are compared only where a key repeats
        return bound(found["key"], lambda keys: value(F.when(F.size(F.array_distinct(keys)) == F.size(keys), found).otherwise(last(found, keys))))

    return bound(good, distinct)


def header_fields(head: Column) -> Column:
    """The document's fields of a header: a map."""
    lines = F.split(F.substring_index(F.concat(F.lit("\n"), head), "\nfragmentos:", 1), "\n", -1)
    return pairs(lines)


def header_fragments(head: Column) -> Column:
    """The fragments' fields of a header: an array of maps. Lines need no strip of their own: keys and values are stripped."""
    whole = F.concat(F.lit("\n"), head)
    after = F.when(F.locate("\nfragmentos:", whole) > 0, F.substr(whole, F.locate("\nfragmentos:", whole) + 12)).otherwise("")
    items = F.slice(F.split(after, "\n  - ", -1), 2, 1_000_000_000)
    return F.transform(items, lambda x: pairs(F.split(x, "\n", -1)))


def chunks(content: Column) -> Column:
    """Chunks of a rendered document's body: blank-line parted, an empty body gives none; a missing end of the header is an error."""
    body = F.get(F.split(content, "\n---\n", 2), 1)
    bare = F.regexp_replace(body, r"^\n+|\n+$", "")
    wrong = F.raise_error(F.lit("the header has no end")).cast("array<string>")
    return F.when(body.isNull(), wrong).when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, "\n\n", -1))


def word_count(body: Column) -> Column:
    """Words parted by white space of any kind."""
    return F.size(F.filter(F.split(body, r"(?U)\s+", -1), lambda w: w != ""))
