"""Prompts for models and the contracts that their answers must keep. Answers that break one become an error beside nulls, never a failed job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lorewright.operators.cost import SEGMENT_PROMPT, STRUCTURE_PROMPT
from lorewright.operators.reconcile import JOKE_STATES
from lorewright.operators.taxonomy import NO_MATCH

#: Fields of the answers about a joke, about where it begins, and about a label.
STRUCTURE_FIELDS = ("texto_normalizado", "tema", "estructura", "estado", "sugerencias")
SEGMENT_FIELDS = ("inicio",)
LABEL_FIELDS = ("nombre",)
CLOSED = {"estado": JOKE_STATES}


def structure_prompt(text: Column) -> Column:
    """Asks for the five fields of a joke."""
    return F.concat(F.lit(STRUCTURE_PROMPT), text)


def segment_prompt(window: Column) -> Column:
    """Asks where the joke of a window begins."""
    return F.concat(F.lit(SEGMENT_PROMPT), window)


def label_prompt(text: Column, kind: str, attempt: int, names: Column | None = None) -> Column:
    """Asks for the name of a joke's topic or technique; the first attempt is free, later ones choose from `names` (an array) or answer that none fits."""
    head = F.concat(F.lit(f"Name the {kind} of this joke in a few words.\n\n"), text)
    if attempt == 1:
        return head
    if names is None:
        raise ValueError("later attempts need the names to choose from")
    return F.concat(head, F.lit(f"\n\nChoose one of these, or answer {NO_MATCH}:\n"), F.array_join(F.transform(names, lambda n: F.concat(F.lit("- "), n)), "\n"))


def answer(raw: Column, fields: Sequence[str] = STRUCTURE_FIELDS, closed: Mapping[str, Sequence[str]] = CLOSED) -> Column:
    """struct of `fields` and error, from a model's JSON text.

    Every field must be there and be a string, and one of `closed` must have one of its values; the error names the first fault, and
    then all fields are null. Null, empty and malformed text, and JSON that is no object, are faults too. Other fields are left out.
    """
    variant = F.try_parse_json(raw)
    error = F.when(variant.isNull(), F.lit("no JSON")).when(~F.schema_of_variant(variant).startswith("OBJECT"), F.lit("no object"))
    values = {}
    for name in fields:
        found = F.try_variant_get(variant, f"$.{name}", "variant")
        values[name] = F.try_variant_get(variant, f"$.{name}", "string")
        wrong = found.isNull() | F.is_variant_null(found)
        error = error.when(wrong, F.lit(f"{name} is missing")).when(F.schema_of_variant(found) != "STRING", F.lit(f"{name} is no string"))
        if name in closed:
            error = error.when(~values[name].isin(*closed[name]), F.concat(F.lit(f"{name}: unknown value "), values[name]))
    kept = [F.when(error.isNull(), values[name]).alias(name) for name in fields]
    return F.struct(*kept, error.alias("error"))
