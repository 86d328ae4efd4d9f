"""Punch-line marks: colours, spans, windows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import letters_and_digits, strip

#: Colour limits and the characters that stay outside a span's tags.
GREEN_BLUE_BELOW, RED_FROM, PURE_RED_FROM = 90, 120, 200
BORDERS = " \t\n.,;:!?…·—–-\"'“”‘’«»()[]{}¡¿"
PUNCH, ASIDE = "REMATE", "CHISTOIDE"
_BORDER_CLASS = "[" + "".join("\\" + c if c in "[]\\-^" else c for c in BORDERS) + "]"


def colour_tag(colour: Column) -> Column:
    """"REMATE" for pure red, "CHISTOIDE" for dark red, null for other colours, "auto" and what is no colour."""

    def channel(at: int) -> Column:
        return F.conv(F.substring(colour, at, 2), 16, 10).cast("int")

    good = colour.rlike("^[0-9A-Fa-f]{5}") & F.substring(colour, 5, 2).rlike("^[0-9A-Fa-f]{1,2}$")
    red = good & (channel(3) < GREEN_BLUE_BELOW) & (channel(5) < GREEN_BLUE_BELOW)
    return F.when(red & (channel(1) >= PURE_RED_FROM), PUNCH).when(red & (channel(1) >= RED_FROM), ASIDE)


def span(tag: Column, text: Column) -> Column:
    """`text` with its core in tags and border characters outside; text of border characters alone and a null tag leave it as it is."""
    lead = F.regexp_extract(text, f"^({_BORDER_CLASS}*)", 1)
    rest = F.substr(text, F.length(lead) + 1)
    core = F.regexp_replace(rest, f"{_BORDER_CLASS}+\\z", "")
    tail = F.substr(rest, F.length(core) + 1)
    made = F.concat(lead, F.lit("["), tag, F.lit("]"), core, F.lit("[/"), tag, F.lit("]"), tail)
    return F.when(tag.isNull() | (core == ""), text).otherwise(made)


def windows(text: Column) -> Column:
    """Stretches that each end with a punch line's closing tag, in order; what follows the last is left out.

    A stretch begins where the one before ended, and \\G keeps the search from trying other places in the text after the last. One without an opening tag isn't closed by it and runs on to the next pair.
    """
    return F.regexp_extract_all(text, F.lit(r"(?s)\G(.*?\[REMATE\].*?\[/REMATE\])"), F.lit(1))


def punch_line(window: Column) -> Column:
    """The punch line of a window."""
    return strip(F.regexp_extract(window, r"(?s)\[REMATE\](.*?)\[/REMATE\]", 1))


def asides(window: Column) -> Column:
    """The asides of a window, in order."""
    return F.transform(F.regexp_extract_all(window, F.lit(r"(?s)\[CHISTOIDE\](.*?)\[/CHISTOIDE\]"), F.lit(1)), strip)


def setup_place(window: Column, fragment: Column) -> Column:
    """Offset (from 0) at which a quoted fragment begins: exact, else with any white space for white space; null if blank or absent."""
    bare = strip(fragment)
    exact = F.call_function("instr", window, bare)
    pattern = F.concat(F.lit("(?U)"), F.array_join(F.transform(F.split(bare, r"(?U)\s+"), lambda w: F.concat(F.lit("\\Q"), w, F.lit("\\E"))), "\\s+"))
    loose = F.regexp_instr(window, pattern)
    return F.when((bare == "") | bare.isNull(), F.lit(None).cast("int")).when(exact > 0, exact - 1).when(loose > 0, loose - 1)


def tagged_letters(text: Column, tag: str) -> Column:
    """Word characters inside a tag."""
    inside = F.regexp_extract_all(text, F.lit(rf"(?s)\[{tag}\](.*?)\[/{tag}\]"), F.lit(1))
    return letters_and_digits(F.array_join(inside, ""))
