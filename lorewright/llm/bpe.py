"""Byte-level BPE by backtracking over longest matches: exact merges in linear time, and decoding."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain, islice

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shipped

#: Units of text that a worker remembers the ids of (twice as many at most), characters of one of them at most; pairs of tokens that it remembers.
UNITS, UNIT_LENGTH, PAIRS = 400_000, 40, 1_000_000
#: Units of a text that are looked at together.
TOGETHER = 1 << 16
#: Bytes of a word whose longest matches are found together.
STRETCH = 1 << 16
_LOADED: dict[tuple[str, str], Codec] = {}


class Recent(dict):
    """What `make` gives for keys that were asked for of late: when `size` of them are held they become the older half, of which those asked for again stay."""

    def __init__(self, make, size: int, length: int):
        self.make, self.size, self.length, self.older = make, size, length, {}

    def __missing__(self, key: str) -> tuple[int, ...]:
        out = self.older.get(key) or self.make(key)
        if len(key) <= self.length:
            if len(self) >= self.size:
                self.older = dict(self)
                self.clear()
            self[key] = out
        return out


class Codec:
    """Ids of texts by a file of ranks (base64 of the bytes and the rank in each line), as merging the adjacent pair of lowest rank until none is left gives them.

    The automaton of all tokens, on bytes as Latin-1 letters, gives the longest token at each place of a word. From left to right that one is taken,
    or a shorter one that begins it, if merging could leave it beside the token before it; where none can stand, the place is given up for good and
    the token before it is shortened. A place is given up once, so the time is linear in the word's length. Tokens that merges never
    make are found as whole words only.
    """

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        if any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError(f"{path} lacks tokens of single bytes")
        self.pattern = regex.compile(pattern)
        self.raw = {n: t for t, n in self.ranks.items()}
        self.before = {n: len(t) - 1 for n, t in self.raw.items()}
        self.same = {n: n for n in self.raw}
        # white space before a blank or after it
        self.runs = regex.compile(r"\s | \s")
        self.alone, self.after_blank = Recent(self.word_ids, UNITS // 4, UNIT_LENGTH), Recent(self.unit_ids, UNITS, UNIT_LENGTH)
        self.decimals = {n: str(n) for n in self.raw}
        self.pairs: dict[tuple[int, int], bool] = {}
        # when a token comes to be: single bytes are there before any merge
        self.born = {n: -1 if len(t) == 1 else n for t, n in self.ranks.items()}
        self.halves: dict[int, tuple[int, int]] = {}
        for token, n in self.ranks.items():
            if len(token) > 1:
                parts = self.merged(token, n)
                if len(parts) == 2:
                    self.halves[n] = parts[0], parts[1]
        made = [n for n, t in self.raw.items() if len(t) == 1 or n in self.halves]
        self.longest_token = max(len(self.raw[n]) for n in made)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for n in made:
            self.automaton.add_word(self.raw[n].decode("latin-1"), n)
        self.automaton.make_automaton()
        known = set(made)
        self.shorter = {n: next((m for k in range(len(t) - 1, 0, -1) if (m := self.ranks.get(t[:k])) in known), None) for n in made for t in (self.raw[n],)}
        # the halves along the seam, from the token to its last (first) byte, each with the time at which it is merged into the next larger one
        self.right, self.left = ({n: self.edge(n, side) for n in made} for side in (1, 0))

    def merged(self, word: bytes, below: int) -> list[int]:
        """Ids of a short word by plain merges of ranks below `below`."""
        parts = [word[k : k + 1] for k in range(len(word))]
        while len(parts) > 1:
            rank, k = min((self.ranks.get(parts[k] + parts[k + 1], below), k) for k in range(len(parts) - 1))
            if rank >= below:
                break
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return [self.ranks[p] for p in parts]

    def edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The tokens that lie at one end of `token` while it is being made, with the times at which they are merged away."""
        out, ends = [(token, float("inf"))], self.halves.get(token)
        while ends:
            out.append((ends[side], self.born[token]))
            token = ends[side]
            ends = self.halves.get(token)
        return out

    def beside(self, a: int, b: int) -> bool:
        """Whether merging leaves `a` and `b` side by side: no token over their seam comes up while both its halves are there.

        A merge over the seam that comes up at the same time as one within `a` is too late, since that one is further left; it comes before one within `b`.
        """
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.pairs[a, b] = not any(
                (n := self.ranks.get(self.raw[x] + self.raw[y])) is not None and max(self.born[x], self.born[y]) < n < gone and n <= lost for x, gone in self.right[a] for y, lost in self.left[b]
            )
        return known

    def longest(self, letters: str) -> list[int]:
        """The longest token at each place of a word given in Latin-1."""
        size, before = len(letters), self.before
        out = [0] * size
        # of the tokens that begin at one place the longer one ends later
        if size <= STRETCH:
            for end, n in self.automaton.iter(letters):
                out[end - before[n]] = n
            return out
        for begin in range(0, size, STRETCH):
            stop = begin + STRETCH
            for end, n in self.automaton.iter(letters[begin : stop + self.longest_token]):
                if (at := begin + end - before[n]) < stop:
                    out[at] = n
        return out

    def word(self, raw: bytes) -> list[int]:
        """Ids of one word of the pattern."""
        if (n := self.ranks.get(raw)) is not None:
            return [n]
        found, size, before, pairs, beside = self.longest(raw.decode("latin-1")), len(raw), self.before, self.pairs, self.beside
        out: list[int] = []
        shorter, given_up, at, last, token = self.shorter, set(), 0, None, found[0]
        while True:
            end = at + before[token] + 1
            if end not in given_up and (last is None or (known if (known := pairs.get((last, token))) is not None else beside(last, token))):
                out.append(token)
                if end == size:
                    return out
                at, last, token = end, token, found[end]
                continue
            token = shorter[token]
            while token is None:
                given_up.add(at)
                token = out.pop()
                at -= before[token] + 1
                token, last = shorter[token], out[-1] if out else None

    def word_ids(self, word: str) -> tuple[int, ...]:
        """Ids of one word of the pattern; equal ids are one object."""
        return tuple(map(self.same.__getitem__, self.word(word.encode())))

    def unit_ids(self, unit: str) -> tuple[int, ...]:
        """Ids of a blank and `unit`. Letters alone are one word of the pattern; of other units the letters at the front are looked up as such."""
        if unit.isalpha():
            return self.word_ids(f" {unit}")
        first, *rest = self.pattern.findall(f" {unit}")
        bare = first[1:]
        return tuple(chain(self.after_blank[bare] if bare.isalpha() else self.alone[first], *map(self.alone.__getitem__, rest)))

    def units(self, text: str) -> Iterator[tuple[Recent, list[str]]]:
        """`text` in units of whole words of the pattern and the table of their ids, a bounded number at a time.

        A blank that follows no white space and is followed by none begins a word, and what is before ends one: where all blanks are so,
        the text is cut before each of them. In other texts each word is a unit.
        """
        if self.runs.search(text) or text[-1:] == " ":
            found = self.pattern.finditer(text)
            while words := [m.group() for m in islice(found, TOGETHER)]:
                yield self.alone, words
            return
        begin = 0
        while begin < len(text):
            # as much as TOGETHER units of the common size; a later part begins with a blank
            end = text.find(" ", begin + 8 * TOGETHER)
            end = len(text) if end < 0 else end
            first, *rest = text[begin:end].split(" ")
            if first:
                yield self.alone, self.pattern.findall(first)
            yield self.after_blank, rest
            begin = end

    def blocks(self, text: str) -> Iterator[list[int]]:
        """Ids of `text`, a bounded number of units at a time."""
        for table, units in self.units(text):
            yield list(chain.from_iterable(map(table.__getitem__, units)))

    def encode(self, text: str) -> list[int]:
        """Ids of `text`."""
        return list(chain.from_iterable(self.blocks(text)))

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of ids; an unknown one is a KeyError."""
        return b"".join(map(self.raw.__getitem__, ids))

    def digests(self, text: str) -> tuple[int, str, str]:
        """(number of ids, SHA-256 of them in decimals with blanks between, SHA-256 of the bytes that they decode to)."""
        count, listed, plain = 0, hashlib.sha256(), hashlib.sha256()
        for ids in self.blocks(text):
            if ids:
                listed.update(((" " if count else "") + " ".join(map(self.decimals.__getitem__, ids))).encode())
                plain.update(self.decode(ids))
                count += len(ids)
        return count, listed.hexdigest(), plain.hexdigest()


def loaded(path: str, pattern: str) -> Codec:
    """The codec of a file of ranks, made once in each worker."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = Codec(path, pattern)
    return _LOADED[path, pattern]


def mapped(df: DataFrame, column: Column, kind: str, schema: str, rows) -> DataFrame:
    """`df` with the columns of `schema` beside it, made by `rows` (values of `column` to rows), a few values at a time; columns of these names are replaced."""
    shipped(df.sparkSession)
    made = [part.split()[0] for part in schema.split(", ")]
    types = pa.struct([pa.field(name, {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}[part.split()[1]]) for name, part in zip(made, schema.split(", "), strict=True)])

    @F.arrow_udf(f"struct<{', '.join(p.replace(' ', ':', 1) for p in schema.split(', '))}>")
    def each(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for values in batches:
            out: list[list] = [[] for _ in made]
            for k in range(0, len(values), 64):
                for row in rows(values.slice(k, 64).to_pylist()):
                    for held, value in zip(out, row, strict=True):
                        held.append(value)
            yield pa.StructArray.from_arrays([pa.array(held, field.type) for held, field in zip(out, types, strict=True)], fields=list(types))

    held = next(f"_made{k}" for k in range(len(df.columns) + 1) if f"_made{k}" not in df.columns)
    out = df.withColumn(held, each(column.cast(kind)))
    return out.select(*[f"`{c}`" for c in df.columns if c not in made], *[F.col(held)[name].alias(name) for name in made])


def encoded(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """`docs` with ids (array<int>) of every whole text; null texts are empty. Each match of `pattern` is encoded apart, without special tokens. No shuffle; repeated rows and other columns stay as they are."""

    def rows(texts: list[str]) -> Iterator[tuple]:
        codec = loaded(path, pattern)
        return ((codec.encode(t),) for t in texts)

    return mapped(docs, F.coalesce(F.col(text_col), F.lit("")), "string", "ids array<int>", rows)


def decoded(rows_of_ids: DataFrame, path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """`rows_of_ids` with raw (binary), the bytes that the ids stand for: of an encoded text its UTF-8, of any other list whatever bytes come out. Null lists give null; null and unknown ids are errors."""

    def rows(lists: list[list[int] | None]) -> Iterator[tuple]:
        codec = loaded(path, pattern)
        return ((None if x is None else codec.decode(x),) for x in lists)

    return mapped(rows_of_ids, F.col(ids_col), "array<int>", "raw binary", rows)


def round_trip(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """`docs` with n_tokens, ids_sha256 and decoded_sha256 of every whole text, encoded and decoded in one pass and a bounded number of words at a time.

    Null and empty texts have no ids: the digests are those of no bytes. Repeated rows have rows of their own. An empty table gives no rows. No shuffle.
    """

    def rows(texts: list[str]) -> Iterator[tuple]:
        codec = loaded(path, pattern)
        return map(codec.digests, texts)

    return mapped(docs, F.coalesce(F.col(text_col), F.lit("")), "string", "n_tokens long, ids_sha256 string, decoded_sha256 string", rows)

