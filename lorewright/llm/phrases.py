"""Phrase collocations by pivot partitioning: fragments of text go to the rarest word of the n-grams in them, which are mined there."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import dealt, dropped, materialised, shipped

#: Occurrences from which a phrase is a candidate, words in a phrase at most, percent of a phrase's occurrences within a longer one that drop it, rows of a language.
LEAST, LONGEST, WITHIN, FIRST = 10, 3, 50, 2000
#: Bytes of one language that are looked at together, and words that a worker remembers the order of.
CHUNK, REMEMBERED = 1 << 22, 300_000
#: Binary logarithm of the counters of the words' order; fragments that one home of a pivot takes, by its word's frequency; bytes in a row of fragments.
COUNTERS, HOME, ROW_BYTES = 22, 1 << 18, 1 << 16
#: Parts in which a language's first rows are found before they meet.
PARTS = 64
#: Ends a piece of text; no byte of UTF-8.
END = b"\xff"
_SPLIT, _BETWEEN = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", END * 10), re.compile(rb"[ \t\n.]")


def chunks(batches: Iterator[pa.RecordBatch], size: int = CHUNK) -> Iterator[tuple[str, list[bytes], bool]]:
    """(lang, words and END, whether the text goes on in the next of this language) of texts (lang, text), about `size` bytes at a time; a longer text is cut between words."""
    held: dict[str, list[bytes]] = {}
    sizes: Counter[str] = Counter()

    def words(parts: list[bytes]) -> list[bytes]:
        return END.join([b"", *parts, b""]).lower().translate(_SPLIT).replace(END, b" \xff ").split()

    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for lang, text in zip(batch.column("lang").to_pylist(), texts, strict=True):
            raw = text.as_py()
            if len(raw) > size:
                if lang in held:
                    yield lang, words(held.pop(lang)), False
                begin = 0
                while len(raw) - begin > size and (cut := _BETWEEN.search(raw, begin + size)):
                    yield lang, words([raw[begin : cut.start()]])[1 if begin else 0 : -1], True
                    begin = cut.start()
                yield lang, words([raw[begin:]])[1 if begin else 0 :], False
                sizes.pop(lang, None)
                continue
            held.setdefault(lang, []).append(raw)
            sizes[lang] += len(raw) + 1
            if sizes[lang] > size or sizes.total() > 4 * size:
                for lang in [lang] if sizes[lang] > size else list(held):
                    yield lang, words(held.pop(lang)), False
                    del sizes[lang]
    for lang, parts in held.items():
        yield lang, words(parts), False


def seed(lang: str) -> int:
    """Seed of the hashes of a language's words."""
    return zlib.crc32(lang.encode())


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, h, word, f) of texts (lang, text): all words and their hashes. Words are counted in each task before they are shuffled."""
    schema = pa.schema([("lang", pa.string()), ("h", pa.int64()), ("word", pa.string()), ("f", pa.int64())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter[bytes]] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, found in held.items():
                found.pop(END, None)
                hashes = np.fromiter((xxhash.xxh64_intdigest(w, seed(lang)) for w in found), np.uint64, len(found)).view(np.int64)
                words = pa.array(list(found), pa.binary()).cast(pa.string())
                yield pa.record_batch([pa.array([lang] * len(found), pa.string()), pa.array(hashes), words, pa.array(list(found.values()), pa.int64())], schema=schema)
            held.clear()

        for lang, words, _ in chunks(batches):
            held.setdefault(lang, Counter()).update(words)
            if sum(map(len, held.values())) > REMEMBERED:
                yield from rows()
        yield from rows()

    return texts.mapInArrow(counted, "lang string, h long, word string, f long").groupBy("lang", "h", "word").agg(F.sum("f").alias("f"))


def order_sketch(words: DataFrame) -> np.ndarray:
    """Counters by the first bits of the hashes: at least a word's frequency, 0 if no word of these has that counter. Of fixed size."""
    found = words.groupBy(F.expr(f"shiftrightunsigned(h, {64 - COUNTERS})").cast("int").alias("k")).agg(F.sum("f").alias("n")).toArrow()
    out = np.zeros(1 << COUNTERS, np.int64)
    out[found["k"].to_numpy()] = found["n"].to_numpy()
    return out


class Order(dict):
    """Places of a language's words in the order of frequency, ties by the first 32 bits of the hash; 0 for END and for words that no candidate holds."""

    def __init__(self, sketch: np.ndarray, lang: str):
        self.sketch, self.seed = sketch, seed(lang)
        self[END] = 0

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word, self.seed)
        n = min(int(self.sketch[h >> (64 - COUNTERS)]), (1 << 31) - 1)
        out = self[word] = n << 32 | h >> 32 if n else 0
        return out


def homes(sketch: np.ndarray, place: int, size: int) -> int:
    """Homes of a pivot: one for every `size` occurrences of its word."""
    return -(-int(sketch[(place & 0xFFFFFFFF) >> (32 - COUNTERS)]) // size)


def fragments(words: list[bytes], place: np.ndarray, first: int, last: int) -> tuple[np.ndarray, list[bytes], list[bytes], list[bytes]]:
    """(places, pivots, words on their left, on their right) of the words from `first` to before `last`: two on either side as far as they are no rarer than the pivot.

    Of equal words the leftmost owns an n-gram, so those on the left must come later in the order. A word with no neighbour is left out. Pivots are in the order of their places.
    """
    o = np.concatenate([np.zeros(2, np.int64), place, np.zeros(2, np.int64)])
    own = place[first:last]
    near = [o[first + 2 + k : last + 2 + k] for k in (-2, -1, 1, 2)]
    one, other = near[1] > own, near[2] >= own
    left, right = one.astype(np.int64) + (one & (near[0] > own)), other.astype(np.int64) + (other & (near[3] >= own))
    at = np.flatnonzero((own > 0) & (left + right > 0))
    at = at[np.argsort(own[at], kind="stable")]
    middle, left, right = (at + first).tolist(), left[at].tolist(), right[at].tolist()
    lefts = [words[m - 1] if n == 1 else words[m - 2] + b" " + words[m - 1] if n else b"" for m, n in zip(middle, left, strict=True)]
    rights = [words[m + 1] if n == 1 else words[m + 1] + b" " + words[m + 2] if n else b"" for m, n in zip(middle, right, strict=True)]
    return own[at], list(map(words.__getitem__, middle)), lefts, rights


HOMES = ["lang", "home", "salts", "pivot"]
ROUTED = pa.schema([("lang", pa.string()), ("home", pa.int64()), ("salts", pa.int32()), ("pivot", pa.binary()), ("lefts", pa.binary()), ("rights", pa.binary()), ("counts", pa.binary())])


def route(batches: Iterator[pa.RecordBatch], sketch: np.ndarray, size: int = CHUNK, home: int = HOME) -> Iterator[pa.RecordBatch]:
    """Rows (lang, home, salts, pivot, lefts, rights, counts): the fragments around each pivot, equal ones of a chunk once with their number. Frequent pivots have several homes, dealt by fragment."""
    orders: dict[str, Order] = {}
    carried: dict[str, tuple[list[bytes], int]] = {}
    for lang, words, more in chunks(batches, size):
        if sum(map(len, orders.values())) > REMEMBERED:
            orders.clear()
        order = orders.setdefault(lang, Order(sketch, lang))
        # a text that was cut goes on with its last words: two that have no neighbours yet on their right, and two on their left
        before, first = carried.pop(lang, ([], 0))
        words = before + words
        last = max(first, len(words) - 2) if more else len(words)
        if more:
            carried[lang] = words[max(0, last - 2) :], min(2, last)
        placed, pivots, lefts, rights = fragments(words, np.fromiter(map(order.__getitem__, words), np.int64, len(words)), first, last)
        out: list[tuple] = []
        cuts = [0, *(np.flatnonzero(np.diff(placed)) + 1).tolist(), len(placed)] if len(placed) else []
        for a, z in zip(cuts, cuts[1:], strict=False):
            place, pivot = int(placed[a]), pivots[a]
            salts = homes(sketch, place, home)
            if z - a == 1 and salts == 1:
                out.append((lang, place, 1, pivot, lefts[a], rights[a], None))
                continue
            pairs = list(zip(lefts[a:z], rights[a:z], strict=True))
            words_of = pivots[a:z]
            # different words may share a place
            for pivot in (pivot,) if words_of.count(pivot) == z - a else set(words_of):
                own = pairs if len(words_of) == words_of.count(pivot) else [p for w, p in zip(words_of, pairs, strict=True) if w == pivot]
                found = dict.fromkeys(own, 1)
                if len(found) < len(own):
                    found = Counter(own)
                dealt_to: dict[int, list] = {} if salts > 1 else {0: list(found)}
                for pair in found if salts > 1 else ():
                    dealt_to.setdefault(zlib.crc32(b"\t".join(pair)) % salts, []).append(pair)
                for salt, some in dealt_to.items():
                    for row in rows_of(some):
                        counts = None if len(found) == len(own) else np.fromiter(map(found.__getitem__, row), np.int64, len(row)).tobytes()
                        x, y = zip(*row, strict=True)
                        out.append((lang, place + salt, salts, pivot, b"\n".join(x), b"\n".join(y), counts))
        if out:
            yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*out, strict=True), ROUTED.types, strict=True)], schema=ROUTED)


def rows_of(pairs: list[tuple[bytes, bytes]]) -> Iterator[list[tuple[bytes, bytes]]]:
    """`pairs` in parts of about ROW_BYTES."""
    if sum(len(x) + len(y) for x, y in pairs) <= ROW_BYTES:
        yield pairs
        return
    held, begin = 0, 0
    for k, (x, y) in enumerate(pairs):
        held += len(x) + len(y)
        if held > ROW_BYTES:
            yield pairs[begin : k + 1]
            held, begin = 0, k + 1
    if begin < len(pairs):
        yield pairs[begin:]


class Pivot:
    """The fragments that a home of a pivot has so far."""

    def __init__(self, lang: str, home: int, salts: int, word: bytes):
        self.key = lang, home, salts, word
        self.lefts, self.rights = Counter(), Counter()
        self.pairs: list[tuple] = []

    def add(self, lefts: bytes, rights: bytes, counts: bytes | None) -> None:
        """Takes a row of fragments."""
        x, y = lefts.split(b"\n"), rights.split(b"\n")
        n = None if counts is None else np.frombuffer(counts, np.int64).tolist()
        for held, side in ((self.lefts, x), (self.rights, y)):
            if n is None:
                held.update(side)
            else:
                for words, times in zip(side, n, strict=True):
                    held[words] += times
        self.pairs.append((x, y, n))

    def grams(self, least: int) -> dict[bytes, int]:
        """The n-grams that the pivot owns, `least` times or more here: with the words on one side, or one word of each side."""
        word = self.key[3]
        near: tuple[Counter, Counter] = Counter(), Counter()
        first: tuple[dict, dict] = {}, {}
        out: dict[bytes, int] = {}
        for side, held in enumerate((self.lefts, self.rights)):
            for words, n in held.items():
                if words:
                    one = words.partition(b" ")[0] if side else words.rpartition(b" ")[2]
                    first[side][words] = one
                    near[side][one] += n
                    if n >= least and len(one) < len(words):
                        out[word + b" " + words if side else words + b" " + word] = n
            for one, n in near[side].items():
                if n >= least:
                    out[word + b" " + one if side else one + b" " + word] = n
        # an n-gram is no more frequent than what it holds
        left, right = ({words: one for words, one in first[side].items() if near[side][one] >= least} for side in (0, 1))
        if left and right:
            middle: Counter = Counter()
            for x, y, n in self.pairs:
                both = zip(map(left.get, x), map(right.get, y), strict=True)
                if n is None:
                    middle.update([p for p in both if p[0] and p[1]])
                else:
                    for p, times in zip(both, n, strict=True):
                        if p[0] and p[1]:
                            middle[p] += times
            out.update((x + b" " + word + b" " + y, n) for (x, y), n in middle.items() if n >= least)
        return out


MINED = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("a", pa.int64()), ("part", pa.bool_())])


def mine(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, a, part) of rows of route() sorted by HOMES: the n-grams that each pivot owns and its home holds `least` times; those of a pivot with several homes are part of a count."""
    out: list[tuple[str, dict[bytes, int], bool]] = []

    made = 0

    def closed(pivot: Pivot) -> None:
        nonlocal made
        lang, _, salts, _ = pivot.key
        if salts > 1 or pivot.lefts.total() >= least:
            found = pivot.grams(1 if salts > 1 else least)
            if found:
                out.append((lang, found, salts > 1))
                made += len(found)

    def rows() -> pa.RecordBatch:
        grams = pa.array([g for x in out for g in x[1]], pa.binary()).cast(pa.string())
        columns = [pa.array([x[0] for x in out for _ in x[1]], pa.string()), grams, pa.array([n for x in out for n in x[1].values()], pa.int64()), pa.array([x[2] for x in out for _ in x[1]], pa.bool_())]
        out.clear()
        return pa.record_batch(columns, schema=MINED)

    now = None
    for batch in batches:
        for *key, lefts, rights, counts in zip(*[batch.column(c).to_pylist() for c in ROUTED.names], strict=True):
            if now is None or now.key != tuple(key):
                if now:
                    closed(now)
                now = Pivot(*key)
            now.add(lefts, rights, counts)
            if made > 20_000:
                yield rows()
                made = 0
    if now:
        closed(now)
    yield rows()


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exactly, for counts below 10 ** 15."""
    wide = lambda c: c.cast("decimal(19,0)")
    return F.call_function("div", (wide(a) * a.cast("decimal(18,0)") * F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(38,0)"), (left.cast("decimal(18,0)") * right.cast("decimal(18,0)")).cast("decimal(38,0)"))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, within: int = WITHIN, first: int = FIRST) -> DataFrame:
    """Each language's `first` phrases of two or three words: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z alone) and split at `[.,;:!?]` and line ends into pieces, and pieces at blanks into words. A phrase counts at every
    place. All words are counted; those that are frequent enough make an order, rarest first, by counters of fixed size: a word's counter is
    never below its frequency, and any order serves as long as it is one. Each place sends the words around it, as far as they are no
    rarer, to its own word, and only the n-grams that this word owns are counted there. A word of more than HOME occurrences has several
    homes, whose counts are summed, so no task holds a frequent word's fragments. Scores are those of the lowest-scoring cut.
    A phrase that stands to `within` percent or more inside a longer candidate is dropped.

    Null texts are empty and null languages `und`. Repeated rows count as often as they stand there. Other columns are not read. An empty table gives
    no rows. Counts must stay below 10 ** 15, or the division raises an error.
    """
    spark = docs.sparkSession
    shipped(spark)
    texts = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    words = materialised(word_counts(texts), "phrase-words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = words.where(F.col("f") >= least)
    sketch = spark.sparkContext.broadcast(order_sketch(frequent))
    routed = materialised(texts.mapInArrow(lambda batches: route(batches, sketch.value), "lang string, home long, salts int, pivot binary, lefts binary, rights binary, counts binary").repartition(dealt(spark), *HOMES).sortWithinPartitions(*HOMES).mapInArrow(lambda batches: mine(batches, least), "lang string, phrase string, a long, part boolean"), "phrase-counts")
    summed = routed.where("part").groupBy("lang", "phrase").agg(F.sum("a").alias("a")).where(F.col("a") >= least)
    found = materialised(routed.where("not part").select("lang", "phrase", "a").unionByName(summed), "phrases")
    out = materialised(ranked(found, frequent.select("lang", "word", "f"), totals, within, first), "collocations")
    sketch.unpersist()
    for table in (words, routed, found):
        dropped(table)
    return out


def ranked(found: DataFrame, words: DataFrame, totals: DataFrame, within: int, first: int) -> DataFrame:
    """The rows of collocations() for candidates (lang, phrase, a), the words' frequencies and the languages' totals."""
    w = F.split("phrase", " ")
    rows = found.withColumn("w", w).withColumns({"one": F.get("w", F.lit(0)), "last": F.element_at("w", -1), "three": F.size("w") == LONGEST})
    rows = rows.withColumns({"head": F.when(F.col("three"), F.concat_ws(" ", F.get("w", F.lit(0)), F.get("w", F.lit(1)))), "tail": F.when(F.col("three"), F.concat_ws(" ", F.get("w", F.lit(1)), F.get("w", F.lit(2))))}).drop("w")

    def with_count(df: DataFrame, table: DataFrame, key: str, to: str, name: str) -> DataFrame:
        other = table.select(F.col("lang").alias("_lang"), F.col(key).alias("_key"), F.col(table.columns[-1]).alias(name))
        return df.join(other, (F.col("lang") == F.col("_lang")) & (F.col(to) == F.col("_key")), "left").drop("_lang", "_key")

    longer = rows.where("three").select("lang", "a", F.explode(F.array("head", "tail")).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    pairs = rows.where("not three").drop("head", "tail")
    pairs = with_count(pairs, longer, "phrase", "phrase", "most").where(F.col("most").isNull() | (F.col("most") * 100 < F.col("a") * within)).drop("most")
    pairs = with_count(with_count(pairs, words, "word", "one", "l"), words, "word", "last", "r").withColumn("score", score(F.col("a"), F.col("l"), F.col("r")))
    three = rows.where("three")
    for table, key, to, name in ((words, "word", "one", "l1"), (found, "phrase", "tail", "r1"), (found, "phrase", "head", "l2"), (words, "word", "last", "r2")):
        three = with_count(three, table, key, to, name)
    cuts = [F.struct(score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in (1, 2)]
    three = three.withColumn("cut", F.array_min(F.array(*cuts)))
    columns = ["lang", "phrase", "a", "l", "r", "score"]
    scored = pairs.select(*columns).unionByName(three.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # first within parts, so no task holds more than PARTS times `first` rows of a language
    scored = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    for keys in (["lang", "part"], ["lang"]):
        scored = scored.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= first)
    long = lambda c: F.col(c).cast("long").alias(c)
    return scored.join(totals, "lang").select("lang", long("rank"), "phrase", long("a"), long("l"), long("r"), long("n"), long("score"))
