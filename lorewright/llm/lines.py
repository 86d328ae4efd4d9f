"""Line dedup: segment-partition edit join of all distinct lines, verified with banded bit-parallel edit distance."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    BITS,
    HOT_SHARE,
    attached,
    beside,
    bit_filter,
    blocks,
    bounds,
    classes_of,
    collected,
    compressed,
    counted,
    dropped,
    frequency_classes,
    lists,
    materialised,
    probing,
    shipped,
    sorted_lists,
    with_whole_ids,
)
from .components import components
from .shingles import _powers, mixed

#: Most edits, and the shortest line (of a pair) that allows so many: below 30 characters lines must be equal.
EDITS = 2
ALLOWED = ((60, 2), (30, 1))
#: Characters of lines hashed at once; cells of the tables of pairs checked at once; entries of a list in a block.
CHUNK, CELLS, LIST = 1 << 20, 1 << 21, 20_000
#: Lines whose keys a task remembers having handed on; bits of the filter of lines that need checking.
SEEN, FILTER_BITS = 500_000, 27
#: The lowest line number that stands for a document without lines.
NO_LINE = -1
_SPACE = " \t\r\f\x0b"


def allowed(n):
    """Edits allowed between two lines of which the shorter has n characters."""
    n = np.asarray(n)
    out = np.zeros(n.shape, np.int64)
    for least, edits in reversed(ALLOWED):
        out[n >= least] = edits
    return out


def segments(n: int, edits: int) -> list[tuple[int, int]]:
    """Start and length of the edits + 1 segments of a line of n characters; the later ones are longer by one where it doesn't divide."""
    k = edits + 1
    short = n // k
    out, at = [], 0
    for i in range(k):
        size = short + (i >= k - n % k)
        out.append((at, size))
        at += size
    return out


def keys_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of lines, and for each twice its line's number, plus one if it is of an own segment: the hashes of a line's own segments, and of its
    substrings that can equal a segment of a line that is as long or shorter by as many characters as are allowed."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    up, down = _powers(len(points) + 1)
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(mixed(points + np.uint64(77)) * up[: len(points)], out=sums[1:])
    keys, entries = [], []

    def add(rows: np.ndarray, at: np.ndarray, size: np.ndarray, i: int, shorter: np.ndarray, own: bool) -> None:
        a = starts[rows] + at
        h = (sums[a + size] - sums[a]) * down[a]
        keys.append(mixed(h + mixed((shorter * 8 + i).astype(np.uint64))))
        entries.append((2 * rows + own).astype(np.uint32))

    for less in range(EDITS + 1):
        shorter = sizes - less
        edits = np.where(shorter > 0, allowed(np.maximum(shorter, 0)), 0)
        for t in range(1, EDITS + 1):
            rows = np.flatnonzero((edits == t) & (less <= t))
            if not len(rows):
                continue
            n = shorter[rows]
            short, extra = n // (t + 1), n % (t + 1)
            for i in range(t + 1):
                longer = np.maximum(0, i - (t + 1 - extra))
                at, size = i * short + longer, short + (i >= t + 1 - extra)
                low = np.maximum(at - i, at + less - (t - i))
                high = np.minimum(at + i, at + less + (t - i))
                for move in range(-t, t + less + 1):
                    place = at + move
                    good = (place >= np.maximum(low, 0)) & (place <= np.minimum(high, sizes[rows] - size))
                    if good.any():
                        add(rows[good], place[good], size[good], i, n[good], less == 0 and move == 0)
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    return np.concatenate(keys), np.concatenate(entries)


def signatures(texts: list[str]) -> np.ndarray:
    """Two words for every line: which of 128 counters of its pairs of neighbouring characters are odd. One edit changes four at most."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    ends = np.cumsum([len(t) for t in texts])
    pair = (mixed(points[:-1] * np.uint64(0x10FFFF) + points[1:]) >> np.uint64(57)).astype(np.uint64)
    out = []
    for low in (True, False):
        bits = np.append(np.where((pair < 64) == low, np.uint64(1) << (pair & np.uint64(63)), np.uint64(0)), np.uint64(0))
        bits[ends - 1] = 0  # a line's last character has no neighbour
        out.append(np.bitwise_xor.reduceat(bits, np.concatenate([[0], ends[:-1]])).view(np.int64))
    return np.stack(out)


def distances(one: list[str], two: list[str], edits: int = EDITS) -> np.ndarray:
    """Edit distances of pairs of lines whose lengths differ by `edits` at most; what is over `edits` is only known to be so.

    Of each column of the table of distances a band of 2 * edits + 1 cells is kept as bits of a word: where a cell is one more (up) or one less
    (down) than that above it. A column is a few word operations, for all pairs at once. Cells off the band count as one more than their
    neighbour, which no path of `edits` edits meets.
    """
    longer = [a if len(a) >= len(b) else b for a, b in zip(one, two, strict=True)]
    other = [b if len(a) >= len(b) else a for a, b in zip(one, two, strict=True)]
    m, n = np.array([len(a) for a in longer]), np.array([len(b) for b in other])
    width = int(m.max(initial=0)) + 2 * edits + 2

    def table(texts: list[str], before: int, fill: int) -> np.ndarray:
        out = np.full((len(texts), width + before), fill, np.int32)
        for row, t in zip(out, texts, strict=True):
            row[before : before + len(t)] = np.frombuffer(t.encode("utf-32-le", "replace"), np.int32)
        return out.T.copy()

    a, b = table(longer, edits, -1), table(other, 0, -2)
    size = 2 * edits + 1
    mask, top = np.uint64((1 << size) - 1), np.uint64(1 << (size - 1))
    unit = np.uint64(1)
    up = np.full(len(one), ((1 << size) - 1) ^ ((1 << (edits + 1)) - 1), np.uint64)
    down = np.zeros(len(one), np.uint64)
    diagonal = (m - n + edits).astype(np.uint64)
    score = (m - n).astype(np.int64)
    for j in range(int(n.max(initial=0))):
        equal = np.zeros(len(one), np.uint64)
        for k in range(size):
            equal |= (a[j + k] == b[j]).astype(np.uint64) << np.uint64(k)
        up_here, down_here = (up >> unit) | top, down >> unit
        level = ((((equal & up_here) + up_here) ^ up_here) | equal | down_here) & mask
        right_up = (down_here | ~(level | up_here)) & mask
        right_down = level & up_here
        above_up = ((right_up << unit) | unit) & mask
        up = ((right_down << unit) | ~(level | above_up)) & mask
        down = level & above_up
        score += np.where(j < n, 1 - ((level >> diagonal) & unit).astype(np.int64), 0)
    return score


def digests(lines: list[str], id_bits: int) -> np.ndarray:
    """(id, check) of every line: 128 bits of BLAKE2b, the id with its last bit 0 and, in tests, of fewer bits."""
    raw = b"".join([hashlib.blake2b(x.encode("utf-8", "replace"), digest_size=16).digest() for x in lines])
    out = np.frombuffer(raw, np.int64).reshape(-1, 2).copy()
    out[:, 0] &= (-1 << (64 - id_bits)) & -2
    return out


def texts_of(batch: pd.DataFrame) -> Iterator[tuple[list[int], list[int], list[str], list[int]]]:
    """Of some documents of the batch at a time: rows and numbers of lines that aren't blank, the lines without white space at their ends, and rows without any."""
    texts, begin = batch["text"].tolist(), 0
    while begin < len(texts):
        rows, numbers, found, none, held = [], [], [], [], 0
        while begin < len(texts) and held < CHUNK:
            text = texts[begin] or ""
            held += len(text) + 1
            before = len(found)
            for k, line in enumerate(text.split("\n")):
                line = line.strip(_SPACE)
                if line:
                    rows.append(begin)
                    numbers.append(k)
                    found.append(line)
            if len(found) == before:
                none.append(begin)
            begin += 1
        yield rows, numbers, found, none


READ = "doc_id long, nil boolean, line_no int, id long, check long, ids binary, keys binary, owners binary, block int, counts binary"


def read(docs: DataFrame, id_bits: int) -> DataFrame:
    """What one pass over the texts gives: a row for every line (doc_id, line_no, id, check) and for every document without lines; keys of
    the distinct lines of ALLOWED lengths, many in a row (ids, keys, owners); sketches of the keys' frequencies (block, counts)."""

    def pass_over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sketch, seen = np.zeros(1 << BITS, np.uint32), set()
        for batch in batches:
            doc_ids, nil = batch["doc_id"].to_numpy(np.int64), batch["nil"].to_numpy(bool)
            for rows, numbers, found, none in texts_of(batch):
                names = digests(found, id_bits)
                at = np.array(rows + none, np.int64)
                out = pd.DataFrame({"doc_id": doc_ids[at], "nil": nil[at], "line_no": np.array(numbers + [NO_LINE] * len(none), np.int32), "id": np.append(names[:, 0], np.zeros(len(none), np.int64)), "check": np.append(names[:, 1], np.zeros(len(none), np.int64))})
                yield out.assign(ids=None, keys=None, owners=None, block=-1, counts=None)
                new = {}
                for k, (line, name) in enumerate(zip(found, map(tuple, names.tolist()), strict=True)):
                    if len(line) >= ALLOWED[-1][0] and name not in seen:
                        seen.add(name)
                        new[k] = line
                if len(seen) > SEEN:
                    seen.clear()
                begin, chosen = 0, list(new)
                while begin < len(chosen):  # a line may be as long as its document
                    end, held = begin, 0
                    while end < len(chosen) and (end == begin or held + len(new[chosen[end]]) <= CHUNK):
                        held += len(new[chosen[end]])
                        end += 1
                    part = chosen[begin:end]
                    keys, owners = keys_of([new[k] for k in part])
                    counted(sketch, keys)
                    yield pd.DataFrame({"doc_id": 0, "nil": True, "line_no": -2, "id": 0, "check": 0, "ids": [names[part, 0].tobytes()], "keys": [keys.tobytes()], "owners": [owners.tobytes()], "block": -1, "counts": None})
                    begin = end
        if sketch.any():
            rows = compressed(sketch)
            yield pd.DataFrame({"doc_id": 0, "nil": True, "line_no": -3, "id": 0, "check": 0, "ids": None, "keys": None, "owners": None, "block": range(len(rows)), "counts": rows})

    return with_whole_ids(docs, "doc_id", "text").mapInPandas(pass_over, READ)


def entries(found: DataFrame, classes, size: int) -> DataFrame:
    """Entries of the lists (h, part, entry): a line's id, odd for an own segment; a list that is expected to be long is dealt to blocks by the ids."""

    def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for ids, keys, owners in zip(batch["ids"], batch["keys"], batch["owners"], strict=True):
                ids, h, owners = np.frombuffer(ids, np.int64), np.frombuffer(keys, np.uint64), np.frombuffer(owners, np.uint32)
                cuts, own = blocks(classes_of(h, classes.value), size), ids[owners >> 1]
                yield pd.DataFrame({"h": h.view(np.int64), "part": np.where(cuts > 1, (own >> 1) % cuts, -1), "entry": own | (owners & 1)})

    return found.where("line_no = -2").select("ids", "keys", "owners").mapInPandas(dealt, "h long, part long, entry long")


def first_round(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Entries of lists with an own segment and more than one line (of a cut list: all), and as pivot the smallest line with an own segment there, else the smallest."""
    for x in lists(batches, ["h", "part", "entry"]):
        first, sizes = bounds(x)
        ids, most = x["entry"] & ~1, np.iinfo(np.int64).max
        own = np.minimum.reduceat(np.where(x["entry"] & 1, ids, most), first)
        least = np.minimum.reduceat(ids, first)
        good = ((own != most) & (least != np.maximum.reduceat(ids, first))) | (x["part"][first] >= 0)
        keep = np.repeat(good, sizes)
        yield pd.DataFrame({"h": x["h"][keep], "part": x["part"][keep], "entry": x["entry"][keep], "pivot": np.repeat(np.where(own != most, own, least), sizes)[keep]})


OPEN = ["h", "part", "entry", "id", "comp", "s", "t", "probe"]


def open_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs of an own segment's line and another line of its list that aren't in one component already, and whose signatures allow so few edits.

    In a block of a cut list, entries that probe it come from the other blocks and meet only its own.
    """
    for x in lists(batches, OPEN):
        first, sizes = bounds(x)
        out = []
        for a, size in zip(first.tolist(), sizes.tolist(), strict=True):
            z = a + size
            comp, entry, probe = x["comp"][a:z], x["entry"][a:z], x["probe"][a:z]
            if comp.min() == comp.max():
                continue
            found, count = np.unique(comp, return_counts=True)
            main = comp == found[np.argmax(count)]
            ids, s, t = x["id"][a:z], x["s"][a:z].view(np.uint64), x["t"][a:z].view(np.uint64)
            own = (entry & 1) == 1
            for k in np.flatnonzero(probe | ~main):
                j = np.flatnonzero((comp != comp[k]) & (own | own[k]) & ~probe)
                j = j[np.bitwise_count(s[j] ^ s[k]).astype(np.int64) + np.bitwise_count(t[j] ^ t[k]) <= 4 * EDITS]
                if len(j):
                    out.append(pd.DataFrame({"a": np.minimum(ids[j], ids[k]), "b": np.maximum(ids[j], ids[k])}))
        if out:
            yield pd.concat(out).drop_duplicates()


def wanted_lines(docs: DataFrame, ids: DataFrame, count: int, id_bits: int) -> DataFrame:
    """(id, check, line, s, t) of the lines with these ids, and of few others: a filter of bits lets them through. s and t are the line's signature."""
    bits = bit_filter(ids, lambda size: F.shiftrightunsigned("id", 64 - size), count, FILTER_BITS)
    shared, shift = docs.sparkSession.sparkContext.broadcast(bits), np.uint64(64 - (len(bits) * 8).bit_length() + 1)

    def take(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chosen, seen = np.unpackbits(shared.value).astype(bool), set()
        for batch in batches:
            for _, _, found, _ in texts_of(batch):
                names = digests(found, id_bits)
                out = []
                for k in np.flatnonzero(chosen[(names[:, 0].view(np.uint64) >> shift).astype(np.int64)]).tolist():
                    name = tuple(names[k].tolist())
                    if len(found[k]) >= ALLOWED[-1][0] and name not in seen:
                        seen.add(name)
                        out.append(k)
                if len(seen) > SEEN:
                    seen.clear()
                begin = 0
                while begin < len(out):
                    end, held = begin, 0
                    while end < len(out) and (end == begin or held + len(found[out[end]]) <= CHUNK):
                        held += len(found[out[end]])
                        end += 1
                    part = out[begin:end]
                    marks = signatures([found[k] for k in part])
                    yield pd.DataFrame({"id": names[part, 0], "check": names[part, 1], "line": [found[k] for k in part], "s": marks[0], "t": marks[1]})
                    begin = end

    return docs.select("text").mapInPandas(take, "id long, check long, line string, s long, t long").dropDuplicates(["id", "check"])


def verified(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose lines are within the edits allowed for the shorter one; `texts` holds (id, line), id being the node."""

    def close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hub, line, held, cells = None, "", [], 0

        def checked() -> pd.DataFrame:
            held.sort(key=lambda x: len(x[2]) + len(x[3]))
            good, begin = [], 0
            while begin < len(held):
                end = begin
                while end < len(held) and (end == begin or (end + 1 - begin) * max(len(held[end][2]), len(held[end][3])) <= CELLS):
                    end += 1
                part = held[begin:end]
                sizes = np.array([min(len(x), len(y)) for _, _, x, y in part], np.int64)
                fits = distances([x for _, _, x, _ in part], [y for *_, y in part]) <= allowed(sizes)
                good += [x[:2] for x, ok in zip(part, fits.tolist(), strict=True) if ok]
                begin = end
            held.clear()
            return pd.DataFrame(good, columns=["a", "b"]).astype("int64")

        for batch in batches:
            for a, other, b, x in zip(batch["a"].tolist(), batch["other"].tolist(), batch["b"].tolist(), batch["line"].tolist(), strict=True):
                if not other:
                    hub, line = a, x
                elif a == hub and abs(len(x) - len(line)) <= EDITS:
                    held.append((a, b, line, x))
                    cells += len(line)
                    if cells > CELLS:
                        yield checked()
                        cells = 0
        if held:
            yield checked()

    return materialised(beside(pairs, texts.select("id", "line")).mapInPandas(close, "a long, b long"), "line-links", 2000)


def line_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", list_size: int = LIST, id_bits: int = 63, blank: bool = False) -> DataFrame:
    """One row per line that isn't blank: doc_id, line_no, class, class_size, keep_doc and keep_line (the class's first occurrence by doc_id
    and line_no), first (whether the line is that one). With `blank`, a document without lines has one row with line_no null.

    Lines, without white space at their ends, are of one class if a chain of links joins them, each within the edits that ALLOWED
    gives for the shorter one. Lines are known by 128 bits of BLAKE2b; half of them are the id by which lists and joins go, and
    lines that share that half but not the other are told apart (`id_bits` makes such cases frequent, for tests). A line of n
    characters is split into edits + 1 segments; of two close lines one segment of the shorter stands in the longer, at one of few
    places, so lists of equal segments hold every close pair. Each list's lines are first checked against one of them; pairs
    are then made only between what isn't linked yet and whose signatures of character pairs are near enough for so few edits.
    Lists longer than `list_size` are dealt to blocks that probe each other; no list is cut short.
    Null and blank texts have no lines. Rows that repeat an id are lines of the same document, and those without an id are too; equal places of
    such rows are both the first. The smallest id comes first, null before all.
    """
    spark = docs.sparkSession
    shipped(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = materialised(read(docs, id_bits), "line-places", 2000)
    classes = spark.sparkContext.broadcast(frequency_classes(found.where("block >= 0")))
    places = found.where("line_no >= 0").select(F.when(~F.col("nil"), F.col("doc_id")).alias("doc_id"), "line_no", "id", "check")
    limit = max(1, int(docs.count() * HOT_SHARE))

    repeated = places.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.min("check").alias("low"), F.max("check").alias("high")).where("n > 1")
    repeated = materialised(repeated, "line-counts")
    shared_ids, twins = repeated.where("low <> high").select("id"), []
    if shared_ids.take(1):  # as many as 63-bit hashes collide by chance
        twins = sorted(map(tuple, places.join(F.broadcast(shared_ids), "id", "left_semi").select("id", "check").distinct().collect()))
    nodes = spark.createDataFrame([(i, c, -1 - 2 * k) for k, (i, c) in enumerate(twins)], "id long, check long, node long")

    def resolved(rows: DataFrame) -> DataFrame:
        """Rows whose id tells lines apart; those that share one have odd ids of their own."""
        if not twins:
            return rows.drop("check")
        return rows.join(F.broadcast(nodes), ["id", "check"], "left").withColumn("id", F.coalesce("node", "id")).drop("check", "node")

    def named(pairs: DataFrame) -> DataFrame:
        """Pairs of ids as pairs of what resolved() calls them."""
        if not twins:
            return pairs
        for end in "ab":
            pairs = pairs.join(F.broadcast(nodes.select(F.col("id").alias(end), F.col("node").alias(f"n{end}"))), end, "left")
        inner = nodes.select("id", F.col("node").alias("a")).join(nodes.select("id", F.col("node").alias("b")), "id").where("a < b").select("a", "b")
        return pairs.select(F.coalesce("na", "a").alias("a"), F.coalesce("nb", "b").alias("b")).unionByName(inner).distinct()

    shared = materialised(sorted_lists(entries(found, classes, list_size)).mapInPandas(first_round, "h long, part long, entry long, pivot long"), "line-lists")
    collected(spark)
    ids = F.col("entry").bitwiseAND(F.lit(-2))
    chosen = materialised(shared.select(ids.alias("id")).distinct(), "line-ids")
    texts = wanted_lines(docs, chosen, chosen.count(), id_bits)
    texts = materialised(resolved(texts.select("id", "check", "line", F.col("id").alias("raw"), "s", "t")), "checked-lines")
    blockwise = shared.where("part >= 0").select("h", "pivot").distinct()
    heads = blockwise.join(blockwise.groupBy("h").agg(F.min("pivot").alias("head")), "h").select(F.col("head").alias("a"), F.col("pivot").alias("b"))
    stars = shared.select(F.col("pivot").alias("a"), ids.alias("b")).unionByName(heads).where("a <> b").distinct()
    stars = verified(texts, named(materialised(stars, "line-pivots")))
    groups = components(stars)
    # ids that several lines share are in no component, not even one of their own
    comp = F.when(F.col("lines") > 1, F.col("raw").bitwiseOR(F.lit(1))).otherwise(F.coalesce("component", "raw")).alias("comp")
    marks = texts.join(groups, "id", "left").groupBy("raw").agg(F.count(F.lit(1)).alias("lines"), F.min("component").alias("component"), F.min("s").alias("s"), F.min("t").alias("t"))
    marks = materialised(marks.select(F.col("raw").alias("id"), comp, F.when(F.col("lines") == 1, F.col("s")).alias("s"), F.when(F.col("lines") == 1, F.col("t")).alias("t")), "line-marks")
    rows = shared.select("h", "part", "entry", ids.alias("id")).join(marks, "id").select("h", "part", "entry", "id", "comp", F.coalesce("s", F.lit(0).cast("long")).alias("s"), F.coalesce("t", F.lit(0).cast("long")).alias("t"))
    rows = probing(rows, classes, list_size, limit, "h long, part long, entry long, id long, comp long, s long, t long").select(*OPEN)
    pairs = materialised(sorted_lists(rows).mapInPandas(open_pairs, "a long, b long").distinct(), "line-pairs")
    linked = components(stars.unionByName(verified(texts, named(pairs))))
    for x in (shared, texts, chosen):
        dropped(x)
    collected(spark)

    several = repeated.where("low = high").select("id")
    if twins:
        several = several.unionByName(nodes.select(F.col("node").alias("id")))
    members = several.join(linked, "id", "full").select("id", F.coalesce("component", "id").alias("class"))
    places = resolved(places)
    counts = places.join(members.select("id"), "id", "left_semi") if twins else repeated.select("id", "n")
    counts = counts.groupBy("id").agg(F.count(F.lit(1)).alias("n")) if twins else counts
    members = materialised(members.join(counts, "id", "left").select("id", "class", F.coalesce("n", F.lit(1)).alias("n")), "line-members")
    rows = materialised(attached(places, members, "id", "n", limit, "doc_id").select("doc_id", "line_no", "id", "class"), "line-rows")
    best = F.min(F.struct("doc_id", "line_no"))
    whole = rows.where("class is not null").groupBy("class").agg(best.alias("first"), F.count(F.lit(1)).alias("class_size"))
    whole = materialised(whole.select("class", "class_size", F.col("first.doc_id").alias("keep_doc"), F.col("first.line_no").alias("keep_line")), "line-classes")
    out = attached(rows.withColumn("class", F.coalesce("class", "id")), whole, "class", "class_size", limit, "line_no")
    alone = F.col("class_size").isNull()
    out = out.select("doc_id", "line_no", "class", F.coalesce("class_size", F.lit(1)).alias("class_size"), F.when(alone, F.col("doc_id")).otherwise(F.col("keep_doc")).alias("keep_doc"), F.when(alone, F.col("line_no")).otherwise(F.col("keep_line")).alias("keep_line"))
    out = out.withColumn("first", F.col("doc_id").eqNullSafe(F.col("keep_doc")) & (F.col("line_no") == F.col("keep_line")))
    if not blank:
        return out
    none = found.where(f"line_no = {NO_LINE}").select(F.when(~F.col("nil"), F.col("doc_id")).alias("doc_id"))
    empty = {"line_no": "int", "class": "long", "class_size": "long", "keep_doc": "long", "keep_line": "int", "first": "boolean"}
    return out.unionByName(none.select("doc_id", *[F.lit(None).cast(kind).alias(c) for c, kind in empty.items()]))


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, lines, kept, and of the lines that repeat an earlier one of their class: dropped (their numbers) and keep_doc, keep_line (where that one stands).

    Documents without lines have none of any. Rows without an id have one row together, whose lists are null: they would have no bound.
    """
    found = line_classes(docs, id_col, text_col, blank=True)
    gone = F.sort_array(F.collect_list(F.when(~F.col("first") & F.col("doc_id").isNotNull(), F.struct("line_no", "keep_doc", "keep_line"))))
    out = found.groupBy("doc_id").agg(F.count("line_no").alias("lines"), F.count_if(F.col("first")).alias("kept"), gone.alias("gone"))
    out = out.withColumn("gone", F.when(F.col("doc_id").isNotNull(), F.col("gone")))
    return out.select("doc_id", "lines", "kept", F.col("gone.line_no").alias("dropped"), F.col("gone.keep_doc").alias("keep_doc"), F.col("gone.keep_line").alias("keep_line"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs`, all columns, with each text's repeated lines taken out. Null texts stay null and rows without an id as they are; of rows that repeat an
    id, each loses the lines that any of them has repeated at that place."""
    own = "_gone"
    while own in docs.columns:
        own += "_"
    gone = dropped_lines(docs, id_col, text_col).where(F.size("dropped") > 0).select(F.struct(F.col("doc_id").alias("id"), "dropped").alias(own))
    joined = docs.join(gone, F.col(id_col) == F.col(f"{own}.id"), "left")
    lines = F.filter(F.split(F.col(text_col), "\n", -1), lambda x, k: ~F.array_contains(f"{own}.dropped", k))
    return joined.withColumn(text_col, F.when(F.col(own).isNull(), F.col(text_col)).otherwise(F.array_join(lines, "\n"))).drop(own)
