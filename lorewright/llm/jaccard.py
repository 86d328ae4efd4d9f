"""N-gram Jaccard join of all documents: size-aware, with subsets enumerated for small sets and inverted lists for large ones."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BITS as SKETCH
from .common import (
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
from .shingles import CHUNK, mixed, shingle_sets

#: Similarity is NUM / DEN or more.
NUM, DEN = 4, 5
#: Sets up to this size can be small; entries of a list in a block; lists up to this length have all their pairs made in the first round; open
#: lists up to this length are worked at together.
SMALL, LIST, SHORT, TOGETHER = 14, 20_000, 4, 16
#: Pairs of entries looked at together.
CELLS = 1 << 17
#: Pairs an entry from which an open list is checked against pivots before its pairs are made.
DENSE = 4
#: Cost of a posting in an inverted list (with its part in checking candidates) against one subset.
LIST_COST = 4
#: Entries that a task holds before it hands them on.
ENTRIES = 100_000
#: Bits of a document's mark: which of so many counters of its shingles are odd.
MARK = 512
#: Rounds of checking lists against a pivot before pairs are made of what is left; a round that links a smaller share of its pairs is the last.
PIVOTS, YIELD = 3, 0.25
#: Bits of the filter of documents that need checking: 16 a document up to this many; beyond it the documents meet their ids in a join.
FILTER_BITS = 27
_SALTS = np.random.default_rng(7).integers(0, 1 << 63, 2, np.uint64)


def needed(n, m):
    """Least overlap of linked sets of n and m shingles: NUM / (NUM + DEN) of the sum, rounded up."""
    return -(-NUM * (n + m) // (NUM + DEN))


def prefix(n: int) -> int:
    """Shingles of a set, first in any common order, among which every linked set has one of its own: n less the least overlap, plus one."""
    return n - -(-NUM * n // DEN) + 1


def partners(n: int) -> range:
    """Sizes of sets that can be linked with one of n."""
    return range(-(-NUM * n // DEN), DEN * n // NUM + 1)


def subset_count(n: int, largest: int) -> int:
    """Subsets that a small set of n is entered under, if sets up to `largest` are small."""
    return sum(comb(n, needed(n, m)) for m in partners(n) if m <= largest)


def boundary(histogram: dict[int, int]) -> int:
    """The largest size for which entering subsets costs least in all, over the numbers of sets of each size."""

    def cost(x: int) -> int:
        lists = sum(c * prefix(n) * LIST_COST for n, c in histogram.items() if n <= x and partners(n)[-1] > x)
        lists += sum(c * prefix(n) * LIST_COST for n, c in histogram.items() if n > x)
        return lists + sum(c * subset_count(n, x) for n, c in histogram.items() if n <= x)

    return min(range(SMALL + 1), key=lambda x: (cost(x), x))


def signature(s: np.ndarray) -> bytes:
    """128 bits of a set."""
    return mixed(s ^ _SALTS[0]).sum().tobytes() + mixed(s ^ _SALTS[1]).sum().tobytes()


def profiles(docs: DataFrame, words: int) -> DataFrame:
    """One row per document (doc_id, n, sig: 128 bits of the set, least: its smallest hash, mark), and rows of the sketch (block, counts)."""

    def profile(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sketch = np.zeros(1 << SKETCH, np.uint32)
        for batch in batches:
            n, sig, least, mark = [0] * len(batch), [b""] * len(batch), [0] * len(batch), [b""] * len(batch)
            held: list[np.ndarray] = []
            for k, s in shingle_sets(batch["text"].tolist(), words):
                n[k] = len(s)
                if len(s):
                    sig[k], least[k], mark[k] = signature(s), int(s[0].astype(np.int64)), odd_counters(s, MARK)
                    held.append(s)
                    if len(held) == 512:
                        counted(sketch, np.concatenate(held))
                        held = []
            if held:
                counted(sketch, np.concatenate(held))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "nil": batch["nil"], "n": n, "sig": sig, "least": least, "mark": mark, "block": -1, "counts": None})
        if sketch.any():
            rows = compressed(sketch)
            yield pd.DataFrame({"doc_id": 0, "nil": True, "n": -1, "sig": None, "least": 0, "mark": None, "block": range(len(rows)), "counts": rows})

    found = with_whole_ids(docs, "doc_id", "text").mapInPandas(profile, "doc_id long, nil boolean, n long, sig binary, least long, mark binary, block int, counts binary")
    return found.withColumn("doc_id", F.when(~F.col("nil"), F.col("doc_id"))).drop("nil")


def postings(docs: DataFrame, words: int, classes, small: int, hot, size: int) -> DataFrame:
    """Entries of every document in the lists: h (the list), part (its block; -1: the list is whole), doc_id, n, pos; pos -1 - m: a subset shared with sets of m shingles.

    Large sets enter their prefix, in the order of frequency class and hash. Copies in the groups of `hot`, a dictionary
    from size and smallest hash to signatures and representatives, do not enter: their representative does.
    """

    def enter(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, crowds = classes.value, hot.value
        for batch in batches:
            ids = batch["doc_id"].to_numpy(np.int64)
            keys, docs, sizes, places, parts = [], [], [], [], []

            def flushed() -> pd.DataFrame:
                columns = {"h": np.concatenate(keys).view(np.int64), "part": np.concatenate(parts), "doc_id": np.concatenate(docs), "n": np.concatenate(sizes), "pos": np.concatenate(places)}
                for x in (keys, docs, sizes, places, parts):
                    x.clear()
                return pd.DataFrame(columns)

            def add(k: int, n: int, h: np.ndarray, pos: np.ndarray, cuts: np.ndarray) -> None:
                keys.append(h)
                docs.append(np.full(len(h), ids[k]))
                sizes.append(np.full(len(h), n, np.int64))
                places.append(pos)
                parts.append(np.where(cuts > 1, int(ids[k]) * 2654435761 % (1 << 32) % cuts, -1))

            for k, s in shingle_sets(batch["text"].tolist(), words):
                n = len(s)
                if not n:
                    continue
                crowd = crowds.get((n, int(s[0].astype(np.int64))))
                if crowd and crowd.get(signature(s), ids[k]) != ids[k]:
                    continue
                c = classes_of(s, table)
                if n <= small:
                    for m in partners(n):
                        if m <= small:
                            pick = np.array(list(combinations(range(n), needed(n, m))))
                            low, high = sorted((n, m))
                            h = mixed(mixed(s[pick]).sum(axis=1) + np.uint64(1000 * low + high))
                            add(k, n, h, np.full(len(h), -1 - m), blocks(c[pick].min(axis=1), size))
                if n > small or partners(n)[-1] > small:
                    first = np.lexsort((s, c))[: prefix(n)]
                    add(k, n, s[first], np.arange(len(first)), blocks(c[first], size))
                if sum(map(len, keys[-256:])) > ENTRIES or len(keys) >= 4096:
                    yield flushed()
            if keys:
                yield flushed()

    return docs.mapInPandas(enter, "h long, part long, doc_id long, n long, pos long")


def can_meet(n, pos, m, place) -> np.ndarray:
    """Whether sets of n and m shingles, whose first common one is at these places, can be linked."""
    n, pos, m, place = (np.asarray(v, np.int64) for v in (n, pos, m, place))
    return (DEN * np.minimum(n, m) >= NUM * np.maximum(n, m)) & (np.minimum(n - pos, m - place) >= needed(n, m))


ASKED = "h long, part long, doc_id long, n long, pos long, pivot long, ask boolean"


def first_round(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each list with more than one entry: all pairs that can be linked if it is short (part -2), else its entries, each with the list's
    pivot and whether to ask for that pair. The pivot has the fewest rarer shingles before this one: of near copies, the least changed."""
    names = ["h", "part", "doc_id", "n", "pos"]
    for x in lists(batches, names):
        first, sizes = bounds(x)
        out = []
        plain = x["pos"][first] >= 0
        for size in range(2, SHORT + 1):
            at = first[(sizes == size) & plain & (x["part"][first] == -1)]
            for i, j in combinations(range(size), 2):
                p, q = at + i, at + j
                good = can_meet(x["n"][p], x["pos"][p], x["n"][q], x["pos"][q])
                p, q = p[good], q[good]
                if len(p):
                    out.append(pd.DataFrame({"h": 0, "part": -2, "doc_id": x["doc_id"][p], "n": 0, "pos": 0, "pivot": x["doc_id"][q], "ask": True}))
        keep = (sizes > SHORT) | ((sizes > 1) & ~plain) | (x["part"][first] >= 0)
        if keep.any():
            row = np.flatnonzero(np.repeat(keep, sizes))
            own = np.repeat(np.arange(keep.sum()), sizes[keep])
            order = np.lexsort((x["doc_id"][row], x["pos"][row], own))
            best = row[order[np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))]][own]
            ask = can_meet(x["n"][row], x["pos"][row], x["n"][best], x["pos"][best]) & (x["doc_id"][row] != x["doc_id"][best]) & (x["pos"][row] >= 0)
            out.append(pd.DataFrame({**{c: x[c][row] for c in names}, "pivot": x["doc_id"][best], "ask": ask}))
        if out:
            yield pd.concat(out)


def marks(column) -> np.ndarray:
    """The rows' marks as words."""
    return np.frombuffer(b"".join(column), np.uint64).reshape(-1, MARK // 64)


def far(mark: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Least numbers of shingles in one of two sets only, by their marks."""
    return np.bitwise_count(mark ^ others).sum(axis=1, dtype=np.int64)


OPEN = ["h", "part", "n", "rep", "pos", "comp", "mark", "probe"]


def pivot_pairs(turn: int):
    """Pairs of one document and all others of its list that can be linked with it and lie in other components, for longer lists of several components.

    The component is the one that comes `turn`-th by its entries in the list, and the document is that of its entries whose mark is
    nearest to what most marks of the component say: of near copies, the least changed.
    """

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in lists(batches, OPEN):
            first, sizes = bounds(x)
            out = []
            for a, size in zip(first.tolist(), sizes.tolist(), strict=True):
                z = a + size
                comp = x["comp"][a:z]
                if size <= TOGETHER or comp.min() == comp.max():
                    continue
                found, count = np.unique(comp, return_counts=True)
                if len(found) <= turn:
                    continue
                own = np.flatnonzero(comp == found[np.lexsort((found, -count))[turn]])
                mark = marks(x["mark"][a:z])
                odd = np.unpackbits(mark[own].view(np.uint8), axis=1)
                most = np.packbits(2 * odd.sum(axis=0, dtype=np.int64) > len(own)).view(np.uint64)
                i = own[np.argmin(far(most, mark[own]))]
                n, pos, rep = x["n"][a:z], x["pos"][a:z], x["rep"][a:z]
                j = np.flatnonzero((comp != comp[i]) & can_meet(n[i], pos[i], n, pos))
                j = j[n[j] + n[i] - far(mark[i], mark[j]) >= 2 * needed(n[j], n[i])]
                if len(j):
                    out.append(np.stack([np.full(len(j), rep[i]), rep[j]]))
            if out:
                yield pd.DataFrame(np.concatenate(out, axis=1).T, columns=["a", "b"]).drop_duplicates()

    return pairs


def pairs_of(x: dict[str, np.ndarray], first: np.ndarray, sizes: np.ndarray) -> Iterator[pd.DataFrame]:
    """Pairs of each of these lists that can be linked and lie in different components, about ENTRIES at a time: those of its largest component never meet each other.

    Short lists of one length are taken together. In a block of a cut list, entries that probe it come from the other blocks and meet only its own.
    """
    out, held = [], 0

    def meet(i: np.ndarray, j: np.ndarray) -> int:
        good = (x["comp"][i] != x["comp"][j]) & ~(x["probe"][i] & x["probe"][j])
        i, j = i[good], j[good]
        good = can_meet(x["n"][i], x["pos"][i], x["n"][j], x["pos"][j])
        i, j = i[good], j[good]
        if not len(i):
            return 0
        n, m = x["n"][i], x["n"][j]
        good = n + m - far(marks(x["mark"][i]), marks(x["mark"][j])) >= 2 * needed(n, m)
        p, q = x["rep"][i[good]], x["rep"][j[good]]
        out.append(np.stack([np.minimum(p, q), np.maximum(p, q)]))
        return len(p)

    def made() -> pd.DataFrame:
        pairs = pd.DataFrame(np.concatenate(out, axis=1).T, columns=["a", "b"]).drop_duplicates()
        out.clear()
        return pairs

    for size in range(2, TOGETHER + 1):
        at = first[sizes == size]
        for i, j in combinations(range(size), 2) if len(at) else ():
            held += meet(at + i, at + j)
    for a, size in zip(first[sizes > TOGETHER].tolist(), sizes[sizes > TOGETHER].tolist(), strict=True):
        found, count = np.unique(x["comp"][a : a + size], return_counts=True)
        main = x["comp"][a : a + size] == found[np.argmax(count)]
        minor, every = np.flatnonzero(~main), np.arange(size)
        comp, n, pos = (x[c][a : a + size] for c in ("comp", "n", "pos"))
        for begin in range(0, len(minor), step := max(1, CELLS // size)):
            i = minor[begin : begin + step]
            # a pair of two minor entries is met once
            good = (comp[i][:, None] != comp) & (main | (every > i[:, None])) & can_meet(n[i][:, None], pos[i][:, None], n, pos)
            row, j = np.nonzero(good)
            held += meet(a + i[row], a + j) if len(j) else 0
            if held > ENTRIES:
                held = 0
                yield made()
    if out:
        yield made()


def all_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """pairs_of() all lists."""
    for x in lists(batches, OPEN):
        yield from pairs_of(x, *bounds(x))


def as_entries(pairs: pd.DataFrame) -> pd.DataFrame:
    """Pairs in the columns of second_round(): part -2, rep and comp the pair."""
    return pd.DataFrame({"h": 0, "part": -2, "n": 0, "rep": pairs["a"], "pos": 0, "comp": pairs["b"], "mark": None})


def second_round(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of lists in several components: pairs_of() them as_entries(). The entries of cut lists, and of lists of which an entry has more than DENSE pairs on average, are handed on."""
    for x in lists(batches, OPEN[:-1]):
        first, sizes = bounds(x)
        x["probe"] = np.zeros(len(x["h"]), bool)
        whole = x["part"][first] == -1
        several = np.minimum.reduceat(x["comp"], first) != np.maximum.reduceat(x["comp"], first)
        short = several & whole & (sizes <= TOGETHER)
        for found in pairs_of(x, first[short], sizes[short]):
            yield as_entries(found)
        out, held, handed = [], 0, ~whole
        for k in np.flatnonzero(several & whole & (sizes > TOGETHER)).tolist():
            own, pairs = [], 0
            for found in pairs_of(x, first[k : k + 1], sizes[k : k + 1]):
                pairs += len(found)
                if pairs > DENSE * sizes[k]:
                    handed[k] = True
                    break
                own.append(found)
            if not handed[k] and own:
                out += own
                held += pairs
            if held > ENTRIES:
                yield as_entries(pd.concat(out).drop_duplicates())
                out, held = [], 0
        if out:
            yield as_entries(pd.concat(out).drop_duplicates())
        keep = np.repeat(handed, sizes)
        if keep.any():
            yield pd.DataFrame({c: x[c][keep] for c in OPEN[:-1]})


def subset_links(entries: DataFrame, limit: int) -> DataFrame:
    """Links (a, b) of small sets: in a list of subsets each smaller set is linked with each larger one, so a chain over the first of either side holds them together."""
    rows = entries.withColumn("m", -1 - F.col("pos"))
    ends = rows.groupBy("h").agg(F.min(F.when(F.col("n") <= F.col("m"), F.col("rep"))).alias("low"), F.min(F.when(F.col("n") >= F.col("m"), F.col("rep"))).alias("high"), F.count(F.lit(1)).alias("many"))
    met = attached(rows.select("h", "n", "m", "rep"), materialised(ends.where("low is not null and high is not null"), "subset-lists"), "h", "many", limit, "rep")
    sides = [met.where(F.col("n") <= F.col("m")).select("rep", F.col("high").alias("to")), met.where(F.col("n") >= F.col("m")).select("rep", F.col("low").alias("to"))]
    return sides[0].unionByName(sides[1]).where("rep <> to").select(F.least("rep", "to").alias("a"), F.greatest("rep", "to").alias("b")).distinct()


def sets_of(docs: DataFrame, pairs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n, parity, s) of the documents of `pairs` and, where a filter of bits picks them, of few others."""
    spark = docs.sparkSession
    ends = materialised(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), "ends")
    count = ends.count()
    if 4 * count > 1 << FILTER_BITS:
        wanted, bits = docs.join(ends, "doc_id", "left_semi").withColumn("bit", F.lit(0).cast("long")), np.full(1, 255, np.uint8)
    else:
        bits = bit_filter(ends, lambda size: F.pmod(F.xxhash64("doc_id"), F.lit(1 << size)), count, FILTER_BITS)
        wanted = docs.where("doc_id is not null").withColumn("bit", F.pmod(F.xxhash64("doc_id"), F.lit(len(bits) * 8)))
    shared = spark.sparkContext.broadcast(bits)

    def take(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chosen = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            batch = batch[chosen[batch["bit"].to_numpy(np.int64)]]
            ids, texts, begin = batch["doc_id"].tolist(), batch["text"].tolist(), 0
            while begin < len(ids):
                end, held = begin, 0
                while end < len(ids) and held < CHUNK:
                    held += len(texts[end] or "")
                    end += 1
                sets = list(shingle_sets(texts[begin:end], words))
                yield pd.DataFrame({"doc_id": [ids[begin + k] for k, _ in sets], "n": [len(s) for _, s in sets], "parity": [parity(s) for _, s in sets], "s": [s.tobytes() for _, s in sets]})
                begin = end

    out = materialised(wanted.select("doc_id", "text", "bit").mapInPandas(take, "doc_id long, n long, parity binary, s binary"), "sets", 1000)
    dropped(ends)
    return out


def met(pairs: DataFrame, sets: DataFrame, column: str, agree) -> DataFrame:
    """The pairs (a, b) for which agree(n, value, n, value) holds, with the values of `column` of either end."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hub, n, value = None, 0, b""
        for batch in batches:
            good = []
            for a, other, b, m, x in zip(batch["a"].tolist(), batch["other"].tolist(), batch["b"].tolist(), batch["n"].tolist(), batch["value"], strict=True):
                if not other:
                    hub, n, value = a, m, x
                elif a == hub and agree(n, value, m, x):
                    good.append((a, b))
            yield pd.DataFrame(good, columns=["a", "b"]).astype("int64")

    return beside(pairs, sets.select(F.col("doc_id").alias("id"), "n", F.col(column).alias("value"))).mapInPandas(check, "a long, b long")


def may_link(n: int, x: bytes, m: int, y: bytes) -> bool:
    """Whether the parity sketches of two sets allow a link."""
    return n + m - least_difference(x, y) >= 2 * needed(n, m)


def are_linked(n: int, x: bytes, m: int, y: bytes) -> bool:
    """Whether two whole sets are linked."""
    return len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True)) >= needed(n, m)


def verified(docs: DataFrame, pairs: DataFrame, words: int) -> DataFrame:
    """The pairs (a, b) whose documents' whole sets are linked: parity sketches, a fiftieth as large, bound the overlap from above first."""
    sets = sets_of(docs, pairs, words)
    few = materialised(met(pairs, sets, "parity", may_link), "likely-pairs", 2000)
    out = materialised(met(few, sets, "s", are_linked), "links", 128)
    dropped(few)
    dropped(sets)
    return out


def odd_counters(s: np.ndarray, size: int) -> bytes:
    """Which of `size` counters of the shingles are odd, as bits."""
    return np.packbits((np.bincount(((s >> np.uint64(8)) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1).astype(np.uint8)).tobytes()


def parity(s: np.ndarray) -> bytes:
    """The odd ones of one to two times as many counters as the set has shingles: enough to tell sets that differ in three tenths of them."""
    return odd_counters(s, max(64, 1 << int(len(s) - 1).bit_length()))


def least_difference(p: bytes, q: bytes) -> int:
    """A lower bound of the number of shingles in one set only: counters that are odd for one alone. The larger sketch is folded to the smaller."""
    x, y = (np.frombuffer(z, np.uint8) for z in (p, q))
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def classes_of_near_duplicates(docs: DataFrame, words: int = 5, id_col: str = "doc_id", text_col: str = "text", list_size: int = LIST, checked: list | None = None) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id, the smallest id reached over links of Jaccard similarity 0.8 or more.

    Texts' sets are distinct shingles of `words` words (A-Z lower-cased, words parted by ASCII white space; fewer words: the whole sequence).
    Equal sets are one class with one representative. The size-aware join: sets no larger than boundary() enter all subsets as large as
    the overlap that a link needs, and a shared subset proves the link; larger sets enter inverted lists under a prefix of rare shingles.
    Long lists are first checked against pivots, which near copies are linked with, so the work is linear in any group; what is linked needs no
    more pairs among itself. Then pairs are made of the rest that lie in different components and pass the bounds by length, position and
    mark, and are checked on their whole sets. Lists longer than `list_size` are dealt to blocks. No link between different texts is
    lost, and no list, key or candidate is cut. Null and empty texts have no shingles and no links. Rows with a null id get null as
    component and link nothing. Rows that repeat an id are taken as one document if their texts are equal.

    checked: a list to which the numbers of pairs checked are added, for tests and reports.
    """
    spark = docs.sparkSession
    shipped(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = materialised(profiles(docs, words), "profiles", 1000)
    classes = spark.sparkContext.broadcast(frequency_classes(found.where("block >= 0")))
    own = found.where("block < 0").select("doc_id", "n", "sig", "least", "mark")
    some = own.where("n > 0 and doc_id is not null")
    limit = max(1, int(found.count() * HOT_SHARE))
    reps = some.groupBy("sig").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("least").alias("least"), F.count(F.lit(1)).alias("copies"))
    reps = materialised(reps, "representatives")
    histogram = {r[0]: r[1] for r in reps.where(F.col("n") <= SMALL).groupBy("n").count().collect()}
    histogram[SMALL + 1] = 1
    small = boundary(histogram)
    crowds: dict[tuple[int, int], dict[bytes, int]] = {}
    for sig, rep, n, least, _ in reps.where(F.col("copies") > limit).collect():  # 1 / HOT_SHARE at most
        crowds.setdefault((n, least), {})[bytes(sig)] = rep
    twins = attached(some.select("doc_id", "sig"), reps.where("copies > 1").select("sig", F.col("doc_id").alias("rep"), "copies"), "sig", "copies", limit, "doc_id")
    twins = materialised(twins.where("doc_id <> rep").select("doc_id", "rep").distinct(), "twins")

    def asked(pairs: DataFrame) -> DataFrame:
        pairs = materialised(pairs.select("a", "b").distinct(), "pairs")
        if checked is not None:
            checked.append(pairs.count())
        return pairs

    def untwinned(pairs: DataFrame) -> DataFrame:
        for end in "ab":
            pairs = pairs.join(twins.select(F.col("doc_id").alias(end), F.col("rep").alias(f"r{end}")), end, "left")
        return pairs.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")).where("a <> b")

    entries = sorted_lists(postings(docs.where("doc_id is not null"), words, classes, small, spark.sparkContext.broadcast(crowds), list_size))
    shared = materialised(entries.mapInPandas(first_round, ASKED), "shared-postings")
    collected(spark)
    heads = shared.where("part >= 0 and pos >= 0").groupBy("h", "pivot").agg(F.lit(1).alias("one")).groupBy("h").agg(F.min("pivot").alias("head"))
    heads = shared.where("part >= 0 and pos >= 0").select("h", "pivot").distinct().join(heads, "h").where("head <> pivot").select(F.col("head").alias("a"), F.col("pivot").alias("b"))
    pairs = shared.where("ask").select(F.col("pivot").alias("a"), F.col("doc_id").alias("b")).unionByName(heads).distinct()
    links = verified(docs, asked(untwinned(pairs)), words)
    collected(spark)
    subsets = shared.where("pos < 0").join(reps.select(F.col("doc_id").alias("rep")), F.col("doc_id") == F.col("rep")).select("h", "n", "rep", "pos")
    links = materialised(links.unionByName(subset_links(subsets, limit)), "links")
    groups = components(links)

    mark = own.where("n > 0").select(F.col("doc_id").alias("rep"), "n", "mark").join(reps.select(F.col("doc_id").alias("rep"), "n"), ["rep", "n"]).groupBy("rep").agg(F.first("mark").alias("mark"))
    mark = materialised(mark.join(groups.withColumnRenamed("id", "rep"), "rep", "left").select("rep", F.coalesce("component", "rep").alias("comp"), "mark"), "marks")
    rows = shared.where("part > -2 and pos >= 0").join(mark, F.col("doc_id") == F.col("rep")).select(*OPEN[:-1])
    rows = sorted_lists(rows, "n", "rep").mapInPandas(second_round, "h long, part long, n long, rep long, pos long, comp long, mark binary")
    rows = materialised(rows, "open-lists")
    dropped(shared)
    short, long = rows.where("part = -2").select(F.col("rep").alias("a"), F.col("comp").alias("b")), rows.where("part > -2")
    collected(spark)

    def in_components(rows: DataFrame) -> DataFrame:
        return rows.drop("comp").join(groups.withColumnRenamed("id", "rep"), "rep", "left").withColumn("comp", F.coalesce("component", "rep")).select(*OPEN[:-1])

    for turn in range(PIVOTS if long.take(1) else 0):
        rows = in_components(long).withColumn("probe", F.lit(False))
        pairs = asked(sorted_lists(rows, "n", "rep").mapInPandas(pivot_pairs(turn), "a long, b long"))
        n = pairs.count()
        if not n:
            break
        new = verified(docs, pairs, words)
        links = materialised(links.unionByName(new), "links")
        groups = components(links)
        collected(spark)
        if new.count() < YIELD * n:
            break
    rows = in_components(long).withColumnRenamed("rep", "id")
    rows = probing(rows, classes, list_size, limit, "h long, part long, n long, id long, pos long, comp long, mark binary").withColumnRenamed("id", "rep").select(*OPEN)
    pairs = asked(sorted_lists(rows, "n", "rep").mapInPandas(all_pairs, "a long, b long").unionByName(short))
    if pairs.take(1):
        groups = components(links.unionByName(verified(docs, pairs, words)))
    collected(spark)

    final = reps.join(groups.withColumnRenamed("id", "doc_id"), "doc_id", "left").where("copies > 1 or component is not null")
    final = final.select("sig", "copies", F.coalesce("component", "doc_id").alias("component"))
    out = attached(own.select("doc_id", "n", F.when(F.col("n") > 0, F.col("sig")).alias("sig")), materialised(final, "classes"), "sig", "copies", limit, "doc_id")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
