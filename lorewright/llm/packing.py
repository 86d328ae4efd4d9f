"""Best-fit packing of token sequences by a grouping genetic algorithm on islands."""

from __future__ import annotations

import bisect
import math
import random
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import collected, materialised, shipped, with_whole_ids
from .tokens import loaded

#: Pieces in a block, islands that work on a block, individuals of an island.
BLOCK, ISLANDS, POPULATION = 4096, 2, 4
#: Offspring of an island in an epoch: so many where best fit is within EXCESS of the lower bound, else up to the second number, while one of the last STALL was better.
OFFSPRING, EXCESS, STALL = (24, 240), 0.005, 60
#: Free tokens up to which a sequence is settled after a round; the last holds for all further rounds, and the last block settles all.
SETTLED = (0, 2, 8, 32)
#: More than the rounds there can be: from the last of SETTLED on, each at least halves the pieces.
ROUNDS = 64
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The token pieces of every document: doc_id, piece, start, length, ids_crc32.

    A document is its token ids and then `end_id`; null text is empty text. One longer than `size` is cut from its end into
    pieces of exactly `size`, so only the first may be shorter. A row whose id repeats gives pieces of its own.
    """
    shipped(docs.sparkSession)
    collected(docs.sparkSession)  # workers let go of what earlier steps broadcast
    tail = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = loaded(tokenizer)
        for batch in batches:
            out = []
            for doc_id, nil, ids in zip(batch["doc_id"].tolist(), batch["nil"].tolist(), words.many([t or "" for t in batch["text"].tolist()]), strict=True):
                ids += tail
                n = len(ids) // 4
                begin, k = 0, 0
                end = n - size * ((n - 1) // size)
                while begin < n:
                    out.append((None if nil else doc_id, k, begin, end - begin, zlib.crc32(ids[4 * begin : 4 * end])))
                    begin, end, k = end, end + size, k + 1
            yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"], dtype=object).astype({"doc_id": "Int64"})

    return with_whole_ids(docs, id_col, text_col).mapInPandas(cut, PIECES)


class Bins:
    """Open sequences by free room; the fullest with enough room is found in a bit set."""

    def __init__(self, size: int):
        self.size, self.mask, self.by_room, self.bins = size, 0, {}, []

    def open(self, items: list[int], room: int) -> None:
        """Adds a sequence that holds `items` already."""
        self.by_room.setdefault(room, []).append(len(self.bins))
        self.mask |= 1 << room
        self.bins.append(items)

    def best_fit(self, item: int, length: int) -> None:
        """Puts an item where the least room stays."""
        fits = self.mask >> length
        if not fits:
            self.open([item], self.size - length)
            return
        room = length + (fits & -fits).bit_length() - 1
        stack = self.by_room[room]
        k = stack.pop()
        if not stack:
            self.mask ^= 1 << room
        self.bins[k].append(item)
        self.by_room.setdefault(room - length, []).append(k)
        self.mask |= 1 << (room - length)


def filled(lengths: list[int], items: list[int], kept: list[list[int]], size: int, noise: float, rng: random.Random) -> list[list[int]]:
    """Best fit, longest first, of `items` into the `kept` sequences and new ones; noise shuffles the order."""
    out = Bins(size)
    for b in kept:
        out.open(b, size - sum(lengths[i] for i in b))
    order = sorted(items, key=(lambda i: -lengths[i] * (1 + noise * rng.random())) if noise else (lambda i: -lengths[i]))
    for i in order:
        out.best_fit(i, lengths[i])
    return out.bins


def fitness(lengths: list[int], bins: list[list[int]], size: int) -> tuple[int, float]:
    """Fewer sequences first, then fuller ones (mean square of the fill)."""
    return -len(bins), sum((sum(lengths[i] for i in b) / size) ** 2 for b in bins)


def crossed(lengths: list[int], one: list[list[int]], two: list[list[int]], size: int, rng: random.Random) -> list[list[int]]:
    """`one` with well-filled sequences of `two` injected: sequences of `one` that share an item go, and their other items are placed by best fit."""
    full = [b for b in two if size - sum(lengths[i] for i in b) <= SETTLED[-1]] or two
    injected = rng.sample(full, max(1, len(full) // 3))
    taken = {i for b in injected for i in b}
    kept, displaced = [], []
    for b in one:
        if taken.isdisjoint(b):
            kept.append(list(b))
        else:
            displaced += [i for i in b if i not in taken]
    loose = sorted(kept, key=lambda b: sum(lengths[i] for i in b))[: max(1, len(kept) // 50)] if kept else []
    for b in loose:
        kept.remove(b)
        displaced += b
    displaced = replaced(lengths, kept, displaced, size)
    return filled(lengths, displaced, [*kept, *map(list, injected)], size, 0.05 * rng.random(), rng)


def replaced(lengths: list[int], bins: list[list[int]], loose: list[int], size: int) -> list[int]:
    """Improves `bins` by exchange with `loose` items, and returns what is loose then: in a sequence one item makes way for the longest loose
    one, or two, that fill it better. What comes out is smaller, so it is easier to place."""
    loose = sorted(loose, key=lambda i: lengths[i])
    held = [lengths[i] for i in loose]
    for b in bins:
        room = size - sum(lengths[i] for i in b)
        if not room or not loose:
            continue
        for k, i in enumerate(b):
            space = room + lengths[i]
            one = bisect.bisect_right(held, space) - 1
            best, pick = (held[one], (one,)) if one >= 0 else (0, ())
            low, high = 0, len(held) - 1
            while low < high and best < space:
                both = held[low] + held[high]
                if both > space:
                    high -= 1
                    continue
                if both > best:
                    best, pick = both, (low, high)
                low += 1
            if best > lengths[i]:
                put = [loose[x] for x in pick]
                for x in sorted(pick, reverse=True):
                    del loose[x], held[x]
                at = bisect.bisect_right(held, lengths[i])
                loose.insert(at, i)
                held.insert(at, lengths[i])
                b[k : k + 1] = put
                break
    return loose


def evolved(lengths: list[int], seeds: list[list[list[int]]], size: int, rng: random.Random) -> tuple[list[list[int]], int, int]:
    """The best individual of an island after one epoch, the number of its offspring, and the sequences of plain best fit.

    It ends early at the least number of sequences that the lengths allow, all but one of them full.
    """
    bound = math.ceil(sum(lengths) / size)
    everything = list(range(len(lengths)))
    people = [*seeds, *[filled(lengths, everything, [], size, 0.0 if k == 0 else 0.1 * k, rng) for k in range(POPULATION - len(seeds))]]
    plain, born, better = len(people[len(seeds)]), 0, 0
    people.sort(key=lambda b: fitness(lengths, b, size), reverse=True)
    most = OFFSPRING[len(people[0]) > bound * (1 + EXCESS)]
    while born < most and len(people[0]) > bound and born - better <= STALL:
        one, two = rng.sample(people, 2)
        child = crossed(lengths, one, two, size, rng)
        born += 1
        if fitness(lengths, child, size) > fitness(lengths, people[0], size):
            better = born
        if fitness(lengths, child, size) > fitness(lengths, people[-1], size):
            people[-1] = child
            people.sort(key=lambda b: fitness(lengths, b, size), reverse=True)
    return people[0], born, plain


def packed(found: DataFrame, size: int = 2048, report: list[dict[str, int]] | None = None) -> DataFrame:
    """`found` (pieces with a `length` from 1 to `size`) plus sequence_id and offset, in as few sequences as can be.

    Full pieces stand alone. The others are dealt by a hash into blocks of about BLOCK pieces. On each block ISLANDS islands
    evolve; where neither reaches the lower bound, each island's elite migrates to the other for a second epoch. The block's
    best packing settles its well-filled sequences; the pieces of the rest move on, into fewer and larger-mixed blocks, until
    one block is left. Once SETTLED is used up or a round has settled little, only a block's emptiest sequences move on, with half
    of its pieces at most, so the blocks at least halve. Every round writes its state to the shared folder, so no task and no driver ever holds more than a block.

    report: a list to which each round adds its blocks, the offspring born, the islands' elites that migrated, and the sequences of plain best fit and of the search.
    """
    spark = found.sparkSession
    shipped(spark)
    out, columns = [], found.columns
    whole = found.where(F.col("length") == size).select(*columns, (F.monotonically_increasing_id() * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = found.where(F.col("length") < size).withColumn("_uid", F.monotonically_increasing_id())
    count, turn, last, halving = found.where(F.col("length") < size).count(), 0, None, False
    while count:
        blocks = math.ceil(count / BLOCK)
        halving = halving or turn + 1 == len(SETTLED) or last is not None and count > 0.7 * last
        settle = size if blocks == 1 else SETTLED[-1] if halving else SETTLED[turn]
        state = rest.withColumn("_block", F.pmod(F.xxhash64("_uid", F.lit(turn)), F.lit(blocks)))
        done = materialised(one_round(state, size, turn, settle, halving, report), f"packing-{turn}")
        out.append(done.where("sequence_id is not null").select(*columns, "sequence_id", "offset"))
        rest = done.where("sequence_id is null").drop("sequence_id", "offset")
        last, count, turn = count, rest.count(), turn + 1
        collected(spark)
    for part in out:
        whole = whole.unionByName(part)
    return whole


def one_round(state: DataFrame, size: int, turn: int, settle: int, halving: bool = False, report: list[dict[str, int]] | None = None) -> DataFrame:
    """One round over all blocks: `state` without _block, with sequence_id and offset where the piece's sequence is settled.

    halving: the fuller sequences are settled too, so far that at most half of a block's pieces stay open."""
    fields = [f"`{n}` {t}" for n, t in state.drop("_block").dtypes]
    island_schema = ", ".join([*fields, "_block long, _island int, _bin int, _bins int, _done boolean, _born int, _plain int"])
    isles = state.withColumn("_island", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))))

    def first_epoch(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "_uid"], ignore_index=True)
        lengths = rows["length"].tolist()
        return marked(rows, math.ceil(sum(lengths) / size), *evolved(lengths, [], size, random.Random(f"{turn}/{key[0]}/{key[1]}")))

    def marked(rows: pd.DataFrame, bound: int, best: list[list[int]], born: int, plain: int) -> pd.DataFrame:
        where = [0] * len(rows)
        for k, b in enumerate(best):
            for i in b:
                where[i] = k
        return rows.assign(_bin=where, _bins=len(best), _done=len(best) <= bound, _born=born, _plain=plain)

    def second_epoch(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        own, other = (x.sort_values(["length", "_uid"], ignore_index=True) for x in (rows[rows["_island"] == key[1]], rows[rows["_island"] != key[1]]))
        lengths = own["length"].tolist()
        elites = [[list(g.index) for _, g in x.groupby("_bin")] for x in (own, other)]
        return marked(own, 0, *evolved(lengths, elites, size, random.Random(f"{turn}/{key[0]}/{key[1]}/2")))

    def closed(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        best = rows.sort_values(["_bins", "_island"])["_island"].iloc[0]
        rows = rows[rows["_island"] == best].sort_values(["_bin", "_uid"], ignore_index=True)
        total = rows.groupby("_bin")["length"].transform("sum")
        rows["offset"] = (rows.groupby("_bin")["length"].cumsum() - rows["length"]).astype("Int64")
        rows["sequence_id"] = (((key[0] * ROUNDS + turn) * (2 * BLOCK) + rows["_bin"]) * 2 + 1).astype("Int64")
        still = total < size - settle
        if halving:
            held = rows.groupby("_bin")["length"].agg(["sum", "size"]).sort_values("sum", kind="stable")["size"].cumsum()
            still &= rows["_bin"].map(held) <= len(rows) // 2
        rows.loc[still, ["offset", "sequence_id"]] = None
        return rows.drop(columns=["_block", "_island", "_bin", "_bins", "_done", "_born", "_plain"])

    first = materialised(isles.groupBy("_block", "_island").applyInPandas(first_epoch, island_schema), f"islands-{turn}")
    good = first.where("_done").select("_block").distinct()
    open_blocks = first.join(good, "_block", "left_anti")
    moved = open_blocks.withColumn("_to", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))))
    second = moved.groupBy("_block", "_to").applyInPandas(second_epoch, island_schema + ", _to int").drop("_to")
    if report is not None:
        second = materialised(second, f"migrated-{turn}")
    best = first.join(good, "_block", "left_semi").unionByName(second)
    if report is not None:
        isle = F.max(F.struct("_born", "_plain", "_bins")).alias("x")
        born, moves, _ = second.groupBy("_block", "_island").agg(isle).agg(F.sum("x._born"), F.count(F.lit(1)), F.lit(0)).first()
        early = first.groupBy("_block", "_island").agg(isle).agg(F.sum("x._born")).first()[0]
        plain = first.groupBy("_block").agg(F.min("_plain").alias("p")).agg(F.count(F.lit(1)), F.sum("p")).first()
        ends = best.groupBy("_block").agg(F.min("_bins").alias("b")).agg(F.sum("b")).first()[0]
        report.append({"blocks": plain[0], "offspring": (early or 0) + (born or 0), "migrations": moves, "best_fit": plain[1], "search": ends})
    return best.groupBy("_block").applyInPandas(closed, ", ".join([*fields, "offset long, sequence_id long"]))


def pack_documents(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece of every document with its sequence and offset there.

    Null texts are empty, so they are one piece with the end alone; rows that repeat an id, or have none, have pieces of their own.
    An empty table gives no rows. Other columns are never read.
    """
    found = materialised(pieces(docs, tokenizer, size, end_id, id_col, text_col), "pieces", 1000)
    # the search's workers see no null among the ids, which would make them doubles
    found = found.withColumns({"doc_id": F.coalesce("doc_id", F.lit(0).cast("long")), "_nil": F.col("doc_id").isNull()})
    return packed(found, size).withColumn("doc_id", F.when(~F.col("_nil"), F.col("doc_id"))).drop("_nil")
