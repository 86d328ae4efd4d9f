"""Language ID by prediction by partial matching: exact code lengths under frozen byte-context statistics of each language."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shipped

#: Longest context in bytes; least count of a context; entries (context x language x symbol) of the table of code lengths.
ORDER, LEAST, ENTRIES = 4, 4, 6_000_000
#: Training documents of a language at most, in the order of a hash of their ids; bytes of them at most (whole documents).
SAMPLE_DOCS, SAMPLE_BYTES = 400, 800_000
#: Bytes whose evidence the score states at most: longer texts are scored by their mean.
EVIDENCE = 64
CHUNK = 1 << 19
#: Code lengths are whole numbers of 1 / UNIT bits, so sums over a text are exact in any order.
UNIT = 1 << 16
UNDETERMINED = "und"


@dataclass
class Model:
    """Frozen statistics: symbol of each byte, child contexts by (context, older symbol), code lengths by (context, symbol, language) in units of 1 / UNIT bits."""

    languages: list[str]
    symbols: np.ndarray
    children: np.ndarray
    units: np.ndarray

    def code_lengths(self, texts: list[str]) -> np.ndarray:
        """Bits of every text under each language's tree."""
        out = np.zeros((len(texts), len(self.languages)), np.int64)
        batch: list[tuple[int, bytes]] = []
        held = 0
        for k, text in enumerate(texts):
            raw = b"\n" * ORDER + text.encode("utf-8", "replace")
            for begin in range(0, max(1, len(raw) - ORDER), CHUNK):
                part = raw[begin : begin + CHUNK + ORDER]
                batch.append((k, part))
                held += len(part)
                if held >= CHUNK:
                    self._add(batch, out)
                    batch, held = [], 0
        self._add(batch, out)
        return out / UNIT

    def _add(self, batch: list[tuple[int, bytes]], out: np.ndarray) -> None:
        batch = [x for x in batch if len(x[1]) > ORDER]
        if not batch:
            return
        s = self.symbols[np.frombuffer(b"".join(x[1] for x in batch), np.uint8)]
        ends = np.cumsum([len(x[1]) for x in batch])
        node, deepest = contexts(self.children, s, len(self.symbols_used))
        at = deepest * len(self.symbols_used) + s[ORDER:]
        cost = self.units.reshape(-1, len(self.languages))[at]
        begins = np.concatenate([[0], ends[:-1]])
        lead = (begins[1:, None] - ORDER + np.arange(ORDER)[None, :]).ravel()
        cost[lead] = 0  # the filling before each later text
        sums = np.add.reduceat(cost, begins, axis=0, dtype=np.int64)
        for (k, _), row in zip(batch, sums, strict=True):
            out[k] += row

    @property
    def bits(self) -> np.ndarray:
        """Code lengths in bits."""
        return self.units / UNIT

    @property
    def symbols_used(self) -> range:
        """Symbols: one for each byte seen in training, the last for all others."""
        return range(int(self.symbols.max()) + 1)


def contexts(children: np.ndarray, s: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place from ORDER on, the context node at full depth (0: none) and the deepest known one."""
    node = children[n + s[ORDER - 1 : -1].astype(np.int64)]
    deepest = np.maximum(node, 1)
    for k in range(2, ORDER + 1):
        node = children[node.astype(np.int64) * n + s[ORDER - k : -k]]
        deepest = np.maximum(deepest, node)
    return node, deepest.astype(np.int64)


def trained(texts: dict[str, list[str]]) -> Model:
    """The model of labelled texts; a context's symbols get count / (total + distinct), and the escape distinct / (total + distinct)
    goes to the next shorter context, renormalised over the symbols not seen here; below order 0 all byte values are alike."""
    languages = sorted(texts)
    raw = [np.frombuffer(b"".join(b"\n" * ORDER + t.encode("utf-8", "replace") for t in texts[x]), np.uint8) for x in languages]
    seen = np.unique(np.concatenate([np.array([10], np.uint8), *raw]))
    n = len(seen) + (len(seen) < 256)
    symbols = np.full(256, n - 1, np.int32)
    symbols[seen] = np.arange(len(seen), dtype=np.int32)
    least_bits = np.full(n, 1 / 256)
    least_bits[n - 1] = (256 - len(seen) + (len(seen) == 256)) / 256
    streams = [symbols[x] for x in raw]
    room = max(n + 2, ENTRIES // (n * len(languages)))
    children = np.zeros((room, n), np.int32)
    bits = np.zeros((room, n, len(languages)), np.float32)
    nodes = [np.ones(max(0, len(s) - ORDER), np.int32) for s in streams]
    base = np.broadcast_to(least_bits[:, None], (n, len(languages)))
    chances = {1: _mixed(np.stack([np.bincount(s[ORDER:], minlength=n) for s in streams], axis=1)[None], base[None])[0]}
    bits[1] = -np.log2(chances[1])
    used = 2
    for k in range(1, ORDER + 1):
        keys = [node * n + s[ORDER - k : len(s) - k] for node, s in zip(nodes, streams, strict=True)]
        keys = [np.where(node > 0, x, -1) for node, x in zip(nodes, keys, strict=True)]
        found, counts = np.unique(np.concatenate(keys), return_counts=True)
        good = (found >= 0) & (counts >= LEAST)
        found, counts = found[good], counts[good]
        if len(found) > room - used:
            top = np.sort(np.lexsort((found, -counts))[: room - used])
            found = found[top]
        if not len(found):
            break
        ids = np.arange(used, used + len(found))
        children[found // n, found % n] = ids
        here = []
        for x, s in zip(keys, streams, strict=True):
            at = np.searchsorted(found, x)
            at = np.where((at < len(found)) & (found[np.minimum(at, len(found) - 1)] == x), at, -1)
            here.append(at)
        for begin in range(0, len(found), 2048):
            end = min(begin + 2048, len(found))
            count = np.zeros((end - begin, n, len(languages)))
            for j, (at, s) in enumerate(zip(here, streams, strict=True)):
                inside = (at >= begin) & (at < end)
                count[:, :, j] = np.bincount((at[inside] - begin) * n + s[ORDER:][inside], minlength=(end - begin) * n).reshape(-1, n)
            above = np.exp2(-bits[found[begin:end] // n].astype(np.float64))
            bits[used + begin : used + end] = -np.log2(_mixed(count, above))
        nodes = [np.where(at >= 0, at + used, 0).astype(np.int32) for at in here]
        used += len(found)
    return Model(languages, symbols, children[:used].ravel(), np.rint(bits[:used] * UNIT).astype(np.int32))


def _mixed(count: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Chances in contexts with these counts [context, symbol, language], given those of the shorter contexts."""
    total, distinct = count.sum(1, keepdims=True), (count > 0).sum(1, keepdims=True)
    unseen = np.where(count > 0, 0, above)
    left = unseen.sum(1, keepdims=True)
    escape = np.where(left > 0, distinct / np.maximum(total + distinct, 1), 0)
    seen = count / np.maximum(total, 1) * (1 - escape)
    return np.where(total > 0, np.where(count > 0, seen, escape * unseen / np.maximum(left, 1e-300)), above)


def training_texts(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, list[str]]:
    """Whole labelled texts for each language: those of the rows where `learn` holds that come first by a hash of their ids,
    SAMPLE_DOCS documents and SAMPLE_BYTES characters of a language at most (one more document may pass it).

    Ids' hashes and lengths come first, 2 * SAMPLE_DOCS rows a language at most, and whole texts only of the chosen rows.
    """
    known = docs.where(learn & F.col(lang_col).isNotNull())
    counts = {r[0]: r[1] for r in known.groupBy(lang_col).count().collect()}
    if not counts:
        return {}
    place = F.crc32(F.concat(F.lit("ppm:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    share = F.lit(0.0)
    for lang, count in sorted(counts.items()):
        share = F.when(F.col(lang_col) == lang, F.lit(min(1.0, 2 * SAMPLE_DOCS / count))).otherwise(share)
    size = F.length(text_col)
    rows = known.where(place < share * F.lit(2.0**32)).where(F.col(text_col).isNotNull()).withColumns({"_place": place, "_size": size, "_mark": F.xxhash64(text_col)})
    first = Window.partitionBy(lang_col).orderBy("_place", "_mark")
    sizes = rows.select(lang_col, "_place", "_size", "_mark").withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= SAMPLE_DOCS).collect()
    chosen, held = [], {}
    for lang, where, length, mark, _ in sorted(sizes, key=lambda r: (r[0], r[1], r[3])):
        if held.get(lang, 0) < SAMPLE_BYTES:
            chosen.append((lang, where, mark))
            held[lang] = held.get(lang, 0) + length
    wanted = F.broadcast(docs.sparkSession.createDataFrame(sorted(set(chosen)), f"{lang_col} string, _place long, _mark long"))
    out: dict[str, list[str]] = {}
    for lang, _, text in sorted(map(tuple, rows.join(wanted, [lang_col, "_place", "_mark"]).select(lang_col, "_place", text_col).collect())):
        out.setdefault(lang, []).append(text)
    return out


def identified(docs: DataFrame, texts: dict[str, list[str]], text_col: str = "text") -> DataFrame:
    """`docs` with lang_pred and score: the language with the shortest code for the whole text, and its share of the posterior.

    Null texts and texts without a letter get UNDETERMINED and 0, as do all texts if nothing was learned. Of equally short codes the first language by
    name wins. The statistics are frozen after training and broadcast; their size is bounded by ENTRIES, not by the corpus.
    """
    spark = docs.sparkSession
    shipped(spark)
    shared = spark.sparkContext.broadcast(trained(texts) if texts else None)

    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for batch in batches:
            texts = batch.tolist()
            usable = [k for k, t in enumerate(texts) if model is not None and t and any(map(str.isalpha, t))]
            names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
            if usable:
                bits = model.code_lengths([texts[k] for k in usable])
                sizes = np.array([max(1, len(texts[k])) for k in usable])
                best = bits.argmin(1)
                gap = (bits - bits.min(1, keepdims=True)) * np.minimum(1, EVIDENCE / sizes)[:, None]
                share = 1 / np.exp2(-gap).sum(1)
                for k, b, p in zip(usable, best.tolist(), share.tolist(), strict=True):
                    names[k], scores[k] = model.languages[b], p
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    udf = F.pandas_udf(predict, "lang_pred string, score double")
    named = docs.withColumn("_found", udf(F.col(text_col)))
    return named.withColumn("lang_pred", F.col("_found.lang_pred")).withColumn("score", F.col("_found.score")).drop("_found")
