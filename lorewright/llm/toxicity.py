"""Toxicity: a support vector machine on a gap-weighted subsequence string kernel with Nystroem landmarks."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shipped

#: Characters of a subsequence, span of it at most, decay of a span's character, classes of characters, those among them that rarer characters share.
LENGTH, SPAN, DECAY, CLASSES, SHARED = 3, 5, 0.6, 64, 16
#: Offsets of the second and third character.
STEPS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]
#: Labelled documents of either class learned from at most; longest of them; landmarks from toxic and clean words; rounds.
TOXIC, CLEAN, LONGEST, LANDMARKS, ROUNDS = 2000, 4000, 200_000, (160, 32), 6
#: Characters of all texts learned from at most; hashes by which copies of a text are known.
LEARNED, COPIES = 60_000_000, 3
#: Variants of a landmark with a character put in, and their weight as examples.
VARIANTS, VARIANT_WEIGHT = 4, 0.5
#: Clean texts' words this near the plane become counter-examples, and a toxic text's word nearest to it this near becomes an example.
NEAR, WITNESS = -0.6, -0.3
#: A word whose score is bounded by this chance is not looked at further.
FLOOR = 0.02
CHUNK = 1 << 20


@dataclass
class Model:
    """Classes of code points; row of each subsequence in the weights; subsequence weights of the landmarks, the last row zero; kernel map; plane; calibration."""

    classes: np.ndarray
    rows: np.ndarray
    landmarks: np.ndarray
    projection: np.ndarray
    plane: np.ndarray
    slope: float
    shift: float

    def __post_init__(self):
        self.bound = (self.landmarks @ (self.projection @ self.plane[:-1])).astype(np.float32)[self.rows]
        self.lowest = (np.log(FLOOR / (1 - FLOOR)) - self.shift) / self.slope

    def values(self, words: list[str]) -> np.ndarray:
        """Distances of words from the plane."""
        return kernel(words, self.classes, self.rows, self.landmarks) @ self.projection @ self.plane[:-1] + self.plane[-1]

    def chances(self, texts: list[str], seen: dict[str, float]) -> np.ndarray:
        """Chance of toxicity of every text: that of its worst word; of a text without words, FLOOR at most. `seen` remembers words."""
        worst = np.full(len(texts), -np.inf)
        begin = 0
        while begin < len(texts):
            end, held = begin, 0
            while end < len(texts) and (end == begin or held + len(texts[end]) <= CHUNK):
                held += len(texts[end])
                end += 1
            doc, words = suspects(texts[begin:end], self.classes, self.bound, self.plane[-1], self.lowest, True)
            new = [w for w in dict.fromkeys(words) if w not in seen]
            if len(seen) > 200_000:
                seen.clear()
                new = list(dict.fromkeys(words))
            seen.update(zip(new, self.values(new).tolist(), strict=True) if new else ())
            np.maximum.at(worst, begin + doc, np.array([seen[w] for w in words])) if words else None
            begin = end
        worst = np.where(np.isfinite(worst), worst, min(self.lowest, self.plane[-1]))
        return 1 / (1 + np.exp(-(self.slope * worst + self.shift)))


def code_points(text: str) -> np.ndarray:
    """Lower-cased code points."""
    return np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)


def classed(points: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Class of each code point: 0 white space, CLASSES for what is skipped, else 1 to CLASSES - 1."""
    return classes[points]


def letters(texts: list[str]) -> np.ndarray:
    """Classes of code points: the most frequent letters and digits have their own, the others are dealt to SHARED ones, whatever their script; marks between letters are skipped."""
    counts: Counter = Counter()
    for t in texts:
        counts.update(t.lower())
    own = CLASSES - 1 - SHARED
    out = np.full(0x110000, CLASSES, np.uint8)
    for c in range(len(out)):
        x = chr(c)
        if x.isspace():
            out[c] = 0
        elif x.isalnum() or c >= 0x1F000:  # pictures are like letters
            out[c] = own + 1 + (c * 2654435761 >> 7) % SHARED
    common = [c for c, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0])) if c.isalnum()][:own]
    for k, c in enumerate(sorted(common)):
        out[ord(c)] = k + 1
    return out


def stream(texts: list[str], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Classes of the kept characters of all texts, their code points, and each word's first place and text.

    White space parts words; runs of three or more one-letter words are read as one word, so spelled-out words count.
    """
    points = code_points("\n".join(t.replace("\n", " ") for t in texts))
    c = classed(points, classes)
    ends = points == 10
    keep = c != CLASSES
    c, points, ends = c[keep], points[keep], ends[keep]
    blank = np.flatnonzero(c == 0)
    starts = np.concatenate([[0], blank + 1])
    sizes = np.diff(np.concatenate([starts, [len(c) + 1]])) - 1
    if len(blank) > 1:
        one = np.concatenate([[False], sizes == 1, [False, False]])
        both = one[1:-2] & one[2:-1]
        joined = both & (one[:-3] | one[3:])
        joined = joined[: len(blank)] & ~ends[blank]
        if joined.any():
            keep = np.ones(len(c), bool)
            keep[blank[joined]] = False
            c, points, ends = c[keep], points[keep], ends[keep]
            blank = np.flatnonzero(c == 0)
            starts = np.concatenate([[0], blank + 1])
    doc = np.concatenate([[0], np.cumsum(ends[blank])]).astype(np.int64)
    return c, points, starts, doc


def subsequences(c: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For each pair of steps: places of first characters, codes of the subsequences within a word, and their weight."""
    wide = c.astype(np.int32)
    word = np.zeros(len(c) + 1, np.int32)
    word[starts[1:] - 1] = 1
    word = np.cumsum(word[:-1])
    for b in range(2, SPAN):
        n = len(c) - b
        if n <= 0:
            return
        same = np.flatnonzero((word[:n] == word[b:]) & (c[:n] > 0))
        head = wide[same] * (CLASSES * CLASSES) + wide[same + b]
        for a, last in STEPS:
            if last == b:
                yield same, head + wide[same + a] * CLASSES, DECAY ** (b + 1)


def least_norms(size: int) -> np.ndarray:
    """Norm of a word's subsequence weights by its length, if none occurs twice: a lower bound."""
    n = np.arange(size + 1)
    return np.sqrt(np.maximum(sum(np.maximum(n - b, 0) * DECAY ** (2 * b + 2) for _, b in STEPS), 1e-12))


def suspects(texts: list[str], classes: np.ndarray, weights: np.ndarray, shift: float, lowest: float, every: bool = False) -> tuple[np.ndarray, list[str]]:
    """Texts and words whose distance from the plane may be over `lowest`: the norm's lower bound bounds it from above."""
    c, points, starts, doc = stream(texts, classes)
    if not len(c):
        return np.zeros(0, np.int64), []
    total = np.zeros(len(c) + 1, np.float32)
    for at, codes, weight in subsequences(c, starts):
        total[at] += weight * weights[codes]
    sizes = np.diff(np.concatenate([starts, [len(c) + 1]])) - 1
    sums = np.add.reduceat(total, np.minimum(starts, len(c)))
    norms = least_norms(int(sizes.max(initial=0)))
    # a sum below 0 is not bounded by the least norm, but then the value is under the shift
    most = np.where(sizes >= LENGTH, np.maximum(sums, 0) / norms[np.maximum(sizes, 0)] + shift, -np.inf)
    chosen = most >= lowest - 1e-3
    if every:  # of texts without any, the word with the highest bound
        order = np.lexsort((-sums / norms[np.maximum(sizes, 0)], doc))
        first = order[np.flatnonzero(np.concatenate([[True], doc[order][1:] != doc[order][:-1]]))]
        none = np.bincount(doc, chosen, len(texts))[doc[first]] == 0
        chosen[first[none & (sizes[first] >= LENGTH)]] = True
    found = np.flatnonzero(chosen)
    words = ["".join(map(chr, points[starts[w] : starts[w] + sizes[w]])) for w in found]
    return doc[found], words


def profile(words: list[str], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights of distinct subsequences: word, code, weight divided by the word's norm."""
    c, _, starts, _ = stream_words(words, classes)
    word = np.zeros(len(c), np.int64)
    word[starts[1:] - 1] = 1
    word = np.cumsum(word)
    keys, values = [np.zeros(0, np.int64)], [np.zeros(0)]
    for at, codes, weight in subsequences(c, starts):
        keys.append(word[at] * CLASSES**LENGTH + codes)
        values.append(np.full(len(at), weight))
    distinct, back = np.unique(np.concatenate(keys), return_inverse=True)
    value = np.bincount(back, np.concatenate(values), len(distinct))
    word, code = distinct // CLASSES**LENGTH, distinct % CLASSES**LENGTH
    norm = np.sqrt(np.maximum(np.bincount(word, value**2, len(words)), 1e-12))
    return word, code, value / norm[word]


def stream_words(words: list[str], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Like stream(), for single words: none is joined to its neighbour."""
    points = code_points(" ".join(words))
    c = classed(points, classes)
    c = np.where(c == CLASSES, CLASSES - 1, c)
    starts = np.concatenate([[0], np.flatnonzero(c == 0) + 1])
    return c, points, starts, starts


def kernel(words: list[str], classes: np.ndarray, rows: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Normalised kernel of each word with each landmark (a column of subsequence weights, in the rows of `rows`)."""
    out = np.zeros((len(words), landmarks.shape[1]))
    for begin in range(0, len(words), 4096):
        part = words[begin : begin + 4096]
        word, code, value = profile(part, classes)
        known = rows[code] < len(landmarks) - 1
        word, code, value = word[known], code[known], value[known]
        if len(word):
            firsts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            out[begin + word[firsts]] = np.add.reduceat(landmarks[rows[code]] * value[:, None], firsts, axis=0)
    return out


def machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 0.05) -> np.ndarray:
    """Plane (last: shift) of a linear machine with squared hinge loss, by Newton steps on the examples inside the margin."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = penalty * np.eye(x.shape[1])
    ridge[-1, -1] = 1e-8
    for _ in range(30):
        inside = y * (x @ w) < 1
        a = x[inside] * weight[inside, None]
        new = np.linalg.solve(a.T @ x[inside] + ridge, a.T @ y[inside])
        if np.abs(new - w).max() < 1e-8:
            break
        w = new
    return w


def marks_of(words: list[str]) -> list[int]:
    """COPIES min-hashes of a text's triples of words: copies of a text, near ones too, mostly share them."""
    triples = {zlib.crc32("\0".join(words[k : k + 3]).encode("utf-8", "replace")) for k in range(max(1, len(words) - 2))}
    x = np.fromiter(triples, np.uint64, len(triples))
    return [int(((x * np.uint64(m) + np.uint64(s)) & np.uint64(0xFFFFFFFF)).min()) for m, s in ((2654435761, 1), (2246822519, 7), (3266489917, 13))[:COPIES]]


def counted_words(texts: list[str], y: np.ndarray, classes: np.ndarray) -> tuple[dict[str, int], dict[str, int]]:
    """For the words of toxic and of clean texts, the texts that hold them; copies of a text, as their min-hashes have it, count once."""
    index: dict[str, int] = {}
    held: tuple[list, list] = ([], [])
    for t, k in zip(texts, y.tolist(), strict=True):
        r = units(t, classes)
        own = np.array([index.setdefault(w, len(index)) for w in set(r) if len(w) >= LENGTH], np.int64)
        held[k].append((own, marks_of(r)))

    def count(rows: list) -> dict[str, int]:
        ids, sizes = np.concatenate([own for own, _ in rows]), [len(own) for own, _ in rows]
        least = None
        for j in range(COPIES):
            keys = np.unique(ids << 32 | np.repeat(np.array([m[j] for _, m in rows], np.int64), sizes))
            n = np.bincount(keys >> 32, minlength=len(index))
            least = n if least is None else np.minimum(least, n)
        return {w: int(least[k]) for w, k in index.items() if least[k]}

    return count(held[1]), count(held[0])


def trained(texts: list[str], labels: list[int]) -> Model | None:
    """The model of labelled texts; None if a class is missing.

    A toxic text holds words that make it so, and which ones is unknown: each labelled text is a bag of words (multiple-instance learning).
    Words that lie so much more in toxic texts than chance explains begin as the examples, and the strongest are landmarks; copies
    of a text count once in this. Then in turns the machine is trained; of each toxic text the word nearest to its side becomes the
    example that stands for the text, if it is near enough (a text without such a word is a label that nothing explains); and the clean texts'
    words that come near the plane become counter-examples; until neither changes. The chance is fitted to the texts' labels.
    """
    y = np.array(labels)
    if not len(y) or y.min() == y.max():
        return None
    classes = letters(texts)
    pos, neg = counted_words(texts, y, classes)
    if not pos or not neg:
        return None
    strong = marking(pos, neg)
    common = sorted(neg, key=lambda w: (-neg[w], w))
    marks = list(dict.fromkeys([*strong[: LANDMARKS[0]], *common[: LANDMARKS[1]]]))
    word, code, value = profile(marks, classes)
    used = np.unique(code)
    table = np.full(CLASSES**LENGTH, len(used), np.int32)
    table[used] = np.arange(len(used))
    weights = np.zeros((len(used) + 1, len(marks)), np.float32)
    weights[table[code], word] = value
    eigen, vectors = np.linalg.eigh(weights.astype(np.float64).T @ weights)
    good = eigen > 1e-6 * eigen.max()
    projection = vectors[:, good] / np.sqrt(eigen[good])
    held = set(strong)
    counter = dict.fromkeys(w for w in [*common[:4000], *common[4000 :: max(1, len(common) // 16_000)]] if w not in held)
    clean, toxic = ([t for t, k in zip(texts, y, strict=True) if k == c] for c in (0, 1))
    written = [v for w in strong[: LANDMARKS[0]] for v in variants(w, classes)]
    share = {v: VARIANT_WEIGHT * math.sqrt(pos[w]) for w in strong[: LANDMARKS[0]] for v in variants(w, classes)} | {w: math.sqrt(pos[w]) for w in strong}
    minus = kernel(list(counter), classes, table, weights) @ projection
    # a word like no landmark, and with it any script that the labels don't hold, is on the clean side
    minus, strange = np.vstack([np.zeros((1, minus.shape[1])), minus]), 50.0
    for _ in range(ROUNDS):
        plus = kernel(list(share), classes, table, weights) @ projection
        sign = np.concatenate([np.ones(len(plus)), -np.ones(len(minus))])
        weight = np.concatenate([np.array(list(share.values())) / sum(share.values()) * 1000, [strange], np.full(len(minus) - 1, 0.5)])
        model = Model(classes, table, weights, projection, machine(np.vstack([plus, minus]), sign, weight), 1.0, 0.0)
        chosen = Counter(w for w, v in witnesses(model, toxic) if v > WITNESS and w not in counter)
        stand = share | {w: math.sqrt(n) for w, n in chosen.items()}
        new = {}
        for begin in range(0, len(clean), 64):
            new |= dict.fromkeys(w for w in suspects(clean[begin : begin + 64], classes, model.bound, model.plane[-1], NEAR)[1] if w not in counter and w not in held)
        values = model.values(list(new)) if new else np.zeros(0)
        new = [w for w, v in zip(new, values.tolist(), strict=True) if v > NEAR]
        stand = {w: x for w, x in stand.items() if w in held or w in written or w not in new}
        if not new and stand == share:
            break
        if new:
            minus = np.vstack([minus, kernel(new, classes, table, weights) @ projection])
        counter |= dict.fromkeys(new)
        share = {w: x for w, x in stand.items() if w not in counter or w in held}
    worst = [max(NEAR, v) for _, v in witnesses(model, texts)]
    others = model.values(written) if written else np.zeros(0)
    slope, shift = calibrated(np.concatenate([worst, np.maximum(others, NEAR)]), np.concatenate([y, np.ones(len(others), y.dtype)]))
    return Model(classes, table, weights, projection, model.plane, slope, shift)


def witnesses(model: Model, texts: list[str]) -> list[tuple[str, float]]:
    """The word of each text that lies furthest on the toxic side, and how far; without any near it, "" and minus infinity."""
    out, seen = [], {}
    for t in texts:
        words = suspects([t], model.classes, model.bound, model.plane[-1], NEAR)[1]
        new = [w for w in dict.fromkeys(words) if w not in seen]
        seen.update(zip(new, model.values(new).tolist(), strict=True) if new else ())
        out.append(max(((w, seen[w]) for w in words), key=lambda x: (x[1], x[0]), default=("", -math.inf)))
    return out


def variants(word: str, classes: np.ndarray) -> list[str]:
    """The word with one character put in, at VARIANTS places: toxic words are also written so."""
    rng = random.Random(word)
    inside = [chr(c) for c in range(97, 123) if classes[c] < CLASSES - 1] or ["x"]
    places = rng.sample(range(1, len(word)), min(VARIANTS, len(word) - 1))
    return [word[:k] + rng.choice([*inside, word[k]]) + word[k:] for k in places]


def marking(pos: dict[str, int], neg: dict[str, int]) -> list[str]:
    """Words that mark toxic texts, strongest first: as many occurrences there would not be expected once in a hundred corpora
    if toxic and clean texts used words alike. If none is that clear, the clearest ones."""
    total = sum(pos.values()) + sum(neg.values())
    share, limit = math.log(sum(pos.values()) / total), math.log(0.01 / max(len(pos), 1))

    def chance(w: str) -> float:
        n, m = pos[w], neg.get(w, 0)
        return n * share + math.lgamma(n + m + 1) - math.lgamma(n + 1) - math.lgamma(m + 1)

    order = sorted((w for w in pos if pos[w] > 4 * neg.get(w, 0)), key=lambda w: (chance(w), w))
    return [w for w in order if chance(w) < limit] or order[:8] or sorted(pos)[:8]


def calibrated(value: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the chance of class 1, with targets held off 0 and 1."""
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((y == 0).sum() + 2))
    x = np.stack([value, np.ones(len(value))], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (p - target) + 1e-3 * w)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-7:
            break
    return max(float(w[0]), 1e-3), float(w[1])


def units(text: str, classes: np.ndarray) -> list[str]:
    """Words of a text in order."""
    c, points, starts, _ = stream([text], classes)
    sizes = np.diff(np.concatenate([starts, [len(c) + 1]])) - 1
    whole = "".join(map(chr, points))
    return [whole[a : a + n] for a, n in zip(starts.tolist(), sizes.tolist(), strict=True) if n]


def training_rows(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> tuple[list[str], list[int]]:
    """Whole labelled texts and labels: of each class, those that come first by a hash of their ids, TOXIC and CLEAN of them at most,
    none longer than LONGEST characters and LEARNED characters in all. Null texts and labels are left out; of several labels of an id the largest counts."""
    known = labels.where(learn & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max(label_col).alias("_y"))
    place = F.crc32(F.concat(F.lit("toxic:"), F.col(id_col).cast("string")))
    picked = None
    for y, most in ((0, CLEAN), (1, TOXIC)):
        part = known.where(F.col("_y") == y).orderBy(place, id_col).limit(most)
        picked = part if picked is None else picked.unionByName(part)
    rows = docs.select(id_col, text_col).where(F.col(text_col).isNotNull() & (F.length(text_col) <= LONGEST)).join(F.broadcast(picked), id_col)
    # lengths first: whole texts come only as far as LEARNED reaches
    sizes = sorted(map(tuple, rows.select(place, id_col, F.length(text_col)).distinct().collect()))
    held = np.cumsum([r[2] for r in sizes])
    within = [r[1] for r, x in zip(sizes, held.tolist(), strict=True) if x <= LEARNED]
    rows = rows.join(F.broadcast(docs.sparkSession.createDataFrame([(i,) for i in within], f"{id_col} {dict(docs.dtypes)[id_col]}")), id_col)
    found = sorted(map(tuple, rows.select(id_col, text_col, "_y").collect()))
    return [r[1] for r in found], [r[2] for r in found]


def scored(docs: DataFrame, texts: list[str], labels: list[int], text_col: str = "text") -> DataFrame:
    """`docs` with score: the chance that a text is toxic, by its worst word. Null texts are empty ones and score FLOOR at most;
    if nothing was learned, all texts get 0. Repeated rows score alike. The broadcast model's size doesn't depend on the corpus."""
    spark = docs.sparkSession
    shipped(spark)
    shared = spark.sparkContext.broadcast(trained(texts, labels))

    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model, seen = shared.value, {}
        for batch in batches:
            texts = [t or "" for t in batch.tolist()]
            yield pd.Series(model.chances(texts, seen) if model is not None else np.zeros(len(texts)))

    return docs.withColumn("score", F.pandas_udf(predict, "double")(F.col(text_col)))
