"""Sets of hashed word shingles of whole texts, computed for many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK = 1 << 19
_RANDOM = np.random.default_rng(20240229)
#: A random 64-bit value for each byte, A-Z as a-z.
_BYTES = _RANDOM.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BYTES[65:91] = _BYTES[97:123]
_BLANK = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_PLACES = _RANDOM.integers(0, 1 << 63, 16, np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: list[np.ndarray] = []


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, CHUNK + 1)
        both = [np.full(size, b, np.uint64) for b in (_BASE, _INVERSE)]
        for p in both:
            p[0] = 1
        _POWERS[:] = [np.multiply.accumulate(p) for p in both]
    return _POWERS[0], _POWERS[1]


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and 64-bit hash of every word (run of bytes that are no blanks) of a buffer."""
    b = np.frombuffer(raw, np.uint8)
    blank = np.concatenate([[True], _BLANK[b], [True]])
    starts = np.flatnonzero(blank[:-1] & ~blank[1:])
    ends = np.flatnonzero(~blank[:-1] & blank[1:])
    up, down = _powers(len(b) + 1)
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_BYTES[b] * up[: len(b)], out=sums[1:])
    return starts, mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_sets(texts: list[str | None], words: int = 5) -> Iterator[tuple[int, np.ndarray]]:
    """(index, sorted distinct hashes) of every text: its shingles of `words` words; with fewer words, the whole sequence as one; none without words."""
    begin = 0
    while begin < len(texts):
        parts, size, end = [], 0, begin
        while end < len(texts) and (end == begin or size < CHUNK):
            parts.append((texts[end] or "").encode("utf-8", "replace"))
            size += len(parts[-1]) + 1
            end += 1
        yield from _sets(parts, begin, words)
        begin = end


def _sets(parts: list[bytes], first: int, words: int) -> Iterator[tuple[int, np.ndarray]]:
    starts, hashes = word_hashes(b"\n".join(parts))
    bounds = np.searchsorted(starts, np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])]))
    n = len(hashes) - words + 1
    rolled = np.zeros(max(n, 0), np.uint64)
    for k in range(words):
        rolled += hashes[k : k + n] * _PLACES[k] if n > 0 else 0
    rolled = mixed(rolled)
    for k, (a, z) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        if z - a >= words:
            yield first + k, np.unique(rolled[a : z - words + 1])
        elif z > a:
            yield first + k, mixed((hashes[a:z] * _PLACES[: z - a]).sum(keepdims=True) + np.uint64(z - a))
        else:
            yield first + k, np.zeros(0, np.uint64)
