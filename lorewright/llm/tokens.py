"""Byte-level BPE token ids, by a vocabulary file given by path."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np

#: Split rule of the vocabulary's pre-tokeniser.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words that one worker remembers at most; about 60 MB.
CACHED_WORDS = 250_000
CACHED_LENGTH = 40
#: Characters of the texts that are looked at together.
CHUNK = 1 << 19
_LOADED: dict[str, "Tokens"] = {}


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabulary files: printable ones themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Tokens:
    """Token ids of whole texts as little-endian 32-bit bytes, equal to those of the vocabulary's own library.

    The file's merges are in the order of their ids, so ids are ranks and a rank-based encoder gives the same ids, only
    faster. Text is cut before single blanks that follow a character other than white space: no token spans such a place
    and no look-ahead reaches over it, so words are encoded once, many at a time, and remembered. A text in which a word is
    empty, very long or ends with white space, or that holds an added token of the file (such as an end marker), is encoded as a whole.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            given = json.load(f)
        letters, added = byte_letters(), {}
        for token in given["added_tokens"]:
            if token["single_word"] or token["lstrip"] or token["rstrip"]:
                raise ValueError(f"added token {token['content']!r} takes in what surrounds it")
            added[token["content"]] = token["id"]
        ranks = {bytes(letters[c] for c in word): n for word, n in given["model"]["vocab"].items() if all(c in letters for c in word) and word not in added}
        self.added = {content: np.array([n], "<u4").tobytes() for content, n in added.items()}
        # the longest of those that begin at one place
        self.marker = re.compile("(" + "|".join(re.escape(x) for x in sorted(added, key=len, reverse=True)) + ")") if added else None
        self.encoder = tiktoken.Encoding("given", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for raw, n in ranks.items():
            self.sizes[n] = len(raw)
        self.cache: dict[str, bytes] = {}

    def marked(self, text: str) -> bool:
        """Whether `text` holds an added token."""
        return any(x in text for x in self.added)

    def whole(self, text: str) -> bytes:
        """The ids of `text`, without the cache. Added tokens are cut out first, and what lies between them is encoded apart."""
        if self.marked(text):
            return b"".join(self.added[x] if k % 2 else self.whole(x) for k, x in enumerate(self.marker.split(text)))
        return np.array(self.encoder.encode_ordinary(text), "<u4").tobytes()

    def learn(self, words: list[str]) -> None:
        """Remembers the ids of words after a blank: they are encoded as one text and parted by the tokens' bytes."""
        text = " " + " ".join(words)
        ids = self.encoder.encode_to_numpy(text, disallowed_special=()).astype("<u4")
        blanks = np.flatnonzero(np.frombuffer(text.encode(), np.uint8) == 32)
        ends = np.append(blanks[1:], len(text.encode()))
        cuts = (4 * (np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1)).tolist()
        raw = ids.tobytes()
        self.cache.update(zip(words, [raw[a:z] for a, z in zip([0, *cuts], cuts, strict=False)], strict=True))

    def many(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text."""
        begin = 0
        while begin < len(texts):
            end, held, split = begin, 0, []
            while end < len(texts) and held < CHUNK:
                # a text with an added token is encoded as a whole
                split.append([texts[end]] if self.marked(texts[end]) else texts[end].split(" "))
                held += len(texts[end])
                end += 1
            if len(self.cache) > CACHED_WORDS:
                self.cache.clear()
            new = set().union(*(s[1:] for s in split)).difference(self.cache)
            new = [w for w in new if w and len(w) <= CACHED_LENGTH and not w[-1].isspace()]
            if new:
                self.learn(new)
            known = self.cache.__getitem__
            for text, words in zip(texts[begin:end], split, strict=True):
                first = words[0]
                if len(words) > 1 and (not first or first[-1].isspace()):
                    yield self.whole(text)
                    continue
                try:
                    yield self.whole(first) + b"".join(map(known, words[1:]))
                except KeyError:
                    yield self.whole(text)
            begin = end


def loaded(path: str) -> Tokens:
    """The encoder of a vocabulary file, read once in each worker."""
    if path not in _LOADED:
        _LOADED[path] = Tokens(path)
    return _LOADED[path]
