"""Byte-level BPE against the vocabulary's own library, exact round trips, and a small vocabulary against plain merges."""

import base64
import hashlib
import random

import public_tokenizers as public
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from lorewright.llm import bpe

SMALL = "/root/testdata/sf0.001"
FILES = ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"]


def library(codec):
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


@pytest.fixture(scope="module", params=FILES)
def pair(request):
    codec = bpe.loaded(public.path(request.param), public.PATTERN)
    return codec, library(codec)


def digests(ids, raw):
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(raw).hexdigest()


def test_query(spark):
    codec = bpe.loaded(public.path(FILES[0]), public.PATTERN)
    given_library = library(codec)
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = entry.queries()["op12_backtracking_bpe"](spark, SMALL).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == digests(given_library.encode_ordinary(docs[r.doc_id]), docs[r.doc_id].encode())


def test_words_of_tokens_and_bytes(pair):
    codec, other = pair
    rng, tokens = random.Random(2), list(codec.raw.values())
    for k in range(4000):
        word = (
            b"".join(rng.choice(tokens) for _ in range(rng.randint(1, 6))) if k % 3 == 0
            else bytes(rng.randrange(256) for _ in range(rng.randint(1, 30))) if k % 3 == 1
            else rng.choice([b"a", b"ab", b" ", b"-", b"\xc3", b"0", b"ha"]) * rng.randint(1, 200)
        )
        assert codec.word(word) == other._encode_single_piece(word)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]) | st.sampled_from(" \t\n\r'sé1.  "), max_size=60))
def test_any_text(text):
    codec = bpe.loaded(public.path(FILES[0]), public.PATTERN)
    ids = codec.encode(text)
    assert ids == library_of_first.encode_ordinary(text) and codec.decode(ids) == text.encode()
    assert codec.digests(text) == digests(ids, text.encode())


library_of_first = library(bpe.loaded(public.path(FILES[0]), public.PATTERN))


def test_long_texts(pair):
    codec, other = pair
    for text in ("abcdefghij" * 20_000 + "é" * 50_000, "wort " * 300_000, "a b  c\n d " * 60_000, " " * 100_000):
        assert codec.encode(text) == other.encode_ordinary(text)
        assert codec.digests(text)[0] == len(other.encode_ordinary(text))


def test_blocks_are_bounded(pair):
    codec, _ = pair
    assert max(len(units) for text in ("wort " * 300_000, "a  b" * 200_000) for _, units in codec.units(text)) <= 8 * bpe.TOGETHER


def test_small_vocabulary(tmp_path):
    """A token that merges can't reach is found as a whole word only; all words of four letters against plain merges."""
    tokens = [bytes([b]) for b in range(256)] + [b"ab", b"bc", b"abc", b"ca", b"abca", b"bcbc", b"cab"]
    path = tmp_path / "ranks"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" " + str(n).encode() for n, t in enumerate(tokens)))
    codec = bpe.Codec(str(path), public.PATTERN)
    other = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    words = [""]
    for _ in range(8):
        words = [w + c for w in words for c in "abc"]
        for w in words if len(words) < 3000 else random.Random(1).sample(words, 2000):
            assert codec.encode(w) == other.encode_ordinary(w), w


def test_lacking_bytes(tmp_path):
    (tmp_path / "ranks").write_bytes(base64.b64encode(b"a") + b" 0\n")
    with pytest.raises(ValueError, match="single bytes"):
        bpe.Codec(str(tmp_path / "ranks"), public.PATTERN)


def test_frames(spark):
    """Ids and bytes as columns, nulls, repeated rows, an empty table and clashing names."""
    args = public.path(FILES[0]), public.PATTERN
    rows = [(1, None, 7), (2, "", 7), (3, "Déjà vu, 你好 's", 7), (3, "Déjà vu, 你好 's", 7), (None, "x" * 70_000, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = bpe.decoded(bpe.encoded(docs, *args), *args).collect()
    assert len(got) == 5 and all(bytes(r.raw).decode() == (r.text or "") for r in got) and set(got[0].asDict()) == {"doc_id", "text", "ids", "raw"}
    assert [r.ids for r in got] == [library_of_first.encode_ordinary(t or "") for _, t, _ in rows]
    tripped = bpe.round_trip(docs.withColumnRenamed("ids", "n_tokens").withColumn("_made0", bpe.F.lit(1)), *args).collect()
    assert [(r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in tripped] == [digests(library_of_first.encode_ordinary(t or ""), (t or "").encode()) for _, t, _ in rows]
    assert bpe.round_trip(docs.limit(0), *args).count() == 0
    # ids that are no text's, and no ids at all
    odd = spark.createDataFrame([(1, [195]), (2, []), (3, None)], "k int, ids array<int>")
    assert [None if r.raw is None else bytes(r.raw) for r in bpe.decoded(odd, *args).collect()] == [library_of_first.decode_bytes([195]), b"", None]
