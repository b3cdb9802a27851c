import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from docketry.llm import packing

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def reference_ids(text):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids + [1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 64), max_size=60))
def test_shard_is_a_partition_within_capacity(sizes):
    seen = {i: [] for i in range(len(sizes))}
    windows = packing.pack_shard(sizes, 64)
    for window in windows:
        assert 0 < sum(n for _, _, n in window) <= 64
        for item, at, n in window:
            seen[item].append((at, n))
    for item, parts in seen.items():
        at = 0
        for start, n in sorted(parts):
            assert start == at
            at += n
        assert at == sizes[item]
    least = -(-sum(sizes) // 64)
    assert len(windows) <= max(least + 1, int(least * 1.05))


def plain_difference(sizes, windows):
    """Karmarkar-Karp on full tuples."""
    parts = [sorted([n] + [0] * (windows - 1), reverse=True) for n in sizes]
    while len(parts) > 1:
        parts.sort(key=lambda t: t[-1] - t[0])
        a, b = parts.pop(0), parts.pop(0)
        parts.append(sorted((x + y for x, y in zip(a, reversed(b), strict=True)), reverse=True))
    return parts[0]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 10**9), min_size=1, max_size=14, unique=True), st.integers(1, 5))
def test_differencing_is_that_of_the_plain_version(sizes, windows):
    # Sizes far apart: without ties both take the same two partitions each time.
    sizes = [n * 31 + i for i, n in enumerate(sizes)]
    loads = sorted((sum(sizes[i] for i in w) for w in packing.difference(sizes, windows)), reverse=True)
    want = plain_difference(sizes, windows)
    assert sum(loads) == sum(want) and loads[0] - loads[-1] == want[0] - want[-1]


def test_window_count_rises():
    assert len(packing.windows_of([3, 3, 3], 5, 9)) == 3 and packing.windows_of([3, 3, 3], 5, 2) is None
    rng = np.random.default_rng(5)
    sizes = rng.integers(1, 2048, 700).tolist()
    made = packing.pack_shard(sizes, 2048)
    assert -(-sum(sizes) // 2048) < len(made) <= 1.05 * -(-sum(sizes) // 2048)
    assert len(packing.pack_shard([1300] * 400, 2048)) <= 1.05 * 254


def test_differencing_is_near_equal():
    sizes = [8, 7, 6, 5, 4]
    loads = sorted(sum(sizes[i] for i in w) for w in packing.difference(sizes, 2))
    assert loads == [14, 16]
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 100, 300).tolist()
    loads = [sum(sizes[i] for i in w) for w in packing.difference(sizes, 20)]
    assert sum(loads) == sum(sizes) and max(loads) - min(loads) <= 3


@pytest.mark.parametrize("text", ["plain words", "é ü 日本 😀 <|endoftext|> \n\n x", "a" * 300, " ", "\u0000퟿"])
def test_ids_are_those_of_the_tokenizer(text):
    assert packing.encode(text, RANKS, 1).tolist() == reference_ids(text)


def test_round_trip(spark):
    long = "of the thing and " * 1500
    rows = [(1, "short text", "x"), (2, None, "y"), (3, "", "z"), (4, long, "a"), (None, "no id", "b"), (1, "short text", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, offset string")
    out = packing.pack(docs, RANKS).collect()
    want = {}
    for doc, text, _ in rows:
        want.setdefault(doc, []).append(reference_ids(text))
    pieces, sequences = {}, {}
    for r in out:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(pieces) == set(want)
    for doc, texts in want.items():
        assert sum(r.length for r in pieces[doc]) == sum(map(len, texts))
        ids = np.array(texts[0], dtype="<u4")
        for r in pieces[doc]:
            assert r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 2048


PLAIN = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
MARKED = ["a <|endoftext|> b", "<|endoftext|><|endoftext|>x", "end <|endoftext|>\n\n  next", "<|endoftext|", "<|ENDOFTEXT|> <|endoftext|> é 日本"]


@pytest.mark.parametrize("text", ["plain words", "", *MARKED])
def test_added_tokens_are_those_of_the_plain_call(text):
    assert packing.encode(text, RANKS, 1, added=True).tolist() == [*PLAIN.encode(text, add_special_tokens=False).ids, 1]


def test_packed_ids_are_those_of_the_plain_call(spark):
    docs = spark.createDataFrame(list(enumerate(MARKED)), "doc_id long, text string")
    out = {r.doc_id: r for r in packing.pack(docs, RANKS).collect()}
    for i, text in enumerate(MARKED):
        ids = np.array([*PLAIN.encode(text, add_special_tokens=False).ids, 1], dtype="<u4")
        assert (out[i].doc_tokens, out[i].ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(docs, RANKS).collect() == []
