"""Sequence packing by Karmarkar-Karp multiway differencing.

Documents are tokenised, cut at window capacity, and the remainders are dealt
into windows by largest differencing: every partial partition is an m-tuple of
window loads, the two tuples with the largest spread are merged so that the
heaviest window of one meets the lightest of the other, and the last tuple
gives near-equal windows.  Whole windows of a long document stay alone.

Work is done shard by shard inside each input partition (a shard is a bounded
run of remainders), so there is no shuffle, no driver state, and a lost
executor only repeats its own partitions.  Sequence ids are
``partition << 33 | running number``: unique, and the same on every retry.

Capacity: the differencing starts with the least number of windows that could hold
a shard; whenever a window exceeds the capacity, the number rises and the differencing
is repeated.  Remainders that fit badly (all of two thirds of a window, say) would
raise it without end in sight, so where it passes ``slack`` over the least number the
longest remainders are cut in two and it starts again.

Ids are those of the vocabulary's JSON form without further settings, so the
marker of an added token (``ADDED``) in a text is that token's one id.

Defined cases: null and empty texts are the end id alone; repeated rows and
null ids are packed like any others; an empty table gives an empty result;
columns other than the id and the text are ignored.
"""

from __future__ import annotations

import base64
import functools
import heapq
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.session import ship_package

SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)


def difference(sizes: list[int], windows: int) -> list[list[int]]:
    """Karmarkar-Karp: deal items 0..n-1 of ``sizes`` into ``windows`` lists.

    Tuples hold only their loaded windows, heaviest first, with loads relative
    to their lightest window; the absent windows have load 0.
    """
    if windows == 1:
        return [list(range(len(sizes)))]
    heap: list[tuple[int, int, list[tuple[int, list[int]]]]] = [
        (-s, i, [(s, [i])]) for i, s in enumerate(sizes)
    ]
    heapq.heapify(heap)
    tick = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        overlap = len(a) + len(b) - windows
        if overlap <= 0:
            merged = a + b
        else:  # the lightest loads of a meet the lightest of b in reverse
            keep_a, low_a = a[: len(a) - overlap], a[len(a) - overlap :]
            keep_b, low_b = b[: len(b) - overlap], b[len(b) - overlap :]
            # In full tuples a's k-th heaviest faces b's k-th lightest.
            merged = keep_a + keep_b
            for (la, xa), (lb, xb) in zip(low_a, reversed(low_b), strict=True):
                xa.extend(xb)
                merged.append((la + lb, xa))
        merged.sort(key=lambda w: -w[0])
        if len(merged) == windows:
            least = merged[-1][0]
            if least:
                merged = [(load - least, x) for load, x in merged]
        heapq.heappush(heap, (-merged[0][0], tick, merged))
        tick += 1
    loads = heap[0][2] if heap else []
    return [x for _, x in loads] + [[] for _ in range(windows - len(loads))]


def windows_of(sizes: list[int], capacity: int, most: int) -> list[list[int]] | None:
    """The differencing with the first number of windows, of ``most`` at most, that holds every load."""
    total = sum(sizes)
    windows = -(-total // capacity)
    while windows <= most:
        dealt = difference(sizes, windows)
        top = max(sum(sizes[i] for i in w) for w in dealt)
        if top <= capacity:
            return dealt
        # The loads are as far apart at the next number; their mean must make room for that.
        room = capacity - (top - total / windows)
        windows = max(windows + 1, math.ceil(total / room) if room > 0 else 0)
    return None


def pack_shard(sizes: list[int], capacity: int, slack: float = 0.05) -> list[list[tuple[int, int, int]]]:
    """Windows of ``(item, from, length)``; every item of at most ``capacity``."""
    total = sum(sizes)
    if not total:
        return []
    least = -(-total // capacity)
    most = max(least + 1, int(least * (1 + slack)))
    pieces = [(i, 0, n) for i, n in enumerate(sizes) if n]
    while (dealt := windows_of([n for _, _, n in pieces], capacity, most)) is None:
        half = (max(n for _, _, n in pieces) + 1) // 2
        pieces = [
            p
            for i, at, n in pieces
            for p in ([(i, at, (n + 1) // 2), (i, at + (n + 1) // 2, n // 2)] if n > half else [(i, at, n)])
        ]
    return [sorted((pieces[k] for k in w), key=lambda p: (-p[2], p)) for w in dealt if w]


#: The vocabulary's added tokens; its rank file does not hold them.
ADDED = {"<|endoftext|>": 50256}


@functools.cache
def _encoding(vocabulary: str, added: bool = False):
    import public_tokenizers
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=ADDED if added else {}
    )


def encode(text: str | None, vocabulary: str, end_id: int, added: bool = False) -> np.ndarray:
    """Ids and the end id; with ``added`` the marker of an added token is that token, else plain text."""
    if not text:
        ids = []
    elif added:
        ids = _encoding(vocabulary, True).encode(text, allowed_special="all")
    else:
        ids = _encoding(vocabulary).encode_ordinary(text)
    ids.append(end_id)
    return np.array(ids, dtype="<u4")


def pack(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = 2048,
    end_id: int = 1,
    shard_pieces: int = 1024,
    slack: float = 0.05,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece of a document; see the module's docstring.

    ``vocabulary`` is the path of the byte-level BPE's rank file, the same on
    every executor.  ``shard_pieces`` bounds the remainders (and with them the
    ids) that a task holds at once.
    """
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base = TaskContext.get().partitionId() << 33
        used = 0
        rest: list[tuple] = []

        def rows(cut_up: list[tuple]) -> pd.DataFrame:
            frame = pd.DataFrame(
                cut_up,
                columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )
            return frame.astype({"doc_id": "Int64"})

        def flush() -> list[tuple]:
            nonlocal used
            made = []
            for window in pack_shard([len(ids) for _, _, ids, _ in rest], capacity, slack):
                offset = 0
                for item, at, n in window:
                    doc, start, ids, total = rest[item]
                    crc = zlib.crc32(ids[at : at + n].tobytes())
                    made.append((doc, start + at, n, crc, total, base | used, offset))
                    offset += n
                used += 1
            rest.clear()
            return made

        for batch in batches:
            made: list[tuple] = []
            for doc, text in zip(batch["i"], batch["t"], strict=True):
                doc = None if doc is None or doc is pd.NA or doc != doc else int(doc)
                ids = encode(text, vocabulary, end_id, added=True)
                full = len(ids) // capacity * capacity
                for at in range(0, full, capacity):
                    crc = zlib.crc32(ids[at : at + capacity].tobytes())
                    made.append((doc, at, capacity, crc, len(ids), base | used, 0))
                    used += 1
                if full < len(ids):
                    rest.append((doc, full, ids[full:].copy(), len(ids)))
                if len(rest) == shard_pieces:
                    made += flush()
            if made:
                yield rows(made)
        if rest:
            yield rows(flush())

    return docs.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t")).mapInPandas(
        run, SCHEMA
    )
