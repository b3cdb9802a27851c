"""Benchmark decontamination by the q-gram lemma.

A benchmark item of m characters that occurs in a text with at most k edits
shares at least m - q + 1 - k*q character q-grams with it, and all of them lie
within k+1 neighbouring diagonals (place in the text minus place in the item).
Shared q-grams are counted in diagonal bands of 2(k+1), one starting every k+1,
so that some band holds them all; a band that meets the bound is verified by a
banded alignment of the whole item against that region.  Nothing is missed
within the budget k = floor(rate * m), lowered for short items until the bound
is at least 1; items shorter than q are found exactly.

Texts and items are compared in lower case with every white-space character
read as a blank.  Positions are code points of the original text.

Scale: one pass over whole texts, no shuffle.  The items travel in blocks of about
``block_chars`` characters and an item more (with the hashes about 16 bytes a character),
one pass over the texts and one broadcast at a time a block; long texts are read in
overlapping pieces, and shared q-grams are counted in lots, however repetitive a text is.

Defined cases: null and empty texts hold nothing; null and blank items match
nothing; items repeated are reported each, rows repeated likewise; of overlapping regions of
an item that tie in edits the first counts; null ids are handed through; empty
tables give empty results; other columns are ignored, and
:func:`drop_contaminated` hands them through.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.session import ship_package, write_shared

RESULT = "doc_id bigint, item_id bigint, start bigint, end bigint, edits int"
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BITS = 22
PIECE = 1_000_000
PAIRS = 4_000_000


def folded(text: str) -> str:
    """Lower case of the same length; white space as blanks."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    return "".join(low.translate(_BLANKS))


_BLANKS = {ord(c): " " for c in "\t\n\v\f\r\x1c\x1d\x1e\x1f\x85\xa0  "}


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def gram_hashes(c: np.ndarray, q: int) -> np.ndarray:
    n = len(c) - q + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    h = np.zeros(n, dtype=np.uint64)
    for j in range(q):
        h *= _MULTIPLIER
        h += c[j : j + n]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h


@dataclass(frozen=True)
class Item:
    item_id: int
    text: str
    codes: np.ndarray
    budget: int
    least: int


class Benchmark:
    """Items and an index from q-gram to (item, place)."""

    def __init__(self, items: list[tuple[int, str]], q: int, rate: float):
        self.q = q
        self.items: list[Item] = []
        self.short: list[Item] = []
        for item_id, text in items:
            text = folded(text or "").strip()
            m = len(text)
            if not m:
                continue
            budget = max(0, min(int(rate * m), (m - q) // q))
            item = Item(item_id, text, codes(text), budget, m - q + 1 - budget * q)
            (self.items if m >= q else self.short).append(item)
        grams = [gram_hashes(i.codes, q) for i in self.items]
        h = np.concatenate(grams) if grams else np.zeros(0, dtype=np.uint64)
        order = np.argsort(h, kind="stable")
        self.item_of = np.repeat(np.arange(len(grams)), [len(g) for g in grams])[order].astype(np.int64)
        self.place_of = (
            np.concatenate([np.arange(len(g)) for g in grams])[order].astype(np.int64) if grams else np.zeros(0, np.int64)
        )
        self.hashes, self.first = np.unique(h[order], return_index=True)
        self.count = np.diff(np.append(self.first, len(h)))
        self.maybe = np.zeros(1 << _BITS, dtype=bool)
        self.maybe[(self.hashes >> np.uint64(64 - _BITS)).astype(np.int64)] = True
        self.step = np.array([i.budget + 1 for i in self.items], dtype=np.int64)
        self.least = np.array([i.least for i in self.items], dtype=np.int64)
        self.longest = max((len(i.text) + 2 * i.budget for i in self.items + self.short), default=0)

    def regions(self, texts: list[str | None]) -> list[list[tuple[int, int, int, int]]]:
        """For each text the (item_id, start, end, edits) of its regions, by start and item."""
        found: list[set] = [set() for _ in texts]
        lot: list[tuple[int, int, str]] = []
        size = 0
        for n, text in enumerate(texts):
            if not text:
                continue
            low = folded(text)
            for at in range(0, max(1, len(low) - self.longest), PIECE):
                piece = low[at : at + PIECE + self.longest]
                lot.append((n, at, piece))
                size += len(piece)
                if size >= PIECE:
                    self._scan(lot, found)
                    lot, size = [], 0
        self._scan(lot, found)
        return [sorted(_apart(f), key=lambda r: (r[1], r[0], r[2])) for f in found]

    def _scan(self, lot: list[tuple[int, int, str]], found: list[set]) -> None:
        for item in self.short:
            for n, base, piece in lot:
                at = piece.find(item.text)
                while at >= 0:
                    found[n].add((item.item_id, base + at, base + at + len(item.text), 0))
                    at = piece.find(item.text, at + 1)
        if not self.items or not lot:
            return
        # A private code point between pieces keeps q-grams inside one piece.
        joined = codes("\U0010ffff".join(p for _, _, p in lot))
        starts = np.zeros(len(lot), dtype=np.int64)
        np.cumsum([len(p) + 1 for _, _, p in lot[:-1]], out=starts[1:])
        h = gram_hashes(joined, self.q)
        at = np.flatnonzero(self.maybe[(h >> np.uint64(64 - _BITS)).astype(np.int64)])
        slot = np.searchsorted(self.hashes, h[at])
        slot[slot == len(self.hashes)] = 0
        real = self.hashes[slot] == h[at]
        at, slot = at[real], slot[real]
        if not len(at):
            return
        many = self.count[slot]
        piece = np.searchsorted(starts, at, side="right") - 1
        # Pieces that cannot reach the least bound of any item go at once.
        reach = np.bincount(piece, many, minlength=len(lot)) >= self.least.min()
        keep = reach[piece]
        at, slot, many, piece = at[keep], slot[keep], many[keep], piece[keep]
        if not len(at):
            return
        lift = max(len(p) for _, _, p in lot) + self.longest + 2
        both, counts = self._bands(at - starts[piece], slot, many, piece, lift)
        of = both // (2 * lift)
        good = counts >= self.least[of % len(self.items)]
        for k in both[good].tolist():
            p, i = divmod(k // (2 * lift), len(self.items))
            n, base, text = lot[p]
            it = self.items[i]
            lo = (k % (2 * lift) - lift) * (it.budget + 1)
            hit = align(it, text, lo, lo + 2 * (it.budget + 1) - 1)
            if hit:
                found[n].add((it.item_id, base + hit[0], base + hit[1], hit[2]))

    def _bands(self, at: np.ndarray, slot: np.ndarray, many: np.ndarray, piece: np.ndarray, lift: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys (piece, item, band) and their counts of shared q-grams, from at most about ``PAIRS`` pairs at a time.

        A repetitive text shares its few q-grams with every place of a repetitive item.
        """
        reach = np.cumsum(many)
        keys, counts = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        a = 0
        while a < len(at):
            b = max(a + 1, int(np.searchsorted(reach, (reach[a - 1] if a else 0) + PAIRS, side="right")))
            m = many[a:b]
            entry = np.repeat(self.first[slot[a:b]] - np.cumsum(m) + m, m) + np.arange(m.sum())
            item = self.item_of[entry]
            low = (np.repeat(at[a:b], m) - self.place_of[entry]) // self.step[item]
            key = (np.repeat(piece[a:b], m) * len(self.items) + item) * (2 * lift) + low + lift
            new, times = np.unique(np.concatenate([key, key - 1]), return_counts=True)
            if a:
                new, where = np.unique(np.concatenate([keys, new]), return_inverse=True)
                times = np.bincount(where, np.concatenate([counts, times])).astype(np.int64)
            keys, counts, a = new, times, b
        return keys, counts


def _apart(regions: set) -> list[tuple[int, int, int, int]]:
    """Of overlapping regions of one item the one with the fewest edits."""
    out: list[tuple[int, int, int, int]] = []
    places: dict[int, tuple[list[int], list[int]]] = {}
    for r in sorted(regions, key=lambda r: (r[0], r[3], r[1], r[2])):
        starts, ends = places.setdefault(r[0], ([], []))  # of what is kept; apart, so both ascend
        k = bisect.bisect_left(starts, r[2])
        if k and ends[k - 1] > r[1]:
            continue
        starts.insert(k, r[1])
        ends.insert(k, r[2])
        out.append(r)
    return out


def align(item: Item, text: str, lo: int, hi: int) -> tuple[int, int, int] | None:
    """Best alignment of the whole item with a part of the text on diagonals lo..hi.

    (start, end, edits) with the fewest edits, then the smallest end, or None
    beyond the budget.
    """
    m = len(item.text)
    at = text.find(item.text, max(0, lo), max(0, hi + m))
    if at >= 0:
        return at, at + m, 0
    if not item.budget:
        return None
    lo, hi = lo - item.budget, hi + item.budget
    end = _last_row(item.codes, codes(text), lo, hi)
    j = int(np.argmin(end))
    edits = int(end[j])
    if edits > item.budget:
        return None
    stop = m + lo + j
    # Backwards from the end the same alignment gives the start.
    head = codes(text[max(0, stop - m - item.budget) : stop])[::-1]
    back = _last_row(item.codes[::-1], head, -item.budget, item.budget, anchored=True)
    length = m - item.budget + int(np.argmin(back))
    return stop - length, stop, edits


def _last_row(item: np.ndarray, text: np.ndarray, lo: int, hi: int, anchored: bool = False) -> np.ndarray:
    """Edits of the item against text ending on each diagonal of the band lo..hi.

    The text's start is free, or fixed at 0 if ``anchored``.
    """
    width = hi - lo + 1
    big = 1 << 20
    step = np.arange(width)
    place = step + lo  # text position before the item's first character
    inside = (place >= 0) & (place <= len(text))
    row = np.where(inside, place if anchored else 0, big)
    padded = np.full(len(item) + width + 1, 0xFFFFFFFF, dtype=np.uint32)
    first, last = max(0, lo), min(len(text), lo + len(padded))
    if last > first:
        padded[first - lo : last - lo] = text[first:last]
    for i, c in enumerate(item):
        same = row + (padded[i : i + width] != c)
        skip = np.append(row[1:], big) + 1
        row = np.minimum(same, skip)
        row = np.minimum.accumulate(row - step) + step
        place = step + lo + i + 1
        row[(place < 0) | (place > len(text))] = big
    return row


def blocks(benchmark: DataFrame, block_chars: int) -> Iterator[tuple[list[tuple[int, str]], bool]]:
    """The items in blocks, and whether a block is the last."""
    lot: list[tuple[int, str]] = []
    size = 0
    for r in benchmark.select("item_id", "text").where("text IS NOT NULL").toLocalIterator():
        if size >= block_chars:
            yield lot, False
            lot, size = [], 0
        lot.append((r["item_id"], r["text"]))
        size += len(r["text"])
    if lot:
        yield lot, True


def find(
    docs: DataFrame, benchmark: DataFrame, q: int = 10, rate: float = 0.07, block_chars: int = 1_000_000, id_col: str = "doc_id"
) -> DataFrame:
    """One row per region of a document that holds a benchmark item within its budget.

    Of several blocks each has its pass written before the next is broadcast, so one is held at a time.
    """
    spark = docs.sparkSession
    ship_package(spark)
    parts = docs.select(F.col(id_col).cast("string").alias("i"), F.col("text").alias("t"))
    out = spark.createDataFrame([], RESULT)
    for block, last in blocks(benchmark, block_chars):
        held = spark.sparkContext.broadcast(Benchmark(block, q, rate))

        def run(batches: Iterator[pd.DataFrame], held=held) -> Iterator[pd.DataFrame]:
            for batch in batches:
                rows = [
                    (i, *r)
                    for i, regions in zip(batch["i"], held.value.regions(list(batch["t"])), strict=True)
                    for r in regions
                ]
                if rows:
                    yield pd.DataFrame(rows, columns=["i", "item_id", "start", "end", "edits"]).astype({"item_id": "Int64"})

        got = parts.mapInPandas(run, "i string, item_id bigint, start bigint, end bigint, edits int")
        got = got.select(F.col("i").cast("bigint").alias("doc_id"), "item_id", "start", "end", "edits")
        if not last:
            got = write_shared(got, "regions")
            held.destroy()
        out = out.unionByName(got)
    return out


def _clean(held):
    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([not r for r in held.value.regions(list(texts))], dtype=bool)

    return clean


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, q: int = 10, rate: float = 0.07, block_chars: int = 1_000_000
) -> DataFrame:
    """The documents without any benchmark item, all columns kept; blocks as in :func:`find`."""
    spark = docs.sparkSession
    ship_package(spark)
    for block, last in blocks(benchmark, block_chars):
        held = spark.sparkContext.broadcast(Benchmark(block, q, rate))
        docs = docs.where(_clean(held)(F.col("text")))
        if not last:
            docs = write_shared(docs, "uncontaminated")
            held.destroy()
    return docs
