"""Word-shingle sets of whole texts, vectorised over lots of texts.

Words are maximal runs of bytes other than ASCII white space, A-Z lowered.  A
set holds 64-bit hashes of k neighbouring words; a text with fewer words has its
whole sequence as the one element, and a text without words the empty set.
Every hash is a polynomial of the word's bytes, read off one running sum over
the lot, then mixed; two different shingles of a pair of texts share a hash
with odds below 1e-12.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np

LOT = 500_000
_BASE = 0x100000001B3
_INVERSE = pow(_BASE, -1, 1 << 64)

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_SPACE = re.compile(rb"[ \t\n\v\f\r]")
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_KEPT = 1 << 20


def _powers(base: int, n: int) -> np.ndarray:
    """The first n powers; kept for lots of the usual size, made anew for longer words."""
    return _kept_powers(base)[:n] if n <= _KEPT else _made_powers(base, n)


@functools.cache
def _kept_powers(base: int) -> np.ndarray:
    return _made_powers(base, _KEPT)


def _made_powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the number of its text."""
    raw = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    blank = _BLANK[raw]
    edge = np.flatnonzero(np.diff(blank.view(np.int8), prepend=np.int8(1)))
    start, end = edge[::2], edge[1::2]
    running = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((_FOLD[raw].astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(raw)), out=running[1:])
    h = (running[end] - running[start]) * _powers(_INVERSE, len(raw))[start]
    limits = np.cumsum([len(t) + 1 for t in texts])
    return mix(h + (end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), np.searchsorted(limits, start, side="right")


def parts(text: bytes, size: int) -> Iterator[bytes]:
    """A text cut at white space into parts of about ``size`` bytes (longer where a word is)."""
    at = 0
    while at < len(text):
        cut = _SPACE.search(text, at + size)
        end = cut.end() if cut else len(text)
        yield text[at:end]
        at = end


def _sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    if len(texts) == 1 and len(texts[0]) > LOT:  # a long text's words, part by part
        h = np.concatenate([words([part])[0] for part in parts(texts[0], LOT)])
        of = np.zeros(len(h), dtype=np.int64)
    else:
        h, of = words(texts)
    first = np.searchsorted(of, np.arange(len(texts) + 1))
    n = max(0, len(h) - k + 1)
    both = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        both = both * np.uint64(0xD6E8FEB86659FD93) + h[j : j + n]
    both = mix(both)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(both[a : b - k + 1]))
        elif b > a:
            whole = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for x in h[a:b]:
                    whole = whole * np.uint64(0xA0761D6478BD642F) + x
            out.append(mix(np.array([whole], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def shingle_sets(texts: list[str | None], k: int) -> Iterator[np.ndarray]:
    """The sorted shingle set of each text, in order."""
    lot: list[bytes] = []
    held = 0
    for text in texts:
        raw = (text or "").encode("utf-8", "surrogatepass")
        if len(raw) > LOT and lot:
            yield from _sets(lot, k)
            lot, held = [], 0
        lot.append(raw)
        held += len(raw)
        if held >= LOT:
            yield from _sets(lot, k)
            lot, held = [], 0
    if lot:
        yield from _sets(lot, k)


def fingerprint(s: np.ndarray) -> int:
    """Signed 64-bit hash of a set."""
    total = int(s.sum(dtype=np.uint64)) + int(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)) * 3 + len(s)
    return int(mix(np.array([total & (1 << 64) - 1], dtype=np.uint64)).view(np.int64)[0])


def second_print(s: np.ndarray) -> int:
    """A signed 64-bit hash of a set that does not depend on :func:`fingerprint`."""
    total = int(mix(s ^ np.uint64(0xA24BAED4963EE407)).sum(dtype=np.uint64)) + 7 * len(s)
    return int(mix(np.array([(total ^ 0x9FB21C651E98DF25) & (1 << 64) - 1], dtype=np.uint64)).view(np.int64)[0])
