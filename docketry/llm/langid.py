"""Hierarchical language identification.

First the family: one linear support vector machine per family, the largest
margin wins.  Then, inside the family, one-versus-one linear support vector
machines separate each pair of languages and the votes decide (ties: summed
margins, then name).  Features are relative frequencies of hashed byte trigrams
of the lower-cased text, with digits and ASCII punctuation read as blanks.

A model is linear in the mean of per-position features, so a text of any length
is scored by summing table look-ups over its positions: whole texts, one pass,
nothing per document but a few sums.

Training reads at most ``rows_per_lang`` documents of every language, chosen by a
hash of the id.  The driver holds one family's at a time; the families' own
machines learn from at most about ``max_rows`` of all, the same of each language.

Defined cases: null texts and texts without a letter give ``und`` with score 0;
null ids are scored, never learnt from; with no trained language every text is
``und``; with one language that one is given; rows repeated are scored each;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docketry.session import ship_package, write_shared

# Language families by ISO 639-1 code; a code not listed is its own family.
FAMILIES: dict[str, str] = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic",
    "no": "germanic", "nb": "germanic", "nn": "germanic", "is": "germanic", "af": "germanic",
    "fr": "romance", "es": "romance", "pt": "romance", "it": "romance", "ca": "romance",
    "gl": "romance", "ro": "romance", "oc": "romance",
    "ru": "slavic", "uk": "slavic", "be": "slavic", "pl": "slavic", "cs": "slavic", "sk": "slavic",
    "bg": "slavic", "sr": "slavic", "hr": "slavic", "bs": "slavic", "sl": "slavic", "mk": "slavic",
    "fi": "uralic", "et": "uralic", "hu": "uralic",
    "tr": "turkic", "az": "turkic", "kk": "turkic", "uz": "turkic",
    "id": "malayic", "ms": "malayic",
    "hi": "indic", "ur": "indic", "bn": "indic", "mr": "indic", "ne": "indic",
}

BITS = 12
SIZE = 1 << BITS

_BYTE = np.arange(256, dtype=np.uint8)
_BYTE[:128] = [c if 97 <= c <= 122 else 32 for c in range(128)]
_HASH = np.uint32(2654435761)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def positions(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature of every trigram of every text; text of each; first place of each text."""
    raw = [b" " + t.lower().encode("utf-8", "replace") + b"  " for t in texts]
    starts = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum([len(r) for r in raw], out=starts[1:])
    b = _BYTE[np.frombuffer(b"".join(raw), dtype=np.uint8)]
    n = len(b) - 2
    blank = b == 32
    use = ~(blank[1:-1] & (blank[:-2] | blank[2:]))
    use[np.minimum(starts[1:] - 2, n - 1)] = False
    use[np.minimum(starts[1:] - 1, n - 1)] = False
    at = np.flatnonzero(use)
    code = b[at].astype(np.uint32) << 16 | b[at + 1].astype(np.uint32) << 8 | b[at + 2]
    return (code * _HASH) >> np.uint32(32 - BITS), at, starts


def pieces(texts: list[str | None], size: int = 1_000_000) -> Iterator[list[tuple[int, str]]]:
    """(text number, part of the text) in lots of about ``size`` characters.

    Parts of a long text overlap by the two characters its trigrams need.
    """
    lot, held = [], 0
    for n, text in enumerate(texts):
        if not text:
            continue
        for at in range(0, len(text), size):
            part = text[max(0, at - 2) : at + size]
            lot.append((n, part))
            held += len(part)
            if held >= size:
                yield lot
                lot, held = [], 0
    if lot:
        yield lot


def mean_features(texts: list[str]) -> np.ndarray:
    x = np.zeros((len(texts), SIZE), dtype=np.float32)
    for lot in pieces(texts):
        h, at, starts = positions([t for _, t in lot])
        part = np.searchsorted(starts, at, side="right") - 1
        sums = np.bincount(part * SIZE + h, minlength=len(lot) * SIZE).reshape(len(lot), SIZE)
        np.add.at(x, [n for n, _ in lot], sums.astype(np.float32))
    return x / np.maximum(x.sum(1, keepdims=True), 1)


def svm(x: np.ndarray, y: np.ndarray, steps: int = 300, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Squared-hinge linear machine by accelerated gradient descent; y is +-1.

    Columns are scaled to unit deviation for the descent and scaled back after;
    classes weigh the same whatever their sizes.
    """
    scale = 1 / (x.std(0) + 1e-4)
    mid = x.mean(0)
    z = (x - mid) * scale
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    ridge = max(ridge, 1e-6)
    # Largest curvature by power iteration.
    v = np.ones(z.shape[1], dtype=np.float32)
    top = 1.0
    for _ in range(12):
        v = z.T @ (weight * (z @ v))
        top = float(np.linalg.norm(v)) or 1.0
        v /= top
    rate = 1 / (2 * (top + 1) + ridge)
    w, b = np.zeros(z.shape[1], dtype=np.float32), 0.0
    pw, pb = w, b
    for k in range(steps):
        m = k / (k + 3)
        yw, yb = w + m * (w - pw), b + m * (b - pb)
        slack = np.maximum(0, 1 - y * (z @ yw + yb)) * y * weight
        pw, pb = w, b
        w = yw - rate * (-2 * (z.T @ slack) + ridge * yw)
        b = yb - rate * (-2 * float(slack.sum()))
    w = w * scale
    return w.astype(np.float64), float(b - mid @ w)


@dataclass(frozen=True)
class LanguageModel:
    families: tuple[str, ...]
    members: tuple[tuple[str, ...], ...]
    pairs: tuple[tuple[str, str], ...]
    table: np.ndarray  # SIZE x (families + pairs)
    bias: np.ndarray

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
        rows = [i for i, t in enumerate(texts) if self.families and has_letter(t)]
        if not rows:
            return out
        count = np.zeros(len(rows))
        total = np.zeros((len(rows), self.table.shape[1]))
        for lot in pieces([texts[i] for i in rows]):
            h, at, starts = positions([t for _, t in lot])
            part = np.searchsorted(starts, at, side="right") - 1
            numbers = [n for n, _ in lot]
            np.add.at(count, numbers, np.bincount(part, minlength=len(lot)))
            sums = np.stack([np.bincount(part, c[h], minlength=len(lot)) for c in self.table.T], 1)
            np.add.at(total, numbers, sums)
        margin = total / np.maximum(count, 1)[:, None] + self.bias
        many = len(self.families)
        for i, m in zip(rows, margin, strict=True):
            first = int(np.argmax(m[:many])) if many > 1 else 0
            sure = float(1 / (1 + np.exp(-4 * m[first]))) if many > 1 else 1.0
            langs = self.members[first]
            votes = {lang: [0, 0.0] for lang in langs}
            for (a, b), v in zip(self.pairs, m[many:], strict=True):
                if a in votes:
                    votes[a if v >= 0 else b][0] += 1
                    votes[a][1] += v
                    votes[b][1] -= v
            lang = min(langs, key=lambda c: (-votes[c][0], -votes[c][1], c))
            if len(langs) > 1:
                sure *= float(1 / (1 + np.exp(-4 * votes[lang][1] / (len(langs) - 1))))
            out[i] = (lang, sure)
        return out


def fit_family(langs: list[str], x: np.ndarray) -> list[tuple[tuple[str, str], np.ndarray, float]]:
    """A machine for each pair of the languages of one family."""
    names = sorted(set(langs))
    of = np.array(langs, dtype=object)
    made = []
    for i, a in enumerate(names):
        for c in names[i + 1 :]:
            keep = (of == a) | (of == c)
            made.append(((a, c), *svm(x[keep], np.where(of[keep] == a, 1.0, -1.0).astype(np.float32))))
    return made


def family_of(lang: str) -> str:
    return FAMILIES.get(lang, lang)


def fit_tops(langs: list[str], x: np.ndarray) -> list[tuple[str, np.ndarray, float]]:
    """A machine for each family against the rest."""
    of = np.array([family_of(c) for c in langs], dtype=object)
    families = sorted(set(of))
    if len(families) < 2:
        return [(f, np.zeros(SIZE), 0.0) for f in families]
    return [(f, *svm(x, np.where(of == f, 1.0, -1.0).astype(np.float32))) for f in families]


def assembled(langs: list[str], tops: list[tuple], inner: list[tuple]) -> LanguageModel:
    families = tuple(f for f, _, _ in tops)
    members = tuple(tuple(c for c in sorted(set(langs)) if family_of(c) == f) for f in families)
    machines = [*tops, *inner]
    table = np.stack([w for _, w, _ in machines], 1) if machines else np.zeros((SIZE, 0))
    return LanguageModel(families, members, tuple(p for p, _, _ in inner), table, np.array([b for _, _, b in machines]))


def fit(docs: DataFrame, rows_per_lang: int = 600, max_rows: int = 4800, id_col: str = "doc_id", folds: int = 5) -> LanguageModel:
    """Train on the driver from feature rows made by Spark, every language outside the held-out fold."""
    spark = docs.sparkSession
    ship_package(spark)
    learn = docs.select(F.col(id_col).alias("i"), "lang", F.col("text").alias("t")).where(
        (F.crc32(F.col("i").cast("string").cast("binary")) % folds != 0) & F.col("lang").isNotNull()
    )
    seen = learn.groupBy("lang").count().collect()
    # A share of the hashes that holds about three times the rows wanted comes
    # first, so the exact choice below sees few rows of even the largest language.
    shares = [(r["lang"], int(min(1.0, (3 * rows_per_lang + 100) / r["count"]) * (1 << 20))) for r in seen]
    near = F.broadcast(spark.createDataFrame(shares, "lang string, below int"))
    spot = F.pmod(F.xxhash64("i"), F.lit(1 << 20))
    order = Window.partitionBy("lang").orderBy(spot, "i")
    chosen = (
        learn.select("i", "lang")
        .join(near, "lang")
        .where(spot < F.col("below"))
        .withColumn("k", F.row_number().over(order))
        .where(F.col("k") <= rows_per_lang)
        .groupBy("i", "lang")
        .agg(F.min("k").alias("k"))
    )
    # At most rows_per_lang rows of an id and a code for each language; repeats of one pair are one row.
    rows = learn.join(F.broadcast(chosen), ["i", "lang"]).where(F.length("t") > 0)
    rows = rows.groupBy("i", "lang").agg(F.min("k").alias("k"), F.min("t").alias("t")).select("lang", "k", "t")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 200):
                part = batch.iloc[at : at + 200]
                x = mean_features(list(part["t"]))
                made = [r.astype(np.float16).tobytes() for r in x]
                yield pd.DataFrame({"lang": part["lang"].to_numpy(), "k": part["k"].to_numpy(), "x": made})

    features = write_shared(rows.mapInPandas(run, "lang string, k int, x binary"), "language-rows")

    def held(part: DataFrame) -> tuple[list[str], np.ndarray]:
        found = sorted(part.select("lang", "x").collect(), key=lambda r: (r["lang"], bytes(r["x"])))
        x = np.stack([np.frombuffer(r["x"], dtype=np.float16) for r in found]).astype(np.float32) if found else np.zeros((0, SIZE))
        return [r["lang"] for r in found], x

    langs = sorted(r["lang"] for r in features.select("lang").distinct().collect())
    each = max(1, max_rows // max(1, len(langs)))
    lead = Window.partitionBy("lang").orderBy("k", "x")
    first = features if each >= rows_per_lang else features.withColumn("k", F.row_number().over(lead)).where(F.col("k") <= each)
    tops = fit_tops(*held(first))
    inner: list[tuple] = []
    for f, _, _ in tops:
        own = [c for c in langs if family_of(c) == f]
        if len(own) > 1:
            inner += fit_family(*held(features.where(F.col("lang").isin(own))))
    return assembled(langs, tops, inner)


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", folds: int = 5) -> DataFrame:
    """One row per document: id, held_out, lang_pred and score."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = model.predict(list(batch["t"]))
            yield pd.DataFrame({"i": batch["i"].to_numpy(), "lang_pred": [m[0] for m in made], "score": [m[1] for m in made]})

    out = docs.select(F.col(id_col).cast("string").alias("i"), F.col("text").alias("t")).mapInPandas(
        run, "i string, lang_pred string, score double"
    )
    held = F.crc32(F.col("i").cast("binary")) % folds == 0
    return out.select(
        F.col("i").cast("bigint").alias("doc_id"), F.coalesce(held, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )
