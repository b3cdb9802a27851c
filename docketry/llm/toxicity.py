"""Counterfactually regularised toxicity classifier.

A logistic regression over the presence of words.  The words are those whose
document rates differ most between the two labels (a z-score, so noise words
stay out) plus the identity terms.  Labelled texts are cut into sentences; every
sentence that holds an identity term is swapped onto the other terms of its group and the
squared change of its linear score is penalised, which drives the model to give
neutral group mentions no weight of their own.

Training reads a bounded sample of labelled rows (``max_train``, in the order
of a hash of the id, so it is the same at every run); scoring covers every
whole text, of any length.  Both read words with :func:`distinct_words`.  The model is a
few hundred weights, which travel in the closure.

Defined cases: null and empty texts get the score of a text without any known
word; null labels and rows whose label table entries disagree count as toxic if
any entry says so; null ids are never learnt from and are scored like others;
with one label only the score is the smoothed rate of label 1, and with no labels
it is 0; words that tie in their z-score are taken in code point order; rows repeated are
learnt from and scored each; an empty table gives an empty result; other columns are ignored, and
:func:`drop_toxic` hands them through untouched.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.session import ship_package

# Terms that may stand for each other in a sentence, by kind of group.
IDENTITY_GROUPS: tuple[tuple[str, ...], ...] = (
    ("people", "women", "men", "girls", "boys", "transgender", "nonbinary"),
    ("person", "woman", "man", "girl", "boy"),
    ("believers", "muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "atheists"),
    ("religious", "muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "atheist"),
    ("straight", "gay", "lesbian", "bisexual", "queer", "heterosexual", "homosexual"),
    ("white", "black", "asian", "latino", "hispanic", "indigenous", "african", "european"),
    ("young", "old", "elderly", "disabled", "blind", "deaf"),
    ("menschen", "frauen", "männer", "muslime", "christen", "juden"),
    ("personnes", "femmes", "hommes", "musulmans", "chrétiens", "juifs"),
    ("personas", "mujeres", "hombres", "musulmanes", "cristianos", "judíos"),
)

_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[^.!?\n]+")
_TERMS = frozenset(w for group in IDENTITY_GROUPS for w in group)

LONG = 2_000_000


def distinct_words(text: str) -> set[str]:
    """The lower-cased words of a text; of a long one without a list of them all."""
    low = text.lower()
    return set(_WORD.findall(low)) if len(low) <= LONG else {m.group() for m in _WORD.finditer(low)}


@dataclass(frozen=True)
class ToxicityModel:
    bias: float
    weights: dict[str, float] = field(default_factory=dict)

    def score(self, text: str | None) -> float:
        z = self.bias
        if text and self.weights:
            for word in self.weights.keys() & distinct_words(text):
                z += self.weights[word]
        return 0.0 if z == -math.inf else 1.0 / (1.0 + math.exp(-max(-700.0, min(700.0, z))))


def mentions(text: str) -> list[list[str]]:
    """The identity terms of each sentence that has any."""
    low = text.lower()
    if not any(w in low for w in _TERMS):
        return []
    held = (_TERMS.intersection(_WORD.findall(m.group())) for m in _SENTENCE.finditer(low))
    return [sorted(h) for h in held if h]


def train_rows(
    docs: DataFrame, labels: DataFrame, max_train: int, id_col: str = "doc_id", folds: int = 5
) -> DataFrame:
    """(words, mentions, toxic) of at most ``max_train`` labelled ids outside the held-out fold."""
    chosen = (
        labels.select(F.col(id_col).alias("i"), (F.col("toxic") == 1).cast("int").alias("toxic"))
        .where(F.crc32(F.col("i").cast("string").cast("binary")) % folds != 0)
        .where("toxic IS NOT NULL")
        .groupBy("i")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("i"), "i")
        .limit(max_train)
    )
    # Bounded by max_train rows of two numbers, whatever the size of the tables.
    rows = docs.select(F.col(id_col).alias("i"), F.coalesce("text", F.lit("")).alias("t")).join(F.broadcast(chosen), "i")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(
                {
                    "words": [sorted(distinct_words(t)) for t in batch["t"]],
                    "mentions": [mentions(t) for t in batch["t"]],
                    "toxic": batch["toxic"].to_numpy(),
                }
            )

    return rows.select("t", "toxic").mapInPandas(run, "words array<string>, mentions array<array<string>>, toxic int")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    max_train: int = 12_000,
    max_words: int = 512,
    least_z: float = 3.5,
    ridge: float = 1e-4,
    counterfactual: float = 1.0,
    steps: int = 50,
) -> ToxicityModel:
    """Train on the driver from counts and presence vectors made by Spark.

    What reaches the driver is bounded by ``max_train`` rows of at most
    ``max_words`` words, and a count for each pair of an identity term and the terms beside it.
    """
    ship_package(docs.sparkSession)
    rows = train_rows(docs, labels, max_train).persist()
    try:
        sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
        pos, neg = sizes.get(1, 0), sum(n for k, n in sizes.items() if k != 1)
        if not pos + neg:
            return ToxicityModel(-math.inf)
        if not pos or not neg:
            rate = (pos + 1) / (pos + neg + 2)
            return ToxicityModel(math.log(rate / (1 - rate)))
        a, b = F.col("a") / pos, F.col("b") / neg
        pooled = (F.col("a") + F.col("b") + 1.0) / (pos + neg + 2.0)
        z = F.abs(a - b) / F.sqrt(pooled * (1 - pooled) * (1.0 / pos + 1.0 / neg))
        counted = (
            rows.select(F.explode("words").alias("w"), "toxic")
            .groupBy("w")
            .agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
            .where((F.col("a") + F.col("b") >= 3) & (F.length("w") <= 64))
            .select("w", z.alias("z"))
            .where(F.col("z") >= least_z)
            .orderBy(F.desc("z"), "w")
            .limit(max_words)
        )
        vocabulary = [r["w"] for r in counted.collect()]
        for group in IDENTITY_GROUPS:
            vocabulary += [w for w in group if w not in vocabulary]
        known = F.array(*[F.lit(w) for w in vocabulary])
        held = rows.select(F.array_intersect("words", known).alias("words"), "toxic").collect()
        # Sentences with the same terms swap alike; their number is what counts.
        said = rows.select(F.explode("mentions").alias("terms")).groupBy("terms").agg(F.count("*").alias("n")).collect()
    finally:
        rows.unpersist()
    sentences = sorted((tuple(r["terms"]), r["n"]) for r in said)
    return fit_local([r["words"] for r in held], [r["toxic"] for r in held], vocabulary, sentences, ridge, counterfactual, steps)


def swap_penalty(sentences: list[tuple[tuple[str, ...], int]], at: dict[str, int]) -> np.ndarray:
    """Mean of d d' over the swaps of each identity term of a sentence, d the change of its features.

    ``sentences`` are the identity terms of each, and how many there are.
    """
    size = len(at)
    out, swaps = np.zeros((size, size)), 0
    for terms, n in sentences:
        present = set(terms)
        for group in IDENTITY_GROUPS:
            for old in present.intersection(group):
                for new in group:
                    if new not in present and old in at and new in at:
                        i, j = at[old], at[new]
                        out[i, i] += n
                        out[j, j] += n
                        out[i, j] -= n
                        out[j, i] -= n
                        swaps += n
    return out / max(swaps, 1)


def fit_local(
    texts: list[list[str]],
    toxic: list[int],
    vocabulary: list[str],
    sentences: list[tuple[tuple[str, ...], int]],
    ridge: float = 1e-4,
    counterfactual: float = 1.0,
    steps: int = 50,
) -> ToxicityModel:
    """Newton's method on mean log-loss + ridge + counterfactual penalty."""
    at = {w: i for i, w in enumerate(vocabulary)}
    x = np.zeros((len(texts), len(at) + 1))
    x[:, -1] = 1  # the bias, neither penalised nor swapped
    for row, words in enumerate(texts):
        x[row, [at[w] for w in words if w in at]] = 1
    y = np.asarray(toxic, dtype=np.float64)
    shrink = np.zeros((len(at) + 1, len(at) + 1))
    shrink[:-1, :-1] = ridge * np.eye(len(at)) + 2 * counterfactual * swap_penalty(sentences, at)
    shrink[-1, -1] = 1e-9
    w = np.zeros(len(at) + 1)

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.mean(np.logaddexp(0, z) - y * z) + w @ shrink @ w / 2)

    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        slope = x.T @ (p - y) / len(y) + shrink @ w
        bend = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x / len(y) + shrink
        move, rate, now = np.linalg.solve(bend, slope), 1.0, loss(w)
        while rate > 1e-4 and loss(w - rate * move) > now:
            rate /= 2
        w = w - rate * move
        if rate * np.abs(move).max() < 1e-6:
            break
    return ToxicityModel(float(w[-1]), {t: float(v) for t, v in zip(vocabulary, w, strict=False) if v})


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", folds: int = 5) -> DataFrame:
    """One row per document: id, held_out, score and predicted."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = pd.DataFrame({"i": batch["i"], "score": [model.score(t) for t in batch["t"]]})
            yield made

    out = docs.select(F.col(id_col).cast("string").alias("i"), F.col("text").alias("t")).mapInPandas(
        run, "i string, score double"
    )
    held = F.crc32(F.col("i").cast("binary")) % folds == 0
    return out.select(
        F.col("i").cast("bigint").alias("doc_id"),
        F.coalesce(held, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """The documents scored under ``threshold``, all columns kept."""
    ship_package(docs.sparkSession)

    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) < threshold for t in texts], dtype=bool)

    return docs.where(clean(F.col("text")))
