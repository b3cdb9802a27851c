"""A training-corpus pipeline of five operators.

Every stage takes (spark, docs, sf_dir), works on all its predecessor kept and
returns a DataFrame that is written as Parquet and read again for the next.  All
but the last return the columns of ``documents``.

1. toxicity: documents the classifier rejects go.
2. near_duplicates: of documents that share 80 in 100 of their distinct runs of
   five words (and of what links through others) the smallest id stays.
3. decontamination: documents that hold a benchmark item go.
4. pii: confirmed personal data is masked in place.
5. packing: what is left is tokenised and dealt into sequences.

Defined cases, for every stage: null and empty texts are clean, hold nothing and
stay (a packed one is its end id alone); texts of any length are read whole; rows
with a null id stay; repeated rows are judged alike, and of rows with one id and one text
one stays; an empty table gives an empty result; further columns, whatever their
names, are handed through as they are (the last stage returns its own).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docketry.llm import decontaminate, ngram_join, packing, pii, toxicity
from docketry.session import table, write_shared


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores under one half; labels come from the table ``labels``."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of every class of near copies; equal ids and texts once."""
    return ngram_join.keep_one(docs, k=5, percent=80)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage that is a benchmark item within its edit budget."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, confirmed personal data replaced by its kind; ``n_chars`` stays that of the source."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row a piece of a document, dealt into sequences of at most 2048 ids; null ids and repeats are packed too."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", clean),
    ("near_duplicates", unique),
    ("decontamination", uncontaminated),
    ("pii", masked),
    ("packing", packed),
]

#: The classifier, the tokeniser and the differencing have no SQL; tests/llm holds
#: the pipeline against a brute-force version instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_shared(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
