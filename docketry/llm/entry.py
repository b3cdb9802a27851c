"""Queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docketry.llm import decontaminate, langid, licenses, multi_index, ngram_join, oracles, packing, pii, revisits, secret_scan, toxicity
from docketry.session import table


def op1_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.search(table(spark, sf_dir, "embeddings"))


def op2_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revisits.digest(revisits.resolve(revisits.captures(table(spark, sf_dir, "pages"))))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.find(table(spark, sf_dir, "documents")))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    )


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"), k=4, percent=85)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_multi_index": op1_multi_index,
    "op2_revisits": op2_revisits,
    "op3_pii": op3_pii,
    "op4_decontamination": op4_decontamination,
    "op5_secrets": op5_secrets,
    "op6_toxicity": op6_toxicity,
    "op7_language": op7_language,
    "op8_licenses": op8_licenses,
    "op9_packing": op9_packing,
    "op10_ngram_join": op10_ngram_join,
}

ORACLES: dict[str, str] = {
    "op2_revisits": oracles.revisits_sql(),
    "op3_pii": oracles.pii_sql(),
    "op5_secrets": oracles.secrets_sql(),
}
