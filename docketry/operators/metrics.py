"""Versioned text metrics: the token stream of a document, its counts and its hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.functions.text import metric_tokens, squeeze

INCLUDED = ("title", "opening", "heading", "paragraph", "table")
VERSION = "metric-1"


def text_metrics(elements: DataFrame, fold: bool = True) -> DataFrame:
    """doc, token_text, word_count, character_count, element_count, content_sha256.

    Elements count even when empty; a document without tokens has a null hash.  One
    exchange on the document; its elements are put in order within the group.
    """
    part = elements.where(F.col("type").isin(*INCLUDED)).select(
        "doc", "position", metric_tokens(F.col("text"), fold).alias("tokens"), F.length(squeeze(F.coalesce("text", F.lit("")))).alias("chars")
    )
    grouped = part.groupBy("doc").agg(
        F.array_sort(F.collect_list(F.struct("position", "tokens"))).alias("e"),
        F.sum(F.size("tokens")).alias("word_count"), F.sum("chars").alias("character_count"), F.count("*").alias("element_count"),
    )
    stream = F.array_join(F.flatten(F.transform("e", lambda x: x["tokens"])), " ")
    return grouped.select(
        "doc", stream.alias("token_text"), "word_count", "character_count", "element_count",
        F.when(F.col("word_count") > 0, F.sha2(stream, 256)).alias("content_sha256"), F.lit(VERSION).alias("metric_version"),
    )
