"""Structured Streaming forms of the rate counters and of incremental loads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docketry.operators.upserts import last_per_key, replace_table, stored, upsert


def minute_counts(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """(caller, window_start, count) of a stream; state older than the bound is dropped."""
    return (
        events.withWatermark("ts", late).groupBy("caller", F.window("ts", "1 minute").alias("w")).agg(F.count("*").alias("count"))
        .select("caller", F.col("w.start").alias("window_start"), "count")
    )


def read_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 8) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def upsert_stream(
    batches: DataFrame, target: str, keys: list[str], order: list[Column], checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None
) -> StreamingQuery:
    """Every batch is upserted into a table folder, last write wins.

    A batch that is run again writes the same rows, so overlap and retries do no harm.
    """

    def write(batch: DataFrame, _: int) -> None:
        rows = transform(batch) if transform else batch
        old = stored(batch.sparkSession, target)
        replace_table(last_per_key(rows, keys, order) if old is None else upsert(old, rows, keys, order), target)

    return batches.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
