"""Keyed writes over immutable tables.

A table is a DataFrame; every operator returns the table after the write.  The
caller stores it (``replace_table``) or feeds it to the next step.  One exchange on
the key serves both sides; a batch is reduced to one row a key first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def last_per_key(batch: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of every key of a batch."""
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*[c for c in order]))
    return batch.withColumn("__n", n).where("__n = 1").drop("__n")


def upsert(table: DataFrame, batch: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """All columns of the batch's rows replace those of equal key.

    Of several rows of a key in the batch the last counts: the first by ``order``, or, without
    one, the row that is greatest column by column.
    """
    order = order or [F.desc_nulls_last(c) for c in table.columns if c not in keys] or [F.lit(0)]
    once = last_per_key(batch, keys, order)
    return table.join(once.select(*keys), keys, "left_anti").unionByName(once.select(*table.columns))


def partial_upsert(table: DataFrame, batch: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Only ``columns`` of known keys are written (nulls too); unknown keys are inserted.

    A column the table does not have is an error.
    """
    unknown = [c for c in columns if c not in table.columns]
    if unknown:
        raise ValueError(f"no such columns: {unknown}")
    new = batch.select(*keys, *[F.col(c).alias(f"__{c}") for c in columns], F.lit(True).alias("__in"))
    both = table.withColumn("__old", F.lit(True)).join(new, keys, "full_outer")
    return both.select(
        *[
            F.when(F.col("__in"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in table.columns
        ]
    )


def changed_upsert(table: DataFrame, batch: DataFrame, keys: list[str], watch: list[str]) -> DataFrame:
    """(action, batch columns): insert, update or keep, updates only where a watched column differs (null-safe)."""
    old = table.select(*keys, *[F.col(c).alias(f"__{c}") for c in watch], F.lit(True).alias("__old"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in watch])
    action = F.when(F.col("__old").isNull(), "insert").when(same, "keep").otherwise("update")
    return batch.join(old, keys, "left").select(action.alias("action"), *batch.columns)


def counted(events: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Every event with the counter's value after it."""
    window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return events.withColumn("count", F.count("*").over(window))


def replace_groups(table: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """The groups a batch holds are deleted and inserted anew."""
    return table.join(batch.select(*keys).distinct(), keys, "left_anti").unionByName(batch.select(*table.columns))


def prune(table: DataFrame, keep: DataFrame, keys: list[str]) -> DataFrame:
    """Rows without a partner go."""
    return table.join(keep.select(*keys).distinct(), keys, "left_semi")


def retire(table: DataFrame, requested: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of keys that were asked for and not found go."""
    gone = requested.select(*keys).distinct().join(found.select(*keys), keys, "left_anti")
    return table.join(gone, keys, "left_anti")


def advance(table: DataFrame, guard: Column, changes: dict[str, Column]) -> DataFrame:
    """Where the guard holds (not where it is null) columns take new values."""
    held = F.coalesce(guard, F.lit(False))
    return table.withColumns({c: F.when(held, v).otherwise(F.col(c)) for c, v in changes.items()})


def repair(table: DataFrame, fixes: dict[str, Column]) -> DataFrame:
    """Columns mended, and ``changed``: whether any of them differs."""
    mended = table.withColumns({f"__{c}": v for c, v in fixes.items()})
    differs = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"__{c}")) for c in fixes])
    out = mended.withColumn("changed", differs)
    return out.select(*[F.col(f"__{c}").alias(c) if c in fixes else F.col(c) for c in table.columns], "changed")


def delta(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that came since a snapshot."""
    return after.select(*keys).distinct().join(before.select(*keys), keys, "left_anti")


def unseen_content(rows: DataFrame, done: DataFrame, key: str = "symbol", digest: str = "sha256") -> DataFrame:
    """Rows whose content was not processed before under their key."""
    return rows.join(done.select(key, digest).distinct(), [key, digest], "left_anti")


def _store(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = lambda suffix="": jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + suffix)
    return at().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table in a folder, or None; a swap that was broken off is finished first.

    A broken swap leaves no table but the old one beside a complete new one: the
    new one takes its place, or, where it is not complete, the old one again.
    """
    store, at = _store(spark, path)
    if not store.exists(at()):
        if store.exists(at(".old")) and store.exists(at(".next/_SUCCESS")):
            store.rename(at(".next"), at())
        elif store.exists(at(".old")):
            store.rename(at(".old"), at())
        else:
            return None
    return spark.read.parquet(path)


def replace_table(df: DataFrame, path: str) -> None:
    """Write beside the old table, then swap the folders in the same store.

    One writer at a time.  Between the two renames there is no table under the name; the old and
    the new one both stand beside it, and :func:`stored` (which every writer calls first) puts one
    of them in place, so no interruption loses rows.
    """
    spark = df.sparkSession
    stored(spark, path)
    store, at = _store(spark, path)
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}.next")
    store.delete(at(".old"), True)
    if store.exists(at()):
        store.rename(at(), at(".old"))
    if not store.rename(at(".next"), at()):
        raise OSError(f"could not swap {path}")
    store.delete(at(".old"), True)
