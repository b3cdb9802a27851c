"""The processing ledger: target selection, states and volume splitting."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry.functions.text import strip_bracket
from docketry.operators.catalog import latest_per_key
from docketry.operators.sequences import confirmed_ahead, longest_slice, slices

# The states a document passes through, and how each may end.
NEXT: dict[str, tuple[str, ...]] = {
    "fetched": ("converted", "convert_failed", "extracted", "extract_failed", "no_text_layer", "split"),
    "converted": ("extracted", "extract_failed", "split"),
    "extracted": ("parsed", "parse_failed", "split"),
    "parsed": ("parsed", "split"),
    "unavailable": ("fetched", "unavailable", "failed"),
    "failed": ("fetched", "unavailable", "failed"),
    "convert_failed": ("converted", "convert_failed"),
    "extract_failed": ("extracted", "extract_failed"),
    "parse_failed": ("parsed", "parse_failed"),
    "no_text_layer": ("extracted", "no_text_layer"),
}
FAMILIES = r"^(A/RES/|S/RES/|E/RES/|A/HRC/RES/|A/HRC/PRST/|S/PRST/|A/DEC/|E/DEC/)"


def english(languages: Column) -> Column:
    """No language stated, or English among them."""
    return F.coalesce(F.size(languages) == 0, F.lit(True)) | F.array_contains(languages, "eng")


def targets(catalog: DataFrame, ledger: DataFrame, cut: date, before: bool = False) -> DataFrame:
    """The newest row of each wanted symbol that the ledger lacks.

    ``before`` gives the complement by date: undated rows and those before the cut.
    """
    dated = F.col("published").isNull() | (F.col("published") < F.lit(cut)) if before else F.col("published") >= F.lit(cut)
    wanted = catalog.where(F.col("symbol").rlike(FAMILIES) & english(F.col("languages")) & dated)
    once = latest_per_key(wanted, ["symbol"], [F.col("recid").desc()])
    return once.join(ledger.select("symbol"), "symbol", "left_anti")


def collapse_brackets(wanted: DataFrame, ledger: DataFrame) -> DataFrame:
    """Bracketed parts give way to their parent: dropped if it is wanted or held, else promoted once."""
    part = F.col("symbol").contains("[")
    whole = wanted.where(~part).select("symbol")
    held = whole.unionByName(ledger.select("symbol")).distinct()
    promoted = wanted.where(part).select(strip_bracket(F.col("symbol")).alias("symbol")).distinct()
    return whole.unionByName(promoted.join(held, "symbol", "left_anti"))


def recheck(ledger: DataFrame, catalog: DataFrame, today: date, days: int) -> DataFrame:
    """Unavailable documents published in the last days."""
    once = latest_per_key(catalog, ["symbol"], [F.col("recid").desc()]).select("symbol", "published")
    return ledger.where(F.col("status") == "unavailable").join(once, "symbol", "left").where(
        F.col("published") >= F.date_sub(F.lit(today), days)
    )


def source_files(ledger: DataFrame) -> DataFrame:
    """Each row with the file it is read from: a child's is its volume's.

    Only children meet their volumes: rows without one would all have the same, empty key.
    """
    parent = ledger.select(F.col("symbol").alias("source_symbol"), F.col("archive_path").alias("__path"), F.col("sha256").alias("__sha"))
    child = F.col("source_symbol").isNotNull()
    held = ledger.where(child).drop("archive_path", "sha256").join(parent, "source_symbol", "left").withColumnsRenamed({"__path": "archive_path", "__sha": "sha256"})
    return ledger.where(~child).unionByName(held.select(*ledger.columns))


def settle(ledger: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The ledger after parse outcomes (symbol, ok): a failed re-parse keeps what was good."""
    both = ledger.join(outcomes.select("symbol", F.col("ok").alias("__ok")), "symbol", "left")
    status = (
        F.when(F.col("__ok"), "parsed")
        .when((~F.col("__ok")) & (F.col("status") != "parsed"), "parse_failed")
        .otherwise(F.col("status"))
    )
    return both.withColumn("status", status).drop("__ok").select(*ledger.columns)


def status_counts(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("status", "format").agg(F.count("*").alias("n"))


def split_volume(rows: DataFrame, heading: Column, adoption: Column, child_of: Column, reach: int = 8) -> DataFrame:
    """(volume, child, start, n, text rows): slices whose heading is confirmed by an adoption line, the longest of each child.

    ``rows``: doc (the volume), position, text.  A slice ends at any heading, confirmed or not.
    """
    marked = rows.withColumns({"__heading": heading, "__child": F.when(heading, child_of)}).withColumn(
        "__confirmed", F.col("__heading") & confirmed_ahead(rows, adoption, reach)
    )
    cut = slices(marked, F.col("__heading")).withColumnRenamed("child", "slice")
    summary = cut.groupBy("doc", "slice").agg(
        F.max("__child").alias("child"), F.max("__confirmed").alias("confirmed"), F.min("position").alias("start"), F.count("*").alias("n")
    )
    best = longest_slice(summary.where("confirmed AND child IS NOT NULL").withColumnRenamed("doc", "volume"))
    return best.select("volume", "slice", "child", "start", "n")


def route(children: DataFrame, catalog: DataFrame) -> DataFrame:
    """(key, symbol, route): the first candidate symbol the catalogue has; decisions are written, others only checked.

    ``children``: key, candidates (array, in order of preference).
    """
    options = children.select("key", F.posexplode("candidates").alias("k", "symbol"))
    known = options.join(catalog.select("symbol").distinct(), "symbol", "left_semi")
    first = known.groupBy("key").agg(F.min_by("symbol", "k").alias("symbol"))
    found = children.select("key").join(first, "key", "left")
    how = F.when(F.col("symbol").isNull(), "unmatched").when(F.col("symbol").contains("/DEC/"), "write").otherwise("cross_check")
    return found.withColumn("route", how)


def leaks(children: DataFrame) -> DataFrame:
    """Children (child, volume, last) that reach past the next child's heading (start)."""
    following = F.lead("start").over(Window.partitionBy("volume").orderBy("start"))
    return children.withColumn("next_start", following).where(F.col("last") >= F.col("next_start"))
