"""Report sinks: tab-separated and JSON lines in folders, Markdown for small tables.

The folder sinks write where the rows are, one part a partition, or one ordered part for
reports that people read.  A null is an empty field; tabs and line breaks in
a value become blanks, so that a row stays a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _flat(df: DataFrame) -> DataFrame:
    """Every column as text."""
    text = lambda c: F.to_json(c) if df.schema[c].dataType.typeName() in ("array", "map", "struct") else F.col(c).cast("string")
    return df.select(*[F.regexp_replace(text(c), r"[\t\r\n]+", " ").alias(c) for c in df.columns])


def _ordered(df: DataFrame, order: list[Column] | None) -> DataFrame:
    return df.orderBy(*order).coalesce(1) if order else df


def write_tsv(df: DataFrame, path: str, order: list[Column] | None = None) -> None:
    """Tab-separated with a header; with ``order`` one sorted part."""
    rows = _flat(_ordered(df, order))
    rows.write.mode("overwrite").option("sep", "\t").option("header", "true").option("quote", "").option("nullValue", "").option("emptyValue", "").csv(path)


def write_json(df: DataFrame, path: str, order: list[Column] | None = None) -> None:
    """One JSON object a line, nulls kept."""
    _ordered(df, order).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def markdown(df: DataFrame, order: list[Column], most: int = 200) -> str:
    """The first ``most`` rows as a Markdown table, and a line that says how many more there are."""
    flat = _flat(df.orderBy(*order).limit(most + 1))
    rows = [["" if v is None else v.replace("|", "\\|") for v in r] for r in flat.collect()]
    lines = [df.columns, ["-"] * len(df.columns), *rows[:most]]
    out = "\n".join("|" + "|".join(r) + "|" for r in lines) + "\n"
    return out if len(rows) <= most else f"{out}\n{df.count() - most} more rows\n"
