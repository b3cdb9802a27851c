"""Archive folders, manifests and JSON folders."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from docketry.functions.text import normalize_symbol


def file_format(content: Column) -> Column:
    """docx, doc, wpd, pdf, html or unknown by the first bytes."""
    head = F.hex(F.substring(content, 1, 8))
    text = F.lower(F.decode(F.substring(content, 1, 512), "ISO-8859-1"))
    return (
        F.when(head.startswith("504B0304"), "docx")
        .when(head.startswith("D0CF11E0A1B11AE1"), "doc")
        .when(head.startswith("FF575043"), "wpd")
        .when(head.startswith("255044462D"), "pdf")
        .when(F.ltrim(text).startswith("<") | text.contains("<html"), "html")
        .otherwise("unknown")
    )


def archive(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, size, sha256, format and content of every file."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256"), file_format(F.col("content")).alias("format"), "content")


def manifest(spark: SparkSession, path: str, trailing_comments: bool = False, ordered: bool = False) -> DataFrame:
    """Distinct symbols of a list, one a line.  An empty list means no targets, never all.

    Lines that start with ``#`` are comments; ``trailing_comments`` cuts lines at one too.
    ``ordered`` adds ``ordinal``, the place of first mention.
    """
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("n", "line"))
    text = F.regexp_replace("line", r"\s+#.*$", "") if trailing_comments else F.col("line")
    rows = lines.where(~F.ltrim("line").startswith("#")).select("n", normalize_symbol(text).alias("symbol")).where("symbol != ''")
    once = rows.groupBy("symbol").agg(F.min("n").alias("first"))
    return once.select("symbol", F.row_number().over(Window.orderBy("first")).alias("ordinal")) if ordered else once.select("symbol")


def json_folder(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Every JSON document of a folder but hidden ones (names with ``_`` or ``.`` in front are skipped)."""
    reader = spark.read.option("multiLine", "true").option("pathGlobFilter", "*.json")
    return (reader.schema(schema) if schema else reader).json(path)


def chosen(rows: DataFrame, targets: DataFrame) -> DataFrame:
    return rows.join(targets.select("symbol"), "symbol", "left_semi")


def symbols_of(text: str) -> list[str]:
    """The symbols of a list's text on the driver, first mentions in order."""
    found = (re.sub(r"\s", "", line).upper() for line in text.splitlines() if not line.lstrip().startswith("#"))
    return list(dict.fromkeys(s for s in found if s))


def readable(*readers: Callable[[], DataFrame]) -> DataFrame | None:
    """The first source whose schema can be read; None where none can, so that what needs it is left out."""
    for read in readers:
        try:
            return read()
        except AnalysisException:
            continue
    return None
