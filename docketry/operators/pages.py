"""Page text: columns, marker repair, cropping, and headings as printed.

Input is lines with their places (doc, page, line, x0, x1, y, text), as any page-text
extractor gives them.
"""

from __future__ import annotations

import difflib
import re
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.functions.lexicon import surfaces
from docketry.operators.documents import judged
from docketry.operators.sequences import by_doc
from docketry.session import ship_package

# Glyphs a scanner takes for digits.
CONFUSED = {"l": "1", "I": "1", "|": "1", "O": "0", "o": "0", "S": "5", "B": "8", "Z": "2", "G": "6"}
ORGANS = ("The General Assembly,", "The Security Council,", "The Economic and Social Council,", "The Human Rights Council,", "The Trusteeship Council,")
ENGLISH_STOPS = ("the", "of", "and", "to", "in", "that", "for", "by", "with", "on", "its", "which", "is", "as", "at")
FRENCH_STOPS = ("le", "la", "les", "des", "du", "et", "dans", "que", "une", "pour", "par", "sur", "au", "aux", "de")


def gutter(x0: np.ndarray, x1: np.ndarray, width: float) -> float | None:
    """Place of the gap between two columns of a page, or None.

    The emptiest spot between 35 and 62 hundredths of the width; it must be covered by
    at most six hundredths of the fullest spot, with a fifth of twelve lines or more each side.
    """
    if len(x0) < 12 or width <= 0:
        return None
    bins = 200
    cover = np.zeros(bins + 1)
    np.add.at(cover, np.clip((x0 / width * bins).astype(int), 0, bins), 1)
    np.add.at(cover, np.clip((x1 / width * bins).astype(int), 0, bins), -1)
    cover = np.cumsum(cover)[:bins]
    lo, hi = int(0.35 * bins), int(0.62 * bins)
    at = lo + int(np.argmin(cover[lo:hi]))
    if cover[at] > 0.06 * cover.max():
        return None
    place = (at + 0.5) / bins * width
    left, right = (x1 <= place).mean(), (x0 >= place).mean()
    return float(place) if left >= 0.2 and right >= 0.2 else None


def column_order(lines: DataFrame, width: str = "width") -> DataFrame:
    """Lines with ``column`` (0 or 1) and ``reading``, their order on the page."""

    def judge(*values: list) -> list[dict]:
        x0, x1, y, wide = (np.array(v, float) for v in values)
        at = gutter(x0, x1, wide[0])
        column = np.zeros(len(x0), int) if at is None else (x0 >= at).astype(int)
        reading = np.empty(len(x0), int)
        reading[np.lexsort((x0, y, column))] = np.arange(len(x0))
        return [{"column": c, "reading": r} for c, r in zip(column.tolist(), reading.tolist(), strict=True)]

    placed = judged(lines, "__at", judge, "x0", "x1", "y", width, kind="struct<column:int,reading:int>", keys=("doc", "page"), by=None)
    return placed.select(*lines.columns, "__at.column", "__at.reading")


def repaired_markers(rows: DataFrame, indent: float = 45.0, reach: int = 4) -> DataFrame:
    """Markers with a confused glyph read as the number their neighbours ask for.

    ``l2. Text`` becomes ``12. Text`` if a marker within ``reach`` rows at the same indent is
    one more, and the last marker before it, if near, is one less.
    """
    order = by_doc()
    glyphs = "".join(re.escape(g) for g in CONFUSED)
    raw = F.regexp_extract("text", rf"^([0-9{glyphs}]{{1,3}})\.\s", 1)
    plain = F.translate(raw, "".join(CONFUSED), "".join(CONFUSED.values()))
    number = F.when(raw != "", plain.cast("int"))
    marked = rows.withColumns({"__raw": raw, "__n": number, "__ok": raw.rlike("^[0-9]+$")})
    near = lambda k: F.abs(F.lead("x0", k).over(order) - F.col("x0")) <= indent
    after = F.coalesce(*[F.when(F.lead("__ok", k).over(order) & near(k), F.lead("__n", k).over(order)) for k in range(1, reach + 1)])
    before = F.coalesce(*[F.when(F.lag("__ok", k).over(order), F.lag("__n", k).over(order)) for k in range(1, reach + 1)])
    fits = (F.col("__raw") != "") & ~F.col("__ok") & (after == F.col("__n") + 1) & (before.isNull() | (before == F.col("__n") - 1))
    fixed = F.concat(F.col("__n").cast("string"), F.expr("substring(text, length(__raw) + 1)"))
    out = marked.withColumn("__fits", F.coalesce(fits, F.lit(False)))
    return out.withColumn("text", F.when(F.col("__fits"), fixed).otherwise(F.col("text"))).withColumn("repaired", F.col("__fits")).drop("__raw", "__n", "__ok", "__fits")


def repaired_opening(line: str) -> str:
    """A short garbled opening as the organ's formula it is most like."""
    if len(line) > 46 or not line.lower().startswith("the "):
        return line
    best = max(ORGANS, key=lambda o: difflib.SequenceMatcher(None, line.lower(), o.lower()).ratio())
    return best if difflib.SequenceMatcher(None, line.lower(), best.lower()).ratio() >= 0.86 else line


@cache
def _verb_forms() -> tuple[frozenset[str], dict[tuple[int, str], list[str]]]:
    """All verb forms, and those of one word by length and first two letters."""
    single: dict[tuple[int, str], list[str]] = {}
    for s in surfaces():
        if " " not in s:
            single.setdefault((len(s), s[:2]), []).append(s)
    return frozenset(surfaces()), single


def repaired_verb(line: str) -> str:
    """A first word one junk letter away from exactly one known verb form, put right."""
    m = re.match(r"([A-Za-z|0-9]+)(.*)", line, re.S)
    known, single = _verb_forms()
    if not m or m[1].lower() in known:
        return line
    word = m[1].lower()
    fits = {
        s for s in single.get((len(word), word[:2]), ())
        if sum(a != b for a, b in zip(s, word, strict=True)) == 1 and all(b in "il1|o0ceurnvs" for a, b in zip(s, word, strict=True) if a != b)
    }
    return fits.pop().capitalize() + m[2] if len(fits) == 1 else line


def repaired_lines(rows: DataFrame) -> DataFrame:
    """Openings and leading verbs of damaged lines put right; only suspect lines reach Python."""

    ship_package(rows.sparkSession)

    @F.pandas_udf("string")
    def fix(s: pd.Series) -> pd.Series:
        return s.map(lambda t: repaired_verb(repaired_opening(t)), na_action="ignore")

    suspect = F.col("text").rlike(r"^(?i:the )") & (F.length("text") <= 46) | F.col("text").rlike(r"^[A-Z][A-Za-z|0-9]+\s")
    # The function gets a null for every other line, as its argument is made before any condition around it.
    return rows.withColumn("text", F.when(suspect, fix(F.when(suspect, F.col("text")))).otherwise(F.col("text")))


def heading_keys(symbol: Column) -> Column:
    """struct(style, session, number) of a symbol: new style session/number, or the old number alone."""
    new = F.regexp_extract(symbol, r"/(\d+)/(\d+)[A-Z]*(?:\s*\[.*)?$", 1)
    number = F.regexp_extract(symbol, r"(\d+)[A-Z]*(?:\s*\([IVXLC]+\))?(?:\s*\[.*)?$", 1)
    old = symbol.rlike(r"\d+\s*\([IVXLC]+\)|\d+\s*\(\d{4}\)")
    of_year = F.regexp_extract(symbol, r"(\d+)\s*\(\d{4}\)", 1)
    return F.when(old, F.struct(F.lit("old").alias("style"), F.lit("").alias("session"), F.when(of_year != "", of_year).otherwise(number).alias("number"))).otherwise(
        F.struct(F.lit("new").alias("style"), new.alias("session"), number.alias("number"))
    )


def printed_key(line: Column) -> Column:
    """The same struct read off a printed heading line; null if it is none."""
    new = F.regexp_extract(line, r"^(\d{1,3})/(\d{1,3})[A-Z]*\.?\s", 1)
    second = F.regexp_extract(line, r"^(\d{1,3})/(\d{1,3})[A-Z]*\.?\s", 2)
    old = F.regexp_extract(line, r"^(?:Resolution\s+)?(\d{1,5})\s*\((?:[IVXLC]+|\d{4})\)", 1)
    return F.when(new != "", F.struct(F.lit("new").alias("style"), new.alias("session"), second.alias("number"))).when(
        old != "", F.struct(F.lit("old").alias("style"), F.lit("").alias("session"), old.alias("number"))
    )


def cropped(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """The rows of each document's own text, with ``certain``.

    From its own printed heading (one followed by an opening comes first) to the next
    heading of another document; a document without its heading is kept whole and flagged.
    ``targets``: doc, symbol.
    """
    key = printed_key(F.col("text"))
    opened = F.coalesce(
        F.max(F.when(F.col("text").rlike(r"^The .*(Assembly|Council),$"), 1).otherwise(0)).over(by_doc().rowsBetween(1, 6)) == 1, F.lit(False)
    )
    marked = rows.withColumns({"__k": key, "__o": opened}).join(targets.select("doc", heading_keys(F.col("symbol")).alias("__own")), "doc")
    own = F.col("__k") == F.col("__own")
    start = marked.where(own).groupBy("doc").agg(F.min_by("position", F.struct((~F.col("__o")).alias("o"), F.col("position").alias("p"))).alias("start"))
    later = marked.where(F.col("__k").isNotNull() & ~own).select("doc", F.col("position").alias("p")).join(start, "doc").where("p > start")
    end = later.groupBy("doc").agg(F.min("p").alias("end"))
    whole = rows.join(start, "doc", "left").join(end, "doc", "left")
    kept = whole.where((F.col("start").isNull()) | ((F.col("position") >= F.col("start")) & (F.col("end").isNull() | (F.col("position") < F.col("end")))))
    return kept.withColumn("certain", F.col("start").isNotNull()).drop("start", "end")


def overreach(elements: DataFrame, targets: DataFrame) -> DataFrame:
    """Elements that start with another document's printed heading."""
    body = elements.where(~F.col("type").isin("footnote", "vote_record", "table", "signature", "divider"))
    both = body.join(targets.select("doc", heading_keys(F.col("symbol")).alias("__own")), "doc").withColumn("__k", printed_key(F.col("text")))
    return both.where(F.col("__k").isNotNull() & (F.col("__k") != F.col("__own"))).select("doc", "position", "text")


def child_symbol(family: Column, session: Column, number: Column, letter: Column) -> Column:
    """A child's symbol from its printed number: family/session/number and a letter."""
    return F.concat(family, F.lit("/"), session, F.lit("/"), number, F.coalesce(F.upper(letter), F.lit("")))


def volume_catalog(spark) -> DataFrame:
    """(symbol, kind, session, part): the volumes there may be, by rule.

    Two volumes a session for sessions 57 to 80, and one of each year 2003 to 2025.
    """
    sessions = spark.range(57, 81).select(F.col("id").cast("int").alias("session")).withColumn("part", F.explode(F.array(F.lit(1), F.lit(2))))
    ga = sessions.select(
        F.format_string("A/%d/49 (Vol. %s)", "session", F.when(F.col("part") == 1, "I").otherwise("II")).alias("symbol"), F.lit("session").alias("kind"), "session", "part"
    )
    years = spark.range(2003, 2026).select(F.col("id").cast("int").alias("session"))
    return ga.unionByName(years.select(F.format_string("S/INF/%d", "session").alias("symbol"), F.lit("year").alias("kind"), "session", F.lit(1).alias("part")))


def source_span(words: list[str], anchors: list[tuple[int, list[str], list[str]]]) -> tuple[int, int] | None:
    """(start, end) of a document in its source's words.

    ``anchors``: (rank, first words, last words).  Of the best rank that is found, the
    smallest span from the first words to the last.
    """

    def places(part: list[str]) -> list[int]:
        return [i for i in range(len(words) - len(part) + 1) if words[i : i + len(part)] == part] if part else []

    for rank in sorted({a[0] for a in anchors}):
        spans = [
            (s, e + len(last)) for r, head, last in anchors if r == rank for s in places(head) for e in places(last) if e + len(last) > s
        ]
        if spans:
            return min(spans, key=lambda x: (x[1] - x[0], x[0]))
    return None
