"""Ordered sequences: runs, islands, look-ahead and carried values as windows.

Rows are ordered by ``position`` within ``doc``.  Operators that share the document as
their key need one exchange and one sort between them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry.functions.text import roman_value
from docketry.operators.documents import judged


def by_doc(doc: str = "doc", position: str = "position"):
    return Window.partitionBy(doc).orderBy(position)


def so_far(doc: str = "doc", position: str = "position"):
    return by_doc(doc, position).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def island(starts: Column, window) -> Column:
    """Number of a run: how many starts there were up to the row."""
    return F.sum(F.when(starts, 1).otherwise(0)).over(window)


def carried(value: Column, window) -> Column:
    """The last non-null value up to the row."""
    return F.last(value, ignorenulls=True).over(window)


def enumerator_chains(rows: DataFrame, least: int = 3) -> DataFrame:
    """Candidates (doc, position, major, minor) with ``accepted``: in a chain of ``least`` or more from minor 1.

    A candidate follows the one before if the major is equal and the minor is one more.
    """
    order = by_doc()
    follows = (F.col("major") == F.lag("major").over(order)) & (F.col("minor") == F.lag("minor").over(order) + 1)
    marked = rows.withColumn("__starts", ~F.coalesce(follows, F.lit(False)))
    marked = marked.withColumn("__run", island(F.col("__starts"), so_far()))
    run = Window.partitionBy("doc", "__run")
    ok = (F.count("*").over(run) >= least) & (F.min("minor").over(run) == 1)
    return marked.withColumn("accepted", ok).drop("__starts", "__run")


def slices(rows: DataFrame, heading: Column) -> DataFrame:
    """Rows from each heading up to the next: child number and the heading's position."""
    window = so_far()
    cut = rows.withColumn("child", island(heading, window)).withColumn("heading_position", carried(F.when(heading, F.col("position")), window))
    return cut.where("child > 0")


def confirmed_ahead(rows: DataFrame, flag: Column, reach: int = 8) -> Column:
    """Whether the flag holds on one of the next ``reach`` rows."""
    return F.coalesce(F.max(F.when(flag, 1).otherwise(0)).over(by_doc().rowsBetween(1, reach)) == 1, F.lit(False))


def filled_annex(rows: DataFrame) -> DataFrame:
    """Annex numbers filled forward within the annex; main text has none."""
    return rows.withColumn("annex_filled", F.when(F.col("section") != "main", carried(F.when(F.col("section") == "main", F.lit(-1)).otherwise(F.col("annex_index")), so_far())))


def cell_groups(rows: DataFrame, separator: str = " | ") -> DataFrame:
    """Runs of table cells as one row: doc, first position, joined text, number of cells."""
    cell = F.col("kind") == "table_cell"
    starts = cell & ~F.coalesce(F.lag(cell).over(by_doc()), F.lit(False))
    grouped = rows.withColumn("__run", island(starts, so_far())).where(cell)
    parts = F.array_sort(F.collect_list(F.struct("position", "text")))
    return grouped.groupBy("doc", "__run").agg(F.min("position").alias("position"), parts.alias("c"), F.count("*").alias("cells")).select(
        "doc", "position", F.array_join(F.filter(F.transform("c", lambda x: F.trim(x["text"])), lambda t: t != ""), separator).alias("text"), "cells"
    )


def repeated_lines(rows: DataFrame, least: int = 2, top: float = 0.11, bottom: float = 0.07) -> DataFrame:
    """Rows with ``running``: in a page's top or bottom band and alike, digits aside, on ``least`` lines.

    ``rows``: doc, page, y (0 at the top, 1 at the bottom), text.
    """
    band = F.when(F.col("y") <= top, "top").when(F.col("y") >= 1 - bottom, "bottom")
    plain = F.trim(F.regexp_replace(F.lower("text"), r"\d+", "#"))
    alike = Window.partitionBy("doc", "__band", "__plain")
    marked = rows.withColumn("__band", band).withColumn("__plain", plain)
    return marked.withColumn("running", F.col("__band").isNotNull() & (F.count("*").over(alike) >= least)).drop("__band", "__plain")


def paragraphs(lines: DataFrame, structural: Column, gap: float = 1.6) -> DataFrame:
    """Lines (doc, page, line, y, x, size, text) joined to paragraphs.

    A paragraph starts at a structural line, a new page, a gap over ``gap`` times the
    document's median, an indent after a closed sentence, or another type size.
    """
    order = Window.partitionBy("doc").orderBy("page", "line")
    step = F.when(F.col("page") == F.lag("page").over(order), F.col("y") - F.lag("y").over(order))
    marked = lines.withColumn("__step", step)
    middle = F.percentile("__step", F.lit(0.5)).over(Window.partitionBy("doc"))
    closed = F.lag("text").over(order).rlike(r"[.;:?!]\s*$")
    starts = (
        structural
        | F.lag("page").over(order).isNull()
        | (F.col("page") != F.lag("page").over(order))
        | (F.col("__step") > gap * middle)
        | (closed & (F.col("x") > F.lag("x").over(order) + 8))
        | (F.abs(F.col("size") - F.lag("size").over(order)) > 1)
    )
    run = F.sum(F.when(F.coalesce(starts, F.lit(True)), 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    joined = marked.withColumn("paragraph", run).groupBy("doc", "paragraph").agg(
        F.array_sort(F.collect_list(F.struct("page", "line", "text"))).alias("c")
    )
    from docketry.functions.text import join_lines

    return joined.select("doc", "paragraph", join_lines(F.array_join(F.transform("c", lambda x: x["text"]), "\n")).alias("text"))


def hanging_markers(rows: DataFrame) -> DataFrame:
    """A marker alone on a row moves to the row after it."""
    bare = F.col("text").rlike(r"^(?:\d{1,3}\.|\([A-Za-z0-9]{1,7}\))$")
    before = F.lag(F.when(bare, F.col("text"))).over(by_doc())
    moved = rows.withColumn("__m", before).withColumn("__bare", bare & F.lead("text").over(by_doc()).isNotNull())
    return moved.where(~F.col("__bare")).withColumn("text", F.concat_ws(" ", "__m", "text")).drop("__m", "__bare")


def merged_headings(rows: DataFrame) -> DataFrame:
    """A heading that is only a marker takes the heading after it; pairs do not overlap."""
    bare = (F.col("type") == "heading") & F.col("text").rlike(r"^\(?(?:[IVXLCM]{1,7}|[A-Z]|\d{1,3})\)?\.?$")
    starts = ~F.coalesce(F.lag(bare).over(by_doc()), F.lit(False)) & bare
    run = rows.withColumn("__bare", bare).withColumn("__run", island(starts | ~bare, so_far()))
    odd = run.withColumn("__k", F.row_number().over(Window.partitionBy("doc", "__run").orderBy("position")))
    takes = F.col("__bare") & (F.col("__k") % 2 == 1) & F.lead("type").over(by_doc()).isin("heading", "title")
    marked = odd.withColumn("__takes", F.coalesce(takes, F.lit(False)))
    prefix = F.lag(F.when(F.col("__takes"), F.col("text"))).over(by_doc())
    out = marked.withColumn("prefix", prefix).where(~F.col("__takes"))
    return out.drop("__bare", "__run", "__k", "__takes")


def numbering_gaps(rows: DataFrame) -> DataFrame:
    """(doc, position, expected, found) where an ordinal does not follow at its level.

    Deeper levels start anew under every shallower row, a 1 starts a run, and the
    kind of numbering must not change within one.
    """
    order = by_doc()
    marked = rows
    levels = 6
    for n in range(1, levels):
        # Island of level n+1: a shallower row begins another.
        marked = marked.withColumn(f"__i{n}", F.sum(F.when(F.col("level") <= n, 1).otherwise(0)).over(so_far()))
    scope = F.when(F.col("level") <= 1, 0)
    for n in range(1, levels):
        scope = scope.when(F.col("level") == n + 1, F.col(f"__i{n}"))
    marked = marked.withColumn("__scope", scope.otherwise(0))
    same = Window.partitionBy("doc", "level", "__scope").orderBy("position")
    expected = F.lag("ordinal").over(same) + 1
    kept = F.lag("kind").over(same) == F.col("kind")
    del order
    return (
        marked.withColumn("expected", expected).withColumn("__kept", kept)
        .where(F.col("__kept") & (F.col("ordinal") != 1) & (F.col("ordinal") != F.col("expected")))
        .select("doc", "position", "expected", F.col("ordinal").alias("found"))
    )


def own_region(rows: DataFrame, own: Column, foreign: Column) -> DataFrame:
    """(doc, start, end): from the own heading to the next foreign one (exclusive), else to the end."""
    start = rows.groupBy("doc").agg(F.min(F.when(own, F.col("position"))).alias("start"), (F.max("position") + 1).alias("last"))
    after = rows.where(foreign).select("doc", F.col("position").alias("p")).join(start, "doc").where("p > start").groupBy("doc").agg(F.min("p").alias("end"))
    return start.join(after, "doc", "left").select(
        "doc", F.coalesce("start", F.lit(0)).alias("start"), F.coalesce("end", "last").alias("end"),
        F.when(F.col("start").isNull(), "unlocatable").when(F.col("end").isNull(), "whole").otherwise("heading").alias("mode"),
    )


def longest_slice(rows: DataFrame) -> DataFrame:
    """Of slices (child, volume, start, n) the longest of each child; ties to the first volume and start."""
    order = Window.partitionBy("child").orderBy(F.desc("n"), "volume", "start")
    return rows.withColumn("__r", F.row_number().over(order)).where("__r = 1").drop("__r")


def confirmed_numbers(candidates: pd.DataFrame, band: int, reach: int = 3) -> list[bool]:
    """Which numbered rows of one document carry real numbers.

    ``candidates`` in order: number, verb (an operative verb follows), reset (an
    opening or annex comes before).  A number over ``band`` is no number.  1 always
    is; one to ``reach`` above a running number continues it; otherwise the next
    number must follow within ``reach`` candidates, or an operative verb stand behind.
    """
    return real_numbers(candidates["number"].tolist(), candidates["verb"].tolist(), candidates["reset"].tolist(), band, reach)


def real_numbers(numbers: list[int], verbs: list[bool], resets: list[bool], band: int, reach: int = 3) -> list[bool]:
    """The same of plain lists."""
    live: set[int] = set()
    out = []
    for i, n in enumerate(numbers):
        if resets[i]:
            live = set()
        # Of the running numbers in reach the nearest is continued, the others run on.
        near = next((n - k for k in range(1, reach + 1) if n - k in live), None)
        ok = n <= band and (n == 1 or near is not None or n + 1 in numbers[i + 1 : i + 1 + reach] or bool(verbs[i]))
        if ok:
            live.discard(near)
            live.add(n)
        out.append(ok)
    return out


def confirmed_romans(values: list[int], reach: int = 3) -> list[bool]:
    """Which of a document's upper-case Roman parentheses are markers, not the tails of torn citations.

    One is that goes on from the last marker, or that one of the next ``reach`` candidates goes on from.
    """
    out, last = [], None
    for i, v in enumerate(values):
        ok = (last is not None and v == last + 1) or v + 1 in values[i + 1 : i + 1 + reach]
        last = v if ok else last
        out.append(ok)
    return out


def confirm_romans(rows: DataFrame, reach: int = 3) -> DataFrame:
    """Rows (doc, position, text) whose text starts with an upper-case Roman parenthesis, with ``confirmed``."""
    marker = F.regexp_extract("text", r"^\(([IVXLCDM]+)\)\s", 1)
    found = rows.where(marker != "").select("doc", "position", "text", roman_value(marker).alias("value"))
    return judged(found, "confirmed", lambda values: confirmed_romans(values, reach), "value")


def confirm_numbers(rows: DataFrame, reach: int = 3) -> DataFrame:
    """Rows (doc, position, number, verb, reset, body_rows) with ``confirmed``.

    The band is the larger of the rows that look operative and the body's rows, plus three.
    """

    def judge(numbers: list, verbs: list, resets: list, bodies: list) -> list[bool]:
        some = [i for i, n in enumerate(numbers) if n is not None]
        band = max(sum(bool(verbs[i]) for i in some), max((n for n in bodies if n is not None), default=0)) + 3
        real = iter(real_numbers([numbers[i] for i in some], [verbs[i] for i in some], [resets[i] for i in some], band, reach))
        return [n is not None and next(real) for n in numbers]

    return judged(rows, "confirmed", judge, "number", "verb", "reset", "body_rows")


def paren_levels(markers: list[str]) -> list[tuple[int, str]]:
    """(level, kind) of markers like a, b, i, ii, aa in their order.

    A marker continues the innermost open list it is next in; else it opens one.
    ``i`` is Roman when ``ii`` follows or a letter list other than up to h is open.
    """
    romans = ["i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix", "x", "xi", "xii", "xiii", "xiv", "xv", "xvi", "xvii", "xviii", "xix", "xx"]
    open_lists: list[tuple[str, int]] = []
    out = []

    def readings(m: str) -> Iterator[tuple[str, int]]:
        if m.isdigit():
            yield "number", int(m)
        if m in romans:
            yield "roman", romans.index(m) + 1
        if m and len(set(m)) == 1 and m.isalpha():
            yield "alpha", ord(m[0]) - 96 + 26 * (len(m) - 1)

    for i, raw in enumerate(markers):
        m = raw.lower()
        options = list(readings(m))
        if not options:
            out.append((max(1, len(open_lists)) + 1, "other"))
            continue
        after = markers[i + 1].lower() if i + 1 < len(markers) else ""
        chosen = None
        for depth in range(len(open_lists) - 1, -1, -1):
            kind, last = open_lists[depth]
            if (kind, last + 1) in options and not (m == "i" and kind == "alpha" and after == "ii"):
                chosen = (depth, (kind, last + 1))
                break
        if chosen is None:
            first = next((o for o in options if o[1] == 1), options[0])
            if m == "i" and after != "ii" and ("alpha", 9) in options and not open_lists:
                first = ("roman", 1)
            open_lists.append(first)
            depth = len(open_lists) - 1
        else:
            depth = chosen[0]
            open_lists = open_lists[:depth] + [chosen[1]]
        out.append((depth + 2, open_lists[depth][0]))
    return out


def mended_breaks(rows: DataFrame) -> DataFrame:
    """Rows torn by hard line breaks put together again.

    A row joins the one before it, as it then stands, if that lacks closing
    punctuation, the row starts nothing of its own, and it begins in lower case or
    without the first-line indent the document's paragraphs have.  Whether a row joins
    depends only on the last row of the run before it, so runs are islands.

    ``rows``: doc, position, text, indent (first-line, 0 if none).
    """
    order = by_doc()
    before = F.lag("text").over(order)
    open_end = ~before.rlike(r"[.;:?!”\"]\s*$")
    starts_own = F.col("text").rlike(r"^(?:\d{1,3}\.|\([A-Za-z0-9]{1,7}\)|[IVXLC]+\.|(?i:annex|appendix)\b|_{3,})")
    lower = F.col("text").rlike(r"^\p{Ll}")
    lost = (F.col("indent") == 0) & (F.max("indent").over(Window.partitionBy("doc")) > 0)
    joins = F.coalesce(open_end & ~starts_own & (lower | lost), F.lit(False))
    run = rows.withColumn("__run", island(~joins, so_far()))
    parts = F.array_sort(F.collect_list(F.struct("position", "text")))
    return run.groupBy("doc", "__run").agg(F.min("position").alias("position"), parts.alias("p")).select(
        "doc", "position", F.array_join(F.transform("p", lambda x: x["text"]), " ").alias("text"), F.transform("p", lambda x: x["position"]).alias("raw_positions")
    )
