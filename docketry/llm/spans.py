"""Regular-expression spans as column expressions (no Python on the executors).

Spark gives the matches of a pattern but not their places.  The places follow
from the text between them: ``split`` by the same pattern returns the pieces,
and the k-th match starts at the summed length of the pieces and matches before
it.  Lengths are code points, ends are exclusive.

Work grows with a text's length and its matches, not with their product: sums run in
folds that append to short arrays (:func:`folded`), and parts of a text are taken
from blocks of it (:func:`blocks`, :func:`cut`), since a place in a string is only
found by counting from its start.

Patterns must be free of quadratic search and of recursion on long runs: runs
are possessive and may start only where the run starts or where the last match
ended (``\\G``), which changes no leftmost non-overlapping match.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<s:int,e:int,m:string>>"
LOT = 256
BLOCK = 1024


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def folded(
    items: Column,
    start: Column,
    step: Callable[[Column, Column], tuple[Column, Column]],
    kind: str,
    end: Callable[[Column, Column], Column] = lambda state, out: out,
) -> Column:
    """Left fold over an array: ``step(state, x)`` gives the next state and an array to append.

    ``kind`` is the type of what is returned, ``array<..>``; ``end`` makes the result of the last state
    and the array.  Appending copies, so it is done in lots of ``LOT`` items.
    """

    def lot(it: Column, state: Column, k: Column) -> Column:
        def one(acc: Column, x: Column) -> Column:
            after, more = step(acc["state"], x)
            return F.struct(after.alias("state"), F.concat(acc["out"], more).alias("out"))

        return F.aggregate(
            F.slice(it, k * LOT + 1, LOT), F.struct(state.alias("state"), F.array().cast(kind).alias("out")), one
        )

    def whole(it: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(0), (F.size(it) / LOT).cast("int")),
            F.struct(start.alias("state"), F.array().cast(f"array<{kind}>").alias("out")),
            lambda acc, k: bound(
                lot(it, acc["state"], k),
                lambda r: F.struct(r["state"].alias("state"), F.concat(acc["out"], F.array(r["out"])).alias("out")),
            ),
            lambda acc: end(acc["state"], F.flatten(acc["out"])),
        )

    return bound(items, whole)


def located(text: Column, pattern: str, needs: Column | None = None, least: int = 1) -> Column:
    """array<struct<s,e,m>>: start, end and text of every match, in order.

    ``needs`` is a cheap condition every matching text meets; matches shorter
    than ``least`` code points are passed over, not returned.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # The piece after the last match has no match beside it.
    both = F.arrays_zip(found.alias("m"), F.split(text, pattern, -1).alias("p"))

    def step(at: Column, x: Column) -> tuple[Column, Column]:
        s = at + F.length(x["p"])
        e = s + F.coalesce(F.length(x["m"]), F.lit(0))
        span = F.struct(s.alias("s"), e.alias("e"), x["m"].alias("m"))
        return e, F.when(F.length(x["m"]) >= least, F.array(span)).otherwise(F.array().cast(SPAN))

    hit = text.rlike(pattern) if needs is None else needs & text.rlike(pattern)
    return F.when(hit, folded(both, F.lit(0), step, SPAN)).otherwise(F.array().cast(SPAN))


def blocks(text: Column) -> Column:
    """A text in blocks of ``BLOCK`` code points."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}+"), F.lit(0))


def cut(parts: Column, start: Column, end: Column) -> Column:
    """Code points start to end (exclusive) of the text whose blocks are ``parts``."""
    first = (start / BLOCK).cast("int")
    many = (F.greatest(end - 1, start) / BLOCK).cast("int") - first + 1
    return F.substring(F.array_join(F.slice(parts, first + 1, many), ""), start - first * BLOCK + 1, end - start)


def digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def listed(kind: str, spans: Column) -> Column:
    """Strings kind:start:end."""
    return F.transform(spans, lambda x: F.concat(F.lit(f"{kind}:"), x["s"], F.lit(":"), x["e"]))


def near(parts: Column, span: Column, width: int) -> Column:
    """Lower-case text within ``width`` code points of a span, without the span."""
    before = cut(parts, F.greatest(span["s"] - width, F.lit(0)), span["s"])
    return F.lower(F.concat(before, F.lit(" \x00 "), cut(parts, span["e"], span["e"] + width)))
