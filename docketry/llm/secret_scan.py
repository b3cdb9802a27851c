"""Secrets: known shapes, and windows of high entropy per character class.

Base kinds (assign, access, hex) come from their shapes alone.  The method adds
kind ``entropy``: maximal runs of credential characters become candidates; each
has the class of its alphabet (decimal, hexadecimal, alphanumeric, base64).  A
window slides over the candidate, and its Shannon entropy is kept by incremental
counts: with S the sum of c*log2(c) over the window's character counts, a step
adds one character and drops one, and H = log2(w) - S/w.  A candidate is a secret
when its highest window reaches the threshold of its class, unless the allow-list
suppresses it (identifiers, paths, words in camel or snake case, plain numbers,
sequences of the alphabet, documented example keys) or a base span covers it.

Everything is a column expression: no Python, no shuffle, one pass over whole
texts.  Positions are code points, ends exclusive.

Defined cases: a null text is read as empty; texts without secrets give zero
counts, the digest of the empty string and an empty span list; null ids and
repeated rows are handed through; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.llm.spans import SPAN, bound, folded, located

# Patterns of the kinds.  Runs are maximal, so asking for the least
# length at once gives the same spans as dropping short runs afterwards.
PATTERNS: dict[str, str] = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']? *+[:=] *+["']?[A-Za-z0-9+/_.=-]++""",
    "access": r"AKIA[A-Z0-9]{16,}+",
    "hex": r"[0-9a-f]{24,}+",
    "entropy": r"(?:\G|(?<![A-Za-z0-9+/_=-]))[A-Za-z0-9+/_=-]{20,}+",
}
VALUE = r"""[A-Za-z0-9+/_.=-]++$"""
HEAD = r"""^(?i:password|passwd|secret|token|api_?key)["']? *+[:=] *+["']?"""
BASE = ("assign", "access", "hex")
KINDS = tuple(PATTERNS)

WINDOW = 20
# Class, its alphabet, least window entropy in bits.
CLASSES: tuple[tuple[str, str, float], ...] = (
    ("decimal", r"^[0-9]+$", 9.0),
    ("hexadecimal", r"^(?:[0-9a-f]+|[0-9A-F]+)$", 3.0),
    ("alphanumeric", r"^[A-Za-z0-9]+$", 3.7),
    ("base64", r"^[A-Za-z0-9+/_=-]+$", 3.9),
)
# Candidates of these forms are never secrets.
ALLOW: tuple[str, ...] = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^[A-Za-z]+$",
    r"^(?:[A-Za-z]+|[0-9]+)(?:[/_=+-]+(?:[A-Za-z]+|[0-9]+))*[/_=+-]*$",
    r"(?i)example|sample|placeholder|changeme|abcdefgh|01234567|xxxxxx",
    r"(.)\1{7}",
)


def peak_entropy(candidate: Column, width: int = WINDOW) -> Column:
    """Highest entropy, in bits, of a window of ``width`` characters."""
    return bound(F.filter(F.split(candidate, ""), lambda c: c != ""), lambda chars: _peak(chars, width))


def _peak(chars: Column, width: int) -> Column:
    n = F.size(chars)
    w = F.least(n, F.lit(width))
    zero = F.transform(F.sequence(F.lit(0), F.lit(127)), lambda _: F.lit(0))

    def part(c: Column) -> Column:
        return F.when(c > 1, c * F.log2(c.cast("double"))).otherwise(F.lit(0.0))

    def step(acc: Column, i: Column) -> Column:
        new = F.ascii(F.element_at(chars, i))
        full = i > w
        # The character that leaves; 0 (never in a candidate) while the window fills.
        old = F.when(full, F.ascii(F.element_at(chars, F.greatest(i - w, F.lit(1))))).otherwise(F.lit(0))
        counts = acc["counts"]
        went = F.element_at(counts, old + 1)
        total = acc["total"] + F.when(full, part(went - 1) - part(went)).otherwise(F.lit(0.0))
        came = F.element_at(counts, new + 1) - F.when(full & (old == new), 1).otherwise(0)
        total = total + part(came + 1) - part(came)
        moved = F.transform(
            counts,
            lambda c, k: c + F.when(k == new, 1).otherwise(0) - F.when(full & (k == old), 1).otherwise(0),
        )
        size = w.cast("double")
        best = F.when(i >= w, F.greatest(acc["best"], F.log2(size) - total / size)).otherwise(acc["best"])
        return F.struct(moved.alias("counts"), total.alias("total"), best.alias("best"))

    return F.aggregate(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
        F.struct(zero.alias("counts"), F.lit(0.0).alias("total"), F.lit(0.0).alias("best")),
        step,
        lambda acc: acc["best"],
    )


def uncovered(candidates: Column, covers: Column) -> Column:
    """The candidate spans that overlap no cover; both lists of spans, candidates in order and apart.

    Two sweeps over both by start: forwards with the furthest end of a cover so far,
    backwards with its least start.
    """
    kind = "array<struct<s:int,t:int,e:int,m:string>>"

    def event(t: int):
        return lambda x: F.struct(x["s"].alias("s"), F.lit(t).alias("t"), x["e"].alias("e"), x["m"].alias("m"))

    events = F.array_sort(F.concat(F.transform(covers, event(0)), F.transform(candidates, event(1))))

    def forwards(end: Column, x: Column) -> tuple[Column, Column]:
        cover = x["t"] == 0
        keep = cover | (end <= x["s"])
        return F.when(cover, F.greatest(end, x["e"])).otherwise(end), F.when(keep, F.array(x)).otherwise(F.array().cast(kind))

    def backwards(start: Column, x: Column) -> tuple[Column, Column]:
        cover = x["t"] == 0
        span = F.array(F.struct(x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m")))
        return F.when(cover, x["s"]).otherwise(start), F.when(~cover & (start >= x["e"]), span).otherwise(F.array().cast(SPAN))

    free = F.reverse(folded(F.reverse(folded(events, F.lit(0), forwards, kind)), F.lit(2**31 - 1), backwards, SPAN))
    return F.when((F.size(candidates) == 0) | (F.size(covers) == 0), candidates).otherwise(free)


def allowed(candidate: Column) -> Column:
    """Whether the allow-list suppresses a candidate."""
    out = F.lit(False)
    for pattern in ALLOW:
        out = out | candidate.rlike(pattern)
    return out


def threshold(candidate: Column) -> Column:
    out = F.when(candidate.rlike(CLASSES[0][1]), CLASSES[0][2])
    for _, alphabet, least in CLASSES[1:]:
        out = out.when(candidate.rlike(alphabet), least)
    return out.otherwise(99.0)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, and findings: array<struct<s,rank,e,kind,entropy>> by start, then kind."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    text = F.col("text")
    base = base.select(
        "doc_id",
        "text",
        F.filter(
            located(text, PATTERNS["assign"]),
            lambda x: F.length(F.regexp_replace(x["m"], HEAD, "")) >= 6,
        ).alias("c_assign"),
        located(text, PATTERNS["access"], F.contains(text, F.lit("AKIA"))).alias("c_access"),
        located(text, PATTERNS["hex"]).alias("c_hex"),
        F.filter(located(text, PATTERNS["entropy"]), lambda x: ~allowed(x["m"])).alias("c_entropy"),
    )
    base = base.withColumn("c_entropy", uncovered(F.col("c_entropy"), F.concat("c_assign", "c_access", "c_hex")))

    def as_found(kind: str) -> Column:
        rank = KINDS.index(kind)
        return F.transform(
            F.col(f"c_{kind}"),
            lambda x: F.struct(
                x["s"].alias("s"), F.lit(rank).alias("rank"), x["e"].alias("e"), F.lit(kind).alias("kind"),
                (peak_entropy(x["m"]) if kind == "entropy" else F.lit(None).cast("double")).alias("entropy"),
                threshold(x["m"]).alias("least"),
            ),
        )

    high = F.filter(as_found("entropy"), lambda x: x["entropy"] >= x["least"])
    every = F.array_sort(F.concat(*[as_found(k) for k in BASE], high))
    none = F.array().cast("array<struct<s:int,rank:int,e:int,kind:string,entropy:double,least:double>>")
    some = F.size("c_assign") + F.size("c_access") + F.size("c_hex") + F.size("c_entropy") > 0
    return base.select("doc_id", "text", F.when(some, every).otherwise(none).alias("findings"))


def digest(found: DataFrame) -> DataFrame:
    """The findings as counts, a hash of the base spans, and the list of all spans."""

    def text(x: Column) -> Column:
        return F.array_join(
            F.transform(x, lambda y: F.concat_ws(":", y["kind"], y["s"].cast("string"), y["e"].cast("string"))), ","
        )

    def count(kind: str) -> Column:
        return F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(k) for k in BASE],
        F.sha2(text(F.filter("findings", lambda x: x["kind"].isin(*BASE))), 256).alias("base_sha256"),
        text(F.col("findings")).alias("spans"),
    )
