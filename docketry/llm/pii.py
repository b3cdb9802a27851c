"""Personal data: proposed by patterns, confirmed by checksums, scored by context.

Kinds: email, ip, card (Luhn), phone, iban (mod 97) and ssn.  Every proposed span
that its validator confirms has a score: the kind's prior, raised when a word
that usually goes with the kind stands within ``WINDOW`` code points, lowered when
a word of the opposite sort does (an order number, a version, a test value).  The
four base kinds are always kept whatever their score; iban and ssn need
``KEEP`` or more.

Everything is a column expression: no Python, no shuffle, one pass over whole
texts.  Positions are code points, ends exclusive.

Defined cases: a null text is read as empty; texts without personal data give
zero counts, the digest of the empty string and an empty span list; null ids and
repeated rows are handed through; an empty table gives an empty result; other
columns are ignored, and :func:`redact` hands them through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.llm.spans import blocks, cut, digits, folded, located, near

# Patterns of the kinds, possessive and anchored at run starts.
PATTERNS: dict[str, str] = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
}
BASE = ("email", "ip", "card", "phone")
KINDS = tuple(PATTERNS)

# Prior score of a confirmed span, words that raise it, words that lower it.
CONTEXT: dict[str, tuple[float, str, str]] = {
    "email": (0.9, r"\b(?:e-?mail|mail|contact|write|reply|courriel|correo|kontakt)\b", r"\b(?:example|test|noreply)\b"),
    "ip": (0.6, r"\b(?:ip|host|address|server|client|login|adresse)\b", r"\b(?:version|release|section|v)\b"),
    "card": (0.7, r"\b(?:card|visa|mastercard|amex|credit|debit|payment|karte|carte|tarjeta)\b", r"\b(?:order|isbn|serial|tracking|test)\b"),
    "phone": (0.7, r"\b(?:phone|tel|call|mobile|fax|telefon|téléphone|teléfono|appel)\b", r"\b(?:version|serial|isbn)\b"),
    "iban": (0.8, r"\b(?:iban|bank|account|konto|compte|cuenta|bic|swift)\b", r"\b(?:test|sample|serial)\b"),
    "ssn": (0.4, r"\b(?:ssn|social|security|insurance|taxpayer)\b", r"\b(?:order|part|serial|case|ticket)\b"),
}
FINDINGS = "array<struct<kind:string,s:int,e:int,score:double>>"
WINDOW = 40
RAISE = 0.3
LOWER = 0.35
KEEP = 0.5


def mod97(iban: Column) -> Column:
    """Remainder of an IBAN moved and spelt in digits; 1 is valid."""
    plain = F.replace(iban, F.lit(" "), F.lit(""))
    moved = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.left(plain, F.lit(4)))
    return F.aggregate(
        F.split(moved, ""),
        F.lit(0),
        lambda acc, c: F.when(c == "", acc)
        .when(c.between("0", "9"), (acc * 10 + F.ascii(c) - 48) % 97)
        .otherwise((acc * 100 + F.ascii(c) - 55) % 97)
        .cast("int"),
    )


def valid(kind: str, x: Column) -> Column:
    m = x["m"]
    if kind == "ip":
        parts = F.transform(F.split(m, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(
            parts, lambda p: (F.length(p) <= 3) & (F.when(F.length(p) <= 3, p).otherwise(F.lit("999")).cast("int") <= 255)
        )
    if kind == "card":
        d = digits(m)
        return F.length(d).between(13, 19) & F.call_function("luhn_check", d)
    if kind == "phone":
        return F.length(digits(m)).between(9, 15)
    if kind == "iban":
        plain = F.replace(m, F.lit(" "), F.lit(""))
        return F.length(plain).between(15, 34) & (mod97(m) == 1)
    if kind == "ssn":
        area, group, serial = F.substring(m, 1, 3), F.substring(m, 5, 2), F.substring(m, 8, 4)
        return ~area.isin("000", "666") & (area < "900") & (group != "00") & (serial != "0000")
    return F.lit(True)


def proposals(kind: str, text: Column) -> Column:
    """Confirmed spans of a kind: array<struct<s,e,m>>."""
    needs = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+")), "ssn": F.contains(text, F.lit("-"))}
    spans = located(text, PATTERNS[kind], needs.get(kind), {"card": 13, "phone": 10, "iban": 15}.get(kind, 1))
    return F.filter(spans, lambda x: valid(kind, x))


def scored(kind: str, parts: Column, spans: Column) -> Column:
    """array<struct<kind,s,e,score>> of spans of the text whose blocks are ``parts``."""
    prior, up, down = CONTEXT[kind]

    def one(x: Column) -> Column:
        around = near(parts, x, WINDOW)
        value = F.lit(prior) + F.when(around.rlike(up), RAISE).otherwise(0.0) - F.when(around.rlike(down), LOWER).otherwise(0.0)
        return F.struct(
            F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e"),
            F.round(F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0)), 2).alias("score"),
        )

    return F.transform(spans, one)


def found_in(rows: DataFrame, text_col: str) -> DataFrame:
    """``rows`` (a struct ``row`` and a text without nulls) with ``parts`` and ``findings``, by kind, then start."""
    none = F.array().cast(FINDINGS)
    text = F.col(text_col)
    rows = rows.select("row", text_col, *[proposals(kind, text).alias(f"c_{kind}") for kind in KINDS])
    some = F.lit(False)
    for kind in KINDS:
        some = some | (F.size(f"c_{kind}") > 0)
    rows = rows.withColumn("parts", F.when(some, blocks(text)).otherwise(F.array().cast("array<string>")))
    kept = []
    for kind in KINDS:
        found = scored(kind, F.col("parts"), F.col(f"c_{kind}"))
        if kind not in BASE:
            found = F.filter(found, lambda x: x["score"] >= KEEP)
        kept.append(F.when(F.size(f"c_{kind}") > 0, found).otherwise(none))
    return rows.select("row", text_col, "parts", F.concat(*kept).alias("findings"))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, and findings: array<struct<kind,s,e,score>> by kind, then start."""
    rows = docs.select(
        F.struct(F.col(id_col).alias("doc_id")).alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    return found_in(rows, "text").select("row.doc_id", "text", "findings")


def digest(found: DataFrame) -> DataFrame:
    """The findings as counts, a hash of the base spans, and the list of all spans."""
    def of(kind: str) -> Column:
        return F.filter("findings", lambda x: x["kind"] == kind)

    def text(x: Column) -> Column:
        return F.array_join(F.transform(x, lambda y: F.concat_ws(":", y["kind"], y["s"].cast("string"), y["e"].cast("string"))), ",")

    base = F.filter("findings", lambda x: x["kind"].isin(*BASE))
    return found.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(text(base), 256).alias("base_sha256"),
        text(F.col("findings")).alias("spans"),
        F.array_join(F.transform("findings", lambda y: y["score"].cast("decimal(3,2)").cast("string")), ",").alias("scores"),
    )


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Every kept span replaced by its kind in brackets; all columns kept, of any name.

    Overlapping spans become one mask, named after the kind that starts first
    (ties: the order of ``KINDS``).  A text without findings stays as it is, null too.
    """
    rows = found_in(docs.select(F.struct("*").alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("clear")), "clear")
    rank = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    spans = F.array_sort(
        F.transform("findings", lambda x: F.struct(x["s"].alias("s"), F.element_at(rank, x["kind"]).alias("r"), x["kind"].alias("k"), x["e"].alias("e")))
    )
    parts = F.col("parts")

    def step(at: Column, x: Column) -> tuple[Column, Column]:
        piece = F.concat(cut(parts, at, x["s"]), F.lit("["), F.upper(x["k"]), F.lit("]"))
        return F.greatest(at, x["e"]), F.when(x["s"] >= at, F.array(piece)).otherwise(F.array().cast("array<string>"))

    masked = folded(
        spans, F.lit(0), step, "array<string>", lambda at, out: F.concat(F.array_join(out, ""), cut(parts, at, F.length("clear")))
    )
    held = F.col("row")[text_col]
    shown = F.when(F.size("findings") > 0, masked).otherwise(held)
    return rows.select(*[shown.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
