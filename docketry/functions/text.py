"""Scalar text functions as column expressions.

Three tokenisers live side by side because three different equalities are wanted:
``gate_tokens`` (letters and digits, hyphens and apostrophes glued), ``plain_words``
(ASCII runs) and ``metric_tokens`` (Unicode runs with inner apostrophes, in
compatibility form).  ``word_count`` splits on white space only.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\s\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def squeeze(text: Column) -> Column:
    """No-break spaces, tabs and line ends as single blanks, ends trimmed."""
    return F.trim(F.regexp_replace(text, SPACE + "+", " "))


# ---- document symbols ---------------------------------------------------------


def normalize_symbol(symbol: Column) -> Column:
    """Upper case without any white space; null stays null."""
    return F.upper(F.regexp_replace(symbol, SPACE, ""))


def sanitize_symbol(symbol: Column) -> Column:
    """A symbol as a file name."""
    return F.regexp_replace(symbol, "[^A-Za-z0-9_.-]", "_")


def strip_bracket(symbol: Column) -> Column:
    """The parent of a bracketed part."""
    return F.rtrim(F.regexp_replace(symbol, r"\s*\[.*$", ""))


def symbol_family(symbol: Column) -> Column:
    """PRST before RES before DEC before OTHER."""
    s = F.upper(symbol)
    return (
        F.when(s.contains("PRST"), "PRST").when(s.contains("/RES/"), "RES").when(s.contains("/DEC/"), "DEC").otherwise("OTHER")
    )


def display_title(title: Column, other: Column) -> Column:
    """The title shown: generic titles give way to the alternative one."""
    some = F.coalesce(title, F.lit("")) != ""
    generic = title.rlike(r"(?i)^(resolution|decision|statement)(\s|$)")
    short = F.regexp_replace(F.regexp_replace(title, r"(?i) (resolution|decision)$", ""), r"\.$", "")
    return F.when(some & ~generic, short).when(F.coalesce(other, F.lit("")) != "", other).when(some, title)


def clean_title(*parts: Column) -> Column:
    """Catalogue title parts without trailing punctuation, joined; null if empty."""
    trimmed = [F.regexp_replace(p, r"[ :/]+$", "") for p in parts]
    return F.nullif(F.concat_ws(" ", *[F.nullif(t, F.lit("")) for t in trimmed]), F.lit(""))


# ---- tokens -------------------------------------------------------------------


def gate_tokens(text: Column) -> Column:
    """Lower case, hyphens and apostrophes deleted, runs of a-z and 0-9."""
    return F.regexp_extract_all(_glued(text), F.lit("[a-z0-9]+"), F.lit(0))


def gate_line(text: Column) -> Column:
    """The gate tokens with single blanks between them, without an array in between."""
    return F.trim(F.regexp_replace(_glued(text), "[^a-z0-9]+", " "))


def _glued(text: Column) -> Column:
    return F.coalesce(F.translate(F.lower(text), "-‐‑‒–­'’‘`", ""), F.lit(""))


def plain_words(text: Column) -> Column:
    """ASCII words and numbers in lower case."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[0-9a-z]+"), F.lit(0))


def compatibility_fold(text: Column) -> Column:
    """NFKC and full case folding, which the JVM side has no function for."""

    @F.pandas_udf("string")
    def folded(s: pd.Series) -> pd.Series:
        return s.map(lambda t: unicodedata.normalize("NFKC", t).casefold(), na_action="ignore")

    return folded(text)


def metric_tokens(text: Column, fold: bool = True) -> Column:
    """Unicode word runs with inner apostrophes; folded unless the text is known to be ASCII."""
    straight = F.translate(F.coalesce(text, F.lit("")), "’‘ʼ", "'''")
    ready = compatibility_fold(straight) if fold else F.lower(straight)
    return F.regexp_extract_all(ready, F.lit(r"[\p{L}\p{N}]+(?:'[\p{L}\p{N}]+)*"), F.lit(0))


def word_count(text: Column) -> Column:
    """Pieces between white space; blank and null texts have none."""
    trimmed = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, " ")))


# ---- markers ------------------------------------------------------------------


def leading_marker(text: Column) -> Column:
    """The enumerator a paragraph starts with: ``1.``, ``(a)``, ``1.2``, else null."""
    for_number = F.regexp_extract(text, r"^(\d+\.)\s+\S", 1)
    for_paren = F.regexp_extract(text, r"^(\((?:[A-Za-z]{1,7}|\d{1,3})\))\s+\S", 1)
    for_dotted = F.regexp_extract(text, r"^(\d{1,3}\.(?:\d{1,2}|[a-z]))\s+\S", 1)
    return F.coalesce(*[F.nullif(x, F.lit("")) for x in (for_number, for_paren, for_dotted)])


# Labelled, delimited and bare Roman prefixes of headings.
HEADING_PREFIXES = (
    r"(?i)^((?:action|goal|objective|priority|target|article|annex|appendix|chapter|section|part|principle|pillar|phase|step)\s+[\dIVXLCM]+[.:]?)\s+(\S.*)$",
    r"^((?:[IVXLCM]{1,6}|[A-Z]|\d{1,3})[.:)])\s+(\S.*)$",
    r"^([IVX]{1,6})\s+([A-Z]\S.*)$",
)
# Fixed value: label, numeral and title of an annex heading.
ANNEX_HEADING = r"(?i)^(annex|appendix)(?:\s+([ivxlcdm]+|[a-z]|\d{1,3})\b)?(?:\s*[-–—:.]\s*|\s+)?(\S.*)?$"


def heading_parts(text: Column) -> Column:
    """struct(prefix, title): labelled, delimited or bare Roman prefixes of a heading."""
    out = F.struct(F.lit(None).cast("string").alias("prefix"), text.alias("title"))
    for p in reversed(HEADING_PREFIXES):
        out = F.when(
            text.rlike(p), F.struct(F.regexp_extract(text, p, 1).alias("prefix"), F.regexp_extract(text, p, 2).alias("title"))
        ).otherwise(out)
    return out


def annex_parts(text: Column) -> Column:
    """struct(label, numeral, title) of an annex or appendix heading."""
    part = lambda i: F.nullif(F.regexp_extract(text, ANNEX_HEADING, i), F.lit(""))
    return F.struct(F.initcap(part(1)).alias("label"), part(2).alias("numeral"), part(3).alias("title"))


def roman_value(text: Column) -> Column:
    """Value of a Roman numeral; 0 where a character is none."""
    worth = F.create_map(*[F.lit(x) for kv in {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}.items() for x in kv])
    chars = F.filter(F.split(F.reverse(F.upper(text)), ""), lambda c: c != "")
    total = F.aggregate(
        chars,
        F.struct(F.lit(0).alias("sum"), F.lit(0).alias("top")),
        lambda acc, c: F.struct(
            (acc["sum"] + F.when(worth[c] < acc["top"], -worth[c]).otherwise(worth[c])).alias("sum"),
            F.greatest(acc["top"], worth[c]).alias("top"),
        ),
        lambda acc: acc["sum"],
    )
    return F.when(text.rlike("(?i)^[IVXLCDM]+$"), total).otherwise(0)


def alpha_ordinal(text: Column) -> Column:
    """a=1 … z=26, doubled letters go on: aa=27, bb=28; null where letters differ."""
    low = F.lower(text)
    return F.when(
        low.rlike("^([a-z])\\1*$"), F.ascii(low) - 96 + 26 * (F.length(low) - 1)
    )


def compress_positions(positions: Column) -> Column:
    """Sorted distinct whole numbers as text, runs as ``from-to``."""
    xs = F.array_sort(F.array_distinct(positions))
    runs = F.aggregate(
        xs,
        F.array().cast("array<struct<a:bigint,b:bigint>>"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["b"] == x - 1),
            F.concat(
                F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
                F.array(F.struct(F.try_element_at(acc, F.lit(-1))["a"].alias("a"), x.cast("bigint").alias("b"))),
            ),
        ).otherwise(F.concat(acc, F.array(F.struct(x.cast("bigint").alias("a"), x.cast("bigint").alias("b"))))),
    )
    shown = F.transform(
        runs, lambda r: F.when(r["a"] == r["b"], r["a"].cast("string")).otherwise(F.concat_ws("-", r["a"].cast("string"), r["b"].cast("string")))
    )
    return F.array_join(shown, ", ")


# ---- keys ---------------------------------------------------------------------


def match_key(text: Column, size: int = 60) -> Column:
    """Comparison key: enumerator dropped, lower case, letters, digits and single blanks."""
    bare = F.regexp_replace(squeeze(text), r"^(?:\(?[A-Za-z0-9]{1,5}[.)]\s*)+", "")
    return F.substring(F.trim(F.regexp_replace(F.regexp_replace(F.lower(bare), r"[^\p{L}\p{N} ]", ""), " +", " ")), 1, size)


def heading_key(text: Column) -> Column:
    """Comparison key of a heading: no dot leaders, page numbers or enumerator unless nothing is left."""
    low = F.lower(squeeze(text))
    cut = F.regexp_replace(low, r"[. ]{3,}\s*\d*$", "")
    bare = F.trim(F.regexp_replace(cut, r"^(?:[ivxlcm]{1,6}|[a-z]|\d{1,3})[.:)]\s+", ""))
    return F.coalesce(F.nullif(bare, F.lit("")), F.nullif(F.trim(cut), F.lit("")), low)


def signature(text: Column) -> Column:
    """Letters and digits alone, lower case."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]", "")


def element_id(symbol: Column, lang: Column, position: Column, namespace: str = "6ba7b811-9dad-11d1-80b4-00c04fd430c8") -> Column:
    """Name-based UUID (version 5) of an element's key."""
    name = F.concat_ws(":", symbol, lang, position.cast("string"))
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex((F.conv(F.substring(digest, 17, 2), 16, 10).cast("int").bitwiseAND(0x3F)).bitwiseOR(0x80)))
    return F.concat_ws(
        "-", F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 19, 2)), F.substring(digest, 21, 12),
    )


def key_hash(raw: Column) -> Column:
    return F.sha2(raw, 256)


def key_prefix(raw: Column) -> Column:
    return F.substring(raw, 1, 12)


# ---- dates, lists, repairs ----------------------------------------------------


def catalog_date(text: Column) -> Column:
    """Ten, seven or four leading characters as a date, else the first four-digit word."""
    year = F.regexp_extract(text, r"\b(\d{4})\b", 1)
    return F.coalesce(
        F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd"),
        F.try_to_date(F.substring(text, 1, 7), "yyyy-MM"),
        F.try_to_date(F.substring(text, 1, 4), "yyyy"),
        F.try_to_date(F.nullif(year, F.lit("")), "yyyy"),
    )


def language_codes(text: Column) -> Column:
    """Codes split at separators, or a run of three-letter codes cut up."""
    t = F.trim(F.coalesce(text, F.lit("")))
    return (
        F.when(t == "", F.array().cast("array<string>"))
        .when(t.rlike(r"[\s,;/]"), F.filter(F.split(t, r"[\s,;/]+"), lambda x: x != ""))
        .when(F.length(t) % 3 == 0, F.regexp_extract_all(t, F.lit(".{3}"), F.lit(0)))
        .otherwise(F.array(t))
    )


def name_list(text: Column) -> Column:
    """Comma-separated names without closing brackets and stops."""
    bare = F.regexp_replace(F.trim(text), r"[\].\s]+$", "")
    return F.filter(F.transform(F.split(bare, ","), lambda x: F.trim(x)), lambda x: x != "")


def join_lines(text: Column) -> Column:
    """Soft hyphens at line ends closed up, other line ends as blanks."""
    return F.regexp_replace(F.regexp_replace(text, r"(\p{L})-\n(\p{Ll})", "$1$2"), r"\s*\n\s*", " ")


def _recoded(text: Column) -> Column:
    def one(t: str) -> str:
        try:
            return t.encode("latin-1").decode("utf-8")
        except (UnicodeEncodeError, UnicodeDecodeError):
            return t

    @F.pandas_udf("string")
    def recoded(s: pd.Series) -> pd.Series:
        return s.map(one, na_action="ignore")

    return recoded(text)


def repair_encoding(text: Column) -> Column:
    """UTF-8 text once read as Latin-1, put right; anything else as it is.

    Only texts that could be such a misreading go through Python.
    """
    suspect = text.rlike(r"[\x{00C2}-\x{00F4}][\x{0080}-\x{00BF}]") & text.rlike(r"^[\x{0000}-\x{00FF}]*$")
    return F.when(suspect, _recoded(text)).otherwise(text)


def foreign_line(text: Column, stop_words: tuple[str, ...], least: int = 3, tokens: int = 4) -> Column:
    """Whether a line of ``tokens`` or more has ``least`` words of another language."""
    words = plain_words(text)
    return (F.size(words) >= tokens) & (F.size(F.filter(words, lambda w: w.isin(*stop_words))) >= least)


def size_label(size: Column) -> Column:
    """Bytes as B, KB or MB."""
    return (
        F.when(size < 1024, F.concat(size.cast("string"), F.lit(" B")))
        .when(size < 1024 * 1024, F.concat(F.format_number(size / 1024, 1), F.lit(" KB")))
        .otherwise(F.concat(F.format_number(size / (1024 * 1024), 1), F.lit(" MB")))
    )


def exact_median(values: Column) -> Column:
    """Middle value of an array; an even number of values gives the mean of two."""
    xs = F.array_sort(values)
    n = F.size(xs)
    mid = (n / 2).cast("int")
    return F.when(n == 0, None).when(n % 2 == 1, F.try_element_at(xs, mid + 1)).otherwise(
        (F.try_element_at(xs, F.greatest(mid, F.lit(1))) + F.try_element_at(xs, mid + 1)) / 2
    )


def lower_percentile(values: Column, share: float) -> Column:
    """The value at the floor of the fractional index."""
    xs = F.array_sort(values)
    return F.try_element_at(xs, F.greatest(F.floor(F.lit(share) * (F.size(xs) - 1)).cast("int") + 1, F.lit(1)))


# ---- text-layer quality -------------------------------------------------------


def layer_quality(text: Column, pages: Column, dictionary: tuple[str, ...]) -> Column:
    """none, poor or text: is a page text worth parsing?

    Few characters a page or few tokens: none.  Enough dictionary words and
    letters and little rubbish: text.  Else poor.
    """
    tokens = F.filter(F.split(F.trim(text), r"\s+"), lambda t: t != "")
    n = F.size(tokens)
    letters = F.length(F.regexp_replace(text, r"[^\p{L}\p{N}]", ""))
    solid = F.length(F.regexp_replace(text, r"\s", ""))
    known = F.size(F.filter(tokens, lambda t: F.regexp_replace(F.lower(t), "[^a-z]", "").isin(*dictionary)))
    rubbish = F.size(F.filter(tokens, lambda t: ~t.rlike(r"[A-Za-z0-9]")))
    per_page = solid / F.greatest(pages, F.lit(1))
    return (
        F.when((per_page < 80) | (n < 20), "none")
        .when((known / n >= 0.3) & (letters / F.greatest(solid, F.lit(1)) >= 0.8) & (rubbish / n <= 0.3), "text")
        .otherwise("poor")
    )
