"""Catalogue views and queries: filters, search, facets, statistics, lookups.

Every function takes and returns lazy DataFrames, so filters and columns reach the
scan.  Orders are total (the id breaks ties), so pages do not overlap.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SORTS = ("date_desc", "date_asc", "symbol_asc", "relevance")


def live(docs: DataFrame) -> DataFrame:
    """The rows that are not soft-deleted."""
    return docs.where("deleted_at IS NULL") if "deleted_at" in docs.columns else docs


@dataclass(frozen=True)
class Filters:
    """Optional predicates, all of which must hold.

    ``q`` is matched as a pattern: per cent and underscore are wildcards, as in the
    stored queries; :func:`literal` turns them into plain characters.
    """

    q: str | None = None
    symbol: str | None = None
    body: str | None = None
    kind: str | None = None
    subject: str | None = None
    language: str | None = None
    since: date | None = None
    until: date | None = None

    def __post_init__(self) -> None:
        if self.q is not None and len(self.q) < 2:
            raise ValueError("q needs two characters or more")

    def conditions(self) -> list[Column]:
        out: list[Column] = []
        if self.q:
            out.append(F.col("symbol").ilike(self.q + "%") | F.col("title").ilike("%" + self.q + "%"))
        if self.symbol:
            out.append(F.col("symbol").ilike(self.symbol + "%"))
        if self.body:
            out.append(F.col("body") == self.body)
        if self.kind:
            out.append(F.col("kind") == self.kind)
        if self.subject:
            out.append(F.array_contains("subjects", self.subject))
        if self.language:
            out.append(F.array_contains("languages", self.language))
        if self.since:
            out.append(F.col("published") >= F.lit(self.since))
        if self.until:
            out.append(F.col("published") <= F.lit(self.until))
        return out

    def apply(self, docs: DataFrame) -> DataFrame:
        found = self.conditions()
        return docs.where(reduce(lambda a, b: a & b, found)) if found else docs


def literal(q: str) -> str:
    """A search text whose wildcards stand for themselves."""
    return re.sub(r"([\\%_])", r"\\\1", q)


def ordering(sort: str, q: str | None, id_col: str = "recid") -> list[Column]:
    """Total order of a listing; unknown sorts are by date, newest first."""
    newest = [F.col("published").desc_nulls_last(), F.col(id_col).asc()]
    if sort == "date_asc":
        return [F.col("published").asc_nulls_last(), F.col(id_col).asc()]
    if sort == "symbol_asc":
        return [F.col("symbol").asc_nulls_last(), F.col(id_col).asc()]
    if sort == "relevance" and q:
        return [F.when(F.col("symbol").ilike(q + "%"), 1).otherwise(0).desc(), *newest]
    return newest


def page(docs: DataFrame, filters: Filters, sort: str = "date_desc", number: int = 1, size: int = 20) -> DataFrame:
    """One page of a listing."""
    if number < 1 or not 1 <= size <= 100:
        raise ValueError("pages count from 1 and hold 1 to 100 rows")
    found = filters.apply(live(docs)).orderBy(*ordering(sort, filters.q))
    return found.offset((number - 1) * size).limit(size)


def envelope(docs: DataFrame, filters: Filters, size: int = 20) -> DataFrame:
    """total, per_page and total_pages of a listing, in one row."""
    total = filters.apply(live(docs)).agg(F.count("*").alias("total"))
    return total.select(
        "total", F.lit(size).alias("per_page"), F.greatest(F.lit(1), F.ceil(F.col("total") / size)).cast("long").alias("total_pages")
    )


def looks_like_symbol(q: str, tokens: tuple[str, ...] = ("A", "S", "E", "ST")) -> bool:
    """Whether a search text is the start of a symbol, so titles need no scan."""
    return "/" in q or q.strip().upper().split(" ")[0] in tokens


def suggest(docs: DataFrame, q: str, size: int = 20, id_col: str = "recid") -> DataFrame:
    """Ranked completions: symbol prefix, then title prefix, then the rest; newest first."""
    in_symbol = F.col("symbol").ilike(q + "%") | (F.col(id_col).cast("string") == q)
    tier = F.when(F.col("symbol").ilike(q + "%"), 0).when(F.col("title").ilike(q + "%"), 1).otherwise(2)
    hit = in_symbol if looks_like_symbol(q) else in_symbol | F.col("title").ilike("%" + q + "%")
    return (
        live(docs).where(hit).withColumn("tier", tier)
        .orderBy("tier", F.col("published").desc_nulls_last(), id_col).limit(size)
    )


def by_symbol(docs: DataFrame, symbol: str, id_col: str = "recid") -> DataFrame:
    """The newest row of a symbol, whatever its case."""
    return (
        live(docs).where(F.upper("symbol") == symbol.upper())
        .orderBy(F.col("published").desc_nulls_last(), F.col(id_col).desc()).limit(1)
    )


def by_pattern(docs: DataFrame, q: str) -> DataFrame:
    """The rows whose symbol is ``q`` whatever its case; per cent and underscore in ``q`` are wildcards, none is added."""
    return live(docs).where(F.col("symbol").ilike(q))


# The columns of the list and of the detail view, the symbol under its short name.
SUMMARY = ("recid", "symbol", "title", "date_publication", "un_body", "resource_type", "languages", "summary")
DETAIL = (
    "recid", "symbol", "symbol_body", "symbol_session", "symbol_committee", "title", "title_statement", "date_publication", "date_text", "publisher",
    "pub_place", "physical_desc", "doc_class_code", "doc_class_desc", "languages", "subjects", "corporate_authors", "un_body", "un_committee", "notes",
    "summary", "files", "collections", "resource_type", "resource_subtype", "vote_summary", "agenda_items", "related_documents", "harvested_at",
)


def projected(records: DataFrame, names: tuple[str, ...] = SUMMARY) -> DataFrame:
    """Catalogue records (see ``sources.marc.parse``) in a view's columns; a column they lack is null."""
    have = {"symbol": "document_symbol"}
    return live(records).select(
        *[F.col(have.get(c, c)).alias(c) if have.get(c, c) in records.columns else F.lit(None).cast("timestamp").alias(c) for c in names]
    )


def latest_id(docs: DataFrame, id_col: str = "recid") -> DataFrame:
    """One row: the largest id, 0 of an empty catalogue."""
    return docs.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("latest"))


def validation(docs: DataFrame, top: int = 10) -> DataFrame:
    """(measure, n): rows in all, rows not deleted, and the largest bodies."""
    total = docs.agg(F.lit("total").alias("measure"), F.count("*").alias("n"))
    alive = live(docs).agg(F.lit("active").alias("measure"), F.count("*").alias("n"))
    bodies = live(docs).where("body IS NOT NULL").groupBy(F.concat(F.lit("body "), "body").alias("measure")).agg(F.count("*").alias("n"))
    return total.unionByName(alive).unionByName(bodies.orderBy(F.desc("n"), "measure").limit(top))


def by_id(docs: DataFrame, recid: int, id_col: str = "recid") -> DataFrame:
    return live(docs).where(F.col(id_col) == recid)


def latest_per_key(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of every key in an order (a group limit runs before the shuffle)."""
    numbered = rows.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return numbered.where("__n = 1").drop("__n")


def facets(docs: DataFrame, filters: Filters, limits: dict[str, int] | None = None) -> DataFrame:
    """(facet, value, n) of body, kind, language and year, from one scan.

    Every row is exploded into its facet values, so the filter and the scan run
    once; each facet keeps its largest values (years: the latest).
    """
    limits = limits or {"body": 50, "kind": 50, "language": 30, "year": 100}
    value = F.array(
        F.struct(F.lit("body").alias("facet"), F.col("body").alias("value")),
        F.struct(F.lit("kind").alias("facet"), F.col("kind").alias("value")),
        F.struct(F.lit("year").alias("facet"), F.year("published").cast("string").alias("value")),
    )
    spoken = F.transform(F.coalesce("languages", F.array().cast("array<string>")), lambda x: F.struct(F.lit("language").alias("facet"), x.alias("value")))
    counts = (
        filters.apply(live(docs))
        .select(F.explode(F.concat(value, spoken)).alias("f"))
        .select("f.facet", "f.value")
        .where("value IS NOT NULL")
        .groupBy("facet", "value")
        .agg(F.count("*").alias("n"))
    )
    first = F.when(F.col("facet") == "year", F.col("value")).desc_nulls_last()
    rank = F.row_number().over(Window.partitionBy("facet").orderBy(first, F.desc("n"), "value"))
    cap = F.create_map(*[F.lit(x) for kv in limits.items() for x in kv])[F.col("facet")]
    # The plain bound lets a group limit run before the shuffle; the facet's own comes after.
    return counts.withColumn("__r", rank).where((F.col("__r") <= max(limits.values())) & (F.col("__r") <= cap)).drop("__r")


def statistics(docs: DataFrame, harvested: str | None = None) -> DataFrame:
    """Size, date range and numbers of bodies and kinds of the catalogue, and the latest harvest where a column tells it."""
    more = [F.max(harvested).alias("last_harvested")] if harvested else []
    return live(docs).agg(
        *more,
        F.count("*").alias("documents"), F.min("published").alias("first_date"), F.max("published").alias("last_date"),
        F.count_distinct("body").alias("bodies"), F.count_distinct("kind").alias("kinds"),
    )


def hash_sample(rows: DataFrame, key: str, n: int, without: DataFrame | None = None) -> DataFrame:
    """A repeatable sample: the n smallest digests of a key, some keys set aside."""
    pool = rows if without is None else rows.join(without, key, "left_anti")
    return pool.orderBy(F.md5(F.col(key).cast("string")), key).limit(n)


def citation_rank(citations: DataFrame, top: int, extra: DataFrame | None = None) -> DataFrame:
    """(symbol, label, citations, rank): counts summed over spellings, the commonest spelling shown.

    ``citations``: form, n.  ``extra``: symbols that are listed whatever their rank.
    """
    from docketry.functions.text import normalize_symbol

    forms = citations.groupBy(normalize_symbol(F.col("form")).alias("symbol"), "form").agg(F.sum("n").alias("n"))
    ranked = forms.groupBy("symbol").agg(
        F.sum("n").alias("citations"), F.max_by("form", F.struct("n", "form")).alias("label")
    )
    best = ranked.orderBy(F.desc("citations"), "symbol").limit(top)
    best = best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("citations"), "symbol")).cast("long"))
    if extra is None:
        return best.select("symbol", "label", "citations", "rank")
    more = extra.select(normalize_symbol(F.col("symbol")).alias("symbol")).distinct().join(best, "symbol", "left_anti")
    more = more.join(ranked, "symbol", "left").select(
        "symbol", F.coalesce("label", "symbol").alias("label"), F.coalesce("citations", F.lit(0)).alias("citations"), F.lit(None).cast("long").alias("rank")
    )
    return best.select("symbol", "label", "citations", "rank").unionByName(more)
