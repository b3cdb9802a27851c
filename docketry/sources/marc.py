"""MARC records in XML: read, split, parsed and projected to catalogue columns.

Parsing uses ``from_xml`` in permissive mode, so a malformed record is one null row and
never fails the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.functions.text import catalog_date, clean_title, display_title, language_codes, normalize_symbol

RECORD = (
    "controlfield array<struct<_tag:string,_VALUE:string>>, "
    "datafield array<struct<_tag:string,_ind1:string,_ind2:string,subfield array<struct<_code:string,_VALUE:string>>>>, _bad string"
).replace("subfield array", "subfield:array")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(xml) one row a record of every response file, however the records are spread over lines."""
    return split_records(spark.read.text(path, wholetext=True))


def split_records(responses: DataFrame, column: str = "value") -> DataFrame:
    found = F.regexp_extract_all(F.col(column), F.lit(r"(?s)<(?:\w+:)?record(?=[\s>]).*?</(?:\w+:)?record>"), F.lit(0))
    return responses.select(F.explode(found).alias("xml"))


def _fields(tag: str) -> Column:
    return F.filter(F.coalesce("r.datafield", F.array().cast(_FIELDS)), lambda f: f["_tag"] == tag)


_FIELDS = "array<struct<_tag:string,_ind1:string,_ind2:string,subfield:array<struct<_code:string,_VALUE:string>>>>"


def _code(field: Column, code: str) -> Column:
    """First non-empty subfield of a field."""
    subs = F.filter(F.coalesce(field["subfield"], F.array().cast("array<struct<_code:string,_VALUE:string>>")), lambda s: (s["_code"] == code) & (F.trim(s["_VALUE"]) != ""))
    return F.trim(F.try_element_at(subs, F.lit(1))["_VALUE"])


def first(tag: str, code: str) -> Column:
    """First non-empty subfield over a tag's fields."""
    return F.try_element_at(every(tag, code), F.lit(1))


def every(tag: str, code: str) -> Column:
    """All non-empty subfields of a code, in order."""
    subs = F.flatten(F.transform(_fields(tag), lambda f: F.coalesce(f["subfield"], F.array().cast("array<struct<_code:string,_VALUE:string>>"))))
    return F.filter(
        F.transform(F.filter(subs, lambda s: s["_code"] == code), lambda s: F.trim(s["_VALUE"])), lambda v: v.isNotNull() & (v != "")
    )


def structs(tag: str, parts: dict[str, str], needs: tuple[str, ...] | None = None, ind1: str | None = None) -> Column:
    """One struct a field; kept if all of ``needs``, or any part, is there."""
    made = F.transform(
        _fields(tag),
        lambda f: F.struct(*[(F.nullif(F.trim(f["_ind1"]), F.lit("")) if code == "@1" else _code(f, code)).alias(name) for name, code in parts.items()]),
    )
    if needs:
        return F.filter(made, lambda s: sum((s[n].isNotNull().cast("int") for n in needs), F.lit(0)) == len(needs))
    return F.filter(made, lambda s: F.coalesce(*[s[n] for n in parts]).isNotNull())


def parse(records: DataFrame) -> DataFrame:
    """Catalogue rows of (xml); records whose control number is not all digits are left out."""
    bare = F.regexp_replace(F.regexp_replace("xml", r"<(/?)\w+:", "<$1"), r"\sxmlns(:\w+)?=\"[^\"]*\"", "")
    read = F.from_xml(bare, RECORD, {"columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE"})
    # Out of a generator, since the filter below would else be pushed under it and read every record a second time.
    parsed = records.select("xml", F.explode_outer(F.array(read)).alias("r"))
    number = F.try_element_at(F.filter("r.controlfield", lambda c: c["_tag"] == "001"), F.lit(1))["_VALUE"]
    rows = parsed.withColumn("__id", F.trim(number)).where(F.col("__id").rlike("^[0-9]+$"))
    out = rows.select(
        F.col("__id").cast("int").alias("recid"),
        first("191", "a").alias("document_symbol"), first("191", "b").alias("symbol_body"),
        first("191", "c").alias("symbol_session"), first("191", "d").alias("symbol_committee"),
        clean_title(first("245", "a"), first("245", "b")).alias("title"), first("239", "a").alias("title_other"),
        first("245", "c").alias("title_statement"), catalog_date(first("269", "a")).alias("date_publication"),
        first("260", "c").alias("date_text"), first("260", "b").alias("publisher"), first("260", "a").alias("pub_place"),
        first("300", "a").alias("physical_desc"), first("089", "b").alias("doc_class_code"), first("089", "a").alias("doc_class_desc"),
        language_codes(first("041", "a")).alias("languages"), every("650", "a").alias("subjects"),
        structs("710", {"name": "a", "type": "9"}, ("name",)).alias("corporate_authors"),
        first("981", "a").alias("un_body"), first("981", "b").alias("un_committee"), every("500", "a").alias("notes"),
        first("520", "a").alias("summary"), structs("856", {"url": "u", "lang": "y", "size": "s", "uuid": "9"}, ("url",)).alias("files"),
        every("980", "a").alias("collections"), first("989", "a").alias("resource_type"), first("989", "b").alias("resource_subtype"),
        first("996", "a").alias("vote_summary"), structs("991", {"doc": "a", "item": "b", "desc": "c", "topic": "d"}).alias("agenda_items"),
        structs("993", {"symbol": "a", "relationship": "@1"}, ("symbol",)).alias("related_documents"), F.col("xml").alias("marcxml"),
    )
    return out.withColumns(
        {"symbol_normalized": normalize_symbol(F.col("document_symbol")), "display_title": display_title(F.col("title"), F.col("title_other"))}
    )


def english_pdf(files: Column) -> Column:
    """Address of the first English PDF of a record's files."""
    fit = F.filter(files, lambda f: (f["lang"] == "English") & f["url"].endswith(".pdf"))
    return F.try_element_at(fit, F.lit(1))["url"]
