"""Web-archive revisit resolution.

A not-modified revisit record has headers but no body.  It is resolved by an
as-of join: the latest full response of the same canonical URL strictly before
it.  The pair stands if a validator agrees (entity tag by weak comparison, else
last-modified, else payload digest; the first that both sides have decides), and
then the revisit's headers update the stored ones as a cache would do it: every
header of the revisit but those that describe the connection or the stored body.

Scale: no self-join.  Records are put in time buckets; within (URL, bucket) a
running window finds the response, and what is not found there is carried over
from the buckets before, of which only one row each (the latest response) is kept.  So a
URL with a third of all rows is spread over its buckets.

Defined cases: records with a null URL or time resolve nothing and are never a
source; of responses at one time the largest id counts; a revisit without a
validator in common, or with a differing one, is reported as ``no_validator`` or
``mismatch`` with its candidate; one without an earlier response as ``no_response``;
repeated rows are resolved each; null header maps are empty; of header names that
differ in case alone the first in code point order counts; URLs and values of any length
are compared whole; a null ``revisit`` mark is no revisit and no source; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry.llm.spans import bound

# Headers of a not-modified answer that never replace stored ones.
KEPT_FROM_RESPONSE: tuple[str, ...] = (
    "connection", "content-encoding", "content-length", "content-location", "content-md5", "content-range",
    "content-type", "keep-alive", "proxy-authenticate", "proxy-authorization", "proxy-connection", "te",
    "trailer", "transfer-encoding", "upgrade",
)
# Query parameters that name no other document.
TRACKING = r"^(?:utm_[a-z]+|gclid|fbclid|ref|sessionid|phpsessid)(?:=|$)"


def canonical(url: Column) -> Column:
    """Host and path without scheme, www., default port, fragment, tracking and order of parameters."""
    bare = F.regexp_replace(F.trim(url), "#.*$", "")
    rest = F.regexp_replace(bare, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    site = F.lower(F.regexp_extract(rest, "^([^/?]*)", 1))
    site = F.regexp_replace(F.regexp_replace(site, "^[^@]*@", ""), "^www[0-9]*\\.", "")
    site = F.regexp_replace(site, ":(?:80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, "^[^/?]*([^?]*)", 1), "(?:/index\\.html?)?/*$", "")
    query = F.regexp_extract(rest, "\\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(p).rlike(TRACKING)))
    return F.concat(site, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def lowered(headers: Column) -> Column:
    """Headers by lower-case name; of names that differ in case alone the first in code point order counts."""
    pairs = F.transform(
        F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))),
        lambda e: F.struct(F.lower(e["key"]).alias("name"), e["key"].alias("own"), e["value"].alias("value")),
    )
    return bound(
        F.array_sort(pairs),
        lambda all_: F.map_from_entries(
            F.transform(
                F.filter(all_, lambda e, i: (i == 0) | (e["name"] != F.get(all_, i - 1)["name"])),
                lambda e: F.struct(e["name"].alias("key"), e["value"].alias("value")),
            )
        ),
    )


def merged(stored: Column, fresh: Column) -> Column:
    """Stored headers updated by the permitted ones of a not-modified answer."""
    update = F.map_filter(lowered(fresh), lambda k, v: ~k.isin(*KEPT_FROM_RESPONSE))
    return bound(update, lambda u: F.map_concat(F.map_filter(lowered(stored), lambda k, v: ~F.map_contains_key(u, k)), u))


def resolve(records: DataFrame, bucket_seconds: int = 86_400) -> DataFrame:
    """One row per revisit record, with its response and merged headers.

    ``records``: id, url, ts (timestamp), revisit (boolean), etag, last_modified,
    digest, headers (map of strings).
    """
    rows = records.select(
        "id", canonical(F.col("url")).alias("site"), "ts", "revisit", "etag", "last_modified", "digest", "headers",
        F.floor(F.unix_micros("ts") / (1_000_000 * bucket_seconds)).alias("bucket"),
    )
    full = F.when(
        ~F.col("revisit") & F.col("ts").isNotNull() & F.col("site").isNotNull(),
        F.struct("ts", "id", "etag", "last_modified", "digest", "headers"),
    )
    rows = rows.withColumn("full", full)
    # Without a URL or a time nothing is looked up: such rows stay out of the windows.
    placed = F.col("site").isNotNull() & F.col("ts").isNotNull()
    lone, rows = rows.where(~placed & F.col("revisit")), rows.where(placed)
    inside = (
        Window.partitionBy("site", "bucket")
        .orderBy("ts", F.col("revisit").desc(), "id")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = rows.withColumn("found", F.last("full", ignorenulls=True).over(inside)).where("revisit")
    latest = rows.where("full IS NOT NULL").groupBy("site", "bucket").agg(
        F.max_by("full", F.struct("ts", "id")).alias("full")
    )
    # Carried into a bucket: the latest response of the nearest earlier bucket with one.
    asked = rows.where("revisit").select("site", "bucket").distinct()
    marks = latest.join(asked, ["site", "bucket"], "full_outer")
    before = Window.partitionBy("site").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = marks.select("site", "bucket", F.last("full", ignorenulls=True).over(before).alias("carried"))
    both = local.join(carried, ["site", "bucket"], "left").withColumn("r", F.coalesce("found", "carried")).drop("found", "carried")
    both = both.unionByName(lone.withColumn("r", F.lit(None).cast(both.schema["r"].dataType)))

    def tag(c: str) -> Column:
        return F.regexp_replace(F.col(c), "^W/", "")

    known = (
        F.when(F.col("etag").isNotNull() & F.col("r.etag").isNotNull(), F.when(tag("etag") == tag("r.etag"), "etag").otherwise("mismatch"))
        .when(
            F.col("last_modified").isNotNull() & F.col("r.last_modified").isNotNull(),
            F.when(F.col("last_modified") == F.col("r.last_modified"), "last_modified").otherwise("mismatch"),
        )
        .when(
            F.col("digest").isNotNull() & F.col("r.digest").isNotNull(),
            F.when(F.col("digest") == F.col("r.digest"), "digest").otherwise("mismatch"),
        )
        .otherwise("no_validator")
    )
    verdict = F.when(F.col("r").isNull(), "no_response").otherwise(known)
    stands = verdict.isin("etag", "last_modified", "digest")
    return both.select(
        F.col("id").alias("revisit_id"), "site", F.col("ts").alias("revisit_ts"), F.col("r.id").alias("response_id"),
        F.col("r.ts").alias("response_ts"), verdict.alias("verdict"),
        F.when(stands, merged(F.col("r.headers"), F.col("headers"))).alias("headers"),
    )


def captures(pages: DataFrame) -> DataFrame:
    """Archive records of a crawl of ``pages(page_id, url, html)``.

    Every page is fetched once, a minute after the page before it, and asked for
    again some minutes later; one answer in five comes with a changed entity tag,
    one in seven without any.
    """
    p = F.col("page_id")
    etag = F.concat(F.lit('"'), F.substring(F.md5(F.coalesce("html", F.lit(""))), 1, 16), F.lit('"'))
    size = F.length(F.coalesce("html", F.lit("")))

    def header(*kv: Column) -> Column:
        return F.create_map(*kv)

    first = F.struct(
        (p * 2).alias("id"), F.col("url").alias("url"), F.timestamp_seconds(p * 60).alias("ts"), F.lit(False).alias("revisit"),
        etag.alias("etag"), F.lit(None).cast("string").alias("last_modified"),
        F.sha1(F.coalesce("html", F.lit(""))).alias("digest"),
        header(
            F.lit("Content-Type"), F.lit("text/html"), F.lit("Content-Length"), size.cast("string"),
            F.lit("Cache-Control"), F.concat(F.lit("max-age="), (p % 7).cast("string")), F.lit("ETag"), etag,
        ).alias("headers"),
    )
    again = F.struct(
        (p * 2 + 1).alias("id"), F.col("url").alias("url"),
        F.timestamp_seconds(p * 60 + 30 + 60 * (p % 5000)).alias("ts"), F.lit(True).alias("revisit"),
        F.when(p % 7 == 6, F.lit(None).cast("string")).when(p % 5 == 4, F.lit('"changed"')).otherwise(F.concat(F.lit("W/"), etag)).alias("etag"),
        F.lit(None).cast("string").alias("last_modified"),
        F.when(p % 2 == 0, F.sha1(F.coalesce("html", F.lit("")))).alias("digest"),
        header(
            F.lit("Content-Length"), F.lit("0"), F.lit("Cache-Control"), F.lit("max-age=60"), F.lit("Connection"), F.lit("close"),
        ).alias("headers"),
    )
    return pages.select(F.explode(F.array(first, again)).alias("r")).select("r.*")


def digest(resolved: DataFrame) -> DataFrame:
    """The resolution with times as seconds and headers as one sorted string."""
    shown = F.array_join(
        F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "; "
    )
    return resolved.select(
        "revisit_id", "site", F.unix_seconds("revisit_ts").alias("revisit_s"), "response_id",
        F.unix_seconds("response_ts").alias("response_s"), "verdict", shown.alias("headers"),
    )
