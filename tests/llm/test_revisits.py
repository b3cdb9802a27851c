import random
from datetime import datetime, timedelta

from docketry.llm import revisits

SCHEMA = "id long, url string, ts timestamp, revisit boolean, etag string, last_modified string, digest string, headers map<string,string>, site string"


def at(s):
    return datetime(2024, 1, 1) + timedelta(seconds=s)


def row(i, url, s, revisit, etag=None, modified=None, digest=None, headers=None):
    return (i, url, None if s is None else at(s), revisit, etag, modified, digest, headers, "x")


def test_canonical(spark):
    from pyspark.sql import functions as F

    pairs = {
        "HTTP://www.Site.example:80/a/#top": "site.example/a", "https://site.example/a?utm_source=x&b=2&a=1": "site.example/a?a=1&b=2",
        "https://site.example": "site.example", "http://user@site.example/index.html": "site.example", "https://m.site.example/A": "m.site.example/A",
    }
    df = spark.createDataFrame([(u,) for u in pairs], "u string").select("u", revisits.canonical(F.col("u")).alias("c"))
    assert {r.u: r.c for r in df.collect()} == pairs


def test_resolution(spark):
    rows = [
        row(1, "http://a.example/x", 0, False, '"one"', headers={"Content-Type": "t", "Cache-Control": "old", "ETag": '"one"'}),
        row(2, "https://www.a.example/x#f", 50, True, 'W/"one"', headers={"Content-Type": "z", "cache-control": "new", "Connection": "close"}),
        row(3, "http://a.example/x", 60, False, '"two"', modified="m1", digest="d"),
        row(4, "http://a.example/x", 60, True, '"one"'), row(5, "http://a.example/x", 400_000, True, '"one"'),
        row(6, "http://a.example/x", 400_000, True, None, "m1"), row(7, "http://a.example/x", 400_001, True, None, None, "d"),
        row(8, "http://a.example/x", 61, True), row(9, "http://b.example/", 9, True, '"one"'), row(10, None, 9, True, '"one"'),
        row(11, "http://a.example/x", None, True, '"one"'), row(12, "http://a.example/x", 60, False, '"three"'),
        row(13, "http://a.example/x", 70, True, '"three"'),
    ]
    out = {r.revisit_id: r for r in revisits.resolve(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {i: (r.response_id, r.verdict) for i, r in out.items()} == {
        2: (1, "etag"), 4: (1, "etag"), 5: (12, "mismatch"), 6: (12, "no_validator"), 7: (12, "no_validator"), 8: (12, "no_validator"),
        9: (None, "no_response"), 10: (None, "no_response"), 11: (None, "no_response"), 13: (12, "etag"),
    }
    assert out[2].headers == {"content-type": "t", "cache-control": "new", "etag": '"one"'}
    assert out[5].headers is None


def test_against_brute_force_with_a_hot_url(spark):
    rng = random.Random(4)
    rows = [row(i, f"http://h.example/{rng.choice('aaaab')}", rng.randrange(900_000), rng.random() < 0.5, rng.choice(["x", "y"])) for i in range(500)]
    out = {r.revisit_id: (r.response_id, r.verdict) for r in revisits.resolve(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = {}
    for r in rows:
        if r[3]:
            full = [f for f in rows if not f[3] and f[1] == r[1] and f[2] < r[2]]
            best = max(full, key=lambda f: (f[2], f[0]), default=None)
            want[r[0]] = (best and best[0], "no_response" if not best else "etag" if best[4] == r[4] else "mismatch")
    assert out == want


def test_repeated_header_names_and_long_values(spark):
    rows = [
        row(1, "http://a.example/" + "x" * 50_000, 0, False, '"e"', headers={"ETag": "b", "etag": "c", "ETAG": "a", "Via": "v" * 50_000, "N": None}),
        row(2, "http://a.example/" + "x" * 50_000, 5, True, '"e"', headers={"VIA": "new", "via": "old"}),
        row(3, None, 5, True), row(4, None, None, True), row(5, None, 5, False), (6, "u", at(1), None, None, None, None, None, "x"),
        row(2, "http://a.example/" + "x" * 50_000, 5, True, '"e"', headers={"VIA": "new", "via": "old"}),
    ]
    out = revisits.resolve(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r.revisit_id for r in out) == [2, 2, 3, 4]
    for r in out:
        if r.revisit_id == 2:
            assert r.headers == {"etag": "a", "via": "new", "n": None}
        else:
            assert (r.verdict, r.response_id, r.headers) == ("no_response", None, None)


def test_empty_table(spark):
    assert revisits.resolve(spark.createDataFrame([], SCHEMA)).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert revisits.digest(revisits.resolve(revisits.captures(pages))).count() == 0
