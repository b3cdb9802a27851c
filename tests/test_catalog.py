from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from docketry.operators import catalog, ledger, upserts, usage

SCHEMA = "recid int, symbol string, title string, body string, kind string, languages array<string>, subjects array<string>, published date, deleted_at timestamp"


@pytest.fixture
def docs(spark):
    rows = [
        (1, "A/RES/1", "Peace and 100% law", "GA", "res", ["eng"], ["law"], date(2020, 1, 1), None),
        (2, "A/RES/2", "About A/RES/1", "GA", "res", ["eng", "fre"], [], date(2021, 5, 1), None),
        (3, "S/RES/3", "peace talks", "SC", "res", [], ["peace"], None, None),
        (4, None, "no symbol peace", None, "dec", ["fre"], [], date(2022, 2, 2), None),
        (5, "A/RES/1", "gone", "GA", "res", ["eng"], [], date(2023, 1, 1), datetime(2024, 1, 1)),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def ids(df):
    return [r.recid for r in df.collect()]


def test_filters_and_sorts(docs):
    f = catalog.Filters
    assert ids(catalog.page(docs, f(q="peace"))) == [4, 1, 3]
    assert ids(catalog.page(docs, f(q="A/RES/1"), "relevance")) == [1, 2]
    assert ids(catalog.page(docs, f(language="fre"), "date_asc")) == [2, 4]
    assert ids(catalog.page(docs, f(subject="law", body="GA"))) == [1]
    assert ids(catalog.page(docs, f(since=date(2021, 1, 1), until=date(2021, 12, 31)))) == [2]
    assert ids(catalog.page(docs, f(), "symbol_asc", 2, 2)) == [3, 4]
    assert ids(catalog.page(docs, f(q=catalog.literal("100%")))) == [1] and ids(catalog.page(docs, f(q=catalog.literal("1_0")))) == []
    assert ids(catalog.page(docs, f(q="1_0%"))) == [1]
    assert catalog.envelope(docs, f(), 3).first()[:] == (4, 3, 2) and catalog.envelope(docs, f(body="none")).first().total_pages == 1
    for bad in (dict(number=0), dict(size=101)):
        with pytest.raises(ValueError):
            catalog.page(docs, f(), **bad)
    with pytest.raises(ValueError):
        f(q="x")


def test_lookups(docs):
    assert ids(catalog.by_symbol(docs, "a/res/1")) == [1] and ids(catalog.by_id(docs, 5)) == []
    assert ids(catalog.suggest(docs, "A/RES")) == [2, 1] and ids(catalog.suggest(docs, "peace")) == [1, 3, 4]
    assert ids(catalog.latest_per_key(docs, ["symbol"], [F.desc("recid")]).orderBy("recid")) == [2, 3, 4, 5]


def test_facets_and_stats(docs):
    got = {(r.facet, r.value): r.n for r in catalog.facets(docs, catalog.Filters()).collect()}
    assert got[("body", "GA")] == 2 and got[("language", "eng")] == 2 and got[("year", "2020")] == 1 and ("body", None) not in got
    s = catalog.statistics(docs).first()
    assert (s.documents, s.bodies, s.kinds, s.last_date) == (4, 2, 2, date(2022, 2, 2))


def test_citations(spark):
    rows = spark.createDataFrame([("a/1", 2), ("A/1", 3), ("A /1", 3), ("B", 9), ("C", 1)], "form string, n long")
    out = catalog.citation_rank(rows, 2, spark.createDataFrame([("c",), ("z",)], "symbol string")).collect()
    assert [(r.symbol, r.label, r.citations, r["rank"]) for r in sorted(out, key=lambda r: (r["rank"] or 9, r.symbol))] == [
        ("B", "B", 9, 1), ("A/1", "A/1", 8, 2), ("C", "C", 1, None), ("Z", "Z", 0, None)]


def test_upserts(spark, tmp_path):
    t = spark.createDataFrame([(1, "a", 1), (2, "b", None), (3, "c", 3)], "k int, v string, n int")
    b = spark.createDataFrame([(2, "B", 5), (4, "D", 6)], "k int, v string, n int")
    rows = lambda d: sorted(tuple(r) for r in d.collect())
    assert rows(upserts.upsert(t, b, ["k"])) == [(1, "a", 1), (2, "B", 5), (3, "c", 3), (4, "D", 6)]
    part = upserts.partial_upsert(t, spark.createDataFrame([(1, None), (9, "x")], "k int, v string"), ["k"], ["v"])
    assert {(r.k, r.v, r.n) for r in part.collect()} == {(1, None, 1), (2, "b", None), (3, "c", 3), (9, "x", None)}
    with pytest.raises(ValueError):
        upserts.partial_upsert(t, b, ["k"], ["nope"])
    new = spark.createDataFrame([(1, "a", 1), (2, "b", 7), (5, "e", 0)], "k int, v string, n int")
    assert {(r.k, r.action) for r in upserts.changed_upsert(t, new, ["k"], ["v", "n"]).collect()} == {(1, "keep"), (2, "update"), (5, "insert")}
    assert rows(upserts.prune(t, b, ["k"])) == [(2, "b", None)]
    assert [r.k for r in upserts.retire(t, spark.createDataFrame([(1,), (3,)], "k int"), spark.createDataFrame([(3,)], "k int"), ["k"]).orderBy("k").collect()] == [2, 3]
    fixed = upserts.repair(t, {"v": F.upper("v")}).orderBy("k").collect()
    assert [(r.v, r.changed) for r in fixed] == [("A", True), ("B", True), ("C", True)]
    path = str(tmp_path / "t")
    upserts.replace_table(t, path)
    upserts.replace_table(upserts.upsert(spark.read.parquet(path), b, ["k"]), path)
    assert spark.read.parquet(path).count() == 4


def test_rate_windows(spark):
    start = datetime(2024, 1, 31, 23, 59, 50)
    rows = [(i, "key:a", "anonymous", start + timedelta(seconds=i)) for i in range(30)]
    events = spark.createDataFrame(rows, "event_id int, caller string, tier string, ts timestamp")
    out = usage.decisions(events).orderBy("event_id").collect()
    assert [r["count"] for r in out] == [*range(1, 11), *range(1, 21)]
    assert [r.allowed for r in out] == [True] * 20 + [False] * 10 and out[-1].remaining == 0
    both = {r.window_start: r["count"] for r in usage.rate_windows(events).collect()}
    assert sorted(both.values()) == [10, 20]
    now = datetime(2024, 2, 1, 0, 0, 5)
    assert tuple(usage.today_and_month(events, now).first())[1:] == (6, 6)
    assert {r.day: r.n for r in usage.daily(events, now).collect()} == {date(2024, 1, 31): 10, date(2024, 2, 1): 6}
    assert usage.expire(usage.rate_windows(events), now + timedelta(minutes=59)).count() == 1
    who = events.select(usage.caller(F.lit(None).cast("string"), F.lit("1.2.3.4, 5.6.7.8")).alias("c")).first().c
    assert who == "ip:1.2.3.4"


def test_ledger(spark, docs):
    led = spark.createDataFrame([("A/RES/2", None, "p2", "s2", "parsed", "docx"), ("V", None, "pv", "sv", "split", "pdf"), ("V1", "V", None, None, "extracted", None)],
                                "symbol string, source_symbol string, archive_path string, sha256 string, status string, format string")
    assert [r.symbol for r in ledger.targets(docs, led, date(2020, 1, 1)).collect()] == ["A/RES/1"]
    assert [r.symbol for r in ledger.targets(docs, led, date(2020, 1, 1), before=True).collect()] == ["S/RES/3"]
    files = {r.symbol: r.archive_path for r in ledger.source_files(led).collect()}
    assert files == {"A/RES/2": "p2", "V": "pv", "V1": "pv"}
    done = spark.createDataFrame([("A/RES/2", False), ("V1", False)], "symbol string, ok boolean")
    assert {r.symbol: r.status for r in ledger.settle(led, done).collect()} == {"A/RES/2": "parsed", "V": "split", "V1": "parse_failed"}
    want = spark.createDataFrame([("A",), ("A [I]",), ("B [I]",), ("B [II]",), ("C [I]",)], "symbol string")
    held = spark.createDataFrame([("C",)], "symbol string")
    assert sorted(r.symbol for r in ledger.collapse_brackets(want, held).collect()) == ["A", "B"]
    kids = spark.createDataFrame([(1, ["A/DEC/9", "A/RES/1"]), (2, ["A/RES/2"]), (3, ["x"])], "key int, candidates array<string>")
    assert {(r.key, r.symbol, r.route) for r in ledger.route(kids, docs).collect()} == {(1, "A/RES/1", "cross_check"), (2, "A/RES/2", "cross_check"), (3, None, "unmatched")}


def test_volume_split(spark):
    text = ["contents", "1/1. First", "body", "Resolution adopted", "1/2. Second", "more", "x", "1/1. First", "Resolution adopted", "a", "b", "c"]
    rows = spark.createDataFrame([("V", i, t) for i, t in enumerate(text)], "doc string, position int, text string")
    number = F.regexp_extract("text", r"^(\d+/\d+)\.", 1)
    out = ledger.split_volume(rows, F.col("text").rlike(r"^\d+/\d+\."), F.col("text") == "Resolution adopted", F.concat(F.lit("R/"), number), reach=3)
    # 1/1 is found twice, the longer slice stays; 1/2 has no adoption line of its own within reach.
    assert {(r.child, r.start, r.n) for r in out.collect()} == {("R/1/1", 7, 5)}


def test_interrupted_swaps_lose_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    old, new = (spark.createDataFrame([(1, v), (2, v)], "k int, v string") for v in ("old", "new"))
    seen = lambda: sorted(r.v for r in upserts.stored(spark, path).collect())
    assert upserts.stored(spark, path) is None
    upserts.replace_table(old, path)
    # Before the swap: an unfinished new table beside the old one.
    (tmp_path / "t.next").mkdir()
    assert seen() == ["old", "old"]
    # Between the renames, the new table complete.
    new.write.mode("overwrite").parquet(path + ".next")
    (tmp_path / "t").rename(tmp_path / "t.old")
    assert seen() == ["new", "new"]
    # Between the renames, the new table gone.
    (tmp_path / "t").rename(tmp_path / "t.old2")
    assert seen() == ["old", "old"]
    upserts.replace_table(upserts.upsert(upserts.stored(spark, path), new.where("k = 1"), ["k"]), path)
    assert seen() == ["new", "old"]


def test_reports(spark, tmp_path):
    from pyspark.sql import functions as F

    from docketry.operators import reports

    df = spark.createDataFrame([(2, "b\tc", [1]), (1, None, []), (3, "x|y", None)], "k int, v string, a array<int>")
    reports.write_tsv(df, str(tmp_path / "t"), [F.col("k")])
    part = next((tmp_path / "t").glob("part-*")).read_text().splitlines()
    assert part == ["k\tv\ta", "1\t\t[]", "2\tb c\t[1]", "3\tx|y\t"]
    reports.write_json(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).orderBy("k").first().asDict() == {"k": 1, "v": None, "a": []}
    assert reports.markdown(df, [F.col("k")], 2) == "|k|v|a|\n|-|-|-|\n|1||[]|\n|2|b c|[1]|\n\n1 more rows\n"


def test_readable_sources(spark, tmp_path):
    from docketry.sources import files

    spark.range(3).write.parquet(str(tmp_path / "p"))
    got = files.readable(lambda: spark.read.parquet(str(tmp_path / "none")), lambda: spark.read.parquet(str(tmp_path / "p")))
    assert got.count() == 3 and files.readable(lambda: spark.table("no_such_table")) is None
