import numpy as np
from pyspark.sql import functions as F

from docketry.operators import pages


def test_columns(spark):
    x0 = np.array([50.0] * 10 + [320.0] * 10)
    x1 = np.array([280.0] * 10 + [560.0] * 10)
    assert 280 <= pages.gutter(x0, x1, 600.0) <= 320 and pages.gutter(x0[:10], x1[:10], 600.0) is None
    rows = [("d", 1, i, float(a), float(b), float(i % 10), 600.0, f"t{i}") for i, (a, b) in enumerate(zip(x0, x1))]
    df = spark.createDataFrame(rows, "doc string, page int, line int, x0 double, x1 double, y double, width double, text string")
    out = pages.column_order(df).orderBy("reading").collect()
    assert [r.text for r in out] == [f"t{i}" for i in range(20)] and out[10].column == 1


def test_marker_repair(spark):
    rows = [("d", i, 10.0, t) for i, t in enumerate(["1. One", "Z. Two", "3. Three", "S. Alone", "text"])]
    out = pages.repaired_markers(spark.createDataFrame(rows, "doc string, position int, x0 double, text string")).orderBy("position").collect()
    assert [r.text for r in out] == ["1. One", "2. Two", "3. Three", "S. Alone", "text"] and [r.repaired for r in out] == [False, True, False, False, False]


def test_line_repair(spark):
    lines = ["The Genera1 Assernbly,", "The General Assembly,", "The committee met", "Requesfs a report", "Recalllng the past", "Decides well", "Requests all"]
    want = ["The General Assembly,", "The General Assembly,", "The committee met", "Requesfs a report", "Recalling the past", "Decides well", "Requests all"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "i int, text string")
    assert [r.text for r in pages.repaired_lines(df).orderBy("i").collect()] == want


def test_cropping_and_overreach(spark):
    text = ["1/9. Other", "The General Assembly,", "x", "1/10. Ours", "The General Assembly,", "body", "1/11. Next", "y"]
    rows = spark.createDataFrame([("d", i, t, "paragraph") for i, t in enumerate(text)] + [("e", 0, "no heading", "paragraph")], "doc string, position int, text string, type string")
    who = spark.createDataFrame([("d", "A/RES/1/10"), ("e", "A/RES/5/5")], "doc string, symbol string")
    out = pages.cropped(rows, who).orderBy("doc", "position").collect()
    assert [(r.doc, r.position, r.certain) for r in out] == [("d", 3, True), ("d", 4, True), ("d", 5, True), ("e", 0, False)]
    assert [r.position for r in pages.overreach(rows, who).orderBy("position").collect()] == [0, 6]
    keys = spark.createDataFrame([("S/RES/1881 (2009)",), ("A/RES/2625 (XXV)",), ("A/RES/60/1",)], "s string").select(pages.heading_keys(F.col("s")).alias("k"))
    assert [tuple(r.k) for r in keys.collect()] == [("old", "", "1881"), ("old", "", "2625"), ("new", "60", "1")]


def test_catalog_and_span(spark):
    assert pages.volume_catalog(spark).count() == 48 + 23
    words = "a b c start here x y end now z start here end now".split()
    assert pages.source_span(words, [(1, ["start", "here"], ["end", "now"])]) == (10, 14)
    assert pages.source_span(words, [(1, ["none"], ["end"]), (2, ["a"], ["c"])]) == (0, 3) and pages.source_span(words, []) is None
    df = spark.createDataFrame([("A/RES", "60", "1", "b")], "f string, s string, n string, l string")
    assert df.select(pages.child_symbol(*[F.col(c) for c in "fsnl"])).first()[0] == "A/RES/60/1B"
