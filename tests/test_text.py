import hashlib
import unicodedata
import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F

from docketry.functions import text as tx


def values(spark, f, inputs, kind="string"):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {kind}")
    return [r.v for r in rows.select("i", f(F.col("x")).alias("v")).orderBy("i").collect()]


CASES = [
    (tx.normalize_symbol, [" a/res/ 1 ", None], ["A/RES/1", None]),
    (tx.sanitize_symbol, ["A/RES/1 (II)"], ["A_RES_1__II_"]),
    (tx.strip_bracket, ["A/1 [Part I]", "A/1"], ["A/1", "A/1"]),
    (tx.symbol_family, ["S/PRST/1", "A/RES/2", "A/DEC/3", "x"], ["PRST", "RES", "DEC", "OTHER"]),
    (tx.squeeze, ["  a \tb\n c "], ["a b c"]),
    (tx.word_count, ["a b  c", " ", None, ""], [3, 0, 0, 0]),
    (tx.leading_marker, ["1. Go", "(iv) go", "1.2 go", "go", "12 go"], ["1.", "(iv)", "1.2", None, None]),
    (tx.roman_value, ["XIV", "iv", "abc", "MCMXC", ""], [14, 4, 0, 1990, 0]),
    (tx.alpha_ordinal, ["a", "z", "aa", "bb", "ab"], [1, 26, 27, 28, None]),
    (tx.language_codes, ["engfre", "eng fre", "en", "", None, "eng"], [["eng", "fre"], ["eng", "fre"], ["en"], [], [], ["eng"]]),
    (tx.catalog_date, ["2024-03-05x", "2023-07", "1994-02-30", "ca. 1987", "n.d.", None],
     [date(2024, 3, 5), date(2023, 7, 1), date(1994, 2, 1), date(1987, 1, 1), None, None]),
    (tx.name_list, ["Chad, Peru , .]", ""], [["Chad", "Peru"], []]),
    (tx.join_lines, ["inter-\nnational \n law", "A-\nB"], ["international law", "A- B"]),
    (tx.repair_encoding, ["FranÃ§ais", "plain", "Français", "日本", None], ["Français", "plain", "Français", "日本", None]),
    (tx.match_key, ["1. The  Board, (a) acts!", None], ["the board a acts", None]),
    (tx.heading_key, ["II. Budget ..... 12", "V.", "Title"], ["budget", "v.", "title"]),
    (tx.gate_tokens, ["Co-operate, don’t 3"], [["cooperate", "dont", "3"]]),
    (tx.plain_words, ["Été 3b, X"], [["t", "3b", "x"]]),
    (tx.metric_tokens, ["Ｗｏｒｄ don’t _x_ É 5", None], [["word", "don't", "x", "é", "5"], []]),
    (tx.size_label, ["500", "2048", "3145728"], ["500 B", "2.0 KB", "3.0 MB"]),
    (tx.key_prefix, ["abcdefghijklmnop"], ["abcdefghijkl"]),
]


@pytest.mark.parametrize(("f", "inputs", "want"), CASES, ids=[c[0].__name__ for c in CASES])
def test_functions(spark, f, inputs, want):
    g = (lambda x: f(x.cast("long"))) if f is tx.size_label else f
    assert values(spark, g, inputs) == want


def test_titles(spark):
    rows = [("Resolution 5 (1999)", "Peace"), ("Peace resolution.", None), ("Budget decision", "x"), ("", "Other"), (None, None), ("Statement", "")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, t string, o string")
    got = [r.v for r in df.select("i", tx.display_title(F.col("t"), F.col("o")).alias("v")).orderBy("i").collect()]
    assert got == ["Peace", "Peace resolution", "Budget", "Other", None, "Statement"]
    made = df.select(tx.clean_title(F.lit("A title :"), F.lit("part /")).alias("v"), tx.clean_title(F.lit(None).cast("string")).alias("w")).first()
    assert (made.v, made.w) == ("A title part", None)


def test_arrays(spark):
    df = spark.createDataFrame([([14, 15, 16, 20, 15],), ([],), ([3],)], "x array<int>")
    assert [r[0] for r in df.select(tx.compress_positions(F.col("x"))).collect()] == ["14-16, 20", "", "3"]
    df = spark.createDataFrame([([5.0, 1.0, 3.0, 2.0],), ([2.0],), ([],)], "x array<double>")
    assert [r[0] for r in df.select(tx.exact_median(F.col("x"))).collect()] == [2.5, 2.0, None]
    assert [r[0] for r in df.select(tx.lower_percentile(F.col("x"), 0.9)).collect()] == [3.0, 2.0, None]


def test_element_id_is_a_name_uuid(spark):
    df = spark.createDataFrame([("A/1", "en", 7)], "s string, l string, p int")
    got = df.select(tx.element_id(F.col("s"), F.col("l"), F.col("p"))).first()[0]
    assert got == str(uuid.uuid5(uuid.NAMESPACE_URL, "A/1:en:7"))


def test_headings(spark):
    df = spark.createDataFrame([("II. Scope",), ("Goal 3. Water",), ("IV Peace",), ("Plain",)], "x string")
    assert [tuple(r[0]) for r in df.select(tx.heading_parts(F.col("x"))).collect()] == [("II.", "Scope"), ("Goal 3.", "Water"), ("IV", "Peace"), (None, "Plain")]
    df = spark.createDataFrame([("Annex II - Rules",), ("Appendix",)], "x string")
    assert [tuple(r[0]) for r in df.select(tx.annex_parts(F.col("x"))).collect()] == [("Annex", "II", "Rules"), ("Appendix", None, None)]


def test_layer_quality(spark):
    words = ("the", "of", "and", "law")
    good, poor = "the law of the land and the law " * 30, "qx zj vv kk pp ww rr tt yy uu " * 20
    df = spark.createDataFrame([(good, 1), (poor, 1), ("short", 1)], "t string, p int")
    assert [r[0] for r in df.select(tx.layer_quality(F.col("t"), F.col("p"), words)).collect()] == ["text", "poor", "none"]


def test_metrics(spark):
    from docketry.operators.metrics import text_metrics

    rows = [("d", 2, "paragraph", "Ｓｅｃｏｎｄ"), ("d", 1, "title", "First’s É"), ("d", 3, "footnote", "no"), ("d", 4, "heading", ""), ("e", 1, "paragraph", " ")]
    out = {r.doc: r for r in text_metrics(spark.createDataFrame(rows, "doc string, position int, type string, text string")).collect()}
    stream = "first's é second"
    assert out["d"].token_text == stream == " ".join(unicodedata.normalize("NFKC", stream).split())
    assert (out["d"].word_count, out["d"].element_count) == (3, 3) and out["e"].content_sha256 is None
    assert out["d"].content_sha256 == hashlib.sha256(stream.encode()).hexdigest()
