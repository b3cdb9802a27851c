"""What lets a query grow with its input: how rows are dealt out, and how much of them moves."""

import re

import pytest

from docketry.operators import audits, bags, pages, sequences
from docketry.plans import operator_queries as cq


def exchanges(df):
    return len(re.findall(r"\bExchange (?:hash|range|Single|RoundRobin)", df._jdf.queryExecution().executedPlan().toString()))


def lines(spark, docs):
    rows = [(d, i, t) for d, ts in docs.items() for i, t in enumerate(ts)]
    return bags.token_lines(spark.createDataFrame(rows, "doc string, position int, text string"), "doc", "position", "text")


def test_texts_move_once(spark, data):
    """every run of neighbours crossed an exchange, at 40 times the input."""
    df = cq.QUERIES["conservation_gate"](spark, data)
    assert exchanges(df) == 1 and "Window" not in df._jdf.queryExecution().executedPlan().toString()


def test_gate_of_lines_and_of_tokens(spark):
    source = {"d": ["The com mittee met", "over kerb", ""], "e": ["one two three"], "n": ["..."]}
    parsed = {"d": ["The committee met", "overkerb zebra"], "f": ["never asked"]}
    as_tokens = lambda t: t.where("line <> ''").selectExpr("doc", "posexplode(split(line, ' ')) AS (q, tok)", "k").selectExpr("doc", "k * 100 + q AS k", "tok")
    a, b = lines(spark, source), lines(spark, parsed)
    want = [("d", 6, 0, 1, 100.0, "fail"), ("e", 3, 3, 0, 0.0, "fail")]
    for x, y in ((a, b), (as_tokens(a), as_tokens(b)), (a, as_tokens(b))):
        assert sorted(map(tuple, bags.conservation(x, y).collect())) == want


def test_line_is_the_tokens(spark):
    from docketry.functions import text as tx

    rows = [("Co-operation’s  THE end.",), ("",), (None,), (" ... ",), ("Straße 3b–c naïve İx",), ("\ta_b\u00a0c\u2011d",)]
    df = spark.createDataFrame(rows, "t string").select(tx.gate_line("t").alias("line"), tx.gate_tokens("t").alias("toks"))
    assert all(r.line.split(" ") == (r.toks or [""]) for r in df.collect())


def test_difference_moves_each_text_once(spark, data):
    """both bags were counted, then dealt out again by token to be joined."""
    assert exchanges(cq.QUERIES["bag_difference"](spark, data)) == 1


def test_invented_words_move_each_text_once(spark, data):
    """the texts crossed nine exchanges, one for each use of them."""
    assert exchanges(cq.QUERIES["invented_words"](spark, data)) == 1


def test_coverage_moves_each_text_once(spark, data):
    """the types of both texts were dealt out again by token to be joined."""
    assert exchanges(cq.QUERIES["type_coverage"](spark, data)) == 1


def test_coverage_of_lines_and_of_tokens(spark):
    truth = lines(spark, {"d": ["one two", "two three"], "e": ["four"], "n": ["..."]})
    some, more = lines(spark, {"d": ["one one five"]}), spark.createDataFrame([("d", "two"), ("e", "six"), ("f", "one")], "doc string, tok string")
    got = lambda *stored: sorted(map(tuple, bags.type_coverage(truth, *stored, bar=0.6).collect()))
    assert got(some) == [("d", 3, 1, "fail"), ("e", 1, 0, "fail")]
    assert got(some, more) == got(more, some) == [("d", 3, 2, "pass"), ("e", 1, 0, "fail")]


@pytest.mark.parametrize("name", ["marc_records", "summary_view", "detail_view"])
def test_records_are_read_once_in_many_tasks(spark, data, name):
    """a small table of keys was one task, and the filter on the control number read every record again."""
    df = cq.QUERIES[name](spark, data)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml(") == 1
    assert df.rdd.getNumPartitions() >= 4


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_numbers_are_confirmed_many_documents_a_batch(spark, data):
    """each document was a frame of its own, at 20 milliseconds and more."""
    assert "InPandas" not in executed(cq.QUERIES["op_number_confirm"](spark, data))


def test_confirmed_numbers_of_odd_rows(spark):
    rows = [("a", 3, 2, False, True, {"x": 1}), ("a", 1, 1, False, True, None), ("a", 4, None, None, None, {"y": 2}), ("a", 5, 60, True, False, None), ("b", 1, 7, None, False, None)]
    df = spark.createDataFrame(rows, "doc string, position int, number int, verb boolean, reset boolean, more map<string,int>").selectExpr("*", "CASE WHEN doc = 'a' THEN 20 END AS body_rows")
    got = sequences.confirm_numbers(df)
    assert got.columns == [*df.columns, "confirmed"]
    assert {(r.doc, r.position): r.confirmed for r in got.collect()} == {("a", 1): True, ("a", 3): False, ("a", 4): False, ("a", 5): False, ("b", 1): False}
    assert {r.position: r.more for r in got.where("doc = 'a'").collect()} == {1: None, 3: {"x": 1}, 4: {"y": 2}, 5: None}


def test_many_running_numbers_cost_no_more_each():
    """Every number was held against all that run on."""
    steps = []

    class Counted(int):
        def __sub__(self, other):
            steps.append(1)
            return int(self) - int(other)

    numbers = [Counted(5 * i + 1) for i in range(400)]
    assert all(sequences.real_numbers(numbers, [True] * 400, [False] * 400, 10_000))
    assert len(steps) < 10 * 400



def test_documents_are_parsed_many_a_batch(spark, data):
    """each document was a frame of its own, which cost more than its parse."""
    assert "InPandas" not in executed(cq.QUERIES["semantic_parse"](spark, data))


def test_parse_of_styled_rows_and_votes(spark):
    from docketry.plans import parse

    rows = [("d", 1, "paragraph", "Scope of it", {"bold": True}), ("d", 0, "paragraph", "The General Assembly,", None), ("d", 2, "paragraph", "Adopted by a vote of 1 to 1", None), ("d", 3, "paragraph", "In favour: Chad", None), ("e", 0, None, None, None)]
    df = spark.createDataFrame(rows, "doc string, position int, kind string, text string, props struct<bold:boolean>")
    got = {(r.doc, r.record, r.position): r for r in parse.parse(df).collect()}
    assert [got["d", "element", i].type for i in range(3)] == ["opening", "heading", "vote_record"]
    assert got["d", "element", 2].vote == {"in_favour": ["Chad"]} and got["d", "element", 2].raw_positions == [2, 3]
    assert got["e", "dropped", 0].reason == "empty" and len(got) == 4


@pytest.mark.parametrize("name", ["parse_roman_items", "parse_refused_numbers", "missing_headings", "repaired_lines", "roman_markers", "clause_actions", "words_run_together", "columns_of_a_page"])
def test_documents_are_dealt_out(spark, data, name):
    """The documents came from a small table in one task, and met in one again, as their rows have few bytes."""
    plan = executed(cq.QUERIES[name](spark, data))
    assert "REPARTITION_BY_NUM" in plan and "InPandas" not in plan


def test_headings_alike_are_found_as_before(spark):
    old = [("d", 2, "Budget of the union"), ("d", 1, "Peace and security"), ("d", 0, "  "), ("d", 3, "Ocean law"), ("d", 4, "Water"), ("e", 0, "Alone here")]
    new = [("d", 0, "I. Peace and securty"), ("d", 1, "The budget of the union and more"), ("d", 1, "II. Ocaen laws"), ("f", 0, "Not asked")]
    df = lambda rows: spark.createDataFrame(rows, "doc string, position int, text string")
    got = audits.missing_headings(df(old), df(new)).collect()
    assert sorted(map(tuple, got)) == [("d", 1, ["Water"]), ("e", 1, ["Alone here"])]
    verdicts = audits.heading_report(df(old[1:2] + old[5:]), df(new)).collect()
    assert sorted(map(tuple, verdicts)) == [("d", 1, "Peace and security", "near"), ("e", 0, "Alone here", "missing")]


def test_cheap_ratios_come_first(monkeypatch):
    """the full ratio was worked out for every pair of headings."""
    asked = []
    monkeypatch.setattr(audits.difflib.SequenceMatcher, "ratio", lambda self: asked.append(self.a) or 0.0)
    assert not audits.alike("budget of the union", "water") and not asked


def test_verb_forms_are_listed_once(spark, monkeypatch):
    """the list of all verb forms was made anew for every line, and lines that are not suspect crossed to Python too."""
    made = []
    pages._verb_forms.cache_clear()
    monkeypatch.setattr(pages, "surfaces", lambda: made.append(1) or {"recalling": None, "decides": None, "takes note": None})
    assert [pages.repaired_verb(t) for t in ("Recalllng the past", "Decides well", "takes note", "Decibes x")] == ["Recalling the past", "Decides well", "takes note", "Decibes x"]
    assert len(made) <= 2
    pages._verb_forms.cache_clear()
    df = spark.createDataFrame([(1, 0, None), (1, 1, "Recalllng the past"), (1, 2, "lower 1ine"), (1, 3, "")], "doc int, position int, text string")
    assert [r.text for r in pages.repaired_lines(df).orderBy("position").collect()] == [None, "Recalling the past", "lower 1ine", ""]


def test_only_children_meet_their_volumes(spark):
    """all rows without a volume had one empty key, and so one partition of the join."""
    from docketry.operators import ledger

    rows = [("a", None, "pa", "ha", 1), ("b", "a", "pb", "hb", 2), ("c", "z", "pc", "hc", 3), ("d", "e", "pd", None, 4), ("e", None, None, "he", 5), (None, None, "pn", "hn", 6)]
    df = spark.createDataFrame(rows, "symbol string, source_symbol string, archive_path string, sha256 string, n int")
    got = ledger.source_files(df)
    assert got.columns == df.columns
    want = [rows[0], ("b", "a", "pa", "ha", 2), ("c", "z", None, None, 3), ("d", "e", None, "he", 4), rows[4], rows[5]]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[4]) == want
    joined = ledger.source_files(df.union(df)).where("source_symbol IS NOT NULL")
    assert joined.count() == 2 * (2 + 1 + 2)  # two copies of b and d meet two of their volumes each, c none
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and plan.count("isnotnull(source_symbol") >= 1
