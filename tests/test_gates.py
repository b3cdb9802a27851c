"""Gates, with damage that must be seen and baselines that must stay quiet."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from docketry.operators import actions, audits, bags, sequences
from docketry.plans import nightly, parse

SOURCE = ["The committee considered the annual report", "It decided to continue the review of standards", "Members expressed appreciation for the secretariat"]


def tokens(spark, docs):
    rows = [(d, i, t) for d, lines in docs.items() for i, t in enumerate(lines)]
    return bags.token_rows(spark.createDataFrame(rows, "doc string, position int, text string"), "doc", "position", "text")


DAMAGE = {
    "baseline": (SOURCE, "pass"),
    "hyphenation": (["The com mittee considered the annual report", *SOURCE[1:]], "pass"),
    "run_together": (["The committee consideredthe annual report", *SOURCE[1:]], "pass"),
    "truncated": (SOURCE[:1], "fail"),
    "invented": ([*SOURCE, "Nobody ever wrote zebra sentences"], "fail"),
    "swapped": (["Entirely other words stand here instead"] * 3, "fail"),
    "missing": (None, "fail"),
}


@pytest.mark.parametrize("kind", DAMAGE)
def test_conservation(spark, kind):
    lines, want = DAMAGE[kind]
    source = tokens(spark, {"d": SOURCE})
    parsed = tokens(spark, {"d": lines}) if lines else source.limit(0)
    out = bags.conservation(source, parsed).collect()
    assert [r.verdict for r in out] == [want]


def test_bags(spark):
    df = lambda rows: spark.createDataFrame(rows, "doc string, tok string, n long")
    got = bags.minus(df([("d", "a", 3), ("d", "b", 1), ("e", "a", 1)]), df([("d", "a", 1), ("d", "b", 1)]))
    assert {tuple(r) for r in got.collect()} == {("d", "a", 2), ("e", "a", 1)}
    assert bags.breaks_into("generalassembly", {"general", "assembly"}) and not bags.breaks_into("general", {"general"})
    left = spark.createDataFrame([("d", "bluesky"), ("d", "other")], "doc string, tok string")
    known = spark.createDataFrame([("d", "blue"), ("d", "sky")], "doc string, tok string")
    assert [r.tok for r in bags.run_together(left, known).collect()] == ["bluesky"]


def test_position_accounting(spark):
    raw = spark.createDataFrame([("d", i) for i in range(5)], "doc string, position int")
    els = spark.createDataFrame([("d", [0, 0]), ("d", [1]), ("d", [1, 9])], "doc string, raw_positions array<int>")
    drops = spark.createDataFrame([("d", 2)], "doc string, position int")
    assert {(r.position, r.problem) for r in bags.position_accounting(raw, els, drops).collect()} == {(1, "duplicate"), (9, "phantom"), (3, "missing"), (4, "missing")}


def test_elements_against_sources(spark):
    source = tokens(spark, {"d": SOURCE}).select("doc", "tok")
    els = spark.createDataFrame([("d", 0, "completely fabricated paragraph about walrus migration across frozen northern oceans yearly"), ("d", 1, SOURCE[1])], "doc string, position int, text string")
    assert [(r.position, r.verdict) for r in bags.foreign_elements(els, source, source, least=4).collect()] == [(0, "invented")]
    region = source.where("tok = 'zzz'")
    assert ("out_of_region") in {r.verdict for r in bags.foreign_elements(els, source, region, least=4).collect()}
    raw = spark.createDataFrame([("d", 0, SOURCE[0]), ("d", 1, SOURCE[1])], "doc string, position int, text string")
    named = spark.createDataFrame([("d", 0, SOURCE[0] + " extra", [0]), ("d", 1, SOURCE[1], [1])], "doc string, position int, text string, raw_positions array<int>")
    assert [(r.doc, r.position, r.tok) for r in bags.unbacked_elements(named, raw).collect()] == [("d", 0, "extra")]
    whole = raw.groupBy("doc").agg(F.array_join(F.collect_list("text"), " ").alias("text"))
    odd = spark.createDataFrame([("d", 7, "this sentence is nowhere in it"), ("d", 8, SOURCE[0])], "doc string, position int, text string")
    assert [r.position for r in audits.in_source(odd, whole).collect()] == [7]


def element(position, kind, text, label=None, section="main", annex=None, level=1, prefix=None, subtype=None):
    return ("d", position, kind, subtype, section, annex, label, level, prefix, text, [position])


SCHEMA = "doc string, position int, type string, subtype string, section string, annex_index int, paragraph_type string, level int, prefix string, text string, raw_positions array<int>"


def test_display_and_structure(spark):
    rows = [element(0, "heading", "II."), element(1, "paragraph", "Scope of the work"), element(2, "paragraph", "word " * 60), element(3, "paragraph", "seen " * 20, "operative")]
    els = spark.createDataFrame(rows, SCHEMA)
    led = spark.createDataFrame([("d",), ("absent",)], "doc string")
    out = {r.doc: (r.words, r.shown, r.verdict) for r in audits.display_coverage(els, led).collect()}
    assert out == {"d": (85, 21, "fail"), "absent": (0, 0, "fail")}
    assert [(r.check, r.severity) for r in audits.bare_headings(els).collect()] == [("bare-section-heading", "high")]
    assert [r.severity for r in audits.unlabelled_documents(els).collect()] == ["medium"]
    hidden = spark.createDataFrame([element(i, "paragraph", f"({chr(97 + i)}) text", section="annex", annex=1) for i in range(10)], SCHEMA)
    assert audits.invisible_annexes(hidden).count() == 1 and audits.invisible_annexes(els).count() == 0
    found = audits.bare_headings(els)
    assert audits.new_findings(found, found).count() == 0
    assert audits.gate(els, found).first().verdict == "fail" and audits.gate(els.limit(0), found.limit(0)).first().verdict == "fail"
    assert audits.gate(els, found.limit(0)).first().verdict == "pass"


def test_heading_matches(spark):
    assert audits.heading_verdict("scope of work", ["scope of work"]) == "ok" and audits.heading_verdict("scope of the work", ["scope of work"]) == "near"
    assert audits.heading_verdict("a b", ["a", "b"]) == "merged" and audits.heading_verdict("budget", ["peace"]) == "missing"
    old = spark.createDataFrame([("d", 0, "Peace and security"), ("d", 1, "Unrelated budget matters")], "doc string, position int, text string")
    new = spark.createDataFrame([("d", 5, "I. Peace and security in Africa")], "doc string, position int, text string")
    out = audits.missing_headings(old, new).collect()
    assert [(r.missing, r.samples) for r in out] == [(1, ["Unrelated budget matters"])]
    pairs = audits.prefix_matches(new, spark.createDataFrame([("d", 0, "Peace and security in Africa")], "doc string, position int, text string")).collect()
    assert [(r.new_position, r.old_position, r.how) for r in pairs] == [(5, 0, "exact")]


def test_partition(spark):
    cat = spark.createDataFrame([("A", True), ("A [I]", True), ("B", False), ("C", True), ("E", True)], "symbol string, in_scope boolean")
    led = spark.createDataFrame([("A", "parsed"), ("C", "weird")], "symbol string, status string")
    els = spark.createDataFrame([("A", "paragraph", "main", "text")], "doc string, type string, section string, text string")
    part = audits.scope_partition(cat, els, led)
    assert {r.symbol: r.bucket for r in part.collect()} == {"A": "delivered", "A [I]": "within_parent", "B": "out_of_scope", "C": "unclassified", "E": "not_fetched"}
    assert not any(r.sound for r in audits.partition_report(part, cat).collect())
    clean = part.where("bucket != 'unclassified'")
    assert all(r.sound for r in audits.partition_report(clean, cat.where("symbol != 'C'")).collect())
    assert not any(r.sound for r in audits.partition_report(clean, cat).collect())


TEXT = """United Nations
A/RES/99/1
99/1. A question of order
The General Assembly,
Recalling its earlier resolution,
1. Requests the Secretary-General:
(a) To report;
(b) To act:
(i) soon;
(ii) well;
2. Decides to remain seized;
3 Urges all States to act;
Welcomes the point;
5. Calls upon the Board to act.
Adopted by a recorded vote of 2 to 1
In favour: Chad, Peru
Against: Chile
45th plenary meeting
3 May 2020
Annex
Declaration on order
1. States shall act.
2. States shall not fail."""


def raw(text):
    return [{"position": i, "kind": "paragraph", "text": t} for i, t in enumerate(text.split("\n"))]


def test_parser_rules():
    p = parse.parse_rows(raw(TEXT))
    got = [(e["type"], e["paragraph_type"], e.get("level"), e.get("prefix")) for e in p.elements]
    assert got == [
        ("frontmatter", None, None, None), ("title", None, None, None), ("opening", "preambular", 0, None), ("paragraph", "preambular", 0, None),
        ("paragraph", "operative", 1, "1."), ("paragraph", "operative", 2, "(a)"), ("paragraph", "operative", 2, "(b)"), ("paragraph", "operative", 3, "(i)"),
        ("paragraph", "operative", 3, "(ii)"), ("paragraph", "operative", 1, "2."), ("paragraph", "operative", 1, "3."), ("paragraph", "operative", 1, None),
        ("paragraph", "operative", 1, "5."), ("vote_record", None, None, None), ("signature", None, None, None), ("signature", None, None, None),
        ("heading", None, 1, "Annex"), ("paragraph", "operative", 1, "1."), ("paragraph", "operative", 1, "2."),
    ]
    assert p.elements[13]["vote"] == {"in_favour": ["Chad", "Peru"], "against": ["Chile"]}
    assert p.elements[11].get("inferred") and [d["reason"] for d in p.drops] == ["page_artifact"]


@pytest.mark.parametrize("damage", ["", "7\n", "\n\n", "1948. was the year of it\n", "III\n", "___\n", "1.1 a\n1.2 b\n1.3 c\n", "A\nThe General Assembly,\n"])
def test_every_row_is_accounted_for(damage):
    p = parse.parse_rows(raw(damage + TEXT + "\n" + damage))
    used = sorted([x for e in p.elements for x in e["raw_positions"]] + [d["position"] for d in p.drops])
    assert used == list(range(len((damage + TEXT + "\n" + damage).split("\n"))))


def test_parser_refuses_false_numbers():
    p = parse.parse_rows(raw("The General Assembly,\nRecalling the past,\n1948. was the year\n1. Decides to act;\n2. Requests a report."))
    assert [e.get("prefix") for e in p.elements if e["paragraph_type"] == "operative"] == ["1.", "2."]


def test_parse_on_spark(spark):
    rows = [(d, r["position"], r["kind"], r["text"]) for d in ("x", "y") for r in raw(TEXT)]
    df = spark.createDataFrame(rows, "doc string, position int, kind string, text string")
    parsed = parse.parse(df)
    els, drops = parse.elements(parsed), parse.dropped(parsed)
    assert els.groupBy("doc").count().collect()[0]["count"] == 19 and drops.count() == 2
    assert bags.position_accounting(df, els, drops).count() == 0
    acted = {r.position: r.action for r in actions.annotate(els.where("doc = 'x'")).collect()}
    assert acted[4].lemma == "request" and acted[5].inherited and acted[5].lemma == "request" and acted[10].assignee_class == "member_states"
    review = audits.document_review(els, df, drops).where("doc = 'x'").first()
    assert review.accounted_pct == 100.0 and "accounting" not in review.flags
    assert actions.flattened(actions.annotate(els)).where("action_verb_normalized = 'recall'").count() == 2


def test_confirmed_numbers():
    frame = pd.DataFrame([(1, False, True), (2, False, False), (1948, False, False), (3, False, False), (9, True, False)], columns=["number", "verb", "reset"])
    assert sequences.confirmed_numbers(frame, 20) == [True, True, False, True, True]
    assert sequences.confirmed_numbers(frame, 5) == [True, True, False, True, False]


def test_levels():
    assert [x[0] for x in sequences.paren_levels(["a", "b", "i", "ii", "c"])] == [2, 2, 3, 3, 2]
    assert [x[1] for x in sequences.paren_levels(["h", "i", "j"])] == ["alpha", "alpha", "alpha"]


def test_sequences(spark):
    rows = spark.createDataFrame([("d", i, *r) for i, r in enumerate([("heading", "II."), ("heading", "Scope"), ("paragraph", "1."), ("paragraph", "Acts"), ("paragraph", "x")])],
                                 "doc string, position int, type string, text string")
    merged = sequences.merged_headings(rows).orderBy("position").collect()
    assert [(r.prefix, r.text) for r in merged][:1] == [("II.", "Scope")] and len(merged) == 4
    hung = sequences.hanging_markers(rows.where("type = 'paragraph'")).orderBy("position").collect()
    assert [r.text for r in hung] == ["1. Acts", "x"]
    lines = [("d", 1, 0, 0.0, 10.0, 10.0, "A line that goes"), ("d", 1, 1, 12.0, 10.0, 10.0, "on and ends."), ("d", 1, 2, 24.0, 30.0, 10.0, "New one"),
             ("d", 1, 3, 60.0, 10.0, 10.0, "After a gap"), ("d", 2, 0, 0.0, 10.0, 10.0, "Next page")]
    df = spark.createDataFrame(lines, "doc string, page int, line int, y double, x double, size double, text string")
    got = [r.text for r in sequences.paragraphs(df, F.lit(False)).orderBy("paragraph").collect()]
    assert got == ["A line that goes on and ends.", "New one", "After a gap", "Next page"]
    regions = spark.createDataFrame([("d", i, t) for i, t in enumerate(["other 1", "own", "x", "other 2", "y"])], "doc string, position int, text string")
    r = sequences.own_region(regions, F.col("text") == "own", F.col("text").startswith("other")).first()
    assert (r.start, r.end, r["mode"]) == (1, 3, "heading")


def test_nightly_stages():
    assert [nightly.decide(0, True), nightly.decide(1, True), nightly.decide(1, False)] == ["skip", "run", "blocked"]

    def broken():
        raise ValueError("no")

    out = nightly.run_stages([nightly.Stage("a", lambda: 3), nightly.Stage("b", broken), nightly.Stage("c", lambda: 1, lambda: 0)])
    assert [r["verdict"] for r in out.rows] == ["done", "failed", "skipped"] and out.exit_code == 1
    assert nightly.run_stages([]).exit_code == 1 and nightly.run_stages([nightly.Stage("a", lambda: 1)]).ok


def test_mended_breaks(spark):
    rows = [("d", 0, "The Board", 300), ("d", 1, "met and", 0), ("d", 2, "decided.", 0), ("d", 3, "1. New", 0), ("d", 4, "Other start", 300)]
    out = sequences.mended_breaks(spark.createDataFrame(rows, "doc string, position int, text string, indent int")).orderBy("position").collect()
    assert [(r.text, r.raw_positions) for r in out] == [("The Board met and decided.", [0, 1, 2]), ("1. New", [3]), ("Other start", [4])]


def test_reports(spark):
    pairs = spark.createDataFrame(
        [("request", "request", "d", "d", "Board", "the board"), ("urge", "ask", "d", "d", None, "x"), (None, "note", None, "o", None, None)],
        "new_verb string, old_verb string, new_category string, old_category string, new_head string, old_head string",
    )
    assert tuple(audits.verb_report(pairs).first()) == (3, 0.6667, 0.5, 1.0, 1.0)
    rows = spark.createDataFrame([("d", 0, "Scope", "H1", False), ("d", 1, "Scope ..... 3", None, False), ("d", 2, "Aims", None, True), ("d", 3, "plain text.", None, False)],
                                 "doc string, position int, text string, style_id string, bold boolean")
    assert [(r.text, r.how) for r in audits.declared_headings(rows).orderBy("position").collect()] == [("Scope", "style"), ("Aims", "bold")]
    kids = spark.createDataFrame([("a", "A/RES/1/1"), ("b", "A/RES/1/2"), ("c", "A/RES/1/3")], "child string, symbol string")
    text = spark.createDataFrame([("a", 0, "1/1. First"), ("b", 0, "1/1. First"), ("b", 1, "x")], "doc string, position int, text string")
    assert sorted(r.child for r in audits.attribution(kids, text).collect()) == ["b", "c"]
