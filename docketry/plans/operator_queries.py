"""Registered queries of operators whose rules show on small, telling inputs.

Column functions run over ``orders``: every row takes one of a fixed list of samples by
its key.  Document operators run over ``supplier`` or ``customer``: every row is a document
that holds the same fixed rows.  The SQL states the result of every sample.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.functions import text as tx
from docketry.operators import actions, audits, bags, catalog, ledger, pages, sequences, upserts, usage
from docketry.operators.documents import spread
from docketry.plans import parse
from docketry.plans.catalog_queries import ORACLES, QUERIES, query
from docketry.session import table
from docketry.sources import files, marc


def literal(v: object) -> str:
    """A Python value as SQL."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, float):
        return f"CAST({v!r} AS DOUBLE)"
    if isinstance(v, int):
        return repr(v)
    if isinstance(v, datetime):
        return f"TIMESTAMP '{v}'"
    if isinstance(v, date):
        return f"DATE '{v}'"
    return "'" + str(v).replace("'", "''") + "'"


def sampled(name: str, f: Callable[[Column], Column], samples: list, want: list, kind: str = "string") -> None:
    """Register a column function over ``orders`` with one sample a row."""
    n = len(samples)

    def run(spark: SparkSession, d: str) -> DataFrame:
        values = spark.createDataFrame([(i, x) for i, x in enumerate(samples)], f"i int, x {kind}")
        rows = table(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") % n).cast("int").alias("i"))
        return rows.join(F.broadcast(values), "i").select("o_orderkey", f(F.col("x")).alias("v"))

    rows = ", ".join(f"({i}, {literal(v)})" for i, v in enumerate(want))
    QUERIES[name] = run
    ORACLES[name] = f"SELECT o_orderkey, v FROM orders JOIN (VALUES {rows}) AS s(i, v) ON o_orderkey % {n} = i"


sampled("sanitized_symbols", tx.sanitize_symbol, ["A/RES/1 (II)", "S/PRST/2"], ["A_RES_1__II_", "S_PRST_2"])
sampled("parent_symbols", tx.strip_bracket, ["A/1 [Part I]", "A/1"], ["A/1", "A/1"])
sampled("symbol_families", tx.symbol_family, ["S/PRST/1", "A/RES/2", "A/DEC/3", "x"], ["PRST", "RES", "DEC", "OTHER"])
sampled("squeezed_text", tx.squeeze, ["  a \tb\n c ", "plain"], ["a b c", "plain"])
sampled("leading_markers", tx.leading_marker, ["1. Go", "(iv) go", "1.2 go", "go", "12 go"], ["1.", "(iv)", "1.2", None, None])
sampled("roman_values", tx.roman_value, ["XIV", "iv", "abc", "MCMXC", ""], [14, 4, 0, 1990, 0])
sampled("alpha_ordinals", tx.alpha_ordinal, ["a", "z", "aa", "bb", "ab"], [1, 26, 27, 28, None])
sampled("language_codes", lambda x: F.array_join(tx.language_codes(x), ","), ["engfre", "eng fre", "en", "", "eng"], ["eng,fre", "eng,fre", "en", "", "eng"])
sampled("name_lists", lambda x: F.array_join(tx.name_list(x), "|"), ["Chad, Peru , .]", "Chile"], ["Chad|Peru", "Chile"])
sampled("joined_lines", tx.join_lines, ["inter-\nnational \n law", "A-\nB"], ["international law", "A- B"])
sampled("repaired_encoding", tx.repair_encoding, ["FranÃ§ais", "plain", "Français", "日本"], ["Français", "plain", "Français", "日本"])
sampled("match_keys", tx.match_key, ["1. The  Board, (a) acts!", "Plain words"], ["the board a acts", "plain words"])
sampled("heading_keys", tx.heading_key, ["II. Budget ..... 12", "V.", "Title"], ["budget", "v.", "title"])
sampled("plain_word_bags", lambda x: F.array_join(tx.plain_words(x), ","), ["Été 3b, X", "one two"], ["t,3b,x", "one,two"])
sampled("size_labels", lambda x: tx.size_label(x.cast("long")), ["500", "2048", "3145728"], ["500 B", "2.0 KB", "3.0 MB"])
sampled("compressed_positions", tx.compress_positions, [[14, 15, 16, 20, 15], [], [3]], ["14-16, 20", "", "3"], "array<int>")
sampled("exact_medians", tx.exact_median, [[5.0, 1.0, 3.0, 2.0], [2.0], []], [2.5, 2.0, None], "array<double>")
sampled("lower_percentiles", lambda x: tx.lower_percentile(x, 0.9), [[5.0, 1.0, 3.0, 2.0], [2.0], []], [3.0, 2.0, None], "array<double>")
sampled("heading_prefixes", lambda x: F.concat_ws("|", *[tx.heading_parts(x)[c] for c in ("prefix", "title")]), ["II. Scope", "Goal 3. Water", "IV Peace", "Plain"], ["II.|Scope", "Goal 3.|Water", "IV|Peace", "Plain"])
sampled("annex_headings", lambda x: F.concat_ws("|", *[tx.annex_parts(x)[c] for c in ("label", "numeral", "title")]), ["Annex II - Rules", "Appendix"], ["Annex|II|Rules", "Appendix"])
sampled("layer_quality", lambda x: tx.layer_quality(x, F.lit(1), ("the", "of", "and", "law")), ["the law of the land and the law " * 30, "qx zj vv kk pp ww rr tt yy uu " * 20, "short"], ["text", "poor", "none"])
sampled("facing_language_lines", lambda x: tx.foreign_line(x, ("le", "la", "les", "des", "et")), ["le droit et la loi", "the law of the land", "et la"], [True, False, False])
sampled("small_shares", lambda x: audits.small_share(x, F.lit(1_000_000)), [0, 5, 250_000], ["0.00", "<0.01", "25.00"], "int")
sampled("count_differences", lambda x: audits.differs(x[0], x[1]), [[10, 12], [10, 13], [100, 102], [1, 3]], [False, True, False, True], "array<int>")
sampled("printed_headings", lambda x: F.concat_ws("|", *[pages.printed_key(x)[c] for c in ("style", "session", "number")]), ["60/1. Outcome", "Resolution 1881 (2009)", "No heading"], ["new|60|1", "old||1881", ""])
sampled("symbol_heading_keys", lambda x: F.concat_ws("|", *[pages.heading_keys(x)[c] for c in ("style", "session", "number")]), ["S/RES/1881 (2009)", "A/RES/2625 (XXV)", "A/RES/60/1"], ["old||1881", "old||2625", "new|60|1"])
sampled("child_symbols", lambda x: pages.child_symbol(F.lit("A/RES"), F.lit("60"), F.lit("1"), x), ["b", None], ["A/RES/60/1B", "A/RES/60/1"])
sampled("file_formats", lambda x: files.file_format(x.cast("binary")), ["%PDF-1.4", "plain words"], ["pdf", "unknown"])


# ---- documents that hold fixed rows -------------------------------------------------------

Fixed = Callable[[list[tuple], str], DataFrame]


def planted(name: str, run: Callable[[Fixed], DataFrame], columns: str, want: list[tuple]) -> None:
    """Register an operator over documents (one a supplier) that all hold the rows ``run`` asks for.

    ``columns`` are those of its result beside doc; ``want`` their rows in every document.
    """

    def go(spark: SparkSession, d: str) -> DataFrame:
        def fixed(rows: list[tuple], schema: str) -> DataFrame:
            docs = spread(table(spark, d, "supplier").select(F.col("s_suppkey").alias("doc")), "doc")
            return docs.crossJoin(F.broadcast(spark.createDataFrame(rows, schema)))

        return run(fixed).select("doc", *columns.split())

    named = ", ".join(f'"{c}"' for c in columns.split())
    rows = ", ".join("(" + ", ".join(map(literal, r)) + ")" for r in want)
    QUERIES[name] = go
    ORACLES[name] = f"SELECT s_suppkey AS doc, {named} FROM supplier, (VALUES {rows}) AS s({named})"


def numbered(texts: list[str]) -> list[tuple]:
    return list(enumerate(texts))


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
2. States shall not fail.""".split("\n")
KINDS = "type paragraph_type level prefix".split()
ELEMENTS = [
    ("frontmatter", None, None, None), ("title", None, None, None), ("opening", "preambular", 0, None), ("paragraph", "preambular", 0, None),
    ("paragraph", "operative", 1, "1."), ("paragraph", "operative", 2, "(a)"), ("paragraph", "operative", 2, "(b)"), ("paragraph", "operative", 3, "(i)"),
    ("paragraph", "operative", 3, "(ii)"), ("paragraph", "operative", 1, "2."), ("paragraph", "operative", 1, "3."), ("paragraph", "operative", 1, None),
    ("paragraph", "operative", 1, "5."), ("vote_record", None, None, None), ("signature", None, None, None), ("signature", None, None, None),
    ("heading", None, 1, "Annex"), ("paragraph", "operative", 1, "1."), ("paragraph", "operative", 1, "2."),
]


def _parsed(rows: Fixed, text: list[str] = TEXT) -> DataFrame:
    return parse.parse(rows([(i, "paragraph", t) for i, t in enumerate(text)], "position int, kind string, text string"))


planted("parse_elements", lambda rows: parse.elements(_parsed(rows)), "position type paragraph_type level prefix", [(i, *e) for i, e in enumerate(ELEMENTS)])
planted("parse_drops", lambda rows: parse.dropped(_parsed(rows)), "position reason", [(1, "page_artifact")])
planted(
    "parse_votes",
    lambda rows: parse.elements(_parsed(rows)).where("vote IS NOT NULL").select("doc", F.array_join(F.col("vote")["in_favour"], ",").alias("yes"), F.array_join(F.col("vote")["against"], ",").alias("no")),
    "yes no", [("Chad,Peru", "Chile")],
)
planted(
    "parse_refused_numbers",
    lambda rows: parse.elements(_parsed(rows, ["The General Assembly,", "Recalling the past,", "1948. was the year", "1. Decides to act;", "2. Requests a report."])).where("paragraph_type = 'operative'"),
    "prefix", [("1.",), ("2.",)],
)
planted(
    "parse_blocks",
    lambda rows: parse.elements(_parsed(rows, ["The General Assembly,", "1. Decides to act;", "A", "Question of water", "The General Assembly,", "1. Requests a report."])),
    "position type subtype prefix", [(0, "opening", None, None), (1, "paragraph", None, "1."), (2, "heading", "subres", "A"), (3, "opening", None, None), (4, "paragraph", None, "1.")],
)
planted("parse_reviews", lambda rows: _review(rows), "rows accounted_pct misplaced jumps flags", [(23, 100.0, 0, 0, "")])


def _review(rows: Fixed) -> DataFrame:
    parsed = _parsed(rows)
    raw = rows([(i, t) for i, t in enumerate(TEXT)], "position int, text string")
    found = audits.document_review(parse.elements(parsed), raw, parse.dropped(parsed))
    return found.withColumn("flags", F.array_join("flags", ","))


def _actions(rows: Fixed) -> DataFrame:
    flat = actions.flattened(actions.annotate(parse.elements(_parsed(rows))))
    return flat.where("paragraph_type IS NOT NULL AND action_verb_normalized IS NOT NULL")


planted(
    "clause_actions", _actions, "position action_verb_normalized action_category assignee_class action_inherited",
    [
        (3, "recall", "reinforcing", None, False), (4, "request", "directive", "secretary-general", False), (5, "request", "directive", "secretary-general", True),
        (6, "request", "directive", "secretary-general", True), (7, "request", "directive", "secretary-general", True), (8, "request", "directive", "secretary-general", True),
        (9, "decide", "deciding", None, False), (10, "urge", "directive", "member_states", False), (11, "welcome", "evaluative", None, False), (12, "call upon", "directive", "un_body", False),
    ],
)

ITEMS = [
    "Request the Secretary-General to report", "Provide all means", "Expresses its deep hope that it will", "Expresses its gratitude to the Board", "Notes with deep concern the delay",
    "Notes with interest the report", "Notes with the Board the report", "Expresses its support for the plan", "Expressing concern at the delay", "Decides to act and requests the Board to report",
]
planted(
    "verb_carriers",
    lambda rows: actions.flattened(
        actions.annotate(rows([(i, t, "preambular" if t.startswith("Expressing") else "operative", 1, None) for i, t in enumerate(ITEMS)], "position int, text string, paragraph_type string, level int, prefix string"))
    ).withColumn("qualifier", F.get(F.filter("action_modifiers", lambda m: m["kind"] == "qualifier"), 0)["text"]),
    "position action_verb_normalized action_sentiment qualifier",
    [
        (0, "request", 0, None), (1, None, None, None), (2, "express", 0, None), (3, "appreciate", 1, None), (4, "note", -1, "with concern"), (5, "note", 1, "with interest"), (6, "note", 0, None),
        (7, "support", 1, None), (8, "express concern", -1, None), (9, "decide", 0, None),
    ],
)

PLAIN = ["The committee considered the annual report", "It decided to continue the review of standards", "Members expressed appreciation for the secretariat"]
STRUCTURE = "position int, type string, subtype string, section string, annex_index int, paragraph_type string, level int, prefix string, text string, raw_positions array<int>"


def _gate(damaged: list[str]) -> Callable[[Fixed], DataFrame]:
    def run(rows: Fixed) -> DataFrame:
        made = [bags.token_rows(rows(numbered(t), "position int, text string"), "doc", "position", "text") for t in (PLAIN, damaged)]
        return bags.conservation(*made)

    return run


planted("gate_baseline", _gate(PLAIN), "words lost invented verdict", [(20, 0, 0, "pass")])
planted("gate_split_word", _gate(["The com mittee considered the annual report", *PLAIN[1:]]), "words lost invented verdict", [(20, 0, 0, "pass")])
planted("gate_joined_words", _gate(["The committee consideredthe annual report", *PLAIN[1:]]), "words lost invented verdict", [(20, 0, 0, "pass")])
planted("gate_truncated", _gate(PLAIN[:1]), "words lost invented verdict", [(20, 11, 0, "fail")])
planted("gate_invented", _gate([*PLAIN, "Nobody ever wrote zebra sentences"]), "words lost invented verdict", [(20, 0, 5, "fail")])

planted(
    "foreign_elements",
    lambda rows: bags.foreign_elements(
        rows([(0, "completely fabricated paragraph about walrus migration across frozen oceans"), (1, PLAIN[1]), (2, PLAIN[2])], "position int, text string"),
        bags.token_rows(rows(numbered(PLAIN), "position int, text string"), "doc", "position", "text"),
        bags.token_rows(rows(numbered(PLAIN[:2]), "position int, text string"), "doc", "position", "text"), least=4,
    ),
    "position verdict", [(0, "invented"), (2, "out_of_region")],
)
planted(
    "unbacked_words",
    lambda rows: bags.unbacked_elements(
        rows([(0, PLAIN[0] + " extra extra", [0]), (1, PLAIN[1], [1]), (2, PLAIN[2], [0])], "position int, text string, raw_positions array<int>"), rows(numbered(PLAIN), "position int, text string")
    ).withColumn("doc", F.col("doc").cast("bigint")).where("position < 2"),
    "position tok n", [(0, "extra", 2)],
)
planted(
    "source_shares", lambda rows: bags.source_share(rows([(40, 100, 80), (60, 100, 80), (30, 20, 100), (20, 20, 100), (5, 0, 0)], "parsed int, span int, page_average int")),
    "share verdict", [(0.4, "fail"), (0.6, "pass"), (0.3, "pass"), (0.2, "fail"), (0.0, "fail")],
)
planted(
    "words_run_together", lambda rows: bags.run_together(rows([("bluesky",), ("other",), ("sky",)], "tok string"), rows([("blue",), ("sky",)], "tok string")), "tok", [("bluesky",)],
)
planted(
    "elements_not_in_source",
    lambda rows: audits.in_source(
        rows([(7, "this sentence is nowhere in it"), (8, PLAIN[0]), (9, "short")], "position int, text string"), rows([(" ".join(PLAIN),)], "text string")
    ),
    "position", [(7,)],
)


def _part(position: int, kind: str, text: str, label: str | None = None) -> tuple:
    return (position, kind, None, "main", None, label, 1, None, text, [position])


planted(
    "bare_headings",
    lambda rows: audits.bare_headings(rows([_part(0, "heading", "II."), _part(1, "paragraph", "Scope of the work"), _part(2, "heading", "(A)"), _part(3, "paragraph", "A full sentence."), _part(4, "heading", "Aims")], STRUCTURE)),
    "check severity detail", [("bare-section-heading", "high", "position 0"), ("bare-section-heading", "medium", "position 2")],
)
planted(
    "missing_headings",
    lambda rows: audits.missing_headings(
        rows([(0, "Peace and security"), (1, "Unrelated budget matters")], "position int, text string"), rows([(5, "I. Peace and security in Africa")], "position int, text string")
    ).withColumn("samples", F.array_join("samples", "|")),
    "missing samples", [(1, "Unrelated budget matters")],
)
planted(
    "declared_heading_verdicts",
    lambda rows: audits.heading_report(
        rows([(0, "Scope of work"), (1, "Scope of the work"), (2, "Aims Means"), (3, "Budget")], "position int, text string"),
        rows([(0, "Scope of work"), (1, "Aims"), (2, "Means")], "position int, text string"),
    ),
    "position verdict", [(0, "ok"), (1, "near"), (2, "merged"), (3, "missing")],
)
planted(
    "rows_of_two_parses",
    lambda rows: audits.prefix_matches(
        rows([(5, "Peace and security in Africa"), (6, "The committee on the peaceful uses of outer space met twice"), (7, "New")], "position int, text string"),
        rows([(0, "Peace and security in Africa"), (1, "The committee on the peaceful uses of outer space met once"), (2, "Old")], "position int, text string"),
    ),
    "new_position old_position how", [(5, 0, "exact"), (6, 1, "prefix")],
)
planted(
    "declared_headings",
    lambda rows: audits.declared_headings(
        rows([(0, "Scope", "H1", False), (1, "Scope ..... 3", None, False), (2, "Aims", None, True), (3, "plain text.", None, False)], "position int, text string, style_id string, bold boolean")
    ),
    "position text how", [(0, "Scope", "style"), (2, "Aims", "bold")],
)
planted("merged_headings", lambda rows: sequences.merged_headings(rows([(0, "heading", "II."), (1, "heading", "Scope"), (2, "paragraph", "x")], "position int, type string, text string")), "position prefix text", [(1, "II.", "Scope"), (2, None, "x")])
planted("hanging_markers", lambda rows: sequences.hanging_markers(rows([(0, "1."), (1, "Acts"), (2, "x"), (3, "(a)"), (4, "To act")], "position int, text string")), "position text", [(1, "1. Acts"), (2, "x"), (4, "(a) To act")])
planted(
    "paragraphs_of_lines",
    lambda rows: sequences.paragraphs(
        rows(
            [(1, 0, 0.0, 10.0, 10.0, "A line that goes"), (1, 1, 12.0, 10.0, 10.0, "on and ends."), (1, 2, 24.0, 30.0, 10.0, "New one"), (1, 3, 60.0, 10.0, 10.0, "After a gap"), (2, 0, 0.0, 10.0, 10.0, "Next page")],
            "page int, line int, y double, x double, size double, text string",
        ),
        F.lit(False),
    ),
    "paragraph text", [(1, "A line that goes on and ends."), (2, "New one"), (3, "After a gap"), (4, "Next page")],
)
planted(
    "columns_of_a_page",
    lambda rows: pages.column_order(rows([(1, i, 50.0 if i < 10 else 320.0, 280.0 if i < 10 else 560.0, float(i % 10), 600.0) for i in range(20)], "page int, line int, x0 double, x1 double, y double, width double")),
    "line column reading", [(i, i // 10, i) for i in range(20)],
)
planted(
    "repaired_markers",
    lambda rows: pages.repaired_markers(rows([(i, 10.0, t) for i, t in enumerate(["1. One", "Z. Two", "3. Three", "S. Alone", "text"])], "position int, x0 double, text string")),
    "position text repaired", [(0, "1. One", False), (1, "2. Two", True), (2, "3. Three", False), (3, "S. Alone", False), (4, "text", False)],
)
planted(
    "repaired_lines",
    lambda rows: pages.repaired_lines(rows(numbered(["The Genera1 Assernbly,", "The committee met", "Recalllng the past", "Decides well"]), "position int, text string")),
    "position text", [(0, "The General Assembly,"), (1, "The committee met"), (2, "Recalling the past"), (3, "Decides well")],
)

PAGE = [(i, t, "paragraph") for i, t in enumerate(["1/9. Other", "The General Assembly,", "x", "1/10. Ours", "The General Assembly,", "body", "1/11. Next", "y"])]
planted("cropped_rows", lambda rows: pages.cropped(rows(PAGE, "position int, text string, type string"), rows([("A/RES/1/10",)], "symbol string")), "position certain", [(3, True), (4, True), (5, True)])
planted("overreaching_elements", lambda rows: pages.overreach(rows(PAGE, "position int, text string, type string"), rows([("A/RES/1/10",)], "symbol string")), "position text", [(0, "1/9. Other"), (6, "1/11. Next")])
planted(
    "volume_slices",
    lambda rows: ledger.split_volume(
        rows(numbered(["contents", "1/1. First", "body", "Resolution adopted", "1/2. Second", "more", "x", "1/1. First", "Resolution adopted", "a", "b", "c"]), "position int, text string"),
        F.col("text").rlike(r"^\d+/\d+\."), F.col("text") == "Resolution adopted", F.concat(F.lit("R/"), F.regexp_extract("text", r"^(\d+/\d+)\.", 1), F.lit("/"), F.col("doc").cast("string")), reach=3,
    ).select(F.col("volume").alias("doc"), F.expr("substring_index(child, '/', 3)").alias("child"), "start", "n"),
    "child start n", [("R/1/1", 7, 5)],
)
planted(
    "boundary_leaks",
    lambda rows: ledger.leaks(rows([("a", 0, 9), ("b", 10, 25), ("c", 20, 30)], "child string, start int, last int").withColumn("volume", F.col("doc"))),
    "child next_start", [("b", 20)],
)
planted(
    "misattributed_children",
    lambda rows: audits.attribution(
        rows([("a", "A/RES/1/1"), ("b", "A/RES/1/2"), ("c", "A/RES/1/3")], "n string, symbol string").withColumn("child", F.concat_ws("-", "doc", "n")),
        rows([("a", 0, "1/1. First"), ("b", 0, "1/1. First"), ("b", 1, "x")], "n string, position int, text string").withColumn("doc", F.concat_ws("-", "doc", "n")),
    ).select(F.split("child", "-")[0].cast("bigint").alias("doc"), F.split("child", "-")[1].alias("child"), "text"),
    "child text", [("b", "1/1. First"), ("c", None)],
)

planted(
    "roman_markers",
    lambda rows: sequences.confirm_romans(rows(numbered(["(I) First", "(II) Second", "(IX) of 11 December 1954", "(III) Third", "(a) other", "(XX) of 1965", "text"]), "position int, text string")),
    "position value confirmed", [(0, 1, True), (1, 2, True), (2, 9, False), (3, 3, True), (5, 20, False)],
)
planted(
    "parse_roman_items",
    lambda rows: parse.elements(_parsed(rows, ["The General Assembly,", "1. Decides to act under:", "(I) its rules;", "(II) its plans, and resolution 900", "(IX) of 11 December 1954;"])).where("prefix IS NOT NULL"),
    "position prefix level", [(1, "1.", 1), (2, "(I)", 2), (3, "(II)", 2)],
)
planted(
    "annex_gaps", lambda rows: audits.annex_gaps(rows([(i, s, n) for i, (s, n) in enumerate([("main", None), ("annex", 1), ("annex", 1), ("annex", 3)])], "position int, section string, annex_index int")),
    "highest annexes", [(3, 2)],
)
planted(
    "display_sums",
    lambda rows: audits.display_sums(
        rows([_part(0, "heading", "One two"), _part(1, "paragraph", "three four five"), _part(2, "paragraph", "six", "operative"), (3, "paragraph", None, "annex", 1, "operative", 1, None, "a b", [3]), (4, "divider", None, "annex", 1, None, 1, None, "___", [4])], STRUCTURE)
    ),
    "visible total main_visible main_total annex_visible annex_total", [(5, 8, 3, 6, 2, 2)],
)
planted(
    "cropped_losses",
    lambda rows: bags.crop_split(rows([("peace", 2), ("budget", 1)], "tok string, n int"), rows([("budget",), ("other",)], "tok string")),
    "tok n cropped", [("peace", 2, False), ("budget", 1, True)],
)
planted(
    "word_accounting",
    lambda rows: bags.word_accounting(rows([("a", 3), ("b", 1), ("c", 2)], "tok string, n bigint"), rows([("a", 2)], "tok string, n bigint"), rows([("b", 4), ("c", 1), ("a", 1)], "tok string, n bigint")),
    "tok n", [("c", 1)],
)
planted(
    "child_conservation",
    lambda rows: bags.child_conservation(rows([("a", 1), ("b", 1), ("x", 1)], "tok string, n int"), rows([("a", 2), ("b", 1), ("c", 1)], "tok string, n int"), rows([("a", 9)], "tok string, n int")),
    "lost extra verdict", [(1, 1, "fail")],
)


# ---- single queries ------------------------------------------------------------------------

MARC = """<record xmlns="http://www.loc.gov/MARC21/slim"><controlfield tag="001"> {id} </controlfield>
<datafield tag="191" ind1=" " ind2=" "><subfield code="a">a/res/{id}</subfield></datafield>
<datafield tag="245" ind1="1" ind2="0"><subfield code="a">Peace :</subfield><subfield code="b">resolution /</subfield></datafield>
<datafield tag="269" ind1=" " ind2=" "><subfield code="a">1999-12-05</subfield></datafield>
<datafield tag="041" ind1=" " ind2=" "><subfield code="a">engfre</subfield></datafield>
<datafield tag="650" ind1=" " ind2=" "><subfield code="a">LAW</subfield></datafield><datafield tag="650" ind1=" " ind2=" "><subfield code="a">PEACE</subfield></datafield>
<datafield tag="856" ind1=" " ind2=" "><subfield code="u">http://x/a.doc</subfield><subfield code="y">English</subfield></datafield>
<datafield tag="856" ind1=" " ind2=" "><subfield code="u">http://x/{id}.pdf</subfield><subfield code="y">English</subfield></datafield></record>"""


def _customers(spark: SparkSession, d: str) -> DataFrame:
    """The keys of small tables, dealt out before each becomes a whole record."""
    return spread(table(spark, d, "customer").select("c_custkey"), "c_custkey")


@query("""SELECT CAST(c_custkey AS INTEGER) AS recid, 'A/RES/' || c_custkey AS symbol, 'Peace resolution' AS title, DATE '1999-12-05' AS published, 'eng,fre' AS languages,
    'LAW,PEACE' AS subjects, 'http://x/' || c_custkey || '.pdf' AS pdf FROM customer WHERE c_custkey % 10 <> 0""")
def marc_records(spark: SparkSession, d: str) -> DataFrame:
    """Responses of two records each, one of them without a numeric control number every tenth time."""
    key = F.when(F.col("c_custkey") % 10 == 0, F.concat(F.lit("x"), F.col("c_custkey").cast("string"))).otherwise(F.col("c_custkey").cast("string"))
    record = F.replace(F.lit(MARC), F.lit("{id}"), key)
    responses = _customers(spark, d).select(F.concat(F.lit("<collection>"), record, F.lit("</collection>")).alias("value"))
    out = marc.parse(marc.split_records(responses))
    return out.select(
        "recid", F.col("symbol_normalized").alias("symbol"), "title", F.col("date_publication").alias("published"), F.array_join("languages", ",").alias("languages"),
        F.array_join("subjects", ",").alias("subjects"), marc.english_pdf(F.col("files")).alias("pdf"),
    )


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey % 3 <> 0 UNION ALL SELECT c_custkey, 'new' FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 2 = 0 UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 2 = 1")
def replaced_groups(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", "c_name")
    batch = c.where("c_custkey % 6 = 0").withColumn("c_name", F.lit("new"))
    return upserts.replace_groups(c.unionByName(c.where("c_custkey % 6 = 0")), batch, ["c_custkey"])


@query("SELECT c_custkey, c_name FROM customer WHERE NOT (c_custkey % 4 = 0 AND c_custkey % 3 <> 0)")
def retired_keys(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", "c_name")
    return upserts.retire(c, c.where("c_custkey % 4 = 0"), c.where("c_custkey % 3 = 0"), ["c_custkey"])


@query("SELECT c_custkey, upper(c_mktsegment) || CASE WHEN c_custkey % 2 = 0 THEN '!' ELSE '' END AS c_mktsegment, c_custkey % 2 = 0 AS changed FROM customer")
def repaired_columns(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", F.upper("c_mktsegment").alias("c_mktsegment"))
    return upserts.repair(c, {"c_mktsegment": F.when(F.col("c_custkey") % 2 == 0, F.concat("c_mktsegment", F.lit("!"))).otherwise(F.col("c_mktsegment"))})


@query("""SELECT doc_id AS symbol, md5(coalesce(text, '')) AS sha256 FROM documents WHERE NOT (doc_id % 3 = 0 OR doc_id % 5 = 0 AND false)""")
def unseen_content(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("symbol"), F.md5(F.coalesce("text", F.lit(""))).alias("sha256"))
    done = rows.where("symbol % 3 = 0").unionByName(rows.where("symbol % 5 = 0 AND symbol % 3 <> 0").withColumn("sha256", F.lit("stale")))
    return upserts.unseen_content(rows, done)


@query("""SELECT 'key:' || user_id AS caller, date_trunc('minute', ts) AS window_start, count(*) AS count FROM events GROUP BY ALL
    HAVING date_trunc('minute', ts) >= TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 36 HOUR""")
def expired_windows(spark: SparkSession, d: str) -> DataFrame:
    from docketry.plans.catalog_queries import NOW, calls

    kept = usage.expire(usage.rate_windows(calls(spark, d)), NOW, 36)
    return kept.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("""SELECT o_orderkey AS key_id, c_custkey AS user_id, c_name FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 4 <> 0""")
def keys_in_force(spark: SparkSession, d: str) -> DataFrame:
    keys = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("key_id"), F.col("o_custkey").alias("user_id"), F.when(F.col("o_orderkey") % 4 == 0, F.lit(datetime(2024, 1, 1))).alias("revoked_at")
    )
    users = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), "c_name")
    return usage.key_owners(keys, users).select("key_id", "user_id", "c_name")


@query("SELECT event_id FROM events WHERE event_id % 3 <> 0 AND ts + INTERVAL 15 MINUTE > TIMESTAMP '2024-01-15'")
def usable_tokens(spark: SparkSession, d: str) -> DataFrame:
    tokens = table(spark, d, "events").select(
        "event_id", F.when(F.col("event_id") % 3 == 0, F.lit(datetime(2024, 1, 1))).alias("used_at"), (F.col("ts") + F.expr("INTERVAL 15 MINUTES")).alias("expires_at")
    )
    return usage.usable_tokens(tokens, datetime(2024, 1, 15)).select("event_id")


@query("""WITH g AS (SELECT c_custkey, 'S' || c_custkey AS symbol, CASE WHEN c_custkey % 3 = 1 THEN 'S' || (c_custkey - 1) END AS source_symbol FROM customer)
    SELECT symbol, source_symbol, 'p' || CASE WHEN source_symbol IS NOT NULL THEN c_custkey - 1 ELSE c_custkey END AS archive_path FROM g""")
def files_of_children(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    name = lambda p, c: F.concat(F.lit(p), c.cast("string"))
    rows = table(spark, d, "customer").select(
        name("S", k).alias("symbol"), F.when(k % 3 == 1, name("S", k - 1)).alias("source_symbol"), F.when(k % 3 != 1, name("p", k)).alias("archive_path"), name("h", k).alias("sha256"),
    )
    return ledger.source_files(rows).select("symbol", "source_symbol", "archive_path")


@query("""SELECT 'S' || c_custkey AS symbol, CASE WHEN c_custkey % 4 = 0 THEN 'parsed' WHEN c_custkey % 4 = 1 AND c_custkey % 2 = 1 AND c_custkey % 3 <> 0 THEN 'parse_failed'
    WHEN c_custkey % 3 = 0 THEN 'parsed' ELSE 'fetched' END AS status FROM customer""")
def settled_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """Rows of key 0 mod 4 parse, rows of key 1 mod 4 fail; those of key 0 mod 3 were parsed before."""
    k = F.col("c_custkey")
    c = table(spark, d, "customer").select(k, F.concat(F.lit("S"), k.cast("string")).alias("symbol"), F.when(k % 3 == 0, "parsed").otherwise("fetched").alias("status"))
    return ledger.settle(c.select("symbol", "status"), c.where("c_custkey % 4 < 2").select("symbol", (k % 4 == 0).alias("ok")))


@query("""SELECT c_custkey AS symbol, c_name FROM customer WHERE c_custkey % 9 = 0""")
def chosen_symbols(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("symbol"), "c_name")
    return files.chosen(c, c.where("symbol % 9 = 0").unionByName(c.where("symbol % 18 = 0")))


@query("""SELECT count(*) AS clauses, 1.0::DOUBLE AS coverage, round(count(*) FILTER (o_orderkey % 3 <> 0) / count(*), 4) AS verb_agreement, 1.0::DOUBLE AS category_agreement, 1.0::DOUBLE AS head_agreement FROM orders""")
def verb_evaluation(spark: SparkSession, d: str) -> DataFrame:
    pairs = table(spark, d, "orders").select(
        F.lit("request").alias("new_verb"), F.when(F.col("o_orderkey") % 3 == 0, "ask").otherwise("request").alias("old_verb"), F.lit("d").alias("new_category"),
        F.lit("d").alias("old_category"), F.lit("Board").alias("new_head"), F.lit("the board").alias("old_head"),
    )
    return audits.verb_report(pairs)


@query("""SELECT 'A/' || s || '/49 (Vol. ' || v || ')' AS symbol, 'session' AS kind, CAST(s AS INTEGER) AS session FROM range(57, 81) r(s), (VALUES ('I'), ('II')) p(v)
    UNION ALL SELECT 'S/INF/' || y, 'year', CAST(y AS INTEGER) FROM range(2003, 2026) t(y)""")
def volume_catalog(spark: SparkSession, d: str) -> DataFrame:
    return pages.volume_catalog(spark).select("symbol", "kind", "session")


def _marc(spark: SparkSession, d: str) -> DataFrame:
    record = F.replace(F.lit(MARC), F.lit("{id}"), F.col("c_custkey").cast("string"))
    return marc.parse(_customers(spark, d).select(record.alias("xml")))


@query("""SELECT CAST(c_custkey AS INTEGER) AS recid, 'a/res/' || c_custkey AS symbol, 'Peace resolution' AS title, DATE '1999-12-05' AS date_publication, CAST(NULL AS VARCHAR) AS un_body,
    CAST(NULL AS VARCHAR) AS resource_type, 'eng,fre' AS languages, CAST(NULL AS VARCHAR) AS summary FROM customer""")
def summary_view(spark: SparkSession, d: str) -> DataFrame:
    return catalog.projected(_marc(spark, d)).withColumn("languages", F.array_join("languages", ","))


@query("""SELECT CAST(c_custkey AS INTEGER) AS recid, 29 AS columns, 'eng,fre' AS languages, 2 AS files, CAST(NULL AS TIMESTAMP) AS harvested_at FROM customer""")
def detail_view(spark: SparkSession, d: str) -> DataFrame:
    view = catalog.projected(_marc(spark, d), catalog.DETAIL)
    return view.select("recid", F.lit(len(view.columns)).alias("columns"), F.array_join("languages", ",").alias("languages"), F.size("files").alias("files"), F.col("harvested_at").cast("timestamp_ntz").alias("harvested_at"))


@query("""SELECT doc_id AS recid FROM documents WHERE doc_id % 50 <> 49 AND (source || '/RES/' || doc_id) ILIKE 'SRC%/res/1_'""")
def symbol_lookup(spark: SparkSession, d: str) -> DataFrame:
    from docketry.plans.catalog_queries import records

    return catalog.by_pattern(records(spark, d), "SRC%/res/1_").select("recid")


@query("SELECT coalesce(max(doc_id), 0) AS latest FROM documents")
def latest_id(spark: SparkSession, d: str) -> DataFrame:
    from docketry.plans.catalog_queries import records

    return catalog.latest_id(records(spark, d))


@query("""WITH c AS (SELECT * FROM documents WHERE doc_id % 50 <> 49), b AS (SELECT 'body ' || source AS measure, count(*) AS n FROM c WHERE source IS NOT NULL GROUP BY ALL ORDER BY n DESC, measure LIMIT 10)
    SELECT 'total' AS measure, count(*) AS n FROM documents UNION ALL SELECT 'active', count(*) FROM c UNION ALL SELECT measure, n FROM b""")
def catalogue_validation(spark: SparkSession, d: str) -> DataFrame:
    from docketry.plans.catalog_queries import records

    return catalog.validation(records(spark, d))


@query("""SELECT count(*) AS documents, min(p) AS first_date, max(p) AS last_date, count(DISTINCT source) AS bodies, count(DISTINCT lang) AS kinds, max(TIMESTAMP '2024-01-01' + to_days(CAST(doc_id % 30 AS INTEGER))) AS last_harvested
    FROM (SELECT *, DATE '2020-01-01' + CAST(doc_id % 1000 AS INTEGER) AS p FROM documents WHERE doc_id % 50 <> 49)""")
def harvest_stats(spark: SparkSession, d: str) -> DataFrame:
    from docketry.plans.catalog_queries import records

    rows = records(spark, d).withColumn("harvested_at", F.date_add(F.lit(date(2024, 1, 1)), (F.col("recid") % 30).cast("int")).cast("timestamp_ntz"))
    return catalog.statistics(rows, "harvested_at")


@query("""SELECT event_id AS request_id, user_id AS token_id, user_id % 3 <> 0 AND row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1 AS granted FROM events""")
def consumed_tokens(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    tokens = e.select(F.col("user_id").alias("token_id")).distinct().select(
        "token_id", F.when(F.col("token_id") % 3 == 0, F.lit(datetime(2024, 1, 1))).alias("used_at"), F.lit(datetime(2025, 1, 1)).alias("expires_at")
    )
    return usage.consumed(tokens, e.select(F.col("event_id").alias("request_id"), F.col("user_id").alias("token_id"), F.col("ts").alias("at")), datetime(2024, 6, 1))
