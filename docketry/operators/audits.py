"""Gates and reports over parsed documents.

Every gate fails on nothing to check, and every denominator comes from outside the
thing that is checked.
"""

from __future__ import annotations

import difflib
from collections.abc import Iterator
from operator import itemgetter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry.functions.text import leading_marker, match_key, signature, word_count
from docketry.operators.documents import over_documents

FINDING = "doc, check, severity, detail"


def shown(mode: str = "display") -> Column:
    """Whether an element is seen: the display's rule, or the scope report's."""
    if mode == "display":
        return (F.col("type") == "heading") | F.col("paragraph_type").isin("operative", "preambular")
    hidden = F.col("type").isin("frontmatter", "footnote", "divider", "signature", "vote_record", "opening")
    title = (F.col("type") == "title") & (F.col("section") != "annex")
    return ~hidden & ~title & (F.trim("text") != "")


def boilerplate() -> Column:
    return ((F.col("type") == "frontmatter") & (F.col("subtype") == "masthead")) | (F.col("type") == "divider")


def display_coverage(elements: DataFrame, ledger: DataFrame, threshold: float = 60.0) -> DataFrame:
    """One row a ledger document: words, words shown, percentage, verdict; no words is 0 per cent."""
    n = word_count(F.col("text"))
    counts = elements.where(~F.coalesce(boilerplate(), F.lit(False))).groupBy("doc").agg(
        F.sum(n).alias("words"), F.sum(F.when(shown(), n).otherwise(0)).alias("shown")
    )
    rows = ledger.select("doc").distinct().join(counts, "doc", "left")
    pct = F.when(F.coalesce("words", F.lit(0)) > 0, F.round(100.0 * F.col("shown") / F.col("words"), 2)).otherwise(0.0)
    return rows.select(
        "doc", F.coalesce("words", F.lit(0)).alias("words"), F.coalesce("shown", F.lit(0)).alias("shown"), pct.alias("pct"),
        F.when(pct >= threshold, "pass").otherwise("fail").alias("verdict"),
    )


def display_sums(elements: DataFrame) -> DataFrame:
    """Six sums a document: words shown and all words, of the whole, of the main text and of the annexes."""
    n = word_count(F.col("text"))
    annex = F.coalesce(F.col("section") == "annex", F.lit(False))
    part = lambda which, name: [
        F.sum(F.when(which & F.coalesce(shown(), F.lit(False)), n).otherwise(0)).alias(f"{name}visible"), F.sum(F.when(which, n).otherwise(0)).alias(f"{name}total")
    ]
    kept = elements.where(~F.coalesce(boilerplate(), F.lit(False)))
    return kept.groupBy("doc").agg(*part(F.lit(True), ""), *part(~annex, "main_"), *part(annex, "annex_"))


def annex_gaps(elements: DataFrame) -> DataFrame:
    """(doc, highest, annexes): documents whose annex numbers do not run from 1 without a gap."""
    annex = elements.where("section = 'annex'").groupBy("doc")
    return annex.agg(F.max("annex_index").alias("highest"), F.count_distinct("annex_index").alias("annexes")).where("highest <> annexes")


def bare_headings(elements: DataFrame) -> DataFrame:
    """Headings that are only a marker; worse where a title-like row follows."""
    some = elements.where(F.trim("text") != "")
    order = Window.partitionBy("doc").orderBy("position")
    following = F.lead("text").over(order)
    title_like = (F.lead("type").over(order) == "paragraph") & (F.length(following) <= 120) & ~following.rlike(r"[.;:]\s*$")
    bare = (F.col("type") == "heading") & F.col("text").rlike(r"^\(?(?:[IVXLCM]{1,7}|[A-Z]|\d{1,3})\)?\.?$") & (
        F.coalesce(F.col("subtype"), F.lit("")) != "subres"
    )
    return some.select(
        "doc", F.lit("bare-section-heading").alias("check"), F.when(F.coalesce(title_like, F.lit(False)), "high").otherwise("medium").alias("severity"),
        F.concat(F.lit("position "), F.col("position").cast("string")).alias("detail"), bare.alias("hit"),
    ).where("hit").drop("hit")


def unlabelled_documents(elements: DataFrame, most: float = 0.5, worst: float = 0.8, least: int = 50) -> DataFrame:
    """Documents whose body words mostly have no paragraph type."""
    n = word_count(F.col("text"))
    counts = elements.where(F.col("type") == "paragraph").groupBy("doc").agg(
        F.sum(n).alias("n"), F.sum(F.when(F.col("paragraph_type").isNull(), n).otherwise(0)).alias("u")
    )
    share = F.col("u") / F.col("n")
    return counts.where((F.col("n") >= least) & (share > most)).select(
        "doc", F.lit("null-heavy-doc").alias("check"), F.when(share > worst, "high").otherwise("medium").alias("severity"),
        F.concat(F.col("u").cast("string"), F.lit("/"), F.col("n").cast("string")).alias("detail"),
    )


def invisible_annexes(elements: DataFrame, least: int = 10) -> DataFrame:
    """Annexes with many enumerated paragraphs and none labelled."""
    annex = elements.where(F.col("section") == "annex").groupBy("doc", "annex_index").agg(
        F.count_if(leading_marker(F.col("text")).isNotNull() | F.col("prefix").isNotNull()).alias("enumerated"),
        F.count_if(F.col("paragraph_type").isNotNull()).alias("labelled"),
    )
    return annex.where((F.col("enumerated") >= least) & (F.col("labelled") == 0)).select(
        "doc", F.lit("annex-invisible").alias("check"), F.lit("high").alias("severity"),
        F.concat(F.lit("annex "), F.coalesce(F.col("annex_index").cast("string"), F.lit("-"))).alias("detail"),
    )


def alike(a: str, b: str, ratio: float = 0.8, least: int = 5) -> bool:
    """Containment of the shorter text, or a similarity ratio over the bound."""
    short, long = sorted((a, b), key=len)
    return (len(short) >= least and short in long) or _over(a, b, ratio)


def _over(a: str, b: str, ratio: float) -> bool:
    """Whether the similarity ratio is over the bound; the cheap ratios are never below it."""
    found = difflib.SequenceMatcher(None, a, b)
    return found.real_quick_ratio() > ratio and found.quick_ratio() > ratio and found.ratio() > ratio


def _lists(left: DataFrame, right: DataFrame) -> DataFrame:
    """(doc, left, right): the rows of both sides of every document of the left one."""
    listed = lambda d, name: d.groupBy("doc").agg(F.collect_list(F.struct(*[c for c in d.columns if c != "doc"])).alias(name))
    return listed(left, "left").join(listed(right, "right"), "doc", "left").select("doc", "left", "right")


def missing_headings(old: DataFrame, new: DataFrame, samples: int = 8) -> DataFrame:
    """(doc, missing, samples): old headings without a like one in the new parse of the document.

    ``old``, ``new``: doc, position, text.  The texts of one document meet in one group.
    """

    def run(doc: object, left: list[dict], right: list[dict] | None) -> Iterator[tuple]:
        known = list(dict.fromkeys(r["k"] for r in right or () if r["k"]))
        same = set(known)
        there = lambda k: k in same or any(alike(k, x) for x in known)
        gone = [r["text"] for r in sorted(left, key=itemgetter("position")) if r["k"] and not there(r["k"])]
        if gone:
            yield doc, len(gone), gone[:samples]

    kind = old.schema["doc"].dataType.simpleString()
    keyed = lambda d: d.select("doc", "position", "text", match_key(F.col("text")).alias("k"))
    return over_documents(_lists(keyed(old), keyed(new)), run, f"doc {kind}, missing int, samples array<string>")


def heading_verdict(declared: str, found: list[str]) -> str:
    """ok, near, merged or missing for a declared heading against a parse's headings in order."""
    if declared in found:
        return "ok"
    for text in found:
        short, long = sorted((declared, text), key=len)
        if short and short in long and len(short) / len(long) >= 0.75:
            return "near"
        if _over(declared, text, 0.75):
            return "near"
    for a, b in zip(found, found[1:], strict=False):
        if declared == f"{a} {b}":
            return "merged"
    return "missing"


def heading_report(declared: DataFrame, elements: DataFrame) -> DataFrame:
    """(doc, position, text, verdict) of every declared heading."""
    from docketry.functions.text import heading_key

    def run(doc: object, left: list[dict], right: list[dict] | None) -> Iterator[tuple]:
        found = [r["k"] for r in sorted(right or (), key=itemgetter("position"))]
        return ((doc, r["position"], r["text"], heading_verdict(r["k"], found)) for r in left)

    kind = declared.schema["doc"].dataType.simpleString()
    keyed = lambda d: d.select("doc", F.col("position").cast("int").alias("position"), "text", heading_key(F.col("text")).alias("k"))
    return over_documents(_lists(keyed(declared), keyed(elements)), run, f"doc {kind}, position int, text string, verdict string")


def in_source(elements: DataFrame, sources: DataFrame, least: int = 20) -> DataFrame:
    """Elements (doc, position) whose letters and digits, if many enough, are not in the document's source text."""
    s = sources.select("doc", signature(F.col("text")).alias("whole"))
    e = elements.select("doc", "position", signature(F.col("text")).alias("part")).where(F.length("part") >= least)
    return e.join(s, "doc").where(~F.contains("whole", "part")).select("doc", "position")


def new_findings(findings: DataFrame, baseline: DataFrame) -> DataFrame:
    """Findings that were not triaged before."""
    return findings.join(baseline.select("doc", "check").distinct(), ["doc", "check"], "left_anti")


def gate(scanned: DataFrame, findings: DataFrame) -> DataFrame:
    """(scanned, findings, verdict): nothing scanned is a failure too."""
    return (
        scanned.agg(F.count("*").alias("scanned")).crossJoin(findings.agg(F.count("*").alias("findings")))
        .withColumn("verdict", F.when((F.col("scanned") > 0) & (F.col("findings") == 0), "pass").otherwise("fail"))
    )  # one row each


def worst_first(findings: DataFrame, weights: DataFrame) -> DataFrame:
    """(doc, checks, citations): documents by distinct failing checks, then citations."""
    counts = findings.groupBy("doc").agg(F.count_distinct("check").alias("checks"))
    return counts.join(weights, "doc", "left").select("doc", "checks", F.coalesce("citations", F.lit(0)).alias("citations")).orderBy(
        F.desc("checks"), F.desc("citations"), "doc"
    )


def scope_partition(catalog: DataFrame, elements: DataFrame, ledger: DataFrame) -> DataFrame:
    """(symbol, bucket): every catalogue symbol falls in the first bucket that fits.

    ``catalog``: symbol, in_scope.  ``ledger``: symbol, status.  ``elements``: doc (symbol), type, section, text.
    """
    visible = elements.where(shown("scope")).groupBy(F.col("doc").alias("symbol")).agg(F.count("*").alias("visible"))
    parents = visible.select(F.col("symbol").alias("parent"), F.lit(True).alias("parent_shown"))
    from docketry.functions.text import strip_bracket

    rows = (
        catalog.withColumn("parent", F.when(F.col("symbol").contains("["), strip_bracket(F.col("symbol"))))
        .join(visible, "symbol", "left").join(ledger.select("symbol", "status"), "symbol", "left").join(parents, "parent", "left")
    )
    bucket = (
        F.when(F.col("visible") > 0, "delivered")
        .when(F.col("parent_shown"), "within_parent")
        .when(~F.col("in_scope"), "out_of_scope")
        .when(F.col("status") == "split", "split")
        .when(F.col("status").isin("unavailable", "failed"), "no_file")
        .when(F.col("status") == "no_text_layer", "scan")
        .when(F.col("status").isin("convert_failed", "extract_failed", "parse_failed"), "broken")
        .when(F.col("status").isin("fetched", "converted", "extracted"), "pending")
        .when(F.col("status").isNull(), "not_fetched")
        .otherwise("unclassified")
    )
    return rows.select("symbol", bucket.alias("bucket"))


def partition_report(partition: DataFrame, universe: DataFrame) -> DataFrame:
    """(bucket, n, pct, sound): sound when the buckets sum to an independent count and none is unclassified."""
    counts = partition.groupBy("bucket").agg(F.count("*").alias("n"))
    total = universe.agg(F.count("*").alias("total"))
    whole = counts.agg(F.sum("n").alias("s"), F.coalesce(F.sum(F.when(F.col("bucket") == "unclassified", F.col("n"))), F.lit(0)).alias("u"))
    checked = total.crossJoin(whole).select("total", ((F.col("total") == F.col("s")) & (F.col("u") == 0) & (F.col("total") > 0)).alias("sound"))
    return counts.crossJoin(F.broadcast(checked)).select(  # one row
        "bucket", "n", F.round(100.0 * F.col("n") / F.col("total"), 2).alias("pct"), "sound"
    )


def small_share(n: Column, total: Column) -> Column:
    """A percentage; one that is not zero and rounds to it shows as below."""
    pct = F.round(100.0 * n / total, 2)
    return F.when((n > 0) & (pct < 0.01), "<0.01").otherwise(F.format_number(pct, 2))


def differs(a: Column, b: Column, most: int = 2, share: float = 0.2) -> Column:
    """Whether two counts differ by more than a few, or more than a share of the larger."""
    gap = F.abs(a - b)
    return (gap > most) | (gap > share * F.greatest(a, b))


def agreement(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """(left, right, n) with ``agrees`` and the overall share of agreement."""
    counts = pairs.groupBy(left, right).agg(F.count("*").alias("n"))
    same = F.sum(F.when(F.col(left).eqNullSafe(F.col(right)), F.col("n")).otherwise(0)).over(Window.partitionBy(F.lit(1)))
    every = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return counts.select(left, right, "n", F.round(same / every, 4).alias("agreement"))


def prefix_matches(new: DataFrame, old: DataFrame, size: int = 60, prefix: int = 40) -> DataFrame:
    """(doc, new_position, old_position, how): rows of two parses with one text key.

    Equal keys first; what is left may share the first ``prefix`` characters.  Each
    old row is used once, in order, so the fallback runs over each document's rest.
    """
    a = new.select("doc", F.col("position").alias("new_position"), match_key(F.col("text"), size).alias("k")).where("k != ''")
    b = old.select("doc", F.col("position").alias("old_position"), match_key(F.col("text"), size).alias("k")).where("k != ''")
    nth = lambda d, p: d.withColumn("nth", F.row_number().over(Window.partitionBy("doc", "k").orderBy(p)))
    a, b = nth(a, "new_position"), nth(b, "old_position")
    exact = a.join(b, ["doc", "k", "nth"]).select("doc", "new_position", "old_position", F.lit("exact").alias("how"))
    rest_a = a.join(exact, ["doc", "new_position"], "left_anti").withColumn("h", F.substring("k", 1, prefix))
    rest_b = b.join(exact, ["doc", "old_position"], "left_anti").withColumn("h", F.substring("k", 1, prefix))
    again = lambda d, p: d.withColumn("m", F.row_number().over(Window.partitionBy("doc", "h").orderBy(p)))
    near = again(rest_a, "new_position").join(again(rest_b, "old_position").select("doc", "h", "m", "old_position"), ["doc", "h", "m"])
    return exact.unionByName(near.select("doc", "new_position", "old_position", F.lit("prefix").alias("how")))


def document_review(elements: DataFrame, raw_rows: DataFrame, dropped: DataFrame, most_dropped: float = 0.15) -> DataFrame:
    """One row a document: rows accounted for, rows dropped, misplaced preambular rows, level jumps, flags."""
    order = Window.partitionBy("doc").orderBy("position")
    first_op = F.min(F.when(F.col("paragraph_type") == "operative", F.col("position"))).over(Window.partitionBy("doc"))
    marked = elements.select(
        "doc", "paragraph_type", F.size(F.array_distinct("raw_positions")).alias("used"),
        ((F.col("paragraph_type") == "preambular") & (F.col("position") > first_op)).alias("misplaced"),
        (F.col("level") - F.lag("level").over(order) > 1).alias("jump"),
    )
    e = marked.groupBy("doc").agg(
        F.sum("used").alias("used"), F.count_if("misplaced").alias("misplaced"), F.count_if("jump").alias("jumps"),
        F.count_if(F.col("paragraph_type") == "operative").alias("operatives"),
    )
    d = dropped.groupBy("doc").agg(F.count("*").alias("dropped"), F.count_if(F.col("reason") != "empty").alias("dropped_text"))
    r = raw_rows.groupBy("doc").agg(F.count("*").alias("rows"))
    both = r.join(e, "doc", "left").join(d, "doc", "left").na.fill(0)
    return both.select(
        "doc", "rows", F.round(100.0 * (F.col("used") + F.col("dropped")) / F.col("rows"), 2).alias("accounted_pct"), "misplaced", "jumps",
        F.filter(
            F.array(
                F.when(F.col("used") + F.col("dropped") != F.col("rows"), "accounting"), F.when(F.col("misplaced") > 0, "misordered"),
                F.when(F.col("jumps") > 0, "level_jump"), F.when(F.col("dropped_text") > most_dropped * F.col("rows"), "drop_rate"),
                F.when(F.col("operatives") == 0, "no_operatives"),
            ),
            lambda x: x.isNotNull(),
        ).alias("flags"),
    )


def group_report(elements: DataFrame, accounting: DataFrame, group: Column) -> DataFrame:
    """One row a group of documents: documents, rows accounted for, elements, and documents with each kind.

    ``accounting``: doc, rows, used.  Two aggregations, the first on the document.
    """
    one = elements.groupBy("doc").agg(
        F.count("*").alias("elements"), F.count_if(F.col("type") == "heading").alias("headings"),
        F.max((F.col("paragraph_type") == "operative").cast("int")).alias("operative"),
        F.max((F.col("paragraph_type") == "preambular").cast("int")).alias("preambular"), F.max((F.col("section") == "annex").cast("int")).alias("annex"),
    )
    rows = accounting.join(one, "doc", "left").na.fill(0)
    return rows.groupBy(group.alias("group")).agg(
        F.count("*").alias("documents"), F.round(100.0 * F.sum("used") / F.sum("rows"), 2).alias("accounted_pct"), F.sum("elements").alias("elements"),
        F.sum("headings").alias("headings"), F.sum("operative").alias("with_operative"), F.sum("preambular").alias("with_preambular"), F.sum("annex").alias("with_annex"),
    )


def commonest(rows: DataFrame, value: Column, example: Column, n: int = 30, examples: int = 2) -> DataFrame:
    """(value, n, examples): the n commonest values with their smallest examples.

    Examples come from a group limit, so a common value does not gather all its rows.
    """
    pairs = rows.select(value.alias("value"), example.alias("example")).where("value IS NOT NULL")
    top = pairs.groupBy("value").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(n)
    order = Window.partitionBy("value").orderBy("example")
    few = pairs.withColumn("__r", F.dense_rank().over(order)).where(F.col("__r") <= examples).groupBy("value").agg(F.array_sort(F.collect_set("example")).alias("examples"))
    return top.join(few, "value")


def attribution(children: DataFrame, rows: DataFrame) -> DataFrame:
    """Children (child, symbol) whose first row is not their own printed heading."""
    from docketry.operators.pages import heading_keys, printed_key

    first = rows.groupBy(F.col("doc").alias("child")).agg(F.min_by("text", "position").alias("text"))
    both = children.join(first, "child", "left").withColumn("__k", printed_key(F.col("text")))
    return both.where(~F.col("__k").eqNullSafe(heading_keys(F.col("symbol")))).select("child", "symbol", "text")


def verb_report(pairs: DataFrame) -> DataFrame:
    """One row: coverage and agreement of two annotations of the same clauses.

    ``pairs``: new_verb, old_verb, new_category, old_category, new_head, old_head.
    Heads agree loosely: one holds the other.
    """
    both = F.col("new_verb").isNotNull() & F.col("old_verb").isNotNull()
    same = lambda a, b: F.round(F.count_if(both & (F.col(a) == F.col(b))) / F.greatest(F.count_if(both), F.lit(1)), 4)
    heads = F.col("new_head").isNotNull() & F.col("old_head").isNotNull()
    a, b = F.lower("new_head"), F.lower("old_head")
    return pairs.agg(
        F.count("*").alias("clauses"), F.round(F.count_if(F.col("new_verb").isNotNull()) / F.greatest(F.count("*"), F.lit(1)), 4).alias("coverage"),
        same("new_verb", "old_verb").alias("verb_agreement"), same("new_category", "old_category").alias("category_agreement"),
        F.round(F.count_if(heads & (a.contains(b) | b.contains(a))) / F.greatest(F.count_if(heads), F.lit(1)), 4).alias("head_agreement"),
    )


def declared_headings(rows: DataFrame) -> DataFrame:
    """(doc, position, text, how): headings a document itself declares, each text once.

    By style, by a contents line (dot leaders and a page number), or by a bold line
    of its own.  ``rows``: doc, position, text, style_id, bold.
    """
    from docketry.functions.text import heading_key

    contents = F.col("text").rlike(r"\.{3,}\s*\d+\s*$")
    how = (
        F.when(F.col("style_id").rlike(r"(?i)^(H\d+[GM]?|HCh[GM]?|Heading\d+|ArtHead|SectionHead|ChapterHead)$"), "style")
        .when(contents, "contents").when(F.col("bold") & (F.length("text") <= 120) & ~F.col("text").rlike(r"[.;,]\s*$"), "bold")
    )
    found = rows.select("doc", "position", "text", how.alias("how"), heading_key(F.col("text")).alias("__k")).where("how IS NOT NULL AND __k != ''")
    first = Window.partitionBy("doc", "__k").orderBy("position")
    return found.withColumn("__r", F.row_number().over(first)).where("__r = 1").drop("__r", "__k")
