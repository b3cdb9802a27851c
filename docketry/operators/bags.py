"""Bags of words: what a derived text lost from its source, and what it made up.

A bag is (doc, tok, n).  Both directions are always measured, the denominators
come from the source, and a check over nothing fails.

A text is (doc, k, tok), a row a token, or (doc, k, line), a row a line whose tokens have
single blanks between them.  Two texts are compared a document at a time: each moves once,
and runs of neighbours are made where their document is and never leave it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from operator import concat

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry.functions.text import gate_line, gate_tokens
from docketry.operators.documents import over_documents


def bag(rows: DataFrame, doc: str, tokens: Column) -> DataFrame:
    """(doc, tok, n) from an array column."""
    return rows.select(F.col(doc).alias("doc"), F.explode(tokens).alias("tok")).groupBy("doc", "tok").agg(F.count("*").alias("n"))


def minus(a: DataFrame, b: DataFrame) -> DataFrame:
    """Positive part of a - b."""
    other = b.select("doc", "tok", F.col("n").alias("m"))
    left = a.join(other, ["doc", "tok"], "left").select("doc", "tok", (F.col("n") - F.coalesce("m", F.lit(0))).alias("n"))
    return left.where("n > 0")


def token_rows(rows: DataFrame, doc: str, position: str, text: str) -> DataFrame:
    """(doc, k, tok): gate tokens numbered through a document."""
    flat = rows.select(F.col(doc).alias("doc"), F.col(position).alias("p"), F.posexplode(gate_tokens(F.col(text))).alias("q", "tok"))
    return flat.select("doc", F.row_number().over(Window.partitionBy("doc").orderBy("p", "q")).alias("k"), "tok")


def token_lines(rows: DataFrame, doc: str, position: str, text: str) -> DataFrame:
    """(doc, k, line): the gate tokens of every row with single blanks between them; rows without any stay, as a filter would read all lines twice."""
    return rows.select(F.col(doc).alias("doc"), F.col(position).alias("k"), gate_line(F.col(text)).alias("line"))


def _beside(source: DataFrame, parsed: DataFrame) -> DataFrame:
    """(doc, a, b): the words of both texts in their order, one row a document; lines as one string, tokens as an array."""

    def side(text: DataFrame, name: str) -> DataFrame:
        k = F.col("k") if "k" in text.columns else F.lit(0).alias("k")
        if "line" in text.columns:
            return text.select("doc", F.struct(k, F.col("line").alias("w")).alias(name))
        return text.where("tok IS NOT NULL").select("doc", F.struct(k, F.col("tok").alias("w")).alias(name))

    def words(text: DataFrame, name: str) -> Column:
        ordered = F.transform(F.array_sort(name), lambda x: x["w"])
        return (F.array_join(ordered, " ") if "line" in text.columns else ordered).alias(name)

    held = side(source, "a").unionByName(side(parsed, "b"), allowMissingColumns=True)
    both = held.groupBy("doc").agg(F.collect_list("a").alias("a"), F.collect_list("b").alias("b"))
    return both.select("doc", words(source, "a"), words(parsed, "b"))


Words = list[str]


def _compared(source: DataFrame, parsed: DataFrame, judge: Callable[[Words, Words], Iterable[tuple]], columns: str) -> DataFrame:
    """The rows that ``judge`` gives for each document, after its key."""
    listed = lambda v: v.split() if isinstance(v, str) else v

    def run(doc: object, a: str | Words, b: str | Words) -> Iterator[tuple]:
        return ((doc, *row) for row in judge(listed(a), listed(b)))

    kind = source.schema["doc"].dataType.simpleString()
    return over_documents(_beside(source, parsed), run, f"doc {kind}, {columns}")


def _runs_of(words: Words, longest: int = 4) -> list[Words]:
    """At every place the two, three to ``longest`` neighbours from it on written together, a list for each length."""
    out, last = [], words
    for n in range(1, longest):
        last = list(map(concat, last, words[n:]))
        out.append(last)
    return out


def _parts(known: set[str], words: Words, runs: list[Words]) -> set[str]:
    """Words within a run that together is a known word."""
    return {t for n, run in enumerate(runs, 2) for i, whole in enumerate(run) if whole in known for t in words[i : i + n]}


def _lost_words(a: Words, b: Words, runs: tuple[list[Words], list[Words]] | None = None) -> dict[str, int]:
    gone = {t: n for t, n in (Counter(a) - Counter(b)).items() if len(t) > 2 and not (t.isascii() and t.isdigit())}
    if not gone:
        return gone
    ra, rb = runs or (_runs_of(a), _runs_of(b))
    asked = set(gone)
    known = set().union(*[asked.intersection(r) for r in rb]) | _parts(set(b), a, ra)
    return {t: n for t, n in gone.items() if t not in known}


def _invented_words(a: Words, b: Words, runs: tuple[list[Words], list[Words]] | None = None) -> dict[str, int]:
    words = set(a)
    made = {t: n for t, n in Counter(b).items() if t not in words}
    if not made:
        return made
    ra, rb = runs or (_runs_of(a), _runs_of(b))
    asked = set(made)
    known = set().union(*[asked.intersection(r) for r in ra]) | _parts(words, b, rb)
    asked -= known
    sizes = sorted({len(t) for t in asked if len(t) > 2})
    for w in words if sizes else ():
        if len(w) >= 5:
            for n in sizes:
                if n >= len(w):
                    break
                known.update(asked.intersection((w[:n], w[-n:])))
    return {t: n for t, n in made.items() if t not in known}


def _runs(tokens: DataFrame, longest: int) -> DataFrame:
    """(doc, runs): at every token the two to ``longest`` neighbouring tokens from it on, together and apart."""
    order = Window.partitionBy("doc").orderBy("k")
    wide = tokens.select("doc", "tok", *[F.lead("tok", i).over(order).alias(f"a{i}") for i in range(1, longest)])

    def run(i: int) -> Column:
        parts = ["tok", *[f"a{j}" for j in range(1, i + 1)]]
        return F.when(F.col(f"a{i}").isNotNull(), F.struct(F.concat(*parts).alias("whole"), F.array(*parts).alias("parts")))

    return wide.select("doc", F.filter(F.array(*[run(i) for i in range(1, longest)]), lambda r: r.isNotNull()).alias("runs"))


def joined_runs(tokens: DataFrame, longest: int = 4) -> DataFrame:
    """(doc, tok, parts): two to ``longest`` neighbouring tokens written together."""
    found = _runs(tokens, longest).select("doc", F.explode("runs").alias("r"))
    return found.select("doc", F.col("r.whole").alias("tok"), F.size("r.parts").alias("parts"))


def _pieces(least: int) -> Column:
    """Proper beginnings and endings of ``tok``."""
    sizes = F.sequence(F.lit(least), F.length("tok") - 1)
    return F.concat(
        F.transform(sizes, lambda n: F.substring("tok", F.lit(1), n)),
        F.transform(sizes, lambda n: F.substring(F.col("tok"), F.length("tok") - n + 1, n)),
    )


def fragments(source: DataFrame, least_piece: int = 3, least_word: int = 5) -> DataFrame:
    """(doc, tok): proper beginnings and endings of the source's longer words."""
    words = source.where(F.length("tok") >= least_word).select("doc", "tok").distinct()
    return words.select("doc", F.explode(_pieces(least_piece)).alias("tok")).distinct()


def difference(source: DataFrame, parsed: DataFrame) -> DataFrame:
    """(doc, tok, n): how much oftener the source has a token than the parse."""
    return _compared(source, parsed, lambda a, b: (Counter(a) - Counter(b)).items(), "tok string, n bigint")


def lost(source: DataFrame, parsed: DataFrame, ignore: DataFrame | None = None) -> DataFrame:
    """Tokens of the source the parse lacks: no digits, two letters or less, ignored words, or words split or run together."""
    gone = _compared(source, parsed, lambda a, b: _lost_words(a, b).items(), "tok string, n bigint")
    return gone if ignore is None else gone.join(ignore.select("doc", "tok").distinct(), ["doc", "tok"], "left_anti")


def invented(source: DataFrame, parsed: DataFrame) -> DataFrame:
    """Tokens of the parse that are no word, run of words, part of a run or fragment of the source."""
    return _compared(source, parsed, lambda a, b: _invented_words(a, b).items(), "tok string, n bigint")


def split_parts(source: DataFrame, parsed: DataFrame, longest: int = 4) -> DataFrame:
    """(doc, tok): parsed tokens within a run that together is a word of the source."""
    return _compared(source, parsed, lambda a, b: ((t,) for t in _parts(set(a), b, _runs_of(b, longest))), "tok string")


def conservation(source: DataFrame, parsed: DataFrame, most_lost: int = 5, least_kept: float = 95.0, most_invented: int = 0) -> DataFrame:
    """One verdict a document: both numbers within bounds, or fail; an unparsed document fails."""

    def judge(a: Words, b: Words) -> Iterator[tuple]:
        if a:
            runs = _runs_of(a), _runs_of(b)
            yield len(a), sum(_lost_words(a, b, runs).values()), sum(_invented_words(a, b, runs).values()), bool(b)

    rows = _compared(source, parsed, judge, "words bigint, lost bigint, invented bigint, parsed boolean")
    kept = F.round(100.0 * (F.col("words") - F.col("lost")) / F.col("words"), 3)
    good = F.col("parsed") & (F.col("lost") <= most_lost) & (kept >= least_kept) & (F.col("invented") <= most_invented)
    return rows.select("doc", "words", "lost", "invented", kept.alias("kept_pct"), F.when(good, "pass").otherwise("fail").alias("verdict"))


def foreign_elements(elements: DataFrame, source: DataFrame, region: DataFrame, least: int = 8, share: float = 0.6) -> DataFrame:
    """(doc, position, verdict): elements whose words the source, or the document's part of it, does not hold.

    ``elements``: doc, position, text.  ``source`` and ``region``: (doc, tok, …).
    """
    words = elements.select("doc", "position", F.explode(F.array_distinct(F.filter(gate_tokens(F.col("text")), lambda t: F.length(t) > 2))).alias("tok"))
    in_source = source.select("doc", "tok").distinct().withColumn("s", F.lit(1))
    in_region = region.select("doc", "tok").distinct().withColumn("r", F.lit(1))
    held = words.join(in_source, ["doc", "tok"], "left").join(in_region, ["doc", "tok"], "left")
    counts = held.groupBy("doc", "position").agg(F.count("*").alias("n"), F.count("s").alias("s"), F.count("r").alias("r")).where(F.col("n") >= least)
    verdict = F.when(F.col("s") / F.col("n") < share, "invented").when(F.col("r") / F.col("n") < share, "out_of_region")
    return counts.select("doc", "position", verdict.alias("verdict")).where("verdict IS NOT NULL")


def crop_split(gone: DataFrame, outside: DataFrame) -> DataFrame:
    """(doc, tok, n, cropped): lost tokens, and whether the source has them outside the document's region as well."""
    beyond = outside.select("doc", "tok").distinct().withColumn("__o", F.lit(True))
    return gone.join(beyond, ["doc", "tok"], "left").select("doc", "tok", "n", F.coalesce("__o", F.lit(False)).alias("cropped"))


def word_accounting(raw: DataFrame, *used: DataFrame) -> DataFrame:
    """(doc, tok, n): words of the rows that no element, label, note or dropped row accounts for.

    All bags: (doc, tok, n).
    """
    every = used[0]
    for more in used[1:]:
        every = every.unionByName(more)
    return minus(raw, every.groupBy("doc", "tok").agg(F.sum("n").alias("n")))


def child_conservation(child: DataFrame, slice_: DataFrame, sibling: DataFrame) -> DataFrame:
    """(doc, lost, extra, verdict): types a child lacks and has beyond its slice; of two copies it must not be the shorter.

    ``child``, ``slice_``, ``sibling``: (doc, tok, n); a child without a sibling is only held against its slice.
    """
    types = lambda b, name: b.select("doc", "tok").distinct().withColumn(name, F.lit(True))
    both = types(child, "c").join(types(slice_, "s"), ["doc", "tok"], "full_outer")
    apart = both.groupBy("doc").agg(F.count_if(F.col("c").isNull()).alias("lost"), F.count_if(F.col("s").isNull()).alias("extra"))
    size = lambda b, name: b.groupBy("doc").agg(F.sum("n").alias(name))
    rows = apart.join(size(child, "own"), "doc", "left").join(size(sibling, "other"), "doc", "left")
    good = (F.col("lost") == 0) & (F.col("extra") == 0) & (F.coalesce("own", F.lit(0)) >= F.coalesce("other", F.lit(0)))
    return rows.select("doc", "lost", "extra", F.when(good, "pass").otherwise("fail").alias("verdict"))


def position_accounting(raw: DataFrame, elements: DataFrame, dropped: DataFrame) -> DataFrame:
    """(doc, position, problem): rows used twice, not at all, or that never were.

    ``elements``: doc, raw_positions (array; within an element a position counts once).
    """
    used = elements.select("doc", F.explode(F.array_distinct("raw_positions")).alias("position")).unionByName(dropped.select("doc", "position"))
    counts = used.groupBy("doc", "position").agg(F.count("*").alias("uses"))
    both = raw.select("doc", "position", F.lit(True).alias("there")).join(counts, ["doc", "position"], "full_outer")
    problem = F.when(F.col("there").isNull(), "phantom").when(F.col("uses").isNull(), "missing").when(F.col("uses") > 1, "duplicate")
    return both.select("doc", "position", problem.alias("problem")).where("problem IS NOT NULL")


def unbacked_elements(elements: DataFrame, raw: DataFrame) -> DataFrame:
    """(doc, position, tok, n): words an element has beyond the rows it names.

    ``elements``: doc, position, text, raw_positions.  ``raw``: doc, position, text.
    """
    key = F.concat_ws("\u0001", F.col("doc").cast("string"), F.col("position").cast("string"))
    own = bag(elements.withColumn("key", key), "key", gate_tokens(F.col("text")))
    named = elements.select(key.alias("key"), "doc", F.explode(F.array_distinct("raw_positions")).alias("position"))
    backing = bag(named.join(raw, ["doc", "position"]), "key", gate_tokens(F.col("text")))
    made = minus(own, backing)
    parts = F.split("doc", "\u0001")
    return made.select(parts[0].alias("doc"), parts[1].cast("int").alias("position"), "tok", "n")


def source_share(words: DataFrame, trusted: float = 0.5, fallback: float = 0.25, least_span: int = 40) -> DataFrame:
    """(doc, share, verdict): parsed words against the words of the document's span.

    ``words``: doc, parsed, span, page_average.  A span under ``least_span`` words is no
    measure; the page average then stands in, with a lower floor.
    """
    short = F.col("span") < least_span
    base = F.when(short, F.col("page_average")).otherwise(F.col("span"))
    share = F.when(base > 0, F.col("parsed") / base).otherwise(0.0)
    floor = F.when(short, fallback).otherwise(trusted)
    return words.select("doc", F.round(share, 4).alias("share"), F.when(share >= floor, "pass").otherwise("fail").alias("verdict"))


def type_coverage(truth: DataFrame, *stored: DataFrame, bar: float = 0.97) -> DataFrame:
    """(doc, types, covered, verdict): word types of the truth found in any of the stored sets."""
    word = "line" if all("line" in t.columns for t in (truth, *stored)) else "tok"
    alike = lambda t: t.select("doc", word) if word in t.columns else t.select("doc", F.explode(F.split("line", " ")).alias("tok")).where("tok <> ''")
    truth, held, *others = map(alike, (truth, *stored))
    for more in others:
        held = held.unionByName(more)
    listed = lambda c: F.array_distinct(F.filter(F.split(c, " "), lambda t: t != "") if word == "line" else F.col(c)).alias(c)
    types = _beside(truth, held).select("doc", listed("a"), listed("b")).where(F.size("a") > 0)
    counts = types.select("doc", F.size("a").cast("long").alias("types"), F.size(F.array_intersect("a", "b")).cast("long").alias("covered"))
    return counts.select("doc", "types", "covered", F.when(F.col("covered") / F.col("types") >= bar, "pass").otherwise("fail").alias("verdict"))


def breaks_into(token: str, vocabulary: set[str], least: int = 3) -> bool:
    """Whether a token is two or more words of a vocabulary written together."""
    reach = [False] * (len(token) + 1)
    reach[0] = True
    for end in range(least, len(token) + 1):
        reach[end] = any(reach[at] and (at, end) != (0, len(token)) and token[at:end] in vocabulary for at in range(end - least + 1))
    return len(token) >= 2 * least and reach[-1]


def run_together(residual: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(doc, tok): residual tokens that split into words of their document."""

    def split(doc: object, left: Words, right: Words | None) -> Iterator[tuple]:
        known = set(right or ())
        return ((doc, t) for t in left if breaks_into(t, known))

    kind = residual.schema["doc"].dataType.simpleString()
    types = lambda b, name: b.groupBy("doc").agg(F.collect_set("tok").alias(name))
    return over_documents(types(residual, "left").join(types(vocabulary, "right"), "doc", "left").select("doc", "left", "right"), split, f"doc {kind}, tok string")
