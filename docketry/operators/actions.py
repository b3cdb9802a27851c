"""Action verbs of clauses: matched, described and inherited, as column expressions.

A clause's head is matched against one alternation of all surfaces, longest first; the
surface found is looked up in a constant map.  Items under a clause that ends in a
colon inherit its governing verb, carried by a window over the document.
"""

from __future__ import annotations

import json
import re
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.functions import lexicon as lx
from docketry.functions.text import squeeze
from docketry.operators.sequences import carried, so_far

ENTRY = "struct<lemma:string,category:string,form:string,force:int,sentiment:int,bindingness:string,budget:boolean,addressee:boolean,carrier:string>"
ACTION = (
    "struct<verb:string,lemma:string,category:string,force:int,sentiment:int,bindingness:string,budget:boolean,"
    "modifiers:array<struct<kind:string,text:string>>,secondary:string,assignee:string,assignee_head:string,assignee_class:string,"
    "marker:string,inherited:boolean>"
)


def _either(words) -> str:
    return "|".join(re.escape(w).replace(r"\ ", " ") for w in sorted(words, key=lambda w: (-len(w), w)))


@cache
def _table() -> tuple[str, str, str]:
    found = lx.surfaces(bare=True)
    whole = {
        s: {"lemma": v.lemma, "category": v.category, "form": form, "force": v.force, "sentiment": v.sentiment, "bindingness": v.bindingness,
            "budget": v.budget, "addressee": v.addressee, "carrier": v.carrier}
        for s, (v, form) in found.items()
    }
    lemmas: dict[str, dict] = {}
    for e in whole.values():
        lemmas.setdefault(e["lemma"], e)
    return json.dumps(whole), json.dumps(lemmas), _either(found)


def addressee_class(text: Column) -> Column:
    """The first class with one of its words in the text; words may lie within longer ones."""
    low = F.concat(F.lit(" "), F.lower(F.trim(text)), F.lit(" "))
    out = None
    for name, words in lx.ADDRESSEES:
        hit = low.rlike(_either(words))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("unclear")


def describe(rows: DataFrame, text: str = "text", kind: str = "paragraph_type", out: str = "own") -> DataFrame:
    """Rows with an ACTION struct of each clause by itself; null if no verb heads it.

    Every step is a column of its own, so no pattern is matched twice.
    """
    table, _, names = _table()
    entries = F.from_json(F.lit(table), f"map<string,{ENTRY}>")
    mods = "|".join(f"(?:{_either(ws)})" for ws in lx.MODIFIERS.values())
    c = lambda name: F.col(f"__{name}")
    operative = F.coalesce(F.col(kind), F.lit("")) == "operative"
    steps: list[tuple[str, Column]] = [
        ("s", squeeze(F.col(text))),
        ("we", operative & c("s").rlike(r"^We\b")),
        ("t", F.when(c("we"), F.regexp_replace(c("s"), r"^We\b\s*,?\s*", "")).otherwise(c("s"))),
        ("will", F.when(c("we"), F.lower(F.regexp_extract(c("t"), r"(?i)^(will|shall)\b", 1))).otherwise("")),
        ("direct", F.regexp_extract(c("t"), rf"(?i)^({names})(?![\p{{L}}])", 1)),
        ("lead", F.when(c("direct") == "", F.regexp_extract(c("t"), rf"(?i)^((?:(?:{mods})(?![\p{{L}}])[ ,]*)+)(?=\p{{L}})", 1)).otherwise("")),
        ("rest", F.substring(c("t"), F.length(c("lead")) + 1, F.length(c("t")))),
        ("found", F.when(c("direct") != "", c("direct")).otherwise(F.regexp_extract(c("rest"), rf"(?i)^({names})(?![\p{{L}}])", 1))),
        ("e", F.when(c("will") != "", entries[F.lit("decides")]).otherwise(entries[F.lower(c("found"))])),
        ("tail", F.trim(F.substring(c("rest"), F.length(c("found")) + 1, F.length(c("rest"))))),
        ("noun", F.when(
            c("e")["carrier"] == "express",
            F.try_element_at(F.filter(F.slice(F.filter(F.split(F.lower(c("tail")), r"[^\p{L}-]+"), lambda w: w != ""), 1, 4), lambda w: ~w.isin(*lx.FILLERS)), F.lit(1)),
        ).when(c("e")["carrier"].isNotNull(), F.lower(F.regexp_extract(c("tail"), r"(?i)^with\s+(?:(?:deep|grave|serious|profound)\s+)?([a-z]+)", 1)))),
        # What is expressed, or noted with, gives the polarity; any other object is neutral.
        ("pole", F.when(c("noun").isin(*lx.NEGATIVE), -1).when(c("noun").isin("appreciation", "satisfaction"), 1)
            .when((c("e")["carrier"] == "express") & c("noun").isin("gratitude", "support"), 1)
            .when((c("e")["carrier"] != "express") & c("noun").isin(*lx.POSITIVE, "interest"), 1).when(c("e")["carrier"].isNotNull(), 0)),
        ("second", F.lower(F.regexp_extract(F.substring(c("tail"), 1, 80), rf"(?i)^.{{0,60}}?\band (?:(?:{mods})[ ,]+)?({names})(?![\p{{L}}])", 1))),
        ("to", F.when(c("e")["addressee"], F.regexp_extract(c("tail"), r"^(.*?)\s+to(?=\s|$)", 1))),
        ("span", F.when(c("to") != "", c("to")).when(c("e")["addressee"], F.regexp_extract(c("tail"), r"^([^;:]*)", 1))),
        ("assignee", F.nullif(F.trim(F.regexp_replace(c("span"), r"[\s,;:.]+$", "")), F.lit(""))),
        ("head", F.trim(F.regexp_replace(F.regexp_extract(c("assignee"), r"^([^,]*)", 1), rf"(?i)^(?:{_either(lx.QUANTIFIERS)})\s+", ""))),
    ]
    work = rows
    for name, value in steps:
        work = work.withColumn(f"__{name}", value)
    e = c("e")
    express = e["carrier"] == "express"
    lemma = (
        F.when(express & (c("noun") == "support"), "support").when(express & (c("pole") == -1), "express concern")
        .when(express & c("noun").isin("appreciation", "gratitude", "satisfaction"), "appreciate").otherwise(e["lemma"])
    )
    listed = F.transform(
        F.regexp_extract_all(F.lower(c("lead")), F.lit(rf"(?:{mods})(?![\p{{L}}])"), F.lit(0)),
        lambda m: F.struct(
            F.when(m.isin(*lx.MODIFIERS["repetition"]), "repetition").when(m.isin(*lx.MODIFIERS["intensity"]), "intensity").otherwise("connective").alias("kind"),
            m.alias("text"),
        ),
    )
    noted = ~express & (c("pole") != 0)
    listed = F.when(noted, F.concat(listed, F.array(F.struct(F.lit("qualifier").alias("kind"), F.concat(F.lit("with "), c("noun")).alias("text"))))).otherwise(listed)
    spoken = F.when(c("will") != "", c("will")).otherwise(F.concat_ws(" ", F.nullif(F.lower(F.trim(c("lead"))), F.lit("")), F.lower(c("found"))))
    second = entries[c("second")]
    made = F.struct(
        spoken.alias("verb"), lemma.alias("lemma"), e["category"].alias("category"), e["force"].alias("force"),
        F.coalesce(c("pole"), e["sentiment"]).alias("sentiment"), e["bindingness"].alias("bindingness"), e["budget"].alias("budget"), listed.alias("modifiers"),
        F.when(second["form"] == "operative", second["lemma"]).alias("secondary"), c("assignee").alias("assignee"), F.nullif(c("head"), F.lit("")).alias("assignee_head"),
        F.when(c("assignee").isNotNull(), addressee_class(c("assignee"))).alias("assignee_class"), F.lit(None).cast("string").alias("marker"),
        F.lit(False).alias("inherited"),
    )
    # A participle in an operative item is no head of its own.
    gerund = operative & (e["form"] == "preambular") & c("found").rlike("(?i)ing$")
    marker = F.from_json(F.lit(json.dumps({"marker": "chapter_vii", "inherited": False})), ACTION)
    own = F.when(c("s").rlike(lx.CHAPTER_SEVEN), marker).when(e.isNotNull() & ~F.coalesce(gerund, F.lit(False)), made)
    return work.withColumn(out, own).drop(*[f"__{name}" for name, _ in steps])


def governing(text: Column) -> Column:
    """ACTION of the verb that governs the items below a clause ending in a colon, if one is named."""
    _, lemmas, _ = _table()
    entries = F.from_json(F.lit(lemmas), f"map<string,{ENTRY}>")
    t = squeeze(text)
    active = F.lower(F.regexp_extract(t, lx.GOVERNS, 1))
    passive = F.lower(F.regexp_extract(t, lx.GOVERNED, 1))
    names = F.create_map(*[F.lit(x) for kv in (lx.GOVERNING | lx.PASSIVE).items() for x in kv])
    word = F.when(active != "", active).otherwise(F.nullif(passive, F.lit("")))
    e = entries[names[word]]
    made = F.struct(
        word.alias("verb"), e["lemma"].alias("lemma"), e["category"].alias("category"), e["force"].alias("force"), e["sentiment"].alias("sentiment"),
        e["bindingness"].alias("bindingness"), e["budget"].alias("budget"), F.array().cast("array<struct<kind:string,text:string>>").alias("modifiers"),
        F.lit(None).cast("string").alias("secondary"), F.lit(None).cast("string").alias("assignee"), F.lit(None).cast("string").alias("assignee_head"),
        F.lit(None).cast("string").alias("assignee_class"), F.lit(None).cast("string").alias("marker"), F.lit(False).alias("inherited"),
    )
    return F.when(t.endswith(":") & e.isNotNull(), made)


def annotate(elements: DataFrame) -> DataFrame:
    """Elements with ``action``: own verb, or that of the clause that governs them.

    ``elements``: doc, position, text, paragraph_type, level, prefix.  The governing clause is
    the latest with a verb that ends in a colon; a clause of the top level without a colon ends its reach.
    """
    kind = F.col("paragraph_type")
    labelled = kind.isin("operative", "preambular")
    rows = describe(elements, out="__own").withColumn("__own", F.when(labelled, F.col("__own")))
    colon = labelled & squeeze(F.col("text")).endswith(":")
    rows = rows.withColumn("__gov", governing(F.col("text")))
    top = F.coalesce("level", F.when(kind == "operative", 1).otherwise(0)) <= 1
    ends = labelled & top & ~colon
    # A list opened without a verb of its own leaves the clause above it in force.
    lead = (
        F.when(labelled & F.col("__gov").isNotNull(), F.struct(F.col("__gov").alias("a")))
        .when(colon & F.col("__own")["lemma"].isNotNull(), F.struct(F.col("__own").alias("a")))
        .when(ends, F.struct(F.lit(None).cast(ACTION).alias("a")))
    )
    rows = rows.withColumn("__lead", lead)
    before = carried(F.col("__lead"), so_far().rowsBetween(-(1 << 31), -1))["a"]
    item = F.col("prefix").isNotNull() | (F.coalesce("level", F.lit(0)) > 1) | F.col("text").rlike(r"^To\b") | F.col("text").rlike(r"^\p{Ll}")
    given = before.withField("inherited", F.lit(True))
    rows = rows.withColumn("__before", F.when(before.isNotNull(), given))
    action = (
        F.when(F.col("__own").isNotNull(), F.col("__own"))
        .when(labelled & F.col("__gov").isNotNull(), F.col("__gov"))
        .when(labelled & item & ~ends, F.col("__before"))
    )
    return rows.withColumn("action", action).drop("__own", "__gov", "__lead", "__before")


def flattened(annotated: DataFrame) -> DataFrame:
    """The action's parts as columns."""
    names = {
        "verb": "action_verb", "lemma": "action_verb_normalized", "category": "action_category", "force": "action_force",
        "sentiment": "action_sentiment", "bindingness": "action_bindingness", "budget": "action_budget_relevant", "modifiers": "action_modifiers",
        "assignee": "assignee", "assignee_head": "assignee_head_noun", "assignee_class": "assignee_class", "inherited": "action_inherited",
        "marker": "action_context_marker",
    }
    return annotated.select(*[c for c in annotated.columns if c != "action"], *[F.col(f"action.{k}").alias(v) for k, v in names.items()])
