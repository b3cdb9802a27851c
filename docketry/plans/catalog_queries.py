"""Registered queries of the catalogue operators on the driver's tables, with their SQL.

Stand-ins: ``documents`` is the catalogue (and, split into lines, the paragraphs),
``events`` the usage log, ``orders`` and ``lineitem`` the ledger and the numbered
clauses, ``conversations`` the volumes.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docketry.functions import text as tx
from docketry.operators import actions, audits, bags, catalog, ledger, metrics, sequences, upserts, usage
from docketry.plans import parse
from docketry.session import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# ---- stand-in views ---------------------------------------------------------------


def records(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(
        F.col("doc_id").alias("recid"), F.concat("source", F.lit("/RES/"), F.col("doc_id").cast("string")).alias("symbol"),
        F.split("text", "\n")[0].alias("title"), F.col("source").alias("body"), F.col("lang").alias("kind"), F.array("lang").alias("languages"),
        F.array("source", "lang").alias("subjects"), F.date_add(F.lit(date(2020, 1, 1)), (F.col("doc_id") % 1000).cast("int")).alias("published"),
        F.when(F.col("doc_id") % 50 == 49, F.lit(datetime(2024, 1, 1))).alias("deleted_at"),
    )


C = """c AS (SELECT doc_id AS recid, source || '/RES/' || doc_id AS symbol, split_part(text, chr(10), 1) AS title, source AS body, lang AS kind,
    [lang] AS languages, [source, lang] AS subjects, DATE '2020-01-01' + CAST(doc_id % 1000 AS INTEGER) AS published FROM documents WHERE doc_id % 50 <> 49)"""


def lines(spark: SparkSession, d: str) -> DataFrame:
    """Paragraph rows: a type and a label by simple rules, numbered by line."""
    rows = parse.lines_as_rows(table(spark, d, "documents"))
    n = tx.word_count(F.col("text"))
    return rows.select(
        "doc", "position", "text", "kind",
        F.when(F.col("position") == 0, "title").when(n <= 4, "heading").otherwise("paragraph").alias("type"),
        F.lit(None).cast("string").alias("subtype"),
        F.when(F.col("position") % 4 == 3, "annex").otherwise("main").alias("section"), F.when(F.col("position") % 4 == 3, F.col("position") % 3).alias("annex_index"),
        F.when((F.col("position") > 0) & (n > 4) & (F.col("position") % 3 != 0), F.when(F.col("position") % 2 == 0, "operative").otherwise("preambular")).alias("paragraph_type"),
        F.when(F.col("position") % 4 == 3, "(a)").alias("prefix"), F.array("position").alias("raw_positions"), (F.col("position") % 3).alias("level"),
    )


WC = "CASE WHEN trim(regexp_replace(text, '\\s+', ' ', 'g')) = '' THEN 0 ELSE len(string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' ')) END"
L = f"""l0 AS (SELECT doc_id AS doc, string_split(text, chr(10)) AS t FROM documents),
    l1 AS (SELECT doc, unnest(range(0, len(t))) AS position, unnest(t) AS text FROM l0),
    l2 AS (SELECT doc, CAST(position AS INTEGER) AS position, text, {WC} AS n FROM l1),
    l AS (SELECT doc, position, text, n, CASE WHEN position = 0 THEN 'title' WHEN n <= 4 THEN 'heading' ELSE 'paragraph' END AS type,
        CASE WHEN position % 4 = 3 THEN 'annex' ELSE 'main' END AS section, CASE WHEN position % 4 = 3 THEN position % 3 END AS annex_index,
        CASE WHEN position > 0 AND n > 4 AND position % 3 <> 0 THEN CASE WHEN position % 2 = 0 THEN 'operative' ELSE 'preambular' END END AS paragraph_type FROM l2)"""


def calls(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(
        "event_id", F.concat(F.lit("key:"), F.col("user_id").cast("string")).alias("caller"), F.col("ts").cast("timestamp").alias("ts"),
        F.when(F.col("user_id") % 3 == 0, "free").otherwise("anonymous").alias("tier"), "event_type",
    )


def clauses(spark: SparkSession, d: str) -> DataFrame:
    """Numbered rows: a customer's orders in the order of their keys."""
    n = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    return table(spark, d, "orders").select(F.col("o_custkey").alias("doc"), n.alias("position"), F.col("o_orderkey").alias("k"))


N = "n AS (SELECT o_custkey AS doc, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS position, o_orderkey AS k FROM orders)"
NOW = datetime(2024, 1, 20, 12)

# ---- listing, search, facets --------------------------------------------------------


@query(f"""WITH {C} SELECT symbol, title, body, kind, published, recid FROM c WHERE body = 'src3' AND list_contains(languages, 'en')
    AND published BETWEEN DATE '2020-02-01' AND DATE '2022-01-01' ORDER BY published DESC NULLS LAST, recid LIMIT 20""")
def doc_list_filtered(spark: SparkSession, d: str) -> DataFrame:
    f = catalog.Filters(body="src3", language="en", since=date(2020, 2, 1), until=date(2022, 1, 1))
    return catalog.page(records(spark, d), f).select("symbol", "title", "body", "kind", "published", "recid")


@query(f"""WITH {C} SELECT recid, symbol, published FROM c WHERE symbol ILIKE 'src1%' OR title ILIKE '%src1%'
    ORDER BY CASE WHEN symbol ILIKE 'src1%' THEN 1 ELSE 0 END DESC, published DESC NULLS LAST, recid LIMIT 20""")
def doc_search_ranked(spark: SparkSession, d: str) -> DataFrame:
    return catalog.page(records(spark, d), catalog.Filters(q="src1"), "relevance").select("recid", "symbol", "published")


@query(f"WITH {C} SELECT recid, symbol FROM c ORDER BY symbol NULLS LAST, recid LIMIT 20 OFFSET 20")
def doc_page_2(spark: SparkSession, d: str) -> DataFrame:
    return catalog.page(records(spark, d), catalog.Filters(), "symbol_asc", 2).select("recid", "symbol")


@query(f"WITH {C} SELECT count(*) AS total, 20 AS per_page, CAST(greatest(1, ceil(count(*) / 20.0)) AS BIGINT) AS total_pages FROM c WHERE kind = 'fr'")
def doc_envelope(spark: SparkSession, d: str) -> DataFrame:
    return catalog.envelope(records(spark, d), catalog.Filters(kind="fr"))


@query(f"""WITH {C} SELECT recid, symbol, CASE WHEN symbol ILIKE 'the%' THEN 0 WHEN title ILIKE 'the%' THEN 1 ELSE 2 END AS tier FROM c
    WHERE symbol ILIKE 'the%' OR CAST(recid AS VARCHAR) = 'the' OR title ILIKE '%the%' ORDER BY tier, published DESC NULLS LAST, recid LIMIT 20""")
def doc_suggest(spark: SparkSession, d: str) -> DataFrame:
    return catalog.suggest(records(spark, d), "the").select("recid", "symbol", "tier")


@query(f"WITH {C} SELECT recid, symbol, title, published FROM c WHERE upper(symbol) = 'SRC2/RES/2' ORDER BY published DESC NULLS LAST, recid DESC LIMIT 1")
def doc_by_symbol_latest(spark: SparkSession, d: str) -> DataFrame:
    return catalog.by_symbol(records(spark, d), "src2/res/2").select("recid", "symbol", "title", "published")


@query(f"WITH {C} SELECT recid, symbol, title FROM c WHERE recid = 17")
def doc_by_id(spark: SparkSession, d: str) -> DataFrame:
    return catalog.by_id(records(spark, d), 17).select("recid", "symbol", "title")


@query(f"""WITH {C}, v AS (SELECT 'body' AS facet, body AS value FROM c UNION ALL SELECT 'kind', kind FROM c
    UNION ALL SELECT 'language', unnest(languages) FROM c UNION ALL SELECT 'year', CAST(year(published) AS VARCHAR) FROM c),
    g AS (SELECT facet, value, count(*) AS n FROM v WHERE value IS NOT NULL GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY facet ORDER BY CASE WHEN facet = 'year' THEN value END DESC NULLS LAST, n DESC, value) AS k FROM g)
    SELECT facet, value, n FROM r WHERE k <= CASE facet WHEN 'language' THEN 30 WHEN 'year' THEN 100 ELSE 50 END""")
def facets_single_scan(spark: SparkSession, d: str) -> DataFrame:
    return catalog.facets(records(spark, d), catalog.Filters())


@query(f"""WITH {C} SELECT count(*) AS documents, min(published) AS first_date, max(published) AS last_date,
    count(DISTINCT body) AS bodies, count(DISTINCT kind) AS kinds FROM c""")
def corpus_stats(spark: SparkSession, d: str) -> DataFrame:
    return catalog.statistics(records(spark, d))


@query("""SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS n FROM orders) WHERE n = 1""")
def distinct_on_latest(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return catalog.latest_per_key(rows, ["o_custkey"], [F.desc("o_orderkey")])


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id LIMIT 50")
def md5_sample(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "source")
    return catalog.hash_sample(docs, "doc_id", 50, table(spark, d, "labels").select("doc_id"))


@query("""WITH f AS (SELECT 'P ' || (l_partkey % 100) AS form, CAST(l_linenumber AS BIGINT) AS n FROM lineitem
        UNION ALL SELECT 'p' || (l_partkey % 100), 1 FROM lineitem),
    g AS (SELECT upper(replace(form, ' ', '')) AS symbol, form, sum(n) AS n FROM f GROUP BY ALL),
    r AS (SELECT symbol, sum(n) AS citations, arg_max(form, (n, form)) AS label FROM g GROUP BY symbol)
    SELECT symbol, label, CAST(citations AS BIGINT) AS citations, row_number() OVER (ORDER BY citations DESC, symbol) AS rank FROM r ORDER BY citations DESC, symbol LIMIT 25""")
def citation_rank_topn(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    number = (F.col("l_partkey") % 100).cast("string")
    forms = li.select(F.concat(F.lit("P "), number).alias("form"), F.col("l_linenumber").cast("long").alias("n")).unionByName(
        li.select(F.concat(F.lit("p"), number).alias("form"), F.lit(1).cast("long").alias("n"))
    )
    return catalog.citation_rank(forms, 25)


# ---- joins --------------------------------------------------------------------------


@query("""SELECT n_name, count(*) AS n, CAST(round(sum(c_acctbal), 2) AS DOUBLE) AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey WHERE r_name IS NOT NULL GROUP BY n_name""")
def join_inner_3way(spark: SparkSession, d: str) -> DataFrame:
    c, n, r = (table(spark, d, t) for t in ("customer", "nation", "region"))
    both = c.join(n, c["c_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"]).where("r_name IS NOT NULL")
    return both.groupBy("n_name").agg(F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


@query("""WITH o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS k FROM orders)
    SELECT c_custkey, o_orderkey, o_orderstatus FROM customer LEFT JOIN (SELECT * FROM o WHERE k = 1) q ON c_custkey = o_custkey""")
def join_left_latest(spark: SparkSession, d: str) -> DataFrame:
    latest = catalog.latest_per_key(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus"), ["o_custkey"], [F.desc("o_orderkey")])
    c = table(spark, d, "customer").select("c_custkey")
    return c.join(latest, c["c_custkey"] == latest["o_custkey"], "left").select("c_custkey", "o_orderkey", "o_orderstatus")


def _ledger(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").alias("symbol"), F.when(F.col("o_orderkey") % 4 == 0, (F.col("o_orderkey") - 1).cast("string")).alias("source_symbol"),
        F.concat(F.lit("f"), F.col("o_orderkey").cast("string")).alias("archive_path"), F.col("o_orderpriority").alias("sha256"),
        F.when(F.col("o_orderstatus") == "F", "fetched").when(F.col("o_orderstatus") == "O", "parsed").otherwise("unavailable").alias("status"),
        F.when(F.col("o_orderkey") % 2 == 0, "docx").otherwise("pdf").alias("format"),
    )


LEDGER = """g AS (SELECT CAST(o_orderkey AS VARCHAR) AS symbol, CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_orderkey - 1 AS VARCHAR) END AS source_symbol,
    'f' || o_orderkey AS archive_path, o_orderpriority AS sha256, CASE o_orderstatus WHEN 'F' THEN 'fetched' WHEN 'O' THEN 'parsed' ELSE 'unavailable' END AS status,
    CASE WHEN o_orderkey % 2 = 0 THEN 'docx' ELSE 'pdf' END AS format FROM orders)"""


@query(f"""WITH {LEDGER} SELECT g.symbol, g.source_symbol, CASE WHEN g.source_symbol IS NOT NULL THEN p.archive_path ELSE g.archive_path END AS archive_path,
    CASE WHEN g.source_symbol IS NOT NULL THEN p.sha256 ELSE g.sha256 END AS sha256, g.status, g.format FROM g LEFT JOIN g p ON g.source_symbol = p.symbol""")
def join_self_parent(spark: SparkSession, d: str) -> DataFrame:
    return ledger.source_files(_ledger(spark, d))


@query(f"WITH {LEDGER} SELECT status, format, count(*) AS n FROM g GROUP BY ALL")
def status_format_counts(spark: SparkSession, d: str) -> DataFrame:
    return ledger.status_counts(_ledger(spark, d))


@query(f"""WITH {LEDGER} SELECT symbol, source_symbol, archive_path, sha256,
    CASE WHEN format = 'docx' AND status = 'fetched' THEN 'converted' ELSE status END AS status, format FROM g""")
def guarded_state_update(spark: SparkSession, d: str) -> DataFrame:
    guard = (F.col("format") == "docx") & (F.col("status") == "fetched")
    return upserts.advance(_ledger(spark, d), guard, {"status": F.lit("converted")})


@query("SELECT doc_id, quality, toxic FROM labels WHERE EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = labels.doc_id AND d.lang = 'en')")
def semi_prune(spark: SparkSession, d: str) -> DataFrame:
    return upserts.prune(table(spark, d, "labels"), table(spark, d, "documents").where("lang = 'en'"), ["doc_id"])


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def anti_prune(spark: SparkSession, d: str) -> DataFrame:
    c, o = table(spark, d, "customer"), table(spark, d, "orders")
    return c.join(o, c["c_custkey"] == o["o_custkey"], "left_anti").select("c_custkey", "c_name")


@query("""SELECT symbol FROM (SELECT DISTINCT 'A/' || o_custkey AS symbol FROM orders WHERE o_orderkey % 3 = 0
    UNION SELECT DISTINCT 'A/' || (o_custkey % 100) FROM orders WHERE o_orderkey % 3 = 1
        AND 'A/' || (o_custkey % 100) NOT IN (SELECT 'A/' || c_custkey FROM customer WHERE c_custkey < 50))""")
def bracket_collapse(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    whole = o.where("o_orderkey % 3 = 0").select(F.concat(F.lit("A/"), F.col("o_custkey").cast("string")).alias("symbol")).distinct()
    parts = o.where("o_orderkey % 3 = 1").select(F.concat(F.lit("A/"), (F.col("o_custkey") % 100).cast("string"), F.lit(" [Part I]")).alias("symbol"))
    held = table(spark, d, "customer").where("c_custkey < 50").select(F.concat(F.lit("A/"), F.col("c_custkey").cast("string")).alias("symbol"))
    return ledger.collapse_brackets(whole.unionByName(parts), held)


# ---- upserts ------------------------------------------------------------------------


@query("""SELECT c_custkey, c_name, CASE WHEN c_custkey % 7 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM customer WHERE c_custkey % 5 <> 0 OR c_custkey % 7 = 0""")
def upsert_last_write_wins(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    # Every key of the batch comes three times; the version with the greatest balance is the last.
    batch = c.where("c_custkey % 7 = 0").withColumn("version", F.explode(F.array(F.lit(-1), F.lit(1), F.lit(0))))
    batch = batch.withColumn("c_acctbal", F.col("c_acctbal") + F.col("version"))
    return upserts.upsert(c.where("c_custkey % 5 <> 0"), batch, ["c_custkey"], [F.desc("version")])


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN upper(c_name) ELSE c_name END AS c_name, c_acctbal FROM customer""")
def partial_update(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    batch = c.where("c_custkey % 3 = 0").select("c_custkey", F.upper("c_name").alias("c_name"))
    return upserts.partial_upsert(c, batch, ["c_custkey"], ["c_name"])


@query("""SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN 'insert' WHEN c_custkey % 4 = 0 THEN 'update' ELSE 'keep' END AS action FROM customer""")
def upsert_change_detect(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", "c_name", F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("v"))
    batch = c.withColumn("v", F.when(F.col("c_custkey") % 4 == 0, "new").otherwise(F.col("v")))
    return upserts.changed_upsert(c.where("c_custkey % 11 <> 0"), batch, ["c_custkey"], ["v"]).select("c_custkey", "action")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 10 = 3")
def delta_manifest(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey")
    return upserts.delta(o.where("o_orderkey % 10 <> 3"), o, ["o_orderkey"])


# ---- gates and reports ----------------------------------------------------------------


@query(f"""WITH {L}, q AS (SELECT doc, sum(n) AS words, sum(CASE WHEN type = 'heading' OR paragraph_type IS NOT NULL THEN n ELSE 0 END) AS shown FROM l GROUP BY doc)
    SELECT doc, CAST(words AS BIGINT) AS words, CAST(shown AS BIGINT) AS shown, CASE WHEN words > 0 THEN round(100.0 * shown / words, 2) ELSE 0.0 END AS pct,
    CASE WHEN CASE WHEN words > 0 THEN round(100.0 * shown / words, 2) ELSE 0.0 END >= 60 THEN 'pass' ELSE 'fail' END AS verdict FROM q""")
def display_coverage(spark: SparkSession, d: str) -> DataFrame:
    rows = lines(spark, d)
    return audits.display_coverage(rows, table(spark, d, "documents").select(F.col("doc_id").alias("doc")))


@query(f"""WITH {L}, q AS (SELECT doc, sum(n) AS n, sum(CASE WHEN paragraph_type IS NULL THEN n ELSE 0 END) AS u FROM l WHERE type = 'paragraph' GROUP BY doc)
    SELECT doc, 'null-heavy-doc' AS "check", CASE WHEN u / n > 0.8 THEN 'high' ELSE 'medium' END AS severity, u || '/' || n AS detail FROM q WHERE n >= 50 AND u / n > 0.5""")
def null_heavy_docs(spark: SparkSession, d: str) -> DataFrame:
    return audits.unlabelled_documents(lines(spark, d))


@query(f"""WITH {L}, q AS (SELECT doc, annex_index, count(*) AS e, count(paragraph_type) AS p FROM l WHERE section = 'annex' GROUP BY ALL)
    SELECT doc, 'annex-invisible' AS "check", 'high' AS severity, 'annex ' || coalesce(CAST(annex_index AS VARCHAR), '-') AS detail FROM q WHERE e >= 2 AND p = 0""")
def annex_invisible(spark: SparkSession, d: str) -> DataFrame:
    return audits.invisible_annexes(lines(spark, d), least=2)


SCOPE = """x AS (SELECT CASE WHEN doc_id % 9 = 0 THEN 'D/' || (doc_id - 1) || ' [I]' ELSE 'D/' || doc_id END AS symbol, lang <> 'es' AS in_scope, doc_id FROM documents),
    k AS (SELECT 'D/' || doc_id AS symbol, CASE doc_id % 8 WHEN 0 THEN 'split' WHEN 1 THEN 'unavailable' WHEN 2 THEN 'no_text_layer' WHEN 3 THEN 'parse_failed' ELSE 'fetched' END AS status
        FROM documents WHERE doc_id % 10 <> 7),
    w AS (SELECT DISTINCT 'D/' || doc_id AS symbol FROM documents WHERE doc_id % 3 = 0 AND trim(text) <> ''),
    s AS (SELECT x.symbol, CASE WHEN w.symbol IS NOT NULL THEN 'delivered' WHEN pw.symbol IS NOT NULL THEN 'within_parent' WHEN NOT in_scope THEN 'out_of_scope'
        WHEN status = 'split' THEN 'split' WHEN status = 'unavailable' THEN 'no_file' WHEN status = 'no_text_layer' THEN 'scan' WHEN status = 'parse_failed' THEN 'broken'
        WHEN status = 'fetched' THEN 'pending' ELSE 'not_fetched' END AS bucket FROM x LEFT JOIN w ON w.symbol = x.symbol LEFT JOIN k ON k.symbol = x.symbol
        LEFT JOIN w pw ON pw.symbol = CASE WHEN contains(x.symbol, '[') THEN regexp_replace(x.symbol, '\\s*\\[.*$', '') END)"""


def _scope(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, d, "documents")
    i = F.col("doc_id")
    name = lambda c: F.concat(F.lit("D/"), c.cast("string"))
    cat = docs.select(F.when(i % 9 == 0, F.concat(name(i - 1), F.lit(" [I]"))).otherwise(name(i)).alias("symbol"), (F.col("lang") != "es").alias("in_scope"))
    status = F.when(i % 8 == 0, "split").when(i % 8 == 1, "unavailable").when(i % 8 == 2, "no_text_layer").when(i % 8 == 3, "parse_failed").otherwise("fetched")
    led = docs.where(i % 10 != 7).select(name(i).alias("symbol"), status.alias("status"))
    els = docs.where(i % 3 == 0).select(name(i).alias("doc"), F.lit("paragraph").alias("type"), F.lit("main").alias("section"), "text")
    return audits.scope_partition(cat, els, led), cat


@query(f"WITH {SCOPE} SELECT symbol, bucket FROM s")
def scope_partition(spark: SparkSession, d: str) -> DataFrame:
    return _scope(spark, d)[0]


@query(f"WITH {SCOPE} SELECT bucket, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM documents), 2) AS pct, true AS sound FROM s GROUP BY bucket")
def partition_check(spark: SparkSession, d: str) -> DataFrame:
    part, cat = _scope(spark, d)
    return audits.partition_report(part, cat)


@query("""SELECT quality, toxic, count(*) AS n, round((SELECT count_if(quality = toxic) FROM labels) / (SELECT count(*) FROM labels), 4) AS agreement FROM labels GROUP BY ALL""")
def label_agreement(spark: SparkSession, d: str) -> DataFrame:
    return audits.agreement(table(spark, d, "labels"), "quality", "toxic")


@query(f"""WITH {L}, o AS (SELECT doc, count(*) AS e, count_if(type = 'heading') AS h, max(CASE WHEN paragraph_type = 'operative' THEN 1 ELSE 0 END) AS op,
        max(CASE WHEN paragraph_type = 'preambular' THEN 1 ELSE 0 END) AS pre, max(CASE WHEN section = 'annex' THEN 1 ELSE 0 END) AS ann FROM l GROUP BY doc)
    SELECT lang AS "group", count(*) AS documents, CAST(100.0 AS DOUBLE) AS accounted_pct, CAST(sum(e) AS BIGINT) AS elements, CAST(sum(h) AS BIGINT) AS headings,
        CAST(sum(op) AS BIGINT) AS with_operative, CAST(sum(pre) AS BIGINT) AS with_preambular, CAST(sum(ann) AS BIGINT) AS with_annex
    FROM documents JOIN o ON doc_id = doc GROUP BY lang""")
def parse_group_report(spark: SparkSession, d: str) -> DataFrame:
    rows = lines(spark, d)
    n = rows.groupBy("doc").agg(F.count("*").alias("rows"), F.count("*").alias("used"))
    langs = table(spark, d, "documents").select(F.col("doc_id").alias("doc"), "lang")
    report = audits.group_report(rows, n.join(langs, "doc"), F.col("lang"))
    return report.withColumn("accounted_pct", F.col("accounted_pct").cast("double"))


@query("""WITH p AS (SELECT regexp_replace(text, '^(\\S*).*$', '\\1', 's') AS value, conv_id AS example FROM conversations),
    t AS (SELECT value, count(*) AS n FROM p GROUP BY value ORDER BY n DESC, value LIMIT 10)
    SELECT t.value, t.n, (list_sort(list_distinct(list(p.example))))[1:2] AS examples FROM t JOIN p ON p.value = t.value GROUP BY t.value, t.n""")
def commonest_heads(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations")
    return audits.commonest(rows, F.regexp_extract("text", r"^(\S*)", 1), F.col("conv_id"), 10)


@query("""SELECT o_orderkey, EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 5000) AS rich FROM orders""")
def exists_flag(spark: SparkSession, d: str) -> DataFrame:
    o, c = table(spark, d, "orders"), table(spark, d, "customer").where("c_acctbal > 5000").select("c_custkey").distinct()
    return o.join(c, o["o_custkey"] == c["c_custkey"], "left").select("o_orderkey", F.col("c_custkey").isNotNull().alias("rich"))


# ---- text -----------------------------------------------------------------------------


@query("SELECT n_nationkey, upper(regexp_replace(' a/' || n_name || ' / x', '\\s', '', 'g')) AS symbol, regexp_replace(n_name || ' [Part II]', '\\s*\\[.*$', '') AS parent FROM nation")
def normalize_symbol(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    raw = F.concat(F.lit(" a/"), F.col("n_name"), F.lit(" / x"))
    return n.select("n_nationkey", tx.normalize_symbol(raw).alias("symbol"), tx.strip_bracket(F.concat("n_name", F.lit(" [Part II]"))).alias("parent"))


@query("""WITH t AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'Resolution ' || p_name WHEN 1 THEN p_name || ' resolution' WHEN 2 THEN p_name || '.' ELSE '' END AS title,
        CASE WHEN p_partkey % 3 = 0 THEN p_type END AS other FROM part)
    SELECT p_partkey, CASE WHEN title <> '' AND NOT regexp_matches(title, '(?i)^(resolution|decision|statement)(\\s|$)')
        THEN regexp_replace(regexp_replace(title, '(?i) (resolution|decision)$', ''), '\\.$', '') WHEN coalesce(other, '') <> '' THEN other WHEN title <> '' THEN title END AS display_title FROM t""")
def display_title(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("p_partkey") % 4
    title = F.when(p == 0, F.concat(F.lit("Resolution "), "p_name")).when(p == 1, F.concat("p_name", F.lit(" resolution"))).when(p == 2, F.concat("p_name", F.lit("."))).otherwise("")
    other = F.when(F.col("p_partkey") % 3 == 0, F.col("p_type"))
    return table(spark, d, "part").select("p_partkey", tx.display_title(title, other).alias("display_title"))


@query(f"""WITH {L}, t AS (SELECT doc, position, regexp_extract_all(lower(replace(replace(text, '’', ''''), '‘', '''')), '[\\p{{L}}\\p{{N}}]+(?:''[\\p{{L}}\\p{{N}}]+)*') AS k,
        length(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS chars FROM l),
    g AS (SELECT doc, array_to_string(flatten(list(k ORDER BY position)), ' ') AS s, sum(len(k)) AS w, sum(chars) AS ch, count(*) AS e FROM t GROUP BY doc)
    SELECT doc, CAST(w AS BIGINT) AS word_count, CAST(ch AS BIGINT) AS character_count, e AS element_count, CASE WHEN w > 0 THEN sha256(s) END AS content_sha256 FROM g""")
def text_metrics_hash(spark: SparkSession, d: str) -> DataFrame:
    return metrics.text_metrics(lines(spark, d), fold=False).select("doc", "word_count", "character_count", "element_count", "content_sha256")


# The fold is NFKC and full case folding; on texts without compatibility characters that is NFC, lower case and ss for ß.
@query(f"""WITH {L}, t AS (SELECT doc, position, regexp_extract_all(replace(lower(nfc_normalize(replace(replace(replace(text, '’', ''''), '‘', ''''), 'ʼ', ''''))), 'ß', 'ss'),
        '[\\p{{L}}\\p{{N}}]+(?:''[\\p{{L}}\\p{{N}}]+)*') AS k FROM l),
    g AS (SELECT doc, array_to_string(flatten(list(k ORDER BY position)), ' ') AS s, sum(len(k)) AS w FROM t GROUP BY doc)
    SELECT doc, CAST(w AS BIGINT) AS word_count, CASE WHEN w > 0 THEN sha256(s) END AS content_sha256 FROM g""")
def text_metrics_folded(spark: SparkSession, d: str) -> DataFrame:
    return metrics.text_metrics(lines(spark, d)).select("doc", "word_count", "content_sha256")


@query("""SELECT event_id, CASE WHEN event_id % 5 = 0 THEN DATE '2024-03-05' WHEN event_id % 5 = 1 THEN DATE '2023-07-01' WHEN event_id % 5 = 2 THEN DATE '1994-02-01'
    WHEN event_id % 5 = 3 THEN DATE '1987-01-01' END AS d FROM events""")
def catalog_dates(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("event_id") % 5
    raw = F.when(k == 0, "2024-03-05 ff").when(k == 1, "2023-07").when(k == 2, "1994-02-30").when(k == 3, "ca. 1987").otherwise("n.d.")
    return table(spark, d, "events").select("event_id", tx.catalog_date(raw).alias("d"))


# ---- bags -----------------------------------------------------------------------------


def _two_versions(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The texts, and a damaged copy: every seventh line lost, a word added to each document."""
    rows = parse.lines_as_rows(table(spark, d, "documents"))
    kept = rows.where("position % 7 <> 6").select("doc", "position", "text")
    more = rows.where("position = 0").select("doc", F.lit(-1).alias("position"), F.lit("fabricatedword").alias("text"))
    return bags.token_lines(rows, "doc", "position", "text"), bags.token_lines(kept.unionByName(more), "doc", "position", "text")


BAGS = """r0 AS (SELECT doc_id AS doc, string_split(text, chr(10)) AS t FROM documents),
    r1 AS (SELECT doc, unnest(range(0, len(t))) AS position, unnest(t) AS text FROM r0),
    glued AS (SELECT doc, position, regexp_extract_all(regexp_replace(lower(text), '[-‐‑‒–­''’‘`]', '', 'g'), '[a-z0-9]+') AS k FROM r1),
    g AS (SELECT doc, position, unnest(k) AS tok, unnest(range(0, len(k))) AS q FROM glued),
    h AS (SELECT doc, position, tok, q FROM g WHERE position % 7 <> 6 UNION ALL SELECT doc, -1, 'fabricatedword', 0 FROM glued WHERE position = 0),
    a AS (SELECT doc, tok, count(*) AS n FROM g GROUP BY ALL), b AS (SELECT doc, tok, count(*) AS n FROM h GROUP BY ALL)"""
#: Runs of two to four neighbouring tokens of the texts (ra) and of the copy (rb), together and apart.
RUNS = ", ".join(
    f"""w{s} AS (SELECT doc, tok, lead(tok) OVER w AS t1, lead(tok, 2) OVER w AS t2, lead(tok, 3) OVER w AS t3 FROM {t} WINDOW w AS (PARTITION BY doc ORDER BY position, q)),
    r{s} AS (SELECT doc, tok || t1 AS whole, [tok, t1] AS parts FROM w{s} WHERE t1 IS NOT NULL UNION ALL SELECT doc, tok || t1 || t2, [tok, t1, t2] FROM w{s} WHERE t2 IS NOT NULL
        UNION ALL SELECT doc, tok || t1 || t2 || t3, [tok, t1, t2, t3] FROM w{s} WHERE t3 IS NOT NULL)"""
    for s, t in (("a", "g"), ("b", "h"))
)
INVENTED = f"""{RUNS}, long AS (SELECT doc, tok, unnest(range(3, length(tok))) AS c FROM a WHERE length(tok) >= 5),
    known AS (SELECT doc, tok FROM a UNION SELECT doc, whole FROM ra UNION SELECT doc, unnest(parts) FROM rb SEMI JOIN a ON rb.doc = a.doc AND whole = a.tok
        UNION SELECT doc, left(tok, c) FROM long UNION SELECT doc, right(tok, c) FROM long),
    made AS (SELECT b.doc, b.tok, b.n FROM b ANTI JOIN known ON known.doc = b.doc AND known.tok = b.tok)"""


@query(f"WITH {BAGS} SELECT a.doc, a.tok, a.n - coalesce(b.n, 0) AS n FROM a LEFT JOIN b ON a.doc = b.doc AND a.tok = b.tok WHERE a.n - coalesce(b.n, 0) > 0")
def bag_difference(spark: SparkSession, d: str) -> DataFrame:
    return bags.difference(*_two_versions(spark, d))


@query(f"WITH {BAGS}, {INVENTED} SELECT doc, tok, n FROM made")
def invented_words(spark: SparkSession, d: str) -> DataFrame:
    return bags.invented(*_two_versions(spark, d))


@query(f"""WITH {BAGS}, {INVENTED}, found AS (SELECT doc, whole AS tok FROM rb UNION SELECT doc, unnest(parts) FROM ra SEMI JOIN b ON ra.doc = b.doc AND whole = b.tok),
    gone AS (SELECT a.doc, a.tok, a.n - coalesce(b.n, 0) AS n FROM a LEFT JOIN b ON a.doc = b.doc AND a.tok = b.tok
        WHERE a.n - coalesce(b.n, 0) > 0 AND NOT regexp_full_match(a.tok, '[0-9]+') AND length(a.tok) > 2),
    lost AS (SELECT doc, sum(n) AS n FROM gone ANTI JOIN found ON found.doc = gone.doc AND found.tok = gone.tok GROUP BY doc),
    c AS (SELECT t.doc, t.words, CAST(coalesce(lost.n, 0) AS BIGINT) AS lost, CAST(coalesce(m.n, 0) AS BIGINT) AS invented
        FROM (SELECT doc, CAST(sum(n) AS BIGINT) AS words FROM a GROUP BY doc) t LEFT JOIN lost ON lost.doc = t.doc LEFT JOIN (SELECT doc, sum(n) AS n FROM made GROUP BY doc) m ON m.doc = t.doc)
    SELECT doc, words, lost, invented, round(100.0 * (words - lost) / words, 3) AS kept_pct,
        CASE WHEN lost <= 5 AND round(100.0 * (words - lost) / words, 3) >= 95 AND invented = 0 THEN 'pass' ELSE 'fail' END AS verdict FROM c""")
def conservation_gate(spark: SparkSession, d: str) -> DataFrame:
    return bags.conservation(*_two_versions(spark, d))


@query("""WITH t AS (SELECT conv_id, turn, lead(turn) OVER w AS a1, lead(turn, 2) OVER w AS a2 FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
    SELECT doc, tok, parts, count(*) AS n FROM (SELECT conv_id AS doc, CAST(turn AS VARCHAR) || a1 AS tok, 2 AS parts FROM t WHERE a1 IS NOT NULL
    UNION ALL SELECT conv_id, CAST(turn AS VARCHAR) || a1 || a2, 3 FROM t WHERE a2 IS NOT NULL) GROUP BY ALL""")
def contiguous_joins(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations").select(F.col("conv_id").alias("doc"), F.col("turn").alias("k"), F.col("turn").cast("string").alias("tok"))
    return bags.joined_runs(rows, 3).groupBy("doc", "tok", "parts").agg(F.count("*").alias("n"))


@query(f"""WITH {N}, u AS (SELECT doc, position, CASE WHEN position % 5 = 0 THEN 0 WHEN position % 3 = 0 THEN 2 ELSE 1 END AS uses FROM n)
    SELECT doc, CAST(position AS INTEGER) AS position, CASE WHEN uses = 0 THEN 'missing' ELSE 'duplicate' END AS problem FROM u WHERE uses <> 1
    UNION ALL SELECT doc, 999, 'phantom' FROM n WHERE position = 1 AND doc % 10 = 0""")
def position_accounting(spark: SparkSession, d: str) -> DataFrame:
    li = clauses(spark, d).select("doc", "position")
    used = li.where("position % 5 <> 0").select("doc", F.array("position", "position").alias("raw_positions"))
    ghost = li.where("position = 1 AND doc % 10 = 0").select("doc", F.array(F.lit(999)).alias("raw_positions"))
    dropped = li.where("position % 3 = 0 AND position % 5 <> 0")
    return bags.position_accounting(li, used.unionByName(ghost), dropped)


# ---- sequences ------------------------------------------------------------------------


@query(f"""WITH {N}, c AS (SELECT doc, position, doc % 3 AS major, CASE WHEN k % 5 = 0 THEN position + 1 ELSE position END AS minor FROM n),
    f AS (SELECT *, CASE WHEN major = lag(major) OVER w AND minor = lag(minor) OVER w + 1 THEN 0 ELSE 1 END AS s FROM c WINDOW w AS (PARTITION BY doc ORDER BY position)),
    r AS (SELECT *, sum(s) OVER (PARTITION BY doc ORDER BY position) AS run FROM f)
    SELECT doc, CAST(position AS INTEGER) AS position, major, CAST(minor AS INTEGER) AS minor, count(*) OVER (PARTITION BY doc, run) >= 3 AND min(minor) OVER (PARTITION BY doc, run) = 1 AS accepted FROM r""")
def enumerator_chains(spark: SparkSession, d: str) -> DataFrame:
    rows = clauses(spark, d).select(
        "doc", "position", (F.col("doc") % 3).alias("major"), F.when(F.col("k") % 5 == 0, F.col("position") + 1).otherwise(F.col("position")).alias("minor")
    )
    return sequences.enumerator_chains(rows)


@query("""WITH h AS (SELECT conv_id AS doc, turn AS position, role = 'user' AS heading FROM conversations),
    c AS (SELECT doc, position, sum(CASE WHEN heading THEN 1 ELSE 0 END) OVER w AS child, last_value(CASE WHEN heading THEN position END IGNORE NULLS) OVER w AS heading_position
        FROM h WINDOW w AS (PARTITION BY doc ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
    SELECT doc, position, CAST(child AS BIGINT) AS child, heading_position FROM c WHERE child > 0""")
def slice_by_heading(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations").select(F.col("conv_id").alias("doc"), F.col("turn").alias("position"), "role")
    return sequences.slices(rows, F.col("role") == "user").select("doc", "position", "child", "heading_position")


@query("""SELECT conv_id AS doc, turn AS position, coalesce(max(CASE WHEN length(text) > 200 THEN 1 ELSE 0 END) OVER
    (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 FOLLOWING AND 8 FOLLOWING) = 1, false) AS confirmed FROM conversations""")
def lookahead_confirm(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations").select(F.col("conv_id").alias("doc"), F.col("turn").alias("position"), "text")
    return rows.select("doc", "position", sequences.confirmed_ahead(rows, F.length("text") > 200).alias("confirmed"))


@query("""WITH s AS (SELECT conv_id, turn, role, length(text) AS n, turn - row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS g FROM conversations)
    SELECT conv_id AS volume, role AS child, turn AS start, n FROM (SELECT *, row_number() OVER (PARTITION BY role ORDER BY n DESC, conv_id, turn) AS r FROM s) WHERE r = 1""")
def longest_slice_wins(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations").select(F.col("conv_id").alias("volume"), F.col("role").alias("child"), F.col("turn").alias("start"), F.length("text").cast("long").alias("n"))
    return sequences.longest_slice(rows)


@query(f"""WITH {L}, k AS (SELECT *, position % 3 = 1 AS cell FROM l),
    s AS (SELECT *, sum(CASE WHEN cell AND NOT coalesce(lag_cell, false) THEN 1 ELSE 0 END) OVER (PARTITION BY doc ORDER BY position) AS run
        FROM (SELECT *, lag(cell) OVER (PARTITION BY doc ORDER BY position) AS lag_cell FROM k)) SELECT doc, min(position) AS position, count(*) AS cells FROM s WHERE cell GROUP BY doc, run""")
def table_cell_groups(spark: SparkSession, d: str) -> DataFrame:
    rows = lines(spark, d).withColumn("kind", F.when(F.col("position") % 3 == 1, "table_cell").otherwise("paragraph"))
    return sequences.cell_groups(rows).select("doc", "position", "cells")


@query(f"""WITH {L}, f AS (SELECT doc, position, section, annex_index, last_value(CASE WHEN section = 'main' THEN -1 ELSE annex_index END IGNORE NULLS)
    OVER (PARTITION BY doc ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS x FROM l) SELECT doc, position, CASE WHEN section <> 'main' THEN x END AS annex_filled FROM f""")
def annex_fill_forward(spark: SparkSession, d: str) -> DataFrame:
    return sequences.filled_annex(lines(spark, d)).select("doc", "position", "annex_filled")


@query(f"""WITH {L}, b AS (SELECT doc, position, text, position % 10 AS y FROM l),
    m AS (SELECT *, CASE WHEN y <= 1 THEN 'top' WHEN y >= 9 THEN 'bottom' END AS band, trim(regexp_replace(lower(text), '\\d+', '#', 'g')) AS plain FROM b)
    SELECT doc, position, band IS NOT NULL AND count(*) OVER (PARTITION BY doc, band, plain) >= 2 AS running FROM m""")
def repeated_headers(spark: SparkSession, d: str) -> DataFrame:
    rows = lines(spark, d).select("doc", "position", "text", F.floor(F.col("position") / 10).alias("page"), ((F.col("position") % 10) / 10.0).alias("y"))
    return sequences.repeated_lines(rows, top=0.1, bottom=0.1).select("doc", "position", "running")


@query(f"""WITH {N}, e AS (SELECT doc, CAST(position AS INTEGER) AS position, CAST(CASE WHEN k % 5 = 0 THEN position + 2 ELSE position END AS INTEGER) AS ordinal FROM n),
    x AS (SELECT *, lag(ordinal) OVER (PARTITION BY doc ORDER BY position) + 1 AS expected FROM e)
    SELECT doc, position, expected, ordinal AS found FROM x WHERE expected IS NOT NULL AND ordinal <> 1 AND ordinal <> expected""")
def numbering_gaps(spark: SparkSession, d: str) -> DataFrame:
    rows = clauses(spark, d).select(
        "doc", "position", F.lit(1).alias("level"), F.lit("number").alias("kind"),
        F.when(F.col("k") % 5 == 0, F.col("position") + 2).otherwise(F.col("position")).alias("ordinal"),
    )
    return sequences.numbering_gaps(rows)


@query(f"""WITH RECURSIVE {N}, c AS (SELECT doc, CAST(position AS INTEGER) AS position, CAST(position + CASE WHEN k % 6 = 0 THEN 40 ELSE 0 END AS INTEGER) AS number,
        row_number() OVER (PARTITION BY doc ORDER BY position) AS i FROM n),
    l AS (SELECT *, lead(number) OVER w AS a1, lead(number, 2) OVER w AS a2, lead(number, 3) OVER w AS a3 FROM c WINDOW w AS (PARTITION BY doc ORDER BY i)),
    s AS (SELECT doc, 0::BIGINT AS i, 0 AS position, 0 AS number, false AS confirmed, []::INTEGER[] AS live FROM l GROUP BY doc
        UNION ALL SELECT doc, i, position, number, ok, CASE WHEN ok THEN list_distinct(list_append(list_filter(live, lambda x: x <> coalesce(near, -1)), number)) ELSE live END FROM (
            SELECT doc, i, position, number, live, near, number <= 23 AND (number = 1 OR near IS NOT NULL OR coalesce(number + 1 = a1 OR number + 1 = a2, false) OR coalesce(number + 1 = a2, false)
                OR coalesce(number + 1 = a1, false) OR coalesce(number + 1 = a3, false)) AS ok FROM (
            SELECT l.doc, l.i, l.position, l.number, l.a1, l.a2, l.a3, CASE WHEN l.position = 1 THEN [] ELSE s.live END AS live,
                list_max(list_filter(CASE WHEN l.position = 1 THEN [] ELSE s.live END, lambda x: l.number - x BETWEEN 1 AND 3)) AS near FROM s JOIN l ON l.doc = s.doc AND l.i = s.i + 1)))
    SELECT doc, position, number, confirmed FROM s WHERE i > 0""")
def op_number_confirm(spark: SparkSession, d: str) -> DataFrame:
    rows = clauses(spark, d).select(
        "doc", "position", (F.col("position") + (F.col("k") % 6 == 0).cast("int") * 40).alias("number"),
        F.lit(False).alias("verb"), (F.col("position") == 1).alias("reset"), F.lit(20).alias("body_rows"),
    )
    return sequences.confirm_numbers(rows).select("doc", "position", "number", "confirmed")


@query()
def semantic_parse(spark: SparkSession, d: str) -> DataFrame:
    parsed = parse.parse(parse.lines_as_rows(table(spark, d, "documents")))
    return parsed.groupBy("record", "type", "reason").agg(F.count("*").alias("n"))


# ---- ledger ---------------------------------------------------------------------------


def _dated(spark: SparkSession, d: str) -> DataFrame:
    """Dated catalogue rows with several rows a symbol."""
    k = F.col("o_orderkey")
    return table(spark, d, "orders").select(
        k.alias("recid"), F.concat(F.when(k % 5 == 0, "X/").otherwise("A/RES/"), F.col("o_custkey").cast("string")).alias("symbol"),
        F.when(k % 7 != 0, F.col("o_orderdate").cast("date")).alias("published"),
        F.when(k % 3 == 0, F.array(F.lit("eng"), F.lit("fre"))).when(k % 3 == 1, F.array(F.lit("fre"))).otherwise(F.array().cast("array<string>")).alias("languages"),
    )


DATED = """z AS (SELECT o_orderkey AS recid, CASE WHEN o_orderkey % 5 = 0 THEN 'X/' ELSE 'A/RES/' END || o_custkey AS symbol,
    CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END AS published, o_orderkey % 3 AS tongue FROM orders)"""


@query(f"""WITH {DATED}, w AS (SELECT recid, symbol, published, row_number() OVER (PARTITION BY symbol ORDER BY recid DESC) AS n FROM z
    WHERE starts_with(symbol, 'A/RES/') AND tongue <> 1 AND published >= DATE '1995-01-01')
    SELECT recid, symbol, published FROM w WHERE n = 1 AND symbol NOT IN (SELECT 'A/RES/' || c_custkey FROM customer WHERE c_custkey % 4 = 0)""")
def ledger_targets(spark: SparkSession, d: str) -> DataFrame:
    held = table(spark, d, "customer").where("c_custkey % 4 = 0").select(F.concat(F.lit("A/RES/"), F.col("c_custkey").cast("string")).alias("symbol"))
    return ledger.targets(_dated(spark, d), held, date(1995, 1, 1)).select("recid", "symbol", "published")


@query(f"""WITH {DATED}, w AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY recid DESC) AS n FROM z), u AS (SELECT DISTINCT symbol FROM z WHERE tongue = 1)
    SELECT u.symbol, 'unavailable' AS status, w.published FROM u JOIN w ON u.symbol = w.symbol WHERE n = 1 AND published >= DATE '1997-01-01' - 400""")
def recheck_recent(spark: SparkSession, d: str) -> DataFrame:
    cat = _dated(spark, d)
    missing = cat.where("recid % 3 = 1").select("symbol", F.lit("unavailable").alias("status")).distinct()
    return ledger.recheck(missing, cat, date(1997, 1, 1), 400)


@query("""WITH c AS (SELECT c_custkey AS key, ['A/DEC/' || (c_custkey % 40), 'A/RES/' || c_custkey] AS candidates FROM customer),
    k AS (SELECT 'A/DEC/' || o_custkey AS symbol FROM orders WHERE o_custkey < 20 UNION SELECT 'A/RES/' || o_custkey FROM orders WHERE o_custkey % 2 = 0)
    SELECT key, CASE WHEN candidates[1] IN (SELECT symbol FROM k) THEN candidates[1] WHEN candidates[2] IN (SELECT symbol FROM k) THEN candidates[2] END AS symbol,
        CASE WHEN candidates[1] IN (SELECT symbol FROM k) THEN 'write' WHEN candidates[2] IN (SELECT symbol FROM k) THEN 'cross_check' ELSE 'unmatched' END AS route FROM c""")
def route_candidates(spark: SparkSession, d: str) -> DataFrame:
    name = lambda p, c: F.concat(F.lit(p), c.cast("string"))
    kids = table(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.array(name("A/DEC/", F.col("c_custkey") % 40), name("A/RES/", F.col("c_custkey"))).alias("candidates"))
    o = table(spark, d, "orders")
    known = o.where("o_custkey < 20").select(name("A/DEC/", F.col("o_custkey")).alias("symbol")).unionByName(o.where("o_custkey % 2 = 0").select(name("A/RES/", F.col("o_custkey")).alias("symbol")))
    return ledger.route(kids, known)


@query("""WITH f AS (SELECT doc_id AS doc, 'low' AS "check" FROM labels WHERE quality = 0 UNION ALL SELECT doc_id, 'toxic' FROM labels WHERE toxic = 1)
    SELECT doc, "check" FROM f WHERE NOT (doc % 3 = 0 AND "check" = 'low')""")
def new_findings(spark: SparkSession, d: str) -> DataFrame:
    found = _findings(spark, d)
    return audits.new_findings(found, found.where("doc % 3 = 0 AND check = 'low'")).select("doc", "check")


def _findings(spark: SparkSession, d: str) -> DataFrame:
    lab = table(spark, d, "labels").withColumnRenamed("doc_id", "doc")
    return lab.where("quality = 0").select("doc", F.lit("low").alias("check")).unionByName(lab.where("toxic = 1").select("doc", F.lit("toxic").alias("check")))


@query("""WITH f AS (SELECT doc_id AS doc, 'low' AS c FROM labels WHERE quality = 0 UNION ALL SELECT doc_id, 'toxic' FROM labels WHERE toxic = 1)
    SELECT doc, count(DISTINCT c) AS checks, coalesce(max(n_chars), 0) AS citations FROM f LEFT JOIN documents ON doc_id = doc GROUP BY doc""")
def worst_first(spark: SparkSession, d: str) -> DataFrame:
    weights = table(spark, d, "documents").select(F.col("doc_id").alias("doc"), F.col("n_chars").alias("citations"))
    return audits.worst_first(_findings(spark, d), weights)


# ---- regions, breaks, coverage ----------------------------------------------------------


@query("""WITH s AS (SELECT conv_id AS doc, min(CASE WHEN role = 'assistant' THEN turn END) AS s, max(turn) + 1 AS last FROM conversations GROUP BY conv_id),
    e AS (SELECT doc, min(turn) AS e FROM conversations JOIN s ON conv_id = doc WHERE role = 'user' AND turn > s GROUP BY doc)
    SELECT s.doc, coalesce(s, 0) AS start, coalesce(e, last) AS "end", CASE WHEN s IS NULL THEN 'unlocatable' WHEN e IS NULL THEN 'whole' ELSE 'heading' END AS mode FROM s LEFT JOIN e ON e.doc = s.doc""")
def own_region(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations").select(F.col("conv_id").alias("doc"), F.col("turn").alias("position"), "role")
    return sequences.own_region(rows, F.col("role") == "assistant", F.col("role") == "user")


@query(f"""WITH {L}, b AS (SELECT doc, position, text, lag(text) OVER (PARTITION BY doc ORDER BY position) AS before FROM l),
    j AS (SELECT *, coalesce(NOT regexp_matches(before, '[.;:?!”"]\\s*$') AND NOT regexp_matches(text, '^(?:\\d{{1,3}}\\.|\\([A-Za-z0-9]{{1,7}}\\)|[IVXLC]+\\.|(?i:annex|appendix)\\b|_{{3,}})')
        AND regexp_matches(text, '^\\p{{Ll}}'), false) AS joins FROM b),
    r AS (SELECT *, sum(CASE WHEN joins THEN 0 ELSE 1 END) OVER (PARTITION BY doc ORDER BY position) AS run FROM j)
    SELECT doc, min(position) AS position, string_agg(text, ' ' ORDER BY position) AS text FROM r GROUP BY doc, run""")
def mended_breaks(spark: SparkSession, d: str) -> DataFrame:
    rows = lines(spark, d).select("doc", "position", "text", F.lit(0).alias("indent"))
    return sequences.mended_breaks(rows).select("doc", "position", "text")


@query(f"""WITH {BAGS}, t AS (SELECT a.doc, count(*) AS types, count(b.tok) AS covered FROM a LEFT JOIN b ON a.doc = b.doc AND a.tok = b.tok GROUP BY a.doc)
    SELECT doc, types, covered, CASE WHEN covered / types >= 0.97 THEN 'pass' ELSE 'fail' END AS verdict FROM t""")
def type_coverage(spark: SparkSession, d: str) -> DataFrame:
    source, parsed = _two_versions(spark, d)
    return bags.type_coverage(source, parsed)


# ---- actions --------------------------------------------------------------------------

CLAUSES = (
    "Requests the Secretary-General to report", "Also urges all Member States to act", "Recalling its earlier work,", "Decides to remain seized",
    "Welcomes the report", "Expresses its concern at the delay", "The weather was fair",
)


def _clauses(spark: SparkSession, d: str) -> DataFrame:
    text = F.element_at(F.array(*[F.lit(c) for c in CLAUSES]), (F.col("o_orderkey") % 7 + 1).cast("int"))
    kind = F.when(F.col("o_orderkey") % 7 == 2, "preambular").otherwise("operative")
    return table(spark, d, "orders").select(
        F.col("o_custkey").alias("doc"), F.col("o_orderkey").cast("int").alias("position"), text.alias("text"), kind.alias("paragraph_type"),
        F.lit(1).alias("level"), F.lit(None).cast("string").alias("prefix"),
    )


@query("""SELECT CASE o_orderkey % 7 WHEN 0 THEN 'request' WHEN 1 THEN 'urge' WHEN 2 THEN 'recall' WHEN 3 THEN 'decide' WHEN 4 THEN 'welcome' WHEN 5 THEN 'express concern' END AS lemma,
    CASE o_orderkey % 7 WHEN 0 THEN 'directive' WHEN 1 THEN 'directive' WHEN 2 THEN 'reinforcing' WHEN 3 THEN 'deciding' WHEN 4 THEN 'evaluative' WHEN 5 THEN 'evaluative' END AS category,
    CASE o_orderkey % 7 WHEN 0 THEN 'secretary-general' WHEN 1 THEN 'member_states' END AS assignee_class, count(*) AS n FROM orders GROUP BY ALL""")
def verb_category_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = actions.annotate(_clauses(spark, d))
    return rows.groupBy(F.col("action.lemma").alias("lemma"), F.col("action.category").alias("category"), F.col("action.assignee_class").alias("assignee_class")).agg(F.count("*").alias("n"))


# ---- usage ----------------------------------------------------------------------------


@query("SELECT 'key:' || user_id AS caller, date_trunc('minute', ts) AS window_start, count(*) AS count FROM events GROUP BY ALL")
def rate_limit_windows(spark: SparkSession, d: str) -> DataFrame:
    return usage.rate_windows(calls(spark, d)).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("""WITH c AS (SELECT event_id, count(*) OVER (PARTITION BY user_id, date_trunc('minute', ts) ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS count,
        CASE WHEN user_id % 3 = 0 THEN 60 ELSE 10 END AS cap FROM events)
    SELECT event_id, count, count <= cap AS allowed, greatest(cap - count, 0) AS remaining FROM c""")
def rate_limit_allowed(spark: SparkSession, d: str) -> DataFrame:
    return usage.decisions(calls(spark, d)).select("event_id", "count", "allowed", "remaining")


@query("SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-13 12:00:00' AND TIMESTAMP '2024-01-20 12:00:00' GROUP BY ALL")
def usage_daily_7d(spark: SparkSession, d: str) -> DataFrame:
    return usage.daily(calls(spark, d), NOW)


@query("""SELECT 'key:' || user_id AS caller, count(*) FILTER (ts >= TIMESTAMP '2024-01-20') AS today, count(*) FILTER (ts >= TIMESTAMP '2024-01-01') AS month
    FROM events WHERE ts <= TIMESTAMP '2024-01-20 12:00:00' GROUP BY ALL""")
def usage_today_month(spark: SparkSession, d: str) -> DataFrame:
    return usage.today_and_month(calls(spark, d), NOW)


def facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: all facets of the catalogue from one scan."""
    return facets_single_scan(spark, sf_dir)


