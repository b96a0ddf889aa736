"""Queries over edits, graphs, tables, trees and assertions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import edits as ed
from ..operators import graph as gr
from ..operators import votes as vt
from ..sources.tables import books, lines, load
from .registry import BOOKS, LINES, query

# Edits derived from the text: every run of ,, ;; or .. and the places after each 400th character.
EDITS = r"""e AS (SELECT doc_id AS page, k * 400 AS start, k * 400 + (doc_id + k) % 7 AS "end", lower(substr(text, k * 400 + 1, (doc_id + k) % 7)) || '~' AS after, k AS seq, 'R' || CAST(k % 3 AS VARCHAR) AS rule FROM (SELECT doc_id, text, unnest(range(0, length(text) // 400)) AS k FROM documents)),
 f AS (SELECT page, start + 3 AS start, start + 3 + (page % 5) AS "end", '' AS after, seq + 100000 AS seq, 'D' AS rule FROM e WHERE start % 800 = 0), edits AS (SELECT * FROM e UNION ALL SELECT * FROM f)"""
MEET = """CASE WHEN a.start = a."end" AND b.start = b."end" THEN a.start = b.start WHEN a.start = a."end" THEN b.start < a.start AND a.start < b."end" WHEN b.start = b."end" THEN a.start < b.start AND b.start < a."end" ELSE a.start < b."end" AND b.start < a."end" END"""


def _edits(docs: DataFrame) -> DataFrame:
    # what each whole stretch of 400 characters begins with, found in one pass; no text stands beside its edits
    heads = F.regexp_extract_all("text", F.lit("(?s)(.{6}).{394}"), F.lit(1))
    k = docs.select(F.col("doc_id").alias("page"), F.posexplode(heads).alias("k", "head")).withColumn("k", F.col("k").cast("bigint"))
    size = ((F.col("page") + F.col("k")) % 7).cast("int")
    start = F.col("k") * 400
    e = k.select("page", start.alias("start"), (start + size).alias("end"), F.concat(F.lower(F.substring("head", F.lit(1), size)), F.lit("~")).alias("after"), F.col("k").alias("seq"), F.concat(F.lit("R"), (F.col("k") % 3).cast("string")).alias("rule"))
    f = e.where("start % 800 = 0").select("page", (F.col("start") + 3).alias("start"), (F.col("start") + 3 + F.col("page") % 5).alias("end"), F.lit("").alias("after"), (F.col("seq") + 100000).alias("seq"), F.lit("D").alias("rule"))
    return e.unionByName(f)


@query("JN-9", sql=f'WITH {EDITS} SELECT a.page, a.seq AS first, b.seq AS second FROM edits a JOIN edits b ON a.page = b.page AND a.seq < b.seq WHERE {MEET}')
def edit_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    return ed.conflicts(_edits(load(spark, sf, "documents")))


@query(
    "2.9-apply",
    sql=f"""WITH {EDITS}, s AS (SELECT page, count(*) AS applied, list(struct_pack(start := start, "end" := "end", after := after) ORDER BY start DESC) AS l FROM e GROUP BY page),
     r AS (SELECT s.page, s.applied, list_reduce(list_prepend(d.text, list_transform(l, lambda x: chr(1) || CAST(x.start AS VARCHAR) || chr(1) || CAST(x."end" AS VARCHAR) || chr(1) || x.after)),
       lambda t, x: left(t, CAST(string_split(x, chr(1))[2] AS INT)) || string_split(x, chr(1))[4] || substr(t, CAST(string_split(x, chr(1))[3] AS INT) + 1)) AS text FROM s JOIN documents d ON d.doc_id = s.page)
     SELECT page, applied, sha256(text) AS text_sha256 FROM r""",
)
def edit_splice(spark: SparkSession, sf: str) -> DataFrame:
    """Disjoint edits of a page applied in one expression."""
    docs = load(spark, sf, "documents")
    own = _edits(docs).where("rule <> 'D'").groupBy("page").agg(F.collect_list(F.struct("start", "end", "after")).alias("edits"))
    both = own.join(docs.select(F.col("doc_id").alias("page"), "text"), "page")
    return both.select("page", F.size("edits").cast("bigint").alias("applied"), F.sha2(ed.splice(F.col("text"), F.col("edits")), 256).alias("text_sha256"))


@query("2.9-ledger")
def edit_apply_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Applied texts, and whether replaying the log gives them back."""
    pages = load(spark, sf, "documents").select(F.col("doc_id").alias("page"), "text")
    done = ed.applied(pages, _edits(load(spark, sf, "documents")))
    again = done.withColumn("again", ed.replayed(F.col("text"), F.col("log")))
    return again.select("page", "applied", "refused", (F.col("again.ok") & (F.col("done") == F.col("again.text"))).alias("replays"))


# An artifact graph from the tables' keys: orders need customers, these nations, these regions.
GRAPH = """g AS (SELECT 'o' || o_orderkey AS src, 'c' || o_custkey AS dst FROM orders UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey FROM supplier UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation)"""


def _graph(spark: SparkSession, sf: str) -> DataFrame:
    def edges(table: str, a: str, ka: str, b: str, kb: str) -> DataFrame:
        return load(spark, sf, table).select(F.concat(F.lit(a), F.col(ka).cast("string")).alias("src"), F.concat(F.lit(b), F.col(kb).cast("string")).alias("dst"))

    return edges("orders", "o", "o_orderkey", "c", "o_custkey").union(edges("customer", "c", "c_custkey", "n", "c_nationkey")).union(edges("supplier", "s", "s_suppkey", "n", "s_nationkey")).union(edges("nation", "n", "n_nationkey", "r", "n_regionkey"))


@query("GR-1", sql=f"WITH RECURSIVE {GRAPH}, r AS (SELECT 'o' || o_orderkey AS node, 0 AS depth FROM orders WHERE o_orderkey % 50 = 0 UNION ALL SELECT g.dst, r.depth + 1 FROM r JOIN g ON g.src = r.node WHERE r.depth < 10) SELECT node, min(depth) AS depth FROM r GROUP BY node")
def artifact_closure(spark: SparkSession, sf: str) -> DataFrame:
    roots = load(spark, sf, "orders").where("o_orderkey % 50 = 0").select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("node"))
    return gr.closure(_graph(spark, sf), roots)


@query("GR-1", sql=f"WITH RECURSIVE {GRAPH}, r AS (SELECT 'o' || o_orderkey AS node, 0 AS depth FROM orders UNION ALL SELECT g.dst, r.depth + 1 FROM r JOIN g ON g.src = r.node WHERE r.depth < 10) SELECT node, min(depth) AS depth FROM r GROUP BY node")
def artifact_closure_whole(spark: SparkSession, sf: str) -> DataFrame:
    """What all orders need."""
    return gr.closure(_graph(spark, sf), load(spark, sf, "orders").select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("node")))


@query("GR-3", sql=f"WITH RECURSIVE {GRAPH}, d AS (SELECT 'c' || c_custkey AS node FROM customer WHERE c_acctbal < 0 UNION SELECT 's' || s_suppkey FROM supplier WHERE s_acctbal < 0), r AS (SELECT node, node AS cause, 0 AS k FROM d UNION ALL SELECT g.src, r.cause, k + 1 FROM r JOIN g ON g.dst = r.node WHERE g.src NOT IN (SELECT node FROM d) AND k < 10) SELECT DISTINCT node, cause FROM r")
def stale_accounts(spark: SparkSession, sf: str) -> DataFrame:
    """What is stale because of a customer or supplier with a balance below zero."""
    stale = lambda table, a, key, balance: load(spark, sf, table).where(F.col(balance) < 0).select(F.concat(F.lit(a), F.col(key).cast("string")).alias("node"))
    return gr.stale_causes(_graph(spark, sf), stale("customer", "c", "c_custkey", "c_acctbal").union(stale("supplier", "s", "s_suppkey", "s_acctbal")))


@query("GR-3", sql=f"WITH RECURSIVE {GRAPH}, d AS (SELECT 'n' || n_nationkey AS node FROM nation WHERE n_nationkey % 6 = 0 UNION SELECT 'c' || c_custkey FROM customer WHERE c_custkey % 40 = 0), r AS (SELECT node, node AS cause, 0 AS k FROM d UNION ALL SELECT g.src, r.cause, k + 1 FROM r JOIN g ON g.dst = r.node WHERE g.src NOT IN (SELECT node FROM d) AND k < 10) SELECT DISTINCT node, cause FROM r")
def stale_causes(spark: SparkSession, sf: str) -> DataFrame:
    direct = load(spark, sf, "nation").where("n_nationkey % 6 = 0").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("node"))
    direct = direct.union(load(spark, sf, "customer").where("c_custkey % 40 = 0").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string"))))
    return gr.stale_causes(_graph(spark, sf), direct)


@query("GR-2", sql="WITH RECURSIVE e AS (SELECT n_nationkey AS src, (n_nationkey * 3 + n_regionkey) % 25 AS dst FROM nation), r AS (SELECT src AS start, dst AS node, 1 AS k FROM e UNION ALL SELECT r.start, e.dst, k + 1 FROM r JOIN e ON e.src = r.node WHERE k < 25) SELECT DISTINCT CAST(start AS BIGINT) AS node FROM r WHERE start = node")
def graph_cycle(spark: SparkSession, sf: str) -> DataFrame:
    n = load(spark, sf, "nation")
    edges = n.select(F.col("n_nationkey").cast("bigint").alias("src"), ((F.col("n_nationkey") * 3 + F.col("n_regionkey")) % 25).cast("bigint").alias("dst"))
    return gr.cycle_nodes(edges)


@query("GR-4", "TK-7")
def rebuild_order(spark: SparkSession, sf: str) -> DataFrame:
    """Nations and regions in the order to rebuild them: a plan of fixed size."""
    rows = load(spark, sf, "nation").select(F.concat(F.lit("n"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("a"), F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("b")).collect()
    edges = [(r.a, r.b) for r in rows]
    order = gr.order_first(edges, sorted({x for e in edges for x in e}))
    return spark.createDataFrame(list(enumerate(order)), "step long, node string")


@query(
    "GR-5",
    sql=f"""WITH p AS (SELECT l_orderkey AS scope, l_linenumber AS part, l_linenumber * 2 - 1 - (l_linenumber % 3) AS first, l_linenumber * 2 AS last FROM lineitem),
     b AS (SELECT *, coalesce(lag(last) OVER (PARTITION BY scope ORDER BY first, last, part), 0) AS before FROM p)
     SELECT scope, part, first, last, CASE WHEN first > before + 1 THEN 'gap' ELSE 'overlap' END AS problem FROM b WHERE first <> before + 1""",
)
def scope_partitions(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("l_linenumber")
    parts = load(spark, sf, "lineitem").select(F.col("l_orderkey").alias("scope"), n.alias("part"), (n * 2 - 1 - n % 3).alias("first"), (n * 2).alias("last"))
    return gr.scope_problems(parts)


@query("GR-7", "JN-14", sql="""WITH d AS (SELECT o_orderkey, o_custkey FROM orders UNION ALL SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 97 = 0), k AS (SELECT o_orderkey, count(*) AS n FROM d GROUP BY 1 HAVING count(*) > 1)
 SELECT 'duplicate' AS problem, CAST(o_orderkey AS BIGINT) AS key FROM k UNION ALL SELECT 'orphan', o_orderkey FROM orders ANTI JOIN (SELECT c_custkey AS o_custkey FROM customer WHERE c_custkey % 10 <> 3) USING (o_custkey)""")
def key_constraints(spark: SparkSession, sf: str) -> DataFrame:
    """Keys that are not unique, and rows whose dependency is missing."""
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    twice = orders.unionByName(orders.where("o_orderkey % 97 = 0")).groupBy("o_orderkey").count().where("count > 1")
    orphan = orders.join(load(spark, sf, "customer").where("c_custkey % 10 <> 3").select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_anti")
    return twice.select(F.lit("duplicate").alias("problem"), F.col("o_orderkey").alias("key")).union(orphan.select(F.lit("orphan"), "o_orderkey"))


@query("HX-8", "HX-9", "SC-13", sql="""WITH a AS (SELECT doc_id, sha256(coalesce(text, '')) AS h FROM documents), m AS (SELECT doc_id, CASE WHEN doc_id % 50 = 7 THEN sha256('x') ELSE h END AS h FROM a WHERE doc_id % 60 <> 1)
 SELECT doc_id, CASE WHEN m.h IS NULL THEN 'unlisted' WHEN a.h IS NULL THEN 'missing' ELSE 'changed' END AS problem FROM a FULL JOIN m USING (doc_id) WHERE a.h IS DISTINCT FROM m.h""")
def manifest_check(spark: SparkSession, sf: str) -> DataFrame:
    """Texts against a manifest of their hashes."""
    now = load(spark, sf, "documents").select("doc_id", F.sha2(T.text_of(), 256).alias("h"))
    listed = now.where("doc_id % 60 <> 1").select("doc_id", F.when(F.col("doc_id") % 50 == 7, F.sha2(F.lit("x"), 256)).otherwise(F.col("h")).alias("m"))
    both = now.join(listed, "doc_id", "full").where(~F.col("h").eqNullSafe(F.col("m")))
    return both.select("doc_id", F.when(F.col("m").isNull(), "unlisted").when(F.col("h").isNull(), "missing").otherwise("changed").alias("problem"))


@query("2.10-ledger", "JN-4", sql=f"""WITH {BOOKS}, changed AS (SELECT book, page FROM books WHERE page % 37 = 5), n AS (SELECT book, page, lag(page) OVER w AS p, lead(page) OVER w AS q FROM books WINDOW w AS (PARTITION BY book ORDER BY page)),
 need AS (SELECT DISTINCT c.book, unnest([n.page, n.p, n.q]) AS page FROM changed c JOIN n ON n.page = c.page), reviewed AS (SELECT page FROM books WHERE page % 37 IN (5, 25)) SELECT need.book, need.page FROM need ANTI JOIN reviewed USING (page) WHERE need.page IS NOT NULL""")
def review_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Changed pages and their neighbours that nobody reviewed."""
    from ..operators.furniture import neighbours

    pages = books(load(spark, sf, "documents"))
    changed = pages.where("page % 37 = 5").select("page")
    need = neighbours(pages).join(changed, "page").select("book", F.explode(F.array("page", "previous_page", "next_page")).alias("page")).where("page IS NOT NULL").distinct()
    return need.join(pages.where("page % 37 IN (5, 25)").select("page"), "page", "left_anti").select("book", "page")


@query("GS-6", sql="""WITH a AS (SELECT item_id, left(text, 24) AS value, CASE item_id % 3 WHEN 0 THEN 'contains' WHEN 1 THEN 'absent' ELSE 'contains_exact' END AS type FROM benchmark),
 h AS (SELECT item_id, type, count(d.doc_id) AS hits FROM a LEFT JOIN documents d ON contains(d.text, a.value) GROUP BY 1, 2)
 SELECT item_id, type, hits, CASE type WHEN 'contains' THEN hits > 0 WHEN 'absent' THEN hits = 0 ELSE hits = 1 END AS holds FROM h""")
def assertion_check(spark: SparkSession, sf: str) -> DataFrame:
    """Assertions about the texts.  Values are looked up by their first eight characters, which
    documents and assertions are joined on; only then is the whole value compared."""
    a = load(spark, sf, "benchmark").select("item_id", F.left("text", F.lit(24)).alias("value"), F.element_at(F.array(F.lit("contains"), F.lit("absent"), F.lit("contains_exact")), (F.col("item_id") % 3 + 1).cast("int")).alias("type"))
    seeds = a.select("item_id", "value", F.left("value", F.lit(8)).alias("seed"))
    docs = load(spark, sf, "documents").select("doc_id", "text", F.explode(F.array_distinct(T.pieces(T.text_of(), 8))).alias("seed"))
    hits = docs.join(seeds, "seed").where(F.contains("text", F.col("value"))).groupBy("item_id").agg(F.count_distinct("doc_id").alias("hits"))
    out = a.join(hits, "item_id", "left").fillna(0, ["hits"])
    return out.select("item_id", "type", "hits", F.when(F.col("type") == "contains", F.col("hits") > 0).when(F.col("type") == "absent", F.col("hits") == 0).otherwise(F.col("hits") == 1).alias("holds"))


@query("TK-8")
def vote_plan(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs to ask within a budget, most frequent first; one too big for the rest is passed over."""
    pairs = load(spark, sf, "events").groupBy((F.col("user_id") % 97).alias("pair")).agg(F.count("*").alias("n")).withColumn("cost", F.least(F.col("n"), F.lit(3)).cast("long"))
    import pandas as pd

    def plan(rows: pd.DataFrame) -> pd.DataFrame:
        left, out = 40, []
        for r in rows.sort_values(["n", "pair"], ascending=[False, True]).itertuples():
            ask = r.cost >= 2 and r.cost <= left
            left -= r.cost if ask else 0
            out.append((r.pair, r.n, r.cost, ask))
        return pd.DataFrame(out, columns=["pair", "n", "cost", "asked"])

    # at most 97 pairs: the key is a remainder
    return pairs.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(plan, "pair long, n long, cost long, asked boolean")
