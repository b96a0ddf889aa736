"""Queries over votes, samples and sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import wilson_lower
from ..operators import sequences as sq
from ..operators import votes as vt
from ..sources.tables import books, load
from .registry import BOOKS, query

# Events seen as verdicts: two readers (user and its neighbour), three answers.
VERDICT = "CASE WHEN event_type IN ('click', 'purchase') THEN 'A' WHEN event_type = 'view' THEN 'B' ELSE 'none' END"
ITEMS = f"items AS (SELECT user_id % 97 AS a, CAST(floor(value) AS BIGINT) % 89 AS b, {VERDICT} AS verdict FROM events)"
PAIRS = f"{ITEMS}, pairs AS (SELECT least(a, b) AS low, greatest(a, b) AS high, count(*) FILTER (verdict = 'A') AS for_a, count(*) FILTER (verdict = 'B') AS for_b FROM items WHERE verdict IN ('A', 'B') GROUP BY 1, 2)"


def _items(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("event_type").isin("click", "purchase"), "A").when(F.col("event_type") == "view", "B").otherwise("none")
    return load(spark, sf, "events").select((F.col("user_id") % 97).alias("a"), (F.floor("value").cast("bigint") % 89).alias("b"), kind.alias("verdict"))


@query("AG-6", sql=f"WITH {PAIRS} SELECT *, CASE WHEN for_a > for_b THEN 'A' WHEN for_b > for_a THEN 'B' END AS vote FROM pairs")
def pair_votes(spark: SparkSession, sf: str) -> DataFrame:
    return vt.pair_votes(_items(spark, sf), "a", "b", "verdict")


def _wilson(good: str, n: str) -> str:
    return f"(({good} / {n}) + 3.8416 / (2 * {n}) - 1.96 * sqrt(({good} / {n}) * (1 - {good} / {n}) / {n} + 3.8416 / (4 * {n} * {n}))) / (1 + 3.8416 / {n})"


@query(
    "AG-7", "AG-22",
    sql=f"""WITH {PAIRS}, v AS (SELECT low % 10 AS class, count(*) FILTER (for_a > for_b) AS votes_a, count(*) FILTER (for_b > for_a) AS votes_b FROM pairs GROUP BY 1),
     w AS (SELECT *, greatest(votes_a, votes_b) AS g, votes_a + votes_b AS n FROM v)
     SELECT class, votes_a, votes_b, round({_wilson('g', 'n')}, 6) AS bound, CASE WHEN n < 16 OR round({_wilson('g', 'n')}, 9) <= 0.5 THEN 'adjudicate' WHEN votes_a >= votes_b THEN 'A' ELSE 'B' END AS preference FROM w WHERE n > 0""",
)
def wilson_preference(spark: SparkSession, sf: str) -> DataFrame:
    votes = vt.pair_votes(_items(spark, sf), "a", "b", "verdict").groupBy((F.col("low") % 10).alias("class")).agg(F.count_if(F.col("vote") == "A").alias("votes_a"), F.count_if(F.col("vote") == "B").alias("votes_b"))
    a, b = F.col("votes_a"), F.col("votes_b")
    return votes.where(a + b > 0).select("class", "votes_a", "votes_b", F.round(wilson_lower(F.greatest(a, b).cast("double"), (a + b).cast("double")), 6).alias("bound"), vt.preference(a, b).alias("preference"))


@query(
    "AG-8",
    sql=f"""WITH {ITEMS}, t AS (SELECT a, b, count(*) FILTER (verdict = 'A') AS x, count(*) FILTER (verdict = 'B') AS y, count(*) AS answered FROM items GROUP BY 1, 2)
     SELECT *, CASE WHEN answered = 0 OR x = y OR greatest(x, y) < 2 OR 2 * greatest(x, y) <= answered THEN 'none' WHEN x > y THEN 'A' ELSE 'B' END AS decision FROM t""",
)
def ballot_decision(spark: SparkSession, sf: str) -> DataFrame:
    t = _items(spark, sf).groupBy("a", "b").agg(F.count_if(F.col("verdict") == "A").alias("x"), F.count_if(F.col("verdict") == "B").alias("y"), F.count("*").alias("answered"))
    return t.withColumn("decision", vt.ballot(F.col("x"), F.col("y"), F.col("answered")))


@query(
    "HX-7", "GS-6",
    sql=f"""WITH {PAIRS}, r AS (SELECT low, high, CASE WHEN for_a > for_b THEN 'A' WHEN for_b > for_a THEN 'B' ELSE 'none' END AS vote, CASE WHEN (low + high) % 7 = 0 THEN 'B' END AS person FROM pairs)
     SELECT coalesce(person, vote) AS ruling, count(*) AS pairs, count(*) FILTER (person IS NOT NULL) AS by_person, count(*) FILTER (person IS NOT NULL AND person <> vote) AS overruled FROM r GROUP BY 1""",
)
def rulings_overlay(spark: SparkSession, sf: str) -> DataFrame:
    """A person's ruling stands over the vote; how often each decided, and how often they differ."""
    votes = vt.pair_votes(_items(spark, sf), "a", "b", "verdict").withColumn("vote", F.coalesce("vote", F.lit("none")))
    persons = votes.where((F.col("low") + F.col("high")) % 7 == 0).select("low", "high", F.lit("B").alias("person"))
    both = votes.join(persons, ["low", "high"], "left")
    return both.groupBy(F.coalesce("person", "vote").alias("ruling")).agg(F.count("*").alias("pairs"), F.count("person").alias("by_person"), F.count_if(F.col("person") != F.col("vote")).alias("overruled"))


@query("TK-4", sql="WITH h AS (SELECT doc_id, sha256(concat('folio:', CAST(doc_id AS VARCHAR))) AS order_hash FROM documents) SELECT doc_id, order_hash FROM h ORDER BY order_hash, doc_id LIMIT (SELECT CAST(greatest(1, round_even(0.05 * count(*), 0)) AS BIGINT) FROM documents)")
def hash_sample(spark: SparkSession, sf: str) -> DataFrame:
    return vt.hash_sample(load(spark, sf, "documents").select("doc_id"), "doc_id", seed="folio", share=0.05)


@query("TK-5", sql="SELECT doc_id, strpos('13579bdf', right(sha256(concat('show:', CAST(doc_id AS VARCHAR))), 1)) > 0 AS flipped FROM documents")
def hash_flip(spark: SparkSession, sf: str) -> DataFrame:
    odd = F.conv(F.substring(vt.hash_order("show", F.col("doc_id")), 64, 1), 16, 10).cast("int") % 2 == 1
    return load(spark, sf, "documents").select("doc_id", odd.alias("flipped"))


@query(
    "WN-6", "TK-3",
    sql=f"""WITH {BOOKS}, r AS (SELECT book, page, n_chars, row_number() OVER (PARTITION BY book ORDER BY page) - 1 AS i, count(*) OVER (PARTITION BY book) AS n FROM books),
     s AS (SELECT *, ((i + 1) * least(4, n) - 1) // n AS stratum FROM r)
     SELECT book, stratum, arg_max(page, (n_chars, -page)) AS page FROM s GROUP BY 1, 2""",
)
def probe_pages(spark: SparkSession, sf: str) -> DataFrame:
    return vt.strata_tops(books(load(spark, sf, "documents")).select("book", "page", "n_chars"), "book", "page", "n_chars", 4)


@query("WN-7", sql=f"WITH {BOOKS} SELECT book, page, row_number() OVER (PARTITION BY book ORDER BY page) AS round FROM books")
def interleave_items(spark: SparkSession, sf: str) -> DataFrame:
    return vt.round_robin(books(load(spark, sf, "documents")).select("book", "page"), "book", "page")


@query(
    "TK-1", "TK-2", "TK-6",
    sql="""WITH c AS (SELECT o_custkey, o_orderdate, o_totalprice, o_orderkey, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_totalprice DESC, o_orderkey) AS d FROM orders),
     t AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, o_custkey LIMIT 40),
     r AS (SELECT c.*, t.n, row_number() OVER (PARTITION BY c.o_custkey ORDER BY c.o_totalprice DESC, c.o_orderkey) AS k FROM c JOIN t USING (o_custkey) WHERE d = 1)
     SELECT o_custkey, n, o_orderkey, k FROM r WHERE k <= 3""",
)
def top_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """The 40 most frequent keys, and up to three of their rows from different days: a top-k report."""
    from pyspark.sql import Window

    orders = load(spark, sf, "orders")
    top = orders.groupBy("o_custkey").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "o_custkey").limit(40)
    best = (F.desc("o_totalprice"), "o_orderkey")
    one = orders.join(F.broadcast(top), "o_custkey").withColumn("d", F.row_number().over(Window.partitionBy("o_custkey", "o_orderdate").orderBy(*best))).where("d = 1")
    return one.withColumn("k", F.row_number().over(Window.partitionBy("o_custkey").orderBy(*best))).where("k <= 3").select("o_custkey", "n", "o_orderkey", "k")


@query(
    "SRC-7", "WN-2",
    sql=f"""WITH {BOOKS}, d AS (SELECT DISTINCT b.book, l.doc_id AS v FROM labels l JOIN books b USING (doc_id)), i AS (SELECT book, v, v - 20 * row_number() OVER (PARTITION BY book ORDER BY v) AS island FROM d)
     SELECT book, min(v) // 20 AS first, max(v) // 20 AS last, count(*) AS size FROM (SELECT book, v, v // 20 - row_number() OVER (PARTITION BY book ORDER BY v) AS island FROM d) GROUP BY book, island""",
)
def labelled_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of labelled pages of a book (its pages are every 20th document)."""
    pages = books(load(spark, sf, "documents")).select("doc_id", "book").join(load(spark, sf, "labels").select("doc_id").distinct(), "doc_id")
    return sq.contiguous_runs(pages.withColumn("v", F.floor(F.col("doc_id") / 20)), "book", "v")


@query(
    "WN-2", "M-3",
    sql=f"""WITH {BOOKS}, a AS (SELECT book, page, lang, row_number() OVER (PARTITION BY book ORDER BY page) - row_number() OVER (PARTITION BY book, lang ORDER BY page) AS island FROM books),
     r AS (SELECT book, lang, island, min(page) AS first, max(page) AS last, count(*) AS size FROM a GROUP BY 1, 2, 3 HAVING count(*) >= 3),
     m AS (SELECT *, CASE WHEN lag(lang) OVER w = lang THEN 0 ELSE 1 END AS new FROM r WINDOW w AS (PARTITION BY book ORDER BY first)),
     g AS (SELECT *, sum(new) OVER (PARTITION BY book ORDER BY first) AS run FROM m)
     SELECT book, lang, min(first) AS first, max(last) AS last, sum(size) AS size FROM g GROUP BY book, run, lang""",
)
def sequence_runs(spark: SparkSession, sf: str) -> DataFrame:
    return sq.equal_runs(books(load(spark, sf, "documents")).select("book", "page", "lang"), "book", "page", "lang")


@query("WN-3", "M-4", sql=f"WITH {BOOKS}, s AS (SELECT book, l.doc_id // 20 AS v FROM labels l JOIN books b USING (doc_id) GROUP BY 1, 2), n AS (SELECT *, lead(v) OVER (PARTITION BY book ORDER BY v) AS following FROM s) SELECT book, v, following, following - v - 1 AS missing FROM n WHERE following - v <> 1")
def sequence_jumps(spark: SparkSession, sf: str) -> DataFrame:
    pages = books(load(spark, sf, "documents")).select("doc_id", "book").join(load(spark, sf, "labels").select("doc_id").distinct(), "doc_id")
    return sq.jumps(pages.withColumn("v", F.floor(F.col("doc_id") / 20)), "book", "v")


@query(
    "JN-6", "WN-4",
    sql=f"""WITH {BOOKS}, v AS (SELECT book, page // 20 AS page, page // 20 + (n_chars % 3) AS value FROM books), s AS (SELECT *, unnest([1, 2]) AS slope FROM v), o AS (SELECT *, slope * page - value AS shift FROM s),
     c AS (SELECT *, count(*) OVER (PARTITION BY book, slope, shift ORDER BY page RANGE BETWEEN 10 PRECEDING AND 10 FOLLOWING) - 1 AS supporters FROM o)
     SELECT * FROM c WHERE supporters >= 2""",
)
def sequence_support(spark: SparkSession, sf: str) -> DataFrame:
    pages = books(load(spark, sf, "documents")).select("book", F.floor(F.col("page") / 20).alias("page"), "n_chars")
    return sq.supported(pages.withColumn("value", F.col("page") + F.col("n_chars") % 3), "book", "page", "value")


@query("AG-14", "M-4", sql=f"WITH {BOOKS} SELECT book, page // 20 - (page // 20 + (n_chars % 3)) AS shift, count(DISTINCT page // 20) AS pages, min(page // 20) AS first, max(page // 20) AS last FROM books GROUP BY 1, 2")
def offset_counts(spark: SparkSession, sf: str) -> DataFrame:
    pages = books(load(spark, sf, "documents")).select("book", F.floor(F.col("page") / 20).alias("page"), "n_chars")
    return sq.offsets(pages.withColumn("value", F.col("page") + F.col("n_chars") % 3), "book", "page", "value")


@query(
    "AG-14", "M-4",
    sql=f"""WITH RECURSIVE {BOOKS}, c AS (SELECT book, page // 20 - (page // 20 * 2 + (n_chars % 3)) AS shift, count(DISTINCT page // 20) AS pages, min(page // 20) AS first, max(page // 20) AS last FROM books GROUP BY 1, 2),
     o AS (SELECT *, row_number() OVER (PARTITION BY book ORDER BY pages DESC, shift) AS k FROM c WHERE pages >= 1),
     r AS (SELECT DISTINCT book, CAST(0 AS BIGINT) AS k, CAST([] AS STRUCT(shift BIGINT, pages BIGINT, first BIGINT, last BIGINT)[]) AS acc FROM o
      UNION ALL SELECT r.book, o.k, CASE WHEN coalesce(list_max(list_transform(acc, lambda x: greatest(least(o.last, x.last) - greatest(o.first, x.first) + 1, 0))), 0) / (o.last - o.first + 1) < 0.2
       THEN list_append(acc, CAST({{'shift': o.shift, 'pages': o.pages, 'first': o.first, 'last': o.last}} AS STRUCT(shift BIGINT, pages BIGINT, first BIGINT, last BIGINT))) ELSE acc END FROM r JOIN o ON o.book = r.book AND o.k = r.k + 1),
     e AS (SELECT book, unnest(arg_max(acc, k)) AS x FROM r GROUP BY 1) SELECT book, x.shift AS shift, x.pages AS pages, x.first AS first, x.last AS last FROM e""",
)
def accepted_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """Offsets of a numbering that skips a number on every page, as far as their ranges are apart."""
    pages = books(load(spark, sf, "documents")).select("book", F.floor(F.col("page") / 20).alias("page"), "n_chars")
    return sq.fit_offsets(sq.offsets(pages.withColumn("value", F.col("page") * 2 + F.col("n_chars") % 3), "book", "page", "value"), least=1)


@query(
    "JN-13",
    sql="""WITH p AS (SELECT conv_id, turn FROM conversations WHERE turn % 3 <> 1 OR turn = 0), s AS (SELECT conv_id, unnest(range(min(turn), max(turn) + 1)) AS turn FROM p GROUP BY conv_id)
     SELECT s.conv_id, s.turn FROM s ANTI JOIN p USING (conv_id, turn)""",
)
def missing_members(spark: SparkSession, sf: str) -> DataFrame:
    return sq.missing_members(load(spark, sf, "conversations").where("turn % 3 <> 1 OR turn = 0").select("conv_id", "turn"), "conv_id", "turn")
