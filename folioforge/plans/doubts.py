"""Queries over doubts, gates and facts of whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import doubts as db
from ..sources.tables import books, lines, load
from .registry import BOOKS, LINES, query

SIGNS = r"[%*&$#]{3}"
LONG_LINE = 4000


@query(
    "AG-17", "ST-1", "HX-21",
    sql=f"""WITH {LINES}, place AS (SELECT book, page, row_number() OVER (PARTITION BY book ORDER BY page) AS n FROM books),
     l AS (SELECT page, line, lag(line) OVER (PARTITION BY page ORDER BY line_no) AS was FROM lines),
     d AS (SELECT page, 'doubled-line' AS kind FROM l WHERE line = was AND trim(line) <> '' UNION SELECT page, 'signs' FROM l WHERE regexp_matches(line, '{SIGNS}') UNION SELECT page, 'long-line' FROM l WHERE length(line) > {LONG_LINE}),
     i AS (SELECT book, kind, page, n - row_number() OVER (PARTITION BY book, kind ORDER BY n) AS island FROM d JOIN place USING (page)),
     r AS (SELECT book, kind, min(page) AS first, max(page) AS last, count(*) AS pages FROM i GROUP BY book, kind, island)
     SELECT book, concat('Q', lpad(CAST(row_number() OVER (PARTITION BY book ORDER BY first, kind) AS VARCHAR), 4, '0')) AS id, kind, first, last, pages FROM r""",
)
def doubt_list(spark: SparkSession, sf: str) -> DataFrame:
    """What three sources doubt, as one numbered list with runs of pages."""
    pages = books(load(spark, sf, "documents"))
    rows = lines(pages)
    was = F.lag("line").over(Window.partitionBy("page").orderBy("line_no"))
    doubled = rows.withColumn("was", was).where((F.col("line") == F.col("was")) & (F.trim("line") != ""))
    of = lambda found, kind: found.select("page", F.lit(kind).alias("kind"))
    return db.doubt_list(pages, [of(doubled, "doubled-line"), of(rows.where(F.col("line").rlike(SIGNS)), "signs"), of(rows.where(F.length("line") > LONG_LINE), "long-line")])


@query(
    "AG-5",
    sql=f"""WITH {BOOKS}, n AS (SELECT book, len(string_split(coalesce(text, ''), chr(10))) AS n_lines FROM books), c AS (SELECT book, n_lines, count(*) AS rows FROM n GROUP BY 1, 2),
     r AS (SELECT *, row_number() OVER (PARTITION BY book ORDER BY rows DESC, n_lines) AS k FROM c) SELECT book, CASE WHEN rows >= 3 THEN n_lines END AS n_lines, rows FROM r WHERE k = 1""",
)
def common_leaf(spark: SparkSession, sf: str) -> DataFrame:
    """The number of lines that most pages of a book have, if three or more do."""
    pages = books(load(spark, sf, "documents")).select("book", F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("n_lines"))
    return db.commonest(pages, "book", "n_lines", 3)


@query("WN-9", sql="WITH s AS (SELECT conv_id, turn - lag(turn, 1, 0) OVER (PARTITION BY conv_id ORDER BY turn) <> 1 AS broken FROM conversations) SELECT conv_id, count(*) AS figures, count(*) FILTER (broken) AS breaks FROM s GROUP BY 1")
def turn_continuity(spark: SparkSession, sf: str) -> DataFrame:
    return db.continuity(load(spark, sf, "conversations"), "conv_id", "turn")


@query("JN-1", sql="SELECT d.doc_id AS page, d.n_chars, l.quality, length(p.html) AS rendered FROM documents d JOIN labels l ON l.doc_id = d.doc_id JOIN pages p ON p.page_id = d.doc_id")
def page_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Pages that a reading, a second source and a rendering all have."""
    a = load(spark, sf, "documents").select(F.col("doc_id").alias("page"), "n_chars")
    b = load(spark, sf, "labels").select(F.col("doc_id").alias("page"), "quality")
    c = load(spark, sf, "pages").select(F.col("page_id").alias("page"), F.length("html").cast("bigint").alias("rendered"))
    return a.join(b, "page").join(c, "page")


@query("PRJ-9", sql=r"WITH p AS (SELECT page_id, regexp_extract(url, '^[A-Za-z]+://[^/]+/?(.*)$', 1) AS path FROM pages) SELECT page_id, path, length(path) > 0 AND NOT regexp_matches(path, '^[/~]|[\\:\x00-\x1f]|(^|/)\.\.(/|$)') AS safe FROM p")
def path_safety(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the path of each address could be a file's place below a folder."""
    path = F.regexp_extract("url", r"^[A-Za-z]+://[^/]+/?(.*)$", 1)
    return load(spark, sf, "pages").select("page_id", path.alias("path")).withColumn("safe", db.safe_path(F.col("path")))


@query("SC-25", sql=r"SELECT conv_id, turn, list_last(regexp_extract_all(coalesce(text, ''), '([A-Za-z]+)[.?!]', 1)) AS answer FROM conversations")
def last_answer(spark: SparkSession, sf: str) -> DataFrame:
    """The last word that ends a sentence: of several answers in a text the last one counts."""
    found = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"([A-Za-z]+)[.?!]"), F.lit(1))
    return load(spark, sf, "conversations").select("conv_id", "turn", F.try_element_at(found, F.lit(-1)).alias("answer"))


@query("HX-18", sql=f"WITH {BOOKS}, f AS (SELECT book, count(*) AS book_pages, sum(n_chars) AS book_chars, min(page) AS first_page FROM books GROUP BY 1) SELECT book, page, book_pages, book_chars, page = first_page AS opens FROM books JOIN f USING (book)")
def page_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Every page with the facts of its book; facts are joined by key, whatever their number."""
    pages = books(load(spark, sf, "documents")).select("book", "page", "n_chars")
    facts = pages.groupBy("book").agg(F.count("*").alias("book_pages"), F.sum("n_chars").alias("book_chars"), F.min("page").alias("first_page"))
    return pages.join(facts, "book").select("book", "page", "book_pages", "book_chars", (F.col("page") == F.col("first_page")).alias("opens"))


@query("ST-4", sql="WITH a AS (SELECT DISTINCT doc_id FROM documents), b AS (SELECT DISTINCT doc_id FROM labels) SELECT doc_id, 'left' AS side FROM a WHERE doc_id NOT IN (SELECT doc_id FROM b) UNION ALL SELECT doc_id, 'right' FROM b WHERE doc_id NOT IN (SELECT doc_id FROM a)")
def unlabelled_or_unknown(spark: SparkSession, sf: str) -> DataFrame:
    """Documents without a label and labels without a document: the two sets are equal if there is none."""
    return db.one_sided(load(spark, sf, "documents"), load(spark, sf, "labels"), "doc_id")
