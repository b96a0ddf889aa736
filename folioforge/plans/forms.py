"""Queries over numerals, dates, runs, classes, delimiters, notations and rendered tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import masks, numerals, runs
from ..functions import text as T
from ..operators import classes as cl
from ..sources.tables import books, lines, load
from .registry import BOOKS, LINES, query


@query("SC-3", sql="SELECT o_orderkey, o_orderkey % 10000 AS with_units, o_orderkey AS by_digit FROM orders")
def numerals_read(spark: SparkSession, sf: str) -> DataFrame:
    """Order numbers written with units and digit by digit, and read back."""
    key = F.col("o_orderkey")
    return load(spark, sf, "orders").select("o_orderkey", numerals.numeral_value(numerals.written(key % 10000)).alias("with_units"), numerals.numeral_value(F.translate(key.cast("string"), T.ASCII_DIGITS, T.CJK_DIGITS)).alias("by_digit"))


@query("SC-4", "HX-16", sql="SELECT o_orderkey, o_orderpriority AS rest, year(o_orderdate) AS year, month(o_orderdate) AS month, day(o_orderdate) AS day FROM orders")
def dates_split(spark: SparkSession, sf: str) -> DataFrame:
    """Order dates written in ideographs behind a text, and split off it again."""
    at = F.col("o_orderdate")
    year = F.translate(F.year(at).cast("string"), T.ASCII_DIGITS, T.CJK_DIGITS)
    line = F.concat("o_orderpriority", F.lit(" "), year, F.lit("年"), numerals.written(F.month(at)), F.lit("月"), numerals.written(F.dayofmonth(at)), F.lit("日"))
    own = load(spark, sf, "orders").select("o_orderkey", line.alias("line"))
    return numerals.split_dates(own, "line").select("o_orderkey", "rest", "year", "month", "day")


@query(
    "ST-5",
    sql="""WITH p AS (SELECT p_partkey, lower(p_type) AS a, p_name AS b FROM part), s AS (SELECT p_partkey, a, b, unnest(range(1, length(a) + 1)) AS i FROM p),
     t AS (SELECT p_partkey, b, i, unnest(list_transform(range(1, length(a) - i + 2), lambda k: substr(a, i, k))) AS run FROM s), h AS (SELECT * FROM t WHERE contains(b, run)),
     r AS (SELECT p_partkey, arg_min(run, -length(run) * 1000 + i) AS run FROM h GROUP BY 1)
     SELECT p.p_partkey, coalesce(run, '') AS run, regexp_matches(b, array_to_string(string_split(substr(a, 1, 3), ''), '.*')) AS in_order FROM p LEFT JOIN r USING (p_partkey)""",
)
def shared_runs(spark: SparkSession, sf: str) -> DataFrame:
    """The longest run that a part's type and name share, and whether the type's first letters stand in the name in order."""
    kind = F.lower("p_type")
    return load(spark, sf, "part").select("p_partkey", runs.common_run(kind, F.col("p_name")).alias("run"), runs.is_subsequence(F.left(kind, F.lit(3)), F.col("p_name")).alias("in_order"))


@query(
    "WN-8",
    sql="""WITH RECURSIVE l AS (SELECT l_orderkey AS k, l_linenumber AS n, l_partkey AS p, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS i FROM lineitem),
     c AS (SELECT k, i, p, 1 AS len FROM l UNION SELECT l.k, l.i, l.p, c.len + 1 FROM c JOIN l ON l.k = c.k AND l.i > c.i AND l.p > c.p)
     SELECT k AS l_orderkey, max(len) AS chain FROM c GROUP BY 1""",
)
def rising_parts(spark: SparkSession, sf: str) -> DataFrame:
    """The length of the longest chain of an order's lines whose parts rise; an order's lines are one row."""
    rows = load(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("lines"))
    return rows.select("l_orderkey", F.size(runs.chain_places(F.transform("lines", lambda x: x["l_partkey"].cast("long")))).alias("chain"))


@query(
    "GR-6",
    sql="""WITH c AS (SELECT c_custkey, c_custkey - row_number() OVER (ORDER BY c_custkey) AS island FROM customer WHERE c_mktsegment <> 'BUILDING')
     SELECT c_custkey AS node, min(c_custkey) OVER (PARTITION BY island) AS class FROM c QUALIFY count(*) OVER (PARTITION BY island) > 1""",
)
def customer_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Classes of customers whose numbers follow each other outside one segment."""
    own = load(spark, sf, "customer").where("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("a"))
    pairs = own.withColumn("b", F.col("a") + 1).join(own.select(F.col("a").alias("b")), "b")
    return cl.classes(pairs)


@query(
    "AG-15", "M-2",
    sql="""WITH s AS (SELECT c_mktsegment, c_custkey, c_name, unnest(range(1, length(c_name))) AS i FROM customer),
     t AS (SELECT DISTINCT c_mktsegment, c_custkey, unnest(list_transform(range(2, least(24, length(c_name) - i + 1) + 1), lambda k: substr(c_name, i, k))) AS core FROM s),
     c AS (SELECT c_mktsegment, core, count(*) AS texts FROM t GROUP BY 1, 2),
     r AS (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY texts DESC, length(core) DESC, core) AS k FROM c) SELECT c_mktsegment, core, texts FROM r WHERE k = 1""",
)
def segment_cores(spark: SparkSession, sf: str) -> DataFrame:
    """What the names of a segment's customers have in common (no longer stretch keeps 0.9 of them, so the SQL need not grow it)."""
    return cl.shared_cores(load(spark, sf, "customer"), "c_mktsegment", "c_name")


@query(
    "SC-18",
    sql="""WITH r AS (SELECT c_nationkey AS table_id, c_custkey, '| ' || c_name || ' | ' || c_mktsegment || ' |' AS line FROM customer)
     SELECT table_id, sha256('| name | segment |' || chr(10) || '| --- | --- |' || chr(10) || string_agg(line, chr(10) ORDER BY c_custkey)) AS text_sha256 FROM r GROUP BY 1""",
)
def rendered_tables(spark: SparkSession, sf: str) -> DataFrame:
    """A table for each nation's customers, rendered as Markdown."""
    rows = load(spark, sf, "customer")
    body = rows.select(F.col("c_nationkey").alias("table_id"), F.col("c_custkey").cast("long").alias("row"), F.posexplode(F.array("c_name", "c_mktsegment")).alias("col", "text"))
    head = body.select("table_id").distinct().select("table_id", F.lit(-1).cast("long").alias("row"), F.posexplode(F.array(F.lit("name"), F.lit("segment"))).alias("col", "text"))
    return cl.render_markdown(head.unionByName(body)).select("table_id", F.sha2("text", 256).alias("text_sha256"))


@query("PRJ-7", sql=r"SELECT page_id, length(html) AS chars, length(html) - length(regexp_replace(html, '(?s)<!--.*?-->', '', 'g')) AS hidden, sha256(regexp_replace(html, '(?s)<!--.*?-->', '', 'g')) AS shown_sha256 FROM pages")
def hidden_regions(spark: SparkSession, sf: str) -> DataFrame:
    """Characters of a page that are not rendered, overwritten where they stand."""
    own = load(spark, sf, "pages").select("page_id", F.length("html").cast("bigint").alias("chars"), masks.mask(F.col("html"), "\x00").alias("masked"))
    shown = F.replace("masked", F.lit("\x00"), F.lit(""))
    return own.select("page_id", "chars", (F.length("masked") - F.length(shown)).cast("bigint").alias("hidden"), F.sha2(shown, 256).alias("shown_sha256"))


@query("2.10-delimiters")
def delimiter_issues(spark: SparkSession, sf: str) -> DataFrame:
    """Delimiters of documents that do not pair, with the line and column where they stand."""
    found = load(spark, sf, "documents").select("doc_id", "text", F.explode(masks.delimiter_problems(F.col("text"))).alias("d"))
    before = F.substr("text", F.lit(1), F.col("d.place").cast("int"))
    line = F.regexp_count(before, F.lit("\n"))
    column = F.length(F.substring_index(before, "\n", -1)) + 1
    return found.select("doc_id", line.cast("bigint").alias("line_no"), column.cast("bigint").alias("column"), "d.code", F.col("d.sign").alias("token"))


# Notations and what shows them.
NOTATIONS = [("entity", "&[a-z]+;"), ("comment", "<!--"), ("emphasis", r"\*{2,3}"), ("amount", r"\$+"), ("heading-sign", "#+"), ("percent", "%+"), ("link", "href=")]


def notation_counts(pages: DataFrame, key: str, text: str) -> DataFrame:
    """key, kind and n: how often each notation stands in a page, zero where it does not."""
    count = lambda p: F.regexp_count(F.coalesce(text, F.lit("")), F.lit(p)).cast("bigint")
    rows: Column = F.array(*(F.struct(F.lit(k).alias("kind"), count(p).alias("n")) for k, p in NOTATIONS))
    return pages.select(key, F.inline(rows))


NOTATION_SQL = " UNION ALL ".join(f"SELECT page_id, '{k}' AS kind, CAST(len(regexp_extract_all(coalesce(html, ''), '{p}')) AS BIGINT) AS n FROM pages" for k, p in NOTATIONS)


@query("HX-25", sql=NOTATION_SQL)
def page_notations(spark: SparkSession, sf: str) -> DataFrame:
    return notation_counts(load(spark, sf, "pages"), "page_id", "html")


@query(
    "2.10-notation-policy",
    sql=f"""WITH n AS ({NOTATION_SQL}), p AS (SELECT kind, 4 * count(*) FILTER (n > 0) >= count(*) AS used FROM n GROUP BY 1)
     SELECT page_id, kind, n FROM n JOIN p USING (kind) WHERE n > 0 AND NOT used""",
)
def notation_policy(spark: SparkSession, sf: str) -> DataFrame:
    """Notations on pages of a collection whose policy, learned from a quarter of its pages, does not know them."""
    found = notation_counts(load(spark, sf, "pages"), "page_id", "html")
    policy = found.groupBy("kind").agg((4 * F.count_if(F.col("n") > 0) >= F.count("*")).alias("used"))
    return found.where("n > 0").join(policy.where("NOT used").select("kind"), "kind").select("page_id", "kind", "n")


@query(
    "HX-17",
    sql="""WITH f AS (SELECT page_id, regexp_extract_all(html, '[0-9]+') AS figures, regexp_split_to_array(html, '[0-9]+') AS gaps FROM pages), i AS (SELECT *, unnest(range(1, len(figures) + 1)) AS nth FROM f)
     SELECT page_id, nth, figures[nth] AS figure, right(gaps[nth], 1) AS before, left(gaps[nth + 1], 1) AS after FROM i""",
)
def figures_printed(spark: SparkSession, sf: str) -> DataFrame:
    """Every figure of a page, in order, with the characters beside it."""
    gaps = F.split("html", "[0-9]+", -1)
    beside = F.transform(F.regexp_extract_all("html", F.lit("([0-9]+)"), F.lit(1)), lambda x, i: F.struct(x.alias("figure"), F.right(F.get("gaps", i), F.lit(1)).alias("before"), F.left(F.get("gaps", i + 1), F.lit(1)).alias("after")))
    own = load(spark, sf, "pages").select("page_id", "html", gaps.alias("gaps")).select("page_id", F.posexplode(beside).alias("nth", "f"))
    return own.select("page_id", (F.col("nth") + 1).cast("bigint").alias("nth"), "f.figure", "f.before", "f.after")


@query(
    "HX-20",
    sql="""WITH p AS (SELECT item_id, list_filter([CASE WHEN coalesce(text, '') = '' THEN 'text' END, CASE WHEN NOT regexp_matches(coalesce(text, ''), '^[A-Z]') THEN 'capital' END, CASE WHEN NOT regexp_matches(coalesce(text, ''), '[.?!]$') THEN 'end' END], lambda x: x IS NOT NULL) AS problems FROM benchmark)
     SELECT item_id, array_to_string(problems, ',') AS problems FROM p""",
)
def record_problems(spark: SparkSession, sf: str) -> DataFrame:
    """What each record lacks, as a list; an empty list is a whole record."""
    t = T.text_of()
    lacks = F.array_compact(F.array(F.when(t == "", "text"), F.when(~t.rlike("^[A-Z]"), "capital"), F.when(~t.rlike(r"[.?!]\z"), "end")))
    return load(spark, sf, "benchmark").select("item_id", F.array_join(lacks, ",").alias("problems"))


@query(
    "PRJ-5",
    sql=f"""WITH {BOOKS}, w AS (SELECT book, page, text, lag(text) OVER (PARTITION BY book ORDER BY page) AS was FROM books),
     k AS (SELECT page, CASE WHEN regexp_extract(coalesce(text, ''), '^[^ \\n]*') = regexp_extract(coalesce(was, ''), '^[^ \\n]*') THEN 'same' WHEN regexp_matches(regexp_extract(coalesce(text, ''), '^[^ \\n]*'), '[0-9]') THEN 'numeral'
      WHEN regexp_matches(regexp_extract(coalesce(text, ''), '^[^ \\n]*'), '[^\\x00-\\x7f]') THEN 'rare' ELSE 'prose' END AS class FROM w) SELECT class, count(*) AS pages FROM k GROUP BY 1""",
)
def disagreement_classes(spark: SparkSession, sf: str) -> DataFrame:
    """What kind of word two neighbouring pages begin with where they differ: a numeral, a rare sign or prose."""
    word = lambda c: F.regexp_extract(F.coalesce(c, F.lit("")), r"^[^ \n]*", 0)
    near = books(load(spark, sf, "documents")).select("text", F.lag("text").over(Window.partitionBy("book").orderBy("page")).alias("was")).select(word("text").alias("now"), word("was").alias("was"))
    kind = F.when(F.col("now") == F.col("was"), "same").when(F.col("now").rlike("[0-9]"), "numeral").when(F.col("now").rlike(r"[^\x00-\x7f]"), "rare").otherwise("prose")
    return near.groupBy(kind.alias("class")).agg(F.count("*").alias("pages"))


@query(
    "SC-22", "2.10-title-notes",
    sql=f"""WITH {LINES}, m AS (SELECT page, length(regexp_extract(rtrim(line), '[*]+$')) AS stars, 1 AS mark, 0 AS note FROM lines WHERE regexp_matches(rtrim(line), '[^* ][*]+$')
      UNION ALL SELECT page, length(regexp_extract(line, '^[*]+')), 0, 1 FROM lines WHERE regexp_matches(line, '^[*]+[^*]')),
     g AS (SELECT page, stars, CAST(sum(mark) AS BIGINT) AS marks, CAST(sum(note) AS BIGINT) AS notes FROM m GROUP BY 1, 2)
     SELECT page, CAST(stars AS BIGINT) AS stars, marks, notes, CASE WHEN marks = notes THEN 'matched' WHEN notes = 0 THEN 'missing' WHEN marks = 0 THEN 'orphan' ELSE 'mismatch' END AS state FROM g""",
)
def title_notes(spark: SparkSession, sf: str) -> DataFrame:
    """Stars at the ends of lines against notes that begin with as many: matched, missing, orphan or mismatch."""
    rows = lines(books(load(spark, sf, "documents")))
    end, start = F.regexp_extract(F.rtrim("line"), r"[^* ]([*]+)$", 1), F.regexp_extract("line", r"^([*]+)[^*]", 1)
    found = rows.select("page", F.inline(F.array(F.struct(F.length(end).alias("stars"), F.lit(1).alias("mark")), F.struct(F.length(start).alias("stars"), F.lit(0).alias("mark"))))).where("stars > 0")
    counts = found.groupBy("page", F.col("stars").cast("bigint").alias("stars")).agg(F.sum("mark").alias("marks"), F.sum(1 - F.col("mark")).alias("notes"))
    state = F.when(F.col("marks") == F.col("notes"), "matched").when(F.col("notes") == 0, "missing").when(F.col("marks") == 0, "orphan").otherwise("mismatch")
    return counts.withColumn("state", state)
