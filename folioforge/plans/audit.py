"""Queries of the audit, of counts of marks, and of lint counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import audit as au
from ..operators import furniture as fu
from ..sources.tables import books, lines, load
from .pages import HEADS
from .registry import BOOKS, LINES, core, kind, query


def _re(p: str) -> str:
    return "'" + p.replace("'", "''").replace(r"\b", r"\b") + "'"


LINE_SQL = " UNION ALL ".join(f"SELECT page, line_no, '{c}' AS code FROM lines WHERE regexp_matches(line, {_re(p)})" for c, p in au.LINE_ISSUES)
ISSUES = f"""{LINES}, k AS (SELECT page, line_no, {kind('line')} AS kind FROM lines), n AS (SELECT *, lag(kind) OVER w AS was, lead(kind) OVER w AS next FROM k WINDOW w AS (PARTITION BY page ORDER BY line_no)),
 issues AS ({LINE_SQL}
  UNION ALL SELECT page, line_no, 'ordinary-soft-break' FROM n WHERE kind = 'prose' AND was = 'prose'
  UNION ALL SELECT page, line_no, 'heading-spacing-before' FROM n WHERE kind = 'heading' AND was <> 'blank'
  UNION ALL SELECT page, line_no, 'heading-spacing-after' FROM n WHERE kind = 'heading' AND next <> 'blank'
  UNION ALL SELECT page, line_no, 'loose-list-blank' FROM n WHERE kind = 'blank' AND was = 'list' AND next = 'list'
  UNION ALL SELECT doc_id, 0, 'empty-file' FROM documents WHERE coalesce(text, '') = ''
  UNION ALL SELECT doc_id, 0, 'missing-final-newline' FROM documents WHERE text <> '' AND right(text, 1) <> chr(10)
  UNION ALL SELECT doc_id, 0, 'extra-blank-line-at-eof' FROM documents WHERE right(text, 2) = chr(10) || chr(10)
  UNION ALL SELECT doc_id, 0, 'unterminated-fence' FROM documents WHERE len(regexp_extract_all(coalesce(text, ''), '(?m)^ {{0,3}}(```|~~~)')) % 2 = 1
  UNION ALL SELECT doc_id, 0, 'unterminated-frontmatter' FROM documents WHERE starts_with(text, '---' || chr(10)) AND NOT contains(substr(text, 5), chr(10) || '---'))"""


def _issues(spark: SparkSession, sf: str) -> DataFrame:
    pages = books(load(spark, sf, "documents"))
    rows = lines(pages)
    return au.line_issues(rows).unionByName(au.structure_issues(rows)).unionByName(au.whole_issues(pages))


@query("2.10", "DQ", sql=f"WITH {ISSUES} SELECT page, line_no, code FROM issues")
def audit_issues(spark: SparkSession, sf: str) -> DataFrame:
    return _issues(spark, sf)


@query("AG-18", sql=f"WITH {ISSUES} SELECT code, count(*) AS issues, count(DISTINCT page) AS pages FROM issues GROUP BY code")
def audit_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _issues(spark, sf).groupBy("code").agg(F.count("*").alias("issues"), F.count_distinct("page").alias("pages"))


@query(
    "2.10-exceptions", "HX-10",
    sql=f"""WITH {ISSUES}, x AS (SELECT doc_id AS page, 'missing-final-newline' AS code FROM labels WHERE quality = 1 UNION SELECT doc_id, 'suspicious-ocr-symbol' FROM labels WHERE quality = 0),
     j AS (SELECT i.code, x.page IS NOT NULL AS excused FROM issues i LEFT JOIN x ON x.page = i.page AND x.code = i.code),
     s AS (SELECT x.code, count(*) AS stale FROM x ANTI JOIN issues i ON i.page = x.page AND i.code = x.code GROUP BY 1)
     SELECT code, count(*) FILTER (excused) AS excused, count(*) FILTER (NOT excused) AS open, coalesce(any_value(stale), 0) AS stale FROM j LEFT JOIN s USING (code) GROUP BY 1""",
)
def source_exceptions(spark: SparkSession, sf: str) -> DataFrame:
    """Issues that an exception list excuses, those that stay open, and exceptions that excuse nothing."""
    labels = load(spark, sf, "labels")
    excused = labels.where("quality = 1").select(F.col("doc_id").alias("page"), F.lit("missing-final-newline").alias("code")).union(labels.where("quality = 0").select("doc_id", F.lit("suspicious-ocr-symbol"))).distinct()
    issues = _issues(spark, sf)
    judged = issues.join(excused.withColumn("ok", F.lit(True)), ["page", "code"], "left").groupBy("code").agg(F.count_if(F.col("ok")).alias("excused"), F.count_if(F.col("ok").isNull()).alias("open"))
    stale = excused.join(issues.select("page", "code"), ["page", "code"], "left_anti").groupBy("code").agg(F.count("*").alias("stale"))
    return judged.join(stale, "code", "left").fillna(0, ["stale"])


@query("AG-19", sql=f"WITH {LINES}, k AS (SELECT page, line_no, lower({core('line')}) AS key FROM lines) SELECT page, sha256(key) AS key_sha256, count(*) AS copies, min(line_no) AS first_line FROM k WHERE length(key) >= 40 GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    return au.repeated_paragraphs(lines(books(load(spark, sf, "documents"))))


@query("WN-10", "P4", sql=f"WITH {LINES}, l AS (SELECT page, line_no, line, lag(line) OVER (PARTITION BY page ORDER BY line_no) AS was FROM lines) SELECT page, line_no FROM l WHERE trim(line) <> '' AND line = was")
def adjacent_duplicate_lines(spark: SparkSession, sf: str) -> DataFrame:
    return au.adjacent_copies(lines(books(load(spark, sf, "documents"))))


TALLY = f"""{BOOKS}, c AS (SELECT book, page, unnest(string_split(coalesce(text, ''), '')) AS ch, unnest(range(length(coalesce(text, '')))) AS i FROM books),
 m AS (SELECT book, page, i, CASE WHEN ch IN ('(', ')') THEN '(' WHEN ch IN ('[', ']') THEN '[' WHEN ch IN ('{{', '}}') THEN '{{' WHEN ch IN ('（', '）') THEN '（' WHEN ch IN ('「', '」') THEN '「' ELSE '『' END AS bracket,
   CASE WHEN ch IN ('(', '[', '{{', '（', '「', '『') THEN 1 ELSE -1 END AS s FROM c WHERE ch IN ('(', ')', '[', ']', '{{', '}}', '（', '）', '「', '」', '『', '』')),
 d AS (SELECT *, sum(s) OVER (PARTITION BY page, bracket ORDER BY i) AS depth FROM m),
 t AS (SELECT book, page, bracket, CAST(sum(s) - least(0, min(depth)) AS BIGINT) AS opened, CAST(-least(0, min(depth)) AS BIGINT) AS unopened FROM d GROUP BY 1, 2, 3),
 tally AS (SELECT * FROM t WHERE opened > 0 OR unopened > 0)"""


@query("AG-20", sql=f"WITH {TALLY} SELECT * FROM tally")
def bracket_balance(spark: SparkSession, sf: str) -> DataFrame:
    return au.bracket_tally(books(load(spark, sf, "documents")))


@query(
    "AG-20",
    sql=f"""WITH {TALLY}, f AS (SELECT b.book, b.page, k.bracket, coalesce(t.opened, 0) AS opened, coalesce(t.unopened, 0) AS unopened FROM books b JOIN (SELECT DISTINCT book, bracket FROM tally) k ON k.book = b.book LEFT JOIN tally t ON t.page = b.page AND t.bracket = k.bracket),
     n AS (SELECT *, coalesce(lag(opened) OVER w, 0) AS before, coalesce(lead(unopened) OVER w, 0) AS after FROM f WINDOW w AS (PARTITION BY book, bracket ORDER BY page))
     SELECT book, page, bracket, opened, unopened FROM n WHERE unopened > before OR opened > after""",
)
def unbalanced_pages(spark: SparkSession, sf: str) -> DataFrame:
    pages = books(load(spark, sf, "documents"))
    return au.unbalanced_pages(au.bracket_tally(pages), pages)


# Kinds of symbols counted.
SYMBOLS = [("comma", ","), ("period", r"\."), ("question", r"\?"), ("quote", "[\"“”]"), ("dash", "[—–-]"), ("pipe", r"\|"), ("figure", "[0-9]+"), ("cjk_mark", "[。、，]")]


@query("AG-11", "GS-6", sql="SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS kind, count(*) FILTER (n > 0) AS pages, CAST(coalesce(sum(n), 0) AS BIGINT) AS occurrences FROM (SELECT len(regexp_extract_all(coalesce(text, ''), '{p}')) AS n FROM documents)" for k, p in SYMBOLS) + ")")
def symbol_inventory(spark: SparkSession, sf: str) -> DataFrame:
    return au.symbol_counts(lines(books(load(spark, sf, "documents"))), SYMBOLS)


@query(
    "AG-10", "AG-16",
    sql=f"""WITH {BOOKS}, m AS (SELECT book, page, round(len(regexp_extract_all(coalesce(text, ''), '[,.;:!?]')) / greatest(length(text), 1), 9) AS density, len(regexp_extract_all(coalesce(text, ''), ',')) > 0 AS comma FROM books),
     r AS (SELECT *, row_number() OVER (PARTITION BY book ORDER BY density DESC, page) AS k FROM m)
     SELECT book, round(median(density), 6) AS middle, round(max(density) FILTER (k = 2), 6) AS second, 2 * count(*) FILTER (comma) > count(*) AS commas FROM r GROUP BY 1""",
)
def mark_density(spark: SparkSession, sf: str) -> DataFrame:
    """A book's median and second-largest density of marks, and whether most pages have commas."""
    t = T.text_of()
    pages = books(load(spark, sf, "documents")).select("book", "page", F.round(F.regexp_count(t, F.lit("[,.;:!?]")) / F.greatest(F.length("text"), F.lit(1)), 9).alias("density"), F.contains(t, F.lit(",")).alias("comma"))
    ranked = pages.withColumn("k", F.row_number().over(Window.partitionBy("book").orderBy(F.desc("density"), "page")))
    return ranked.groupBy("book").agg(F.round(F.median("density"), 6).alias("middle"), F.round(F.max(F.when(F.col("k") == 2, F.col("density"))), 6).alias("second"), (2 * F.count_if("comma") > F.count("*")).alias("commas"))


@query(
    "AG-21",
    sql=r"""WITH c AS (SELECT doc_id, unnest(string_split(text, '')) AS ch, unnest(range(length(text))) AS i FROM documents),
     r AS (SELECT doc_id, ch, i - row_number() OVER (PARTITION BY doc_id, ch ORDER BY i) AS island FROM c), n AS (SELECT doc_id, count(*) AS n FROM r GROUP BY doc_id, ch, island)
     SELECT doc_id, max(n) AS longest FROM n GROUP BY doc_id""",
)
def longest_char_run(spark: SparkSession, sf: str) -> DataFrame:
    """The longest run of one character: runs are what a back-reference matches, so no character is a row."""
    runs = F.regexp_extract_all("text", F.lit(r"(?s)((.)\2*)"), F.lit(1))
    return load(spark, sf, "documents").where(F.length("text") > 0).select("doc_id", F.array_max(F.transform(runs, lambda x: F.length(x))).cast("bigint").alias("longest"))


@query("AG-12", sql=f"""WITH {HEADS}, f AS (SELECT count(*) AS n FROM cores JOIN kept USING (book, core)), k AS (SELECT {kind('line')} AS kind, line, lag({kind('line')}) OVER (PARTITION BY page ORDER BY line_no) AS was, lag(line) OVER (PARTITION BY page ORDER BY line_no) AS before FROM lines)
 SELECT 'FURN-HEAD' AS counter, CASE WHEN (SELECT count(*) FROM kept) > 0 THEN n END AS n FROM f UNION ALL SELECT 'PARA-DISAGREE', count(*) FROM k WHERE kind = 'prose' AND was = 'prose'
 UNION ALL SELECT 'MARK-SHAPE', count(*) FROM k WHERE regexp_matches(line, '[%*&$#]{{3}}')
 UNION ALL SELECT 'TEXT-DOUBLED', count(*) FROM k WHERE line = before AND trim(line) <> ''""")
def lint_counters(spark: SparkSession, sf: str) -> DataFrame:
    """Counters by name; a counter whose gate fails (nothing learned to judge by) is null."""
    rows = lines(books(load(spark, sf, "documents")))
    heads = fu.recurring_lines(rows)
    cores = rows.select("book", T.line_core(F.col("line")).alias("core"), F.lit(1).alias("hit"))
    furn = heads.select("book", "core").join(cores, ["book", "core"], "left").agg(F.count("core").alias("learned"), F.count("hit").alias("n")).select(F.lit("FURN-HEAD").alias("counter"), F.when(F.col("learned") > 0, F.col("n")).alias("n"))
    w = Window.partitionBy("page").orderBy("line_no")
    k = rows.select(T.line_kind(F.col("line")).alias("kind"), "line", F.lag(T.line_kind(F.col("line"))).over(w).alias("was"), F.lag("line").over(w).alias("before"))
    counts = k.agg(
        F.count_if((F.col("kind") == "prose") & (F.col("was") == "prose")).alias("PARA-DISAGREE"),
        F.count_if(F.col("line").rlike("[%*&$#]{3}")).alias("MARK-SHAPE"), F.count_if((F.col("line") == F.col("before")) & (F.trim("line") != "")).alias("TEXT-DOUBLED"),
    )
    names = ["PARA-DISAGREE", "MARK-SHAPE", "TEXT-DOUBLED"]
    return furn.unionByName(counts.select(F.inline(F.array(*(F.struct(F.lit(c).alias("counter"), F.col(f"`{c}`").alias("n")) for c in names)))))


@query(
    "JN-15", "ST-2",
    sql=f"""WITH {HEADS}, s AS (SELECT c.page, c.line, c.line_no FROM cores c LEFT JOIN kept k ON k.book = c.book AND k.core = c.core WHERE k.core IS NULL),
     a AS (SELECT page, unnest(string_split({core('line')}, '')) AS ch FROM lines), b AS (SELECT page, unnest(string_split({core('line')}, '')) AS ch FROM s),
     x AS (SELECT page, ch FROM a EXCEPT ALL SELECT page, ch FROM b) SELECT page, count(*) AS lost, count(DISTINCT ch) AS kinds FROM x WHERE ch <> '' GROUP BY page""",
)
def text_lost(spark: SparkSession, sf: str) -> DataFrame:
    """Characters of the readings that the stripped text no longer holds, as a multiset."""
    rows = lines(books(load(spark, sf, "documents")))
    heads = fu.recurring_lines(rows).select("book", "core")
    # a page that no line left has all its characters
    cut = rows.withColumn("core", T.line_core(F.col("line"))).join(heads, ["book", "core"], "left_semi").select("page").distinct()
    rows = rows.join(cut, "page", "left_semi")
    chars = lambda df: df.select("page", F.explode(F.split(T.line_core(F.col("line")), "")).alias("ch")).where("ch <> ''").groupBy("page", "ch")
    left = rows.withColumn("core", T.line_core(F.col("line"))).join(heads, ["book", "core"], "left_anti")
    # counted first, so the multiset difference moves a row for each character of a page and not for each place
    a, b = chars(rows).agg(F.count("*").alias("n")), chars(left).agg(F.count("*").alias("m"))
    lost = a.join(b, ["page", "ch"], "left").select("page", "ch", F.greatest(F.col("n") - F.coalesce("m", F.lit(0)), F.lit(0)).alias("n")).where("n > 0")
    return lost.groupBy("page").agg(F.sum("n").alias("lost"), F.count("*").alias("kinds"))
