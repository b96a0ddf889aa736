"""Audit issues and counts over lines and whole texts, as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import compare_key, line_kind

# Issue codes of single lines and the patterns that raise them.
LINE_ISSUES = [
    ("trailing-whitespace", r"[ \t]+$"),
    ("space-before-tab", r" +\t"),
    ("replacement-character", "�"),
    ("ocr-tool-heading", r"^#+ .*(OCR|Scan)"),
    ("low-confidence-bracket", r"\[\?[^\]]*\]"),
    ("unclassified-uncertain-marker", r"\?\?"),
    ("suspicious-ocr-symbol", r"[%*&$#]{3}"),
    ("html-comment-in-final", r"<!--"),
    ("raw-html-outside-table", r"<(div|span|p|br)\b"),
]
PAIRS = [("(", ")"), ("[", "]"), ("{", "}"), ("（", "）"), ("「", "」"), ("『", "』")]


def line_issues(lines: DataFrame) -> DataFrame:
    """page, line_no and code of every issue a single line shows."""
    hits = F.array(*(F.when(F.col("line").rlike(p), F.lit(c)) for c, p in LINE_ISSUES))
    return lines.select("page", "line_no", F.explode(F.array_compact(hits)).alias("code"))


def structure_issues(lines: DataFrame) -> DataFrame:
    """Issues between neighbouring lines of a page."""
    w = Window.partitionBy("page").orderBy("line_no")
    a = lines.select("page", "line_no", line_kind(F.col("line")).alias("kind"))
    a = a.select("page", "line_no", "kind", F.lag("kind").over(w).alias("was"), F.lead("kind").over(w).alias("next"))
    codes = F.array(
        F.when((F.col("kind") == "prose") & (F.col("was") == "prose"), F.lit("ordinary-soft-break")),
        F.when((F.col("kind") == "heading") & F.col("was").isNotNull() & (F.col("was") != "blank"), F.lit("heading-spacing-before")),
        F.when((F.col("kind") == "heading") & F.col("next").isNotNull() & (F.col("next") != "blank"), F.lit("heading-spacing-after")),
        F.when((F.col("kind") == "blank") & (F.col("was") == "list") & (F.col("next") == "list"), F.lit("loose-list-blank")),
    )
    return a.select("page", "line_no", F.explode(F.array_compact(codes)).alias("code"))


def whole_issues(pages: DataFrame) -> DataFrame:
    """Issues of a whole text; they stand at line 0."""
    t = F.coalesce(F.col("text"), F.lit(""))
    fences = F.regexp_count(t, F.lit(r"(?m)^ {0,3}(```|~~~)"))
    codes = F.array(
        F.when(t == "", F.lit("empty-file")),
        F.when((t != "") & (F.right(t, F.lit(1)) != "\n"), F.lit("missing-final-newline")),
        F.when(F.right(t, F.lit(2)) == "\n\n", F.lit("extra-blank-line-at-eof")),
        F.when(fences % 2 == 1, F.lit("unterminated-fence")),
        F.when(t.startswith("---\n") & ~F.substr(t, F.lit(5)).contains("\n---"), F.lit("unterminated-frontmatter")),
    )
    return pages.select("page", F.lit(0).cast("bigint").alias("line_no"), F.explode(F.array_compact(codes)).alias("code"))


def repeated_paragraphs(lines: DataFrame, *, shortest: int = 40) -> DataFrame:
    """Comparison keys of long lines that stand more than once on a page, with how often and where first."""
    keys = lines.select("page", "line_no", compare_key(F.col("line")).alias("key")).where(F.length("key") >= shortest)
    return keys.groupBy("page", F.sha2("key", 256).alias("key_sha256")).agg(F.count("*").alias("copies"), F.min("line_no").alias("first_line")).where("copies > 1")


def adjacent_copies(lines: DataFrame) -> DataFrame:
    """Lines equal to the line before them."""
    w = Window.partitionBy("page").orderBy("line_no")
    return lines.withColumn("was", F.lag("line").over(w)).where((F.trim("line") != "") & (F.col("line") == F.col("was"))).select("page", "line_no")


def _step(opener: str):
    return lambda c: F.when(c == F.lit(opener), 1).otherwise(-1)


def bracket_tally(pages: DataFrame, pairs: list[tuple[str, str]] | None = None) -> DataFrame:
    """opened (left open) and unopened (closed without an opener) by page and kind of bracket.

    Over the page's brackets in order the running depth is summed; its least value is the
    number of closers without an opener.
    """
    out = None
    for k, (a, b) in enumerate(pairs or PAIRS):
        esc = "".join("\\" + c for c in (a, b))
        marks = F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit(f"([{esc}])"), F.lit(1))
        steps = F.transform(marks, _step(a))
        run = F.aggregate(
            steps, F.struct(F.lit(0).alias("depth"), F.lit(0).alias("low")), lambda acc, s: F.struct((acc["depth"] + s).alias("depth"), F.least(acc["low"], acc["depth"] + s).alias("low"))
        )
        own = pages.withColumn("run", run).select("book", "page", F.lit(a).alias("bracket"), (F.col("run.depth") - F.col("run.low")).cast("bigint").alias("opened"), (-F.col("run.low")).cast("bigint").alias("unopened"))
        out = own if out is None else out.unionByName(own)
    return out.where("opened > 0 OR unopened > 0")


def unbalanced_pages(tally: DataFrame, pages: DataFrame) -> DataFrame:
    """Pages whose closers the page before does not explain, or whose openers the next does not."""
    w = Window.partitionBy("book", "bracket").orderBy("page")
    kinds = tally.select("book", "bracket").distinct()
    full = pages.select("book", "page").join(kinds, "book").join(tally, ["book", "page", "bracket"], "left").fillna(0, ["opened", "unopened"])
    near = full.select("book", "page", "bracket", "opened", "unopened", F.coalesce(F.lag("opened").over(w), F.lit(0)).alias("before"), F.coalesce(F.lead("unopened").over(w), F.lit(0)).alias("after"))
    return near.where("unopened > before OR opened > after").select("book", "page", "bracket", "opened", "unopened")


def symbol_counts(lines: DataFrame, kinds: list[tuple[str, str]]) -> DataFrame:
    """Occurrences of kinds of symbols, zero where there are none: kind, pages and occurrences."""
    found = lines.select("page", *(F.regexp_count("line", F.lit(p)).alias(k) for k, p in kinds))
    totals = found.agg(*(F.sum(k).alias(k) for k, _ in kinds), *(F.count_distinct(F.when(F.col(k) > 0, F.col("page"))).alias(f"{k}_pages") for k, _ in kinds))
    rows: Column = F.array(*(F.struct(F.lit(k).alias("kind"), F.col(f"{k}_pages").alias("pages"), F.coalesce(F.col(k), F.lit(0)).cast("bigint").alias("occurrences")) for k, _ in kinds))
    return totals.select(F.inline(rows))
