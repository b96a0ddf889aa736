"""Page furniture: text that recurs at the edges of a book's pages or on many of them."""

from __future__ import annotations

from collections import Counter
from math import ceil

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import compare_key, fold_numerals, line_core

EDGE_SHARE, EDGE_LEAST = 0.05, 5


def recurring_lines(lines: DataFrame, *, share: float = EDGE_SHARE, least: int = EDGE_LEAST, shortest: int = 4) -> DataFrame:
    """book, core and pages of lines on at least max(least, share of the book's pages) pages.

    Both counts combine on the map side; the floors (a row for each book) join by book.
    """
    floors = lines.groupBy("book").agg(F.count_distinct("page").alias("n")).select("book", F.greatest(F.lit(least), F.ceil(F.col("n") * share)).cast("bigint").alias("floor"))
    cores = lines.withColumn("core", line_core(F.col("line"))).where(F.length("core") >= shortest)
    counts = cores.groupBy("book", "core").agg(F.count_distinct("page").alias("pages"))
    return counts.join(floors, "book").where("pages >= floor").select("book", "core", "pages")


def recurring_blocks(lines: DataFrame, *, pages: int = 3, shortest: int = 2) -> DataFrame:
    """Comparison keys that stand as a line of their own on `pages` pages or more, over all books."""
    keys = lines.withColumn("key", compare_key(F.col("line"))).where(F.length("key") >= shortest)
    return keys.groupBy("key").agg(F.count_distinct("page").alias("pages")).where(F.col("pages") >= pages)


def edge_lines(pages: DataFrame) -> DataFrame:
    """book, page and each page's first and last line that is not blank (null: it has none), cut out of the text where it stands."""
    t = F.coalesce("text", F.lit(""))
    marks = F.lit(" \n")
    ends = pages.select("book", "page", t.alias("text"), F.ltrim(t, marks).alias("behind"), F.rtrim(t, marks).alias("before"))
    full = F.col("behind") != ""
    indent = F.substring_index(F.left("text", F.length("text") - F.length("behind")), "\n", -1)
    rest = F.substring_index(F.right("text", F.length("text") - F.length("before")), "\n", 1)
    first, last = F.concat(indent, F.substring_index("behind", "\n", 1)), F.concat(F.substring_index("before", "\n", -1), rest)
    return ends.select("book", "page", F.when(full, first).alias("first"), F.when(full, last).alias("last"))


def _stretches(line: str, letters: str, low: int, *, start: bool) -> list[str]:
    """Beginnings (or ends) of `low` characters or more that begin and end in a letter; letters has a 1 for each."""
    n = len(line)
    if start:
        return [line[:k] for k in range(low, n + 1) if letters[0] == letters[k - 1] == "1"]
    return [line[n - k :] for k in range(low, n + 1) if letters[n - k] == letters[-1] == "1"]


def edge_heads(pages: DataFrame, *, low: int = 4, high: int = 40, share: float = EDGE_SHARE, least: int = EDGE_LEAST) -> DataFrame:
    """book, side, stretch and pages: stretches that open or close enough pages, and that no longer one explains.

    A stretch is left out when one that contains it, by one character more at its inner
    end, stands on 0.8 of its pages or more.  A book has a bounded number of pages, so the
    ends of its pages come together once and their stretches are counted there; only what
    is returned becomes rows.
    """
    edges = edge_lines(pages).where("first IS NOT NULL").select("book", "page", fold_numerals(F.trim("first")).alias("first"), fold_numerals(F.trim("last")).alias("last"))
    letters = lambda c: F.regexp_replace(F.regexp_replace(c, r"\P{L}", "0"), r"\p{L}", "1")
    edges = edges.select("book", "page", F.left("first", F.lit(high)).alias("first"), F.right("last", F.lit(high)).alias("last"))
    edges = edges.select("*", letters("first").alias("first_letters"), letters("last").alias("last_letters"))

    def heads(df: pd.DataFrame) -> pd.DataFrame:
        floor = max(least, ceil(df["page"].nunique() * share))
        out = []
        for side, c in (("start", "first"), ("end", "last")):
            start = side == "start"
            own: dict[int, set[str]] = {}
            for page, line, marks in zip(df["page"], df[c], df[f"{c}_letters"]):
                own.setdefault(page, set()).update(_stretches(line, marks, low, start=start))
            counts = {x: n for x, n in Counter(x for xs in own.values() for x in xs).items() if n >= floor}
            longer: dict[str, int] = {}
            for x, n in counts.items():
                inner = x[:-1] if start else x[1:]
                longer[inner] = max(longer.get(inner, 0), n)
            out += [(df["book"].iloc[0], side, x, n) for x, n in counts.items() if x not in longer or longer[x] < 0.8 * n]
        return pd.DataFrame(out, columns=["book", "side", "stretch", "pages"])

    return edges.groupBy("book").applyInPandas(heads, "book string, side string, stretch string, pages long")


def strip_lines(lines: DataFrame, heads: DataFrame) -> DataFrame:
    """book, page, removed and the page's text without the book's recurring lines."""
    marked = lines.withColumn("core", line_core(F.col("line"))).join(heads.select("book", "core", F.lit(True).alias("hit")), ["book", "core"], "left")
    rows = marked.groupBy("book", "page").agg(F.count_if(F.col("hit")).alias("removed"), F.sort_array(F.collect_list(F.when(F.col("hit").isNull(), F.struct("line_no", "line")))).alias("kept"))
    return rows.select("book", "page", "removed", F.array_join(F.transform("kept", lambda x: x["line"]), "\n").alias("text"))


def layout_heads(lines: DataFrame, *, low: int = 3, high: int = 30) -> DataFrame:
    """Texts that stand twice on one page often, or on half of a book's pages."""
    texts = lines.withColumn("core", line_core(F.col("line"))).where(F.length("core").between(low, high))
    per_page = texts.groupBy("book", "core", "page").agg(F.count("*").alias("n"))
    counts = per_page.groupBy("book", "core").agg(F.count_if(F.col("n") >= 2).alias("within_pages"), F.count("*").alias("across_pages"))
    pages = lines.groupBy("book").agg(F.count_distinct("page").alias("book_pages"))
    twice = (F.col("within_pages") >= 3) & (2 * F.col("within_pages") >= F.col("across_pages"))
    wide = (F.col("book_pages") >= 3) & (F.col("across_pages") >= F.greatest(F.lit(3), F.floor(F.col("book_pages") / 2)))
    return counts.join(pages, "book").where(twice | wide).select("book", "core", "within_pages", "across_pages")


def neighbours(pages: DataFrame) -> DataFrame:
    """Each page with the pages before and after it in its book."""
    w = Window.partitionBy("book").orderBy("page")
    return pages.select("book", "page", F.lag("page").over(w).alias("previous_page"), F.lead("page").over(w).alias("next_page"))
