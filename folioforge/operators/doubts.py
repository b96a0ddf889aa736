"""Doubts of several sources as one list, and facts of a book beside its pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def doubt_list(pages: DataFrame, sources: list[DataFrame]) -> DataFrame:
    """book, id, kind, first, last and pages: what several sources doubt, runs of pages folded.

    `sources` hold page and kind, several times if they like.  A run is made of pages that
    follow each other in their book, so windows are no larger than a book.  Ids count within
    a book by first page and kind.
    """
    place = pages.select("book", "page", F.row_number().over(Window.partitionBy("book").orderBy("page")).alias("at"))
    every = sources[0].select("page", "kind")
    for s in sources[1:]:
        every = every.unionByName(s.select("page", "kind"))
    placed = every.distinct().join(place, "page")
    island = F.col("at") - F.row_number().over(Window.partitionBy("book", "kind").orderBy("at"))
    runs = placed.withColumn("island", island).groupBy("book", "kind", "island").agg(F.min("page").alias("first"), F.max("page").alias("last"), F.count("*").alias("pages"))
    number = F.row_number().over(Window.partitionBy("book").orderBy("first", "kind"))
    return runs.select("book", F.concat(F.lit("Q"), F.lpad(number.cast("string"), 4, "0")).alias("id"), "kind", "first", "last", "pages")


def commonest(rows: DataFrame, group: str, value: str, least: int) -> DataFrame:
    """The value that most rows of a group have, the smaller of equals, if `least` rows have it; else null."""
    counts = rows.groupBy(group, value).agg(F.count("*").alias("rows"))
    best = counts.groupBy(group).agg(F.max(F.struct("rows", (-F.col(value)).alias("v"))).alias("best"))
    return best.select(group, F.when(F.col("best.rows") >= least, -F.col("best.v")).alias(value), F.col("best.rows").alias("rows"))


def safe_path(path: Column) -> Column:
    """Whether a path stays where it is put: relative, no step up, no drive, back slash or control character."""
    return (F.length(path) > 0) & ~path.rlike(r"^[/~]|[\\:\x00-\x1f]|(^|/)\.\.(/|$)")


def one_sided(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys that only one side has, and which; two sets are equal if there are none."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("side", F.lit("left")).unionByName(b.join(a, key, "left_anti").withColumn("side", F.lit("right")))


def continuity(rows: DataFrame, group: str, figure: str) -> DataFrame:
    """Figures of a group, and how many of them are not one more than the one before (the first: not one)."""
    before = F.lag(figure, 1, 0).over(Window.partitionBy(group).orderBy(figure))
    marked = rows.select(group, (F.col(figure) - before != 1).alias("breaks"))
    return marked.groupBy(group).agg(F.count("*").alias("figures"), F.count_if("breaks").alias("breaks"))
