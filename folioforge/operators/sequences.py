"""Runs, jumps and support in sequences of numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def contiguous_runs(rows: DataFrame, group: str, number: str) -> DataFrame:
    """first, last and size of the runs of consecutive numbers."""
    distinct = rows.select(group, F.col(number).cast("bigint").alias("v")).distinct()
    island = F.col("v") - F.row_number().over(Window.partitionBy(group).orderBy("v"))
    return distinct.withColumn("island", island).groupBy(group, "island").agg(F.min("v").alias("first"), F.max("v").alias("last"), F.count("*").alias("size")).drop("island")


def equal_runs(rows: DataFrame, group: str, order: str, value: str, *, least: int = 3) -> DataFrame:
    """first, last, value and size of runs of equal values over the observed order; short runs
    are left out, and runs that then meet with one value merge."""
    w = Window.partitionBy(group).orderBy(order)
    a = rows.withColumn("i", F.row_number().over(w))
    a = a.withColumn("island", F.col("i") - F.row_number().over(Window.partitionBy(group, value).orderBy(order)))
    runs = a.groupBy(group, value, "island").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("size")).where(F.col("size") >= least)
    v = Window.partitionBy(group).orderBy("first")
    runs = runs.withColumn("new", (F.lag(value).over(v).isNull() | (F.lag(value).over(v) != F.col(value))).cast("int"))
    runs = runs.withColumn("run", F.sum("new").over(v.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(group, "run", value).agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("size").alias("size")).drop("run")


def jumps(rows: DataFrame, group: str, number: str) -> DataFrame:
    """Where a number is not followed by the next one: number, following and the missing count."""
    w = Window.partitionBy(group).orderBy("v")
    s = rows.select(group, F.col(number).cast("bigint").alias("v")).distinct().withColumn("following", F.lead("v").over(w))
    return s.where("following - v <> 1").select(group, "v", "following", (F.col("following") - F.col("v") - 1).alias("missing"))


def supported(rows: DataFrame, group: str, page: str, value: str, *, reach: int = 10, least: int = 2, slopes: tuple[int, ...] = (1, 2)) -> DataFrame:
    """Rows whose offset (slope * page - value) at least `least` other pages within `reach` share, by slope."""
    out = []
    for slope in slopes:
        a = rows.select(group, F.col(page).cast("bigint").alias("page"), F.col(value).cast("bigint").alias("value")).withColumn("slope", F.lit(slope)).withColumn("shift", slope * F.col("page") - F.col("value"))
        w = Window.partitionBy(group, "shift").orderBy("page").rangeBetween(-reach, reach)
        out.append(a.withColumn("supporters", F.count("*").over(w) - 1).where(F.col("supporters") >= least))
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    return result


def missing_members(present: DataFrame, group: str, number: str) -> DataFrame:
    """Numbers from a group's least to its greatest that no row has."""
    span = present.groupBy(group).agg(F.min(number).alias("low"), F.max(number).alias("high"))
    expected = span.select(group, F.explode(F.sequence("low", "high")).alias(number))
    return expected.join(present.select(group, number).distinct(), [group, number], "left_anti")


def offsets(rows: DataFrame, group: str, page: str, value: str) -> DataFrame:
    """How many pages have each offset (page - value)."""
    shift: Column = F.col(page) - F.col(value)
    return rows.where(F.col(value).isNotNull()).groupBy(group, shift.cast("bigint").alias("shift")).agg(F.count_distinct(page).alias("pages"), F.min(page).alias("first"), F.max(page).alias("last"))


def fit_offsets(counts: DataFrame, *, least: int = 3, inside: float = 0.2) -> DataFrame:
    """The accepted of a group's counted offsets: group, shift, pages, first, last.

    By falling count (ties: the least shift) an offset is taken unless a fifth of its range
    lies in the range of one taken before.  A group's offsets are one row, folded in place;
    a book has no more of them than pages.
    """
    group = counts.columns[0]
    at = F.struct((-F.col("pages")).alias("order"), "shift", F.col("first").cast("bigint").alias("first"), F.col("last").cast("bigint").alias("last"))
    rows = counts.where(F.col("pages") >= least).groupBy(group).agg(F.array_sort(F.collect_list(at)).alias("offsets"))
    kind = "array<struct<order:bigint,shift:bigint,first:bigint,last:bigint>>"

    def take(acc: Column, x: Column) -> Column:
        shared = F.array_max(F.transform(acc, lambda y: F.greatest(F.least(x["last"], y["last"]) - F.greatest(x["first"], y["first"]) + 1, F.lit(0))))
        return F.when(F.coalesce(shared, F.lit(0)) / (x["last"] - x["first"] + 1) < inside, F.concat(acc, F.array(x))).otherwise(acc)

    taken = F.aggregate(F.col("offsets").cast(kind), F.array().cast(kind), take)
    return rows.select(group, F.inline(taken)).select(group, "shift", (-F.col("order")).alias("pages"), "first", "last")
