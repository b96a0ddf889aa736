"""Votes, preferences and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import wilson_lower


def pair_votes(items: DataFrame, a: str, b: str, verdict: str) -> DataFrame:
    """One vote for each unordered pair: the majority inside it, none where it is tied."""
    key = [F.least(a, b).alias("low"), F.greatest(a, b).alias("high")]
    tally = items.where(F.col(verdict).isin("A", "B")).groupBy(*key).agg(F.count_if(F.col(verdict) == "A").alias("for_a"), F.count_if(F.col(verdict) == "B").alias("for_b"))
    return tally.withColumn("vote", F.when(F.col("for_a") > F.col("for_b"), "A").when(F.col("for_b") > F.col("for_a"), "B"))


def preference(votes_a: Column, votes_b: Column, *, least: int = 16, z: float = 1.96) -> Column:
    """A, B or adjudicate: the leader if its Wilson bound is over one half."""
    n = votes_a + votes_b
    lead = F.greatest(votes_a, votes_b)
    bound = F.round(wilson_lower(lead.cast("double"), n.cast("double"), z), 9)
    return F.when(n < least, "adjudicate").when(bound <= 0.5, "adjudicate").when(votes_a >= votes_b, "A").otherwise("B")


def ballot(for_a: Column, for_b: Column, answered: Column) -> Column:
    """A, B or none: a lead of two votes or more that is a majority of all answers."""
    lead = F.greatest(for_a, for_b)
    clear = (answered > 0) & (for_a != for_b) & (lead >= 2) & (2 * lead > answered)
    return F.when(~clear, "none").when(for_a > for_b, "A").otherwise("B")


def hash_order(seed: str, key: Column) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256)


def hash_sample(rows: DataFrame, key: str, *, seed: str, share: float) -> DataFrame:
    """max(1, round half even of share * n) rows with the least hashes: the same on any cluster.

    This is a sampling operator; its limit is its meaning.
    """
    n = rows.count()
    if share <= 0 or not n:
        return rows.limit(0)
    return rows.withColumn("order_hash", hash_order(seed, F.col(key))).orderBy("order_hash", key).limit(max(1, round(share * n)))


def strata_tops(rows: DataFrame, group: str, order: str, weight: str, strata: int) -> DataFrame:
    """The heaviest row of each of `strata` equal runs of a group's rows in order."""
    w = Window.partitionBy(group)
    ranked = rows.withColumn("i", F.row_number().over(w.orderBy(order)) - 1).withColumn("n", F.count("*").over(w))
    k = F.least(F.lit(strata).cast("bigint"), F.col("n"))
    # run s holds the rows [s * n // k, (s + 1) * n // k)
    placed = ranked.withColumn("stratum", F.floor(((F.col("i") + 1) * k - 1) / F.col("n")).cast("bigint"))
    return placed.groupBy(group, "stratum").agg(F.max_by(order, F.struct(weight, (-F.col(order)).alias("o"))).alias(order))


def round_robin(rows: DataFrame, group: str, order: str) -> DataFrame:
    """First rows of all groups, then the second ones, and so on: the round each row is in."""
    return rows.withColumn("round", F.row_number().over(Window.partitionBy(group).orderBy(order)).cast("bigint"))
