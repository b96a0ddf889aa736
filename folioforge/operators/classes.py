"""Equivalence classes of nodes that pairs join, and texts that groups share."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import _written


def classes(pairs: DataFrame) -> DataFrame:
    """node and class (its least member) of all nodes of pairs (a, b).

    Each round takes the least label among neighbours and then the label's own label, so
    the way to the least node halves and a chain of n nodes needs about log n rounds.
    """
    both = pairs.select("a", "b").union(pairs.select("b", "a")).where("a IS NOT NULL AND b IS NOT NULL").toDF("node", "other").distinct()
    both = _written(both)
    found = _written(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("class")))
    while True:
        near = both.join(found.select(F.col("node").alias("other"), F.col("class").alias("seen")), "other").groupBy("node").agg(F.min("seen").alias("seen"))
        # the label of a node moves to the least label around it, and so does the label of its label
        least = found.join(near, "node").select("node", "class", F.least("class", "seen").alias("new"))
        hooks = least.groupBy(F.col("class").alias("node")).agg(F.min("new").alias("hook"))
        hooked = least.join(hooks, "node", "left").select("node", "class", F.least("new", F.coalesce("hook", "new")).alias("new"))
        up = hooked.select(F.col("node").alias("new"), F.col("new").alias("up"))
        step = _written(hooked.join(up, "new", "left").select("node", F.least("new", F.coalesce("up", "new")).alias("class"), F.col("class").alias("was")))
        found = step.select("node", "class")
        if step.where("class <> was").isEmpty():
            return found


def frequent_cores(texts: list[str], low: int, high: int, least: float) -> dict[str, int]:
    """Stretches of low to high characters in at least `least` of the texts, with their numbers of texts.

    Level by level: a stretch can only be in so many texts if both stretches that are one
    character shorter are.
    """
    found: dict[str, int] = {}
    starts = [range(len(t) - low + 1) for t in texts]
    for size in range(low, high + 1):
        counts = Counter(x for t, own in zip(texts, starts) for x in {t[i : i + size] for i in own})
        kept = {x: n for x, n in counts.items() if n >= least}
        if not kept:
            break
        found |= kept
        left = []
        for t, own in zip(texts, starts):
            good = [i for i in own if t[i : i + size] in kept]
            left.append([i for i, j in zip(good, good[1:]) if j == i + 1])
        starts = left
    return found


def shared_cores(texts: DataFrame, group: str, text: str, *, low: int = 2, high: int = 24, share: float = 0.5, least: int = 3, keep: float = 0.9) -> DataFrame:
    """group, core and texts: the stretch that a group's texts have in common.

    Of the stretches in most texts the longest one is taken, and then, one character at a
    time, the commonest longer one that holds it and has 0.9 of its texts or more.  Ties go
    to the least text.

    Not every stretch is counted over all texts.  Each batch names its stretches in half of
    `share` of its texts, exactly counted; what a batch does not name is in fewer there, so
    sums and sizes of the batches bound a stretch's number of texts.  A stretch that may
    reach the floor and was not named by all batches is counted again in all texts.  Such
    stretches are at most a text's stretches times 2 / share, however many texts there are
    and in whatever order.
    """
    kind = dict(texts.dtypes)[group]
    rows = texts.select(F.col(group).alias("group"), F.col(text).alias("text")).where("text IS NOT NULL")
    floors = rows.groupBy("group").agg(F.count("*").alias("n")).withColumn("floor", F.greatest(F.lit(least), F.ceil(F.col("n") * share)).cast("bigint"))

    def name(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            for key, own in df.groupby("group")["text"]:
                if found := frequent_cores(own.tolist(), low, high, len(own) * share / 2):
                    yield pd.DataFrame({"group": [key] * len(found), "core": list(found), "texts": list(found.values()), "seen": len(own)})

    named = rows.mapInPandas(name, f"group {kind}, core string, texts long, seen long").groupBy("group", "core").agg(F.sum("texts").alias("texts"), F.sum("seen").alias("seen"))
    named = _written(named.join(floors, "group").where(F.col("texts") + (F.col("n") - F.col("seen")) * (share / 2) >= F.col("floor")))
    unsure = named.where("seen < n").groupBy("group").agg(F.collect_list("core").alias("cores"))
    again = rows.join(unsure, "group").select("group", F.explode(F.filter("cores", lambda x: F.contains("text", x))).alias("core")).groupBy("group", "core").agg(F.count("*").alias("texts"))
    shared = named.where("seen = n").select("group", "core", "texts").unionByName(again).join(floors.select("group", "floor"), "group").where("texts >= floor").select("group", "core", "texts")

    def grow(df: pd.DataFrame) -> pd.DataFrame:
        by_size: dict[int, list[tuple[int, str]]] = {}
        for core, n in zip(df["core"], df["texts"]):
            by_size.setdefault(len(core), []).append((-int(n), core))
        top = df["texts"].max()
        best = min(df.loc[df["texts"] == top, "core"], key=lambda x: (-len(x), x))
        n = top
        while longer := sorted(x for x in by_size.get(len(best) + 1, []) if best in x[1] and -x[0] >= keep * n):
            n, best = -longer[0][0], longer[0][1]
        return pd.DataFrame({"group": [df["group"].iloc[0]], "core": [best], "texts": [n]})

    return shared.groupBy("group").applyInPandas(grow, f"group {kind}, core string, texts long").withColumnRenamed("group", group)


def render_markdown(cells: DataFrame) -> DataFrame:
    """table_id and the table as Markdown: the first row is its head; pipes are escaped, line breaks become spaces."""
    clean = F.replace(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\r\n]+", " "), F.lit("|"), F.lit(r"\|"))
    rows = cells.select("table_id", "row", "col", clean.alias("text")).groupBy("table_id", "row").agg(F.array_sort(F.collect_list(F.struct("col", "text"))).alias("c"))
    line = lambda c: F.concat(F.lit("| "), F.array_join(c, " | "), F.lit(" |"))
    rows = rows.select("table_id", "row", F.size("c").alias("width"), line(F.transform("c", lambda x: x["text"])).alias("line"))
    whole = rows.groupBy("table_id").agg(F.array_sort(F.collect_list(F.struct("row", "line", "width"))).alias("r"))
    rule = line(F.array_repeat(F.lit("---"), F.col("r")[0]["width"]))
    lines = F.transform("r", lambda x: x["line"])
    return whole.select("table_id", F.array_join(F.concat(F.slice(lines, 1, 1), F.array(rule), F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0)))), "\n").alias("text"))
