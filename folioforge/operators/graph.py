"""Artifacts that depend on each other: closure, cycles, staleness, order, coverage."""

from __future__ import annotations

import heapq
import tempfile
from itertools import count

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _written(df: DataFrame) -> DataFrame:
    """The rows without their plan, kept in the shared folder: plans of many rounds would grow with every round."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(context.getConf().get("spark.checkpoint.dir") or f"file://{tempfile.mkdtemp(prefix='checkpoints-')}")
    return df.checkpoint()


def closure(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """node and least depth of everything reachable along edges (src, dst) from the roots.

    Semi-naive rounds: only nodes reached for the first time go on, so a cycle ends.
    """
    found = roots.select("node").distinct().withColumn("depth", F.lit(0))
    front = found
    for depth in count(1):
        step = front.join(edges, front["node"] == edges["src"]).select(F.col("dst").alias("node")).distinct().join(found.select("node"), "node", "left_anti")
        front = _written(step.withColumn("depth", F.lit(depth)))
        if front.isEmpty():
            break
        found = found.unionByName(front)
    return found


def cycle_nodes(edges: DataFrame) -> DataFrame:
    """Nodes that can reach themselves.

    Nodes without a way in or out are peeled off first; what is left holds every cycle.
    """
    left = edges.select("src", "dst").distinct()
    n = left.count()
    while n:
        left = left.join(left.select(F.col("dst").alias("src")).distinct(), "src", "left_semi").join(left.select(F.col("src").alias("dst")).distinct(), "dst", "left_semi").select("src", "dst")
        left = _written(left)
        m = left.count()
        if m == n:
            break
        n = m
    walk = left.select(F.col("src").alias("start"), F.col("dst").alias("node"))
    hit = walk.where("start = node").select(F.col("start").alias("node"))
    front = walk
    while n:
        front = front.join(left, front["node"] == left["src"]).select("start", F.col("dst").alias("node")).distinct().join(walk, ["start", "node"], "left_anti")
        front = _written(front)
        if front.isEmpty():
            break
        walk = walk.unionByName(front)
        hit = hit.unionByName(front.where("start = node").select(F.col("start").alias("node")))
    return hit.distinct()


def stale_causes(edges: DataFrame, stale: DataFrame) -> DataFrame:
    """node and cause: a directly stale node is its own cause and only that; others inherit.

    edges: src depends on dst.  Causes pass from dst to src and stop at directly stale nodes.
    """
    direct = stale.select("node").distinct()
    found = direct.withColumn("cause", F.col("node"))
    front = found
    up = edges.join(direct.withColumnRenamed("node", "src"), "src", "left_anti")
    while True:
        front = front.join(up, front["node"] == up["dst"]).select(F.col("src").alias("node"), "cause").distinct().join(found, ["node", "cause"], "left_anti")
        front = _written(front)
        if front.isEmpty():
            break
        found = found.unionByName(front)
    return found


def order_first(edges: list[tuple[str, str]], nodes: list[str]) -> list[str]:
    """Dependencies first, ties by name: a plan's nodes, which are few, on the driver; ValueError for a cycle."""
    need = {n: set() for n in nodes}
    users: dict[str, set[str]] = {n: set() for n in nodes}
    for a, b in edges:
        if a in need and b in need:
            need[a].add(b)
            users[b].add(a)
    ready = [n for n in nodes if not need[n]]
    heapq.heapify(ready)
    out = []
    while ready:
        n = heapq.heappop(ready)
        out.append(n)
        for u in users[n]:
            need[u].discard(n)
            if not need[u]:
                heapq.heappush(ready, u)
    if left := sorted(set(nodes) - set(out)):
        raise ValueError(f"no order: {', '.join(left)} are on a cycle or depend on one")
    return out


def scope_problems(parts: DataFrame) -> DataFrame:
    """Parts (scope, part, first, last) that leave a gap or overlap the part before, or start after 1."""
    w = Window.partitionBy("scope").orderBy("first", "last", "part")
    before = F.coalesce(F.lag("last").over(w), F.lit(0))
    return parts.withColumn("before", before).where(F.col("first") != F.col("before") + 1).select("scope", "part", "first", "last", F.when(F.col("first") > F.col("before") + 1, "gap").otherwise("overlap").alias("problem"))
