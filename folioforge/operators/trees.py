"""Trees written as nested lists."""

from __future__ import annotations

import re
from collections.abc import Callable
from html.parser import HTMLParser
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ITEM = re.compile(r"^([ \t]*)(?:[-*+]|\d+[.)])[ \t]+(.*\S)")
# Texts whose edges are Python objects at once.
ROWS = 200
EDGES = "array<struct<tree_no:int,parent:string,child:string>>"


class _Lists(HTMLParser):
    """(list, depth, text) of the items of a page's outermost lists."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.items: list[list] = []
        self.depth, self.tree, self.open = 0, -1, []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("ul", "ol"):
            self.depth += 1
            self.tree += self.depth == 1
        elif tag == "li" and self.depth:
            self.handle_endtag("li")
            self.items.append([self.tree, self.depth, ""])
            self.open.append(self.items[-1])

    def handle_endtag(self, tag: str) -> None:
        if tag in ("ul", "ol") and self.depth:
            self.handle_endtag("li")
            self.depth -= 1
        elif tag == "li" and self.open and self.open[-1][1] >= self.depth:
            self.open.pop()

    def handle_data(self, data: str) -> None:
        if self.open:
            self.open[-1][2] += data


def text_items(text: str) -> list[tuple[int, int, str]]:
    """(tree, depth, label) of a text's list lines; any other line that is not blank ends the tree."""
    out, tree, inside = [], -1, False
    for line in text.split("\n"):
        found = ITEM.match(line)
        if found:
            tree += not inside
            inside = True
            out.append((tree, len(found[1].expandtabs(4)), found[2]))
        elif line.strip():
            inside = False
    return out


def html_items(html: str) -> list[tuple[int, int, str]]:
    reader = _Lists()
    reader.feed(html)
    reader.close()
    return [(t, d, x) for t, d, text in reader.items if (x := " ".join(text.split()))]


def item_edges(items: list[tuple[int, int, str]]) -> list[tuple[int, str, str]]:
    """An item's parent is the last earlier one of its tree of lesser depth; one stack, so it is linear."""
    out, stack, own = [], [], None
    for tree, depth, label in items:
        if tree != own:
            stack, own = [], tree
        while stack and stack[-1][0] >= depth:
            stack.pop()
        out.append((tree, stack[-1][1] if stack else "", label))
        stack.append((depth, label))
    return out


def _trees(c: Column, items: Callable[[str], list[tuple[int, int, str]]]) -> Column:
    """Edges of each text: texts stay in the Arrow batch, edges become Arrow arrays after ROWS texts."""

    @F.arrow_udf(EDGES)
    def run(x: pa.Array) -> pa.Array:
        parts = [pa.array([], kind)]
        for k in range(0, len(x), ROWS):
            own = [item_edges(items(t.as_py())) if t.is_valid else [] for t in x[k : k + ROWS]]
            flat = list(zip(*(e for es in own for e in es))) or [(), (), ()]
            edges = pa.StructArray.from_arrays([pa.array(v, t.type) for v, t in zip(flat, kind.value_type)], fields=list(kind.value_type))
            parts.append(pa.ListArray.from_arrays(pa.array([0, *accumulate(map(len, own))], pa.int32()), edges).cast(kind))
        return pa.concat_arrays(parts)

    kind = pa.list_(pa.struct([("tree_no", pa.int32()), ("parent", pa.string()), ("child", pa.string())]))
    return run(c)


def text_trees(c: Column) -> Column:
    """Edges of all list lines of a text; a text without a line whose first word could be an item's sign does not reach Python."""
    may = c.rlike(r"(?m)^[ \t]*(?:[-*+]|[^ \t\n]*[.)])[ \t]")
    return _trees(F.when(may, c), text_items)


def html_trees(c: Column) -> Column:
    """Edges of all ul and ol lists of a page; a page without such a tag does not reach Python."""
    return _trees(F.when(c.rlike("(?i)<[uo]l"), c), html_items)


def list_edges(lines: DataFrame) -> DataFrame:
    """tree_id, parent and child labels: a line's parent is the last earlier line of lesser depth.

    The lines before of every depth are carried along as a map, so no line meets all others.
    """
    items = lines.select("tree_id", "line_no", F.length(F.regexp_extract("line", "^( *)", 1)).alias("depth"), F.regexp_replace("line", r"^ *[-*+] +", "").alias("label"))
    w = Window.partitionBy("tree_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    before = items.withColumn("before", F.collect_list(F.struct("line_no", "depth", "label")).over(w))
    last = F.element_at(F.filter("before", lambda x: x["depth"] < F.col("depth")), -1)
    return before.withColumn("up", F.when(F.size(F.filter("before", lambda x: x["depth"] < F.col("depth"))) > 0, last)).select("tree_id", F.coalesce("up.label", F.lit("")).alias("parent"), F.col("label").alias("child"))


def edge_score(golden: DataFrame, read: DataFrame) -> DataFrame:
    """Edges of each, and how many agree, as multisets."""
    right = golden.intersectAll(read).groupBy("tree_id").agg(F.count("*").alias("agreed"))
    return golden.groupBy("tree_id").agg(F.count("*").alias("golden_edges")).join(read.groupBy("tree_id").agg(F.count("*").alias("read_edges")), "tree_id", "full").join(right, "tree_id", "left").fillna(0)
