"""Tables as rows of cells: parsing, turning, comparing, stitching over pages."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import cell_class, squash

CELL = "table_id long, row int, col int, rowspan int, colspan int, header boolean, text string"


class _Reader(HTMLParser):
    """Rows of (text, rowspan, colspan, header) of the tables of one page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[list[list[list]]] = []
        self.cell: list | None = None
        self.depth = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "table":
            self.depth += 1
            if self.depth == 1:
                self.tables.append([])
        elif self.depth == 1 and tag == "tr":
            self.cell = None
            self.tables[-1].append([])
        elif self.depth == 1 and tag in ("td", "th"):
            if not self.tables[-1]:
                self.tables[-1].append([])
            own = dict(attrs)
            span = [int(v) if (v := own.get(k) or "1").isdigit() and 0 < int(v) < 1000 else 1 for k in ("rowspan", "colspan")]
            self.cell = ["", *span, tag == "th"]
            self.tables[-1][-1].append(self.cell)
        elif tag == "br" and self.cell is not None:
            self.cell[0] += " "

    def handle_endtag(self, tag: str) -> None:
        if tag == "table" and self.depth:
            self.depth -= 1
        if tag in ("td", "th", "tr", "table"):
            self.cell = None

    def handle_data(self, data: str) -> None:
        if self.cell is not None:
            self.cell[0] += data


def place(rows: list[list[list]]) -> list[tuple[int, int, int, int, bool, str]]:
    """Anchors of the cells on the grid: a cell takes the first free place of its row, spans end with the table."""
    taken: set[tuple[int, int]] = set()
    out = []
    for r, row in enumerate(rows):
        c = 0
        for text, down, across, header in row:
            while (r, c) in taken:
                c += 1
            down = min(down, len(rows) - r)
            taken.update((r + i, c + j) for i in range(down) for j in range(across))
            out.append((r, c, down, across, header, " ".join(text.split())))
            c += across
    return out


def parse_html(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Cells of every table of every page: key, table number and the cell."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["key", "table_no", "row", "col", "rowspan", "colspan", "header", "text"]
        for b in batches:
            out = []
            for k, text in zip(b["key"], b["html"]):
                reader = _Reader()
                reader.feed(text or "")
                reader.close()
                out += [(k, t, *cell) for t, rows in enumerate(reader.tables) for cell in place(rows)]
            yield pd.DataFrame(out, columns=names)

    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(html).alias("html")).where(F.contains(F.lower("html"), F.lit("<table")))
    return rows.mapInPandas(run, "key long, table_no long, row long, col long, rowspan long, colspan long, header boolean, text string")


RULE = r"^[ \t]*\|?[ \t]*:?-+:?[ \t]*(\|[ \t]*:?-+:?[ \t]*)*\|?[ \t]*$"


def _pipe_cells(line: str) -> Column:
    body = F.regexp_replace(F.regexp_replace(F.trim(line), r"^\|", ""), r"(?<!\\)\|$", "")
    return F.transform(F.split(body, r"(?<!\\)\|"), lambda x: F.replace(F.trim(x), F.lit("\\|"), F.lit("|")))


def parse_pipes(lines: DataFrame) -> DataFrame:
    """Cells of Markdown table rows: page, line_no, col and text; an escaped pipe belongs to its cell."""
    rows = lines.where(F.col("line").rlike(r"^[ \t]*\|") | F.col("line").rlike(r" \| "))
    return rows.select("page", "line_no", F.posexplode(_pipe_cells("line")).alias("col", "text"))


def pipe_tables(lines: DataFrame) -> DataFrame:
    """page, table_no, row, col and text: a table is a block of table rows without a line between; rules are no rows of it."""
    rows = lines.where(F.col("line").rlike(r"^[ \t]*\|") | F.col("line").rlike(r" \| "))
    own = Window.partitionBy("page")
    rows = rows.withColumn("block", F.col("line_no") - F.row_number().over(own.orderBy("line_no")))
    rows = rows.withColumn("table_no", F.dense_rank().over(own.orderBy("block")) - 1).where(~F.col("line").rlike(RULE))
    rows = rows.withColumn("row", F.row_number().over(Window.partitionBy("page", "table_no").orderBy("line_no")) - 1)
    return rows.select("page", "table_no", "row", F.posexplode(_pipe_cells("line")).alias("col", "text"))


def uneven_rows(cells: DataFrame) -> DataFrame:
    """Rows (table_id, row, cells, head) with more or fewer cells than the first row of their table."""
    widths = cells.groupBy("table_id", "row").agg(F.count("*").alias("cells"))
    head = widths.where("row = 0").select("table_id", F.col("cells").alias("head"))
    return widths.join(head, "table_id").where("cells <> head").select("table_id", "row", "cells", "head")


def transpose(cells: DataFrame) -> DataFrame:
    return cells.select("table_id", F.col("col").alias("row"), F.col("row").alias("col"), "text")


def rotate(cells: DataFrame) -> DataFrame:
    """A quarter turn counter-clockwise: the last column becomes the first row."""
    width = cells.groupBy("table_id").agg((F.max("col")).alias("w"))
    return cells.join(width, "table_id").select("table_id", (F.col("w") - F.col("col")).alias("row"), F.col("row").alias("col"), "text")


def simplify(cells: DataFrame) -> DataFrame:
    """Rows and columns numbered without gaps."""
    r = F.dense_rank().over(Window.partitionBy("table_id").orderBy("row")) - 1
    c = F.dense_rank().over(Window.partitionBy("table_id").orderBy("col")) - 1
    return cells.select("table_id", r.cast("int").alias("row"), c.cast("int").alias("col"), "text")


def compare(golden: DataFrame, read: DataFrame) -> DataFrame:
    """table_id, cells, exact, and the character error rate of the texts in row order."""
    key = ["table_id", "row", "col"]
    g, r = golden.select(*key, squash(F.col("text")).alias("g")), read.select(*key, squash(F.col("text")).alias("r"))
    both = g.join(r, key, "full")
    flat = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col(c).isNotNull(), F.struct("row", "col", c)))), lambda x: x[c]), "")
    out = both.groupBy("table_id").agg(F.count("g").alias("cells"), F.count_if(F.col("g") == F.col("r")).alias("exact"), flat("g").alias("gt"), flat("r").alias("rt"))
    return out.select("table_id", "cells", "exact", F.round(F.levenshtein("gt", "rt") / F.greatest(F.length("gt"), F.lit(1)), 6).alias("cer"))


def best_scores(golden: DataFrame, read: DataFrame, *key: str) -> DataFrame:
    """Of every golden table the score of the read table of its key that comes nearest, as written or transposed.

    A turn is taken only if neither its exact cells nor its error rate is worse and one is
    better. Rows: key, table_no, cells, exact, cer, orientation (null if nothing was read), passes.
    """
    cell = F.struct(F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), squash(F.col("text")).alias("text"))
    whole = lambda t: t.groupBy(*key, "table_no").agg(F.array_sort(F.collect_list(cell)).alias("c"))
    turned = F.array_sort(F.transform("r", lambda x: F.struct(x["col"].alias("row"), x["row"].alias("col"), x["text"].alias("text"))))
    text = lambda c: F.array_join(F.transform(c, lambda x: x["text"]), "")
    score = lambda c: F.struct(F.size(F.array_intersect("g", c)).alias("exact"), (F.levenshtein(text(F.col("g")), text(c)) / F.greatest(F.length(text(F.col("g"))), F.lit(1))).alias("cer"), (F.col("g") == c).alias("passes"))
    both = whole(golden).withColumnRenamed("c", "g").join(whole(read).select(*key, F.col("table_no").alias("read_no"), F.col("c").alias("r")), list(key), "left")
    both = both.withColumn("t", turned).withColumn("w", score(F.col("r"))).withColumn("u", score(F.col("t")))
    better = (F.col("u.exact") >= F.col("w.exact")) & (F.col("u.cer") <= F.col("w.cer")) & ((F.col("u.exact") > F.col("w.exact")) | (F.col("u.cer") < F.col("w.cer")))
    fit = F.when(better, F.struct("u.*", F.lit("transposed").alias("orientation"))).otherwise(F.struct("w.*", F.lit("as written").alias("orientation")))
    best = both.withColumn("f", F.when(F.col("r").isNotNull(), fit)).groupBy(*key, "table_no").agg(F.any_value(F.size("g")).alias("cells"), F.min_by("f", F.struct("f.cer", -F.col("f.exact"), "read_no")).alias("f"))
    return best.select(*key, "table_no", "cells", F.coalesce("f.exact", F.lit(0)).alias("exact"), F.round(F.coalesce("f.cer", F.lit(1.0)), 6).alias("cer"), "f.orientation", F.coalesce("f.passes", F.lit(False)).alias("passes"))


def label_rows(cells: DataFrame) -> DataFrame:
    """Tables whose first row is a row of labels: no figure in it, two texts or more, and over
    some text stands a column with as many figures as texts."""
    c = cells.withColumn("class", cell_class(F.col("text")))
    below = c.where("row > 0").groupBy("table_id", "col").agg(F.count_if(F.col("class") == "figure").alias("figures"), F.count_if(F.col("class") == "text").alias("texts"))
    first = c.where("row = 0").join(below, ["table_id", "col"], "left")
    shows = (F.col("class") == "text") & (F.col("figures") > 0) & (F.col("figures") >= F.col("texts"))
    own = first.groupBy("table_id").agg(F.count_if(F.col("class").isin("figure", "numeral")).alias("f"), F.count_if(F.col("class") == "text").alias("t"), F.count_if(shows).alias("s"))
    return own.select("table_id", ((F.col("f") == 0) & (F.col("t") >= 2) & (F.col("s") > 0)).alias("label_row"))


def decide_stitch(title: Column, same_header: Column, label: Column, head_label: Column, width: Column, head_width: Column) -> Column:
    """What the table on the next page is to the one before."""
    return (
        F.when(title, "separate").when(same_header, "merge-drop-header").when(label & head_label, "separate").when(label, "undecided").when(width == head_width, "merge").otherwise("undecided")
    )
