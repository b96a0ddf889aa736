"""Edits as rows: conflicts, application in first-proposed order, and replay of the log.

An edit replaces text[start:end] of a page by `after`.  Edits of one page are applied
together; of two that overlap the first proposed (least seq) stands and the other becomes
a doubt.  The log's offsets hold in the text just before the record.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RECORD = ("id", "at", "before", "after", "rule")
LOG = "array<struct<id:long,at:long,before:string,after:string,rule:string>>"
LOG_TYPE = pa.list_(pa.struct([(n, pa.int64() if n in ("id", "at") else pa.string()) for n in RECORD]))
# Pages edited together in Python.
ROWS = 500


def meet(start, end, other_start, other_end):  # type: ignore[no-untyped-def]
    """Whether half-open spans meet, for columns and for numbers.

    Each begins before the other ends; or each begins where the other ends, which only two
    insertions at one place do.  So an insertion meets a span around it, not one beside it.
    """
    return (start < other_end) & (other_start < end) | (start == other_end) & (other_start == end)


def conflicts(edits: DataFrame) -> DataFrame:
    """Pairs of a page's edits that overlap: page, first and second (their seqs)."""
    a, b = edits.alias("a"), edits.alias("b")
    hit = meet(F.col("a.start"), F.col("a.end"), F.col("b.start"), F.col("b.end"))
    return a.join(b, (F.col("a.page") == F.col("b.page")) & (F.col("a.seq") < F.col("b.seq"))).where(hit).select("a.page", F.col("a.seq").alias("first"), F.col("b.seq").alias("second"))


def splice(text: Column, edits: Column) -> Column:
    """Applies disjoint edits, an array of structs (start, end, after): from the right, so offsets stay true."""
    return F.aggregate(
        F.reverse(F.array_sort(edits)), text, lambda t, e: F.concat(F.left(t, e["start"].cast("int")), e["after"], F.substring(t, e["end"].cast("int") + 1, F.length(t)))
    )


def choose(text: str, edits: list[tuple[int, int, str, str]]) -> tuple[list[tuple[int, int, str, str]], int]:
    """The edits that stand, by place, and how many were refused; edits that change nothing are skipped.

    Spans that stand do not meet, so by place only the two beside a new one can meet it.
    """
    places: list[tuple[int, int]] = []
    taken: list[tuple[int, int, str, str]] = []
    refused = 0
    for e in edits:
        if text[e[0] : e[1]] == e[2]:
            continue
        i = bisect_left(places, e[:2])
        if any(meet(*e[:2], *t) for t in places[max(i - 1, 0) : i + 1]):
            refused += 1
        else:
            places.insert(i, e[:2])
            taken.insert(i, e)
    return taken, refused


def apply_to(text: str, edits: list[tuple[int, int, str, str]]) -> tuple[str, int, int, list[tuple[int, int, str, str, str]]]:
    """The text with the edits that stand, how many stand and were refused, and the log: id, at, before, after, rule."""
    taken, refused = choose(text, edits)
    out, log, last, shift = [], [], 0, 0
    for k, (start, end, after, rule) in enumerate(taken):
        out += [text[last:start], after]
        log.append((k, start + shift, text[start:end], after, rule))
        last = end
        shift += len(after) - (end - start)
    return "".join(out) + text[last:], len(taken), refused, log


def replay_text(text: str, records: list[tuple[int, str, str]]) -> tuple[str, bool]:
    """The text after records (at, before, after) one after another, and whether each found what it replaces.

    As long as a record begins behind the one before, the text up to there is not touched
    again; one that reaches back has the text put together first.
    """
    out: list[str] = []
    last, done, ok = 0, 0, True
    for at, before, after in records:
        if at < done:
            text, out, last, done = "".join(out) + text[last:], [], 0, 0
        start = last + at - done
        ok = ok and text[start : start + len(before)] == before
        out += [text[last:start], after]
        done += len(out[-2]) + len(after)
        last = start + len(before)
    return "".join(out) + text[last:], ok


def _lists(column: pa.ListArray, names: list[str]) -> Iterator[list[tuple]]:
    """The rows of an array of structs as lists of tuples."""
    size = pc.list_value_length(column).to_pylist()
    flat = column.flatten()
    rows = zip(*(flat.field(n).to_pylist() for n in names))
    for n in size:
        yield list(islice(rows, n or 0))


def applied(pages: DataFrame, edits: DataFrame) -> DataFrame:
    """page, text, done, applied, refused and log (an array of records) of every page that has edits; a page's edits are one row beside its text."""
    own = edits.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("seq", "start", "end", "after", "rule"))).alias("edits"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, ROWS):
                b = whole.slice(k, ROWS)
                rows = [apply_to(t or "", e) for t, e in zip(b.column("text").to_pylist(), _lists(b.column("edits"), ["start", "end", "after", "rule"]))]
                log = pa.array([[dict(zip(RECORD, r)) for r in x[3]] for x in rows], LOG_TYPE)
                yield pa.record_batch([b.column("page").cast(pa.int64()), b.column("text"), pa.array([x[0] for x in rows], pa.string()), pa.array([x[1] for x in rows], pa.int64()), pa.array([x[2] for x in rows], pa.int64()), log], names=["page", "text", "done", "applied", "refused", "log"])

    return pages.select("page", "text").join(own, "page").mapInArrow(run, f"page long, text string, done string, applied long, refused long, log {LOG}")


def apply_edits(pages: DataFrame, edits: DataFrame) -> DataFrame:
    """page, text, applied and refused of every page that has edits."""
    return applied(pages, edits).select("page", F.col("done").alias("text"), "applied", "refused")


def edit_log(pages: DataFrame, edits: DataFrame) -> DataFrame:
    """The log: a record for each edit that stands, with its offset in the text just before it."""
    return applied(pages, edits).select("page", F.inline("log"))


def replayed(text: Column, records: Column) -> Column:
    """text and ok after a page's records, an array of structs (id, at, before, after) by id."""

    @F.arrow_udf("struct<text:string,ok:boolean>")
    def run(x: pa.Array, y: pa.Array) -> pa.Array:
        done = [replay_text(t.as_py() or "", r) for t, r in zip(x, _lists(y, ["at", "before", "after"]))]
        return pa.StructArray.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.bool_())], ["text", "ok"])

    return run(text, records)


def replay(pages: DataFrame, log: DataFrame) -> DataFrame:
    """page, text and whether every record found what it replaces: records in order."""
    records = log.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("id", "at", "before", "after"))).alias("records"))
    return pages.join(records, "page").withColumn("again", replayed(F.col("text"), F.col("records"))).select("page", "again.text", "again.ok")
