"""Sharding by histogram sort, with DataFrame functions only.

Rows are ordered by (hash of the text, doc_id, row number), so equal texts stand together
and no two rows are alike in the order.  The
order is cut into cells of nearly equal bytes, a fixed number of cells to a shard.  Cut
points come from probing: each round counts, over all partitions, the exact bytes and
rows in equal slices of every interval that still holds an unsettled cut; only those
intervals are probed again, more finely, until a cut is within tolerance of its place.
An interval that is a single hash value (one hot text) is probed on by doc_id, and one
that is a single doc_id of it by the row number.  What
comes to the driver is `probes` numbers for each unsettled cut and no more, however
many rows there are.  After that rows move once, to their cells; a row's slot is the
number of rows in the cells before it in its shard, which the last histogram gives,
plus its rank in its cell.  No cell holds more than its share of bytes, so a text with a
third of all rows is dealt over as many tasks as its bytes call for.

Law `bytes`: shards differ in size from the mean by the tolerance and one row at most.

Defined cases: null text has 0 bytes and stands with the empty text; a null doc_id sorts
as the least; rows that are repeated entirely stand in the order of the written input,
and are cut like others; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._scratch import Scratch, keep

OVERHEAD = 16
LEAST, MOST = -(1 << 63), (1 << 63) - 1


@dataclass(frozen=True)
class Interval:
    """Keys k with low <= k <= high, k the part of the order after the fixed ones (none, a hash, or a hash and a doc_id); what stands before it."""

    low: int
    high: int
    fixed: tuple[int, ...]
    bytes_before: int
    rows_before: int

    def cut(self, at: int, bytes_before: int, rows_before: int) -> "Cut":
        """Before all rows of the interval whose part is `at` or more."""
        if at <= MOST:
            key = (*self.fixed, at)
        elif not self.fixed:
            return Cut(MOST, MOST, MOST, bytes_before, rows_before)
        else:  # beyond the last value of this part: the next one of the part before
            return Interval(0, 0, self.fixed[:-1], 0, 0).cut(self.fixed[-1] + 1, bytes_before, rows_before)
        return Cut(*(*key, LEAST, LEAST)[:3], bytes_before, rows_before)


ALL = Interval(LEAST, MOST, (), 0, 0)
FIRST = 4096


def _prefixed(keyed: DataFrame) -> DataFrame:
    return keyed.withColumn("prefix", (F.shiftright("key", 52) + 2048).cast("int"))


@dataclass(frozen=True)
class Cut:
    """Rows below (hash, doc_id, row) stand before the cut; their exact bytes and number."""

    hash: int
    doc_id: int
    row: int
    bytes_before: int
    rows_before: int


def _histogram(keyed: DataFrame, intervals: list[Interval], slices: int) -> dict[int, list[tuple[int, int, int]]]:
    """For each interval the (slice, bytes, rows) of its non-empty slices, in order."""
    spark = keyed.sparkSession
    wide = [(x.high - x.low) // slices + 1 for x in intervals]
    long = lambda c: c.cast("decimal(20,0)")  # noqa: E731  a difference of two longs may need 65 bits
    if intervals == [ALL]:
        hits = keyed.select(F.lit(0).alias("i"), (F.shiftright("key", 52) + 2048).alias("s"), "size")
    else:  # every interval lies in one of the 4,096 slices of the first round
        rows = [(((x.fixed[0] if x.fixed else x.low) >> 52) + 2048, k, x.low, x.high, *(*x.fixed, None, None)[:2], Decimal(w)) for k, (x, w) in enumerate(zip(intervals, wide))]
        table = F.broadcast(spark.createDataFrame(rows, "prefix int, i int, low long, high long, h long, d long, step decimal(20,0)"))
        value = F.when(F.col("h").isNull(), F.col("key")).when(F.col("d").isNull(), F.col("id")).otherwise(F.col("row"))
        inside = (F.col("h").isNull() | (F.col("h") == F.col("key"))) & (F.col("d").isNull() | (F.col("d") == F.col("id"))) & value.between(F.col("low"), F.col("high"))
        hits = _prefixed(keyed).join(table, "prefix").where(inside).select("i", F.floor((long(value) - long(F.col("low"))) / F.col("step")).cast("long").alias("s"), "size")
    out: dict[int, list[tuple[int, int, int]]] = {}
    for r in hits.groupBy("i", "s").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect():
        out.setdefault(r.i, []).append((r.s, r.b, r.n))
    return {k: sorted(v) for k, v in out.items()}


def cuts_for(keyed: DataFrame, targets: list[int], below: list[tuple[int, int]], tolerance: float, probes: int = 256) -> list[Cut]:
    """Refines probes until every target (bytes before the cut) is met within `tolerance` bytes, or by a single row.

    `below`: the least and greatest doc_id, and those of the row number.
    """
    done: dict[int, Cut] = {}
    open_: dict[Interval, list[int]] = {ALL: list(range(len(targets)))}
    slices = FIRST
    while open_:
        intervals = list(open_)
        found = _histogram(keyed, intervals, slices)
        next_: dict[Interval, list[int]] = {}
        for k, x in enumerate(intervals):
            step = (x.high - x.low) // slices + 1
            for t in open_[x]:
                b, n = x.bytes_before, x.rows_before
                for s, sb, sn in found.get(k, []):
                    low, high = x.low + s * step, min(x.low + (s + 1) * step - 1, x.high)
                    under, over = targets[t] - b, b + sb - targets[t]
                    if under <= tolerance or over > 0:  # the cut falls at this slice's start or in it
                        if under <= tolerance or sn == 1 and under <= over:
                            done[t] = x.cut(low, b, n)
                        elif over <= tolerance or sn == 1:
                            done[t] = x.cut(high + 1, b + sb, n + sn)
                        elif low == high:  # several rows with this part: the next part tells them apart
                            next_.setdefault(Interval(*below[len(x.fixed)], (*x.fixed, low), b, n), []).append(t)
                        else:
                            next_.setdefault(Interval(low, high, x.fixed, b, n), []).append(t)
                        break
                    b, n = b + sb, n + sn
                else:  # after all rows of the interval
                    done[t] = x.cut(x.high + 1, b, n)
        open_, slices = next_, probes
    return [done[t] for t in range(len(targets))]


def histogram_shards(docs: DataFrame, *, shards: int = 40, cells_per_shard: int = 8, tolerance: float = 0.02) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard; `tolerance` is a share of a cell's bytes."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    with Scratch(spark) as scratch:
        keyed = scratch.table(
            docs.select("doc_id", F.monotonically_increasing_id().alias("row"), F.coalesce(F.col("doc_id"), F.lit(LEAST)).cast("long").alias("id"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("key")),
            "keyed",
        )
        total = keyed.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("b"), F.count("*").alias("n"), F.min("id").alias("least"), F.max("id").alias("most"), F.max("row").alias("last")).first()
        cells = shards * cells_per_shard
        each = total.b / cells
        cuts = cuts_for(keyed, [round(each * k) for k in range(1, cells)], [(total.least, total.most), (0, total.last)], each * tolerance) if total.n else []
        cuts = sorted(cuts, key=lambda c: (c.rows_before, c.hash, c.doc_id, c.row))
        starts = [0, *(c.rows_before for c in cuts)]
        placed = _place(keyed, cuts)
        firsts = [starts[k - k % cells_per_shard] for k in range(len(starts))]
        where = F.broadcast(spark.createDataFrame([(k, k // cells_per_shard, s - f) for k, (s, f) in enumerate(zip(starts, firsts))], "cell int, shard int, before long"))
        in_cell = Window.partitionBy("cell").orderBy("key", "id", "row")
        out = placed.join(where, "cell").withColumn("slot", F.col("before") + F.row_number().over(in_cell) - 1)
        return keep(out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")))


def _place(keyed: DataFrame, cuts: list[Cut]) -> DataFrame:
    """Each row's cell: the number of cuts at or below its key, looked up by the key's first twelve bits."""
    spark = keyed.sparkSession
    prefix = lambda h: (h >> 52) + 2048
    rows, at = [], 0
    for p in range(FIRST):
        own = []
        while at + len(own) < len(cuts) and prefix(cuts[at + len(own)].hash) <= p:
            own.append((cuts[at + len(own)].hash, cuts[at + len(own)].doc_id, cuts[at + len(own)].row))
        rows.append((p, at, own))
        at += len(own)
    table = F.broadcast(spark.createDataFrame(rows, "prefix int, base int, cuts array<struct<h:long,d:long,r:long>>"))

    def passed(c: Column) -> Column:
        return (c["h"] < F.col("key")) | ((c["h"] == F.col("key")) & ((c["d"] < F.col("id")) | ((c["d"] == F.col("id")) & (c["r"] <= F.col("row")))))

    return (
        _prefixed(keyed)
        .join(table, "prefix")
        .select("doc_id", "id", "row", "size", "text_crc32", "key", (F.col("base") + F.size(F.filter("cuts", passed))).cast("int").alias("cell"))
    )
