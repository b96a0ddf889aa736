"""Packing: shortest-pack-first over the length histogram.

A document's token ids (with the end id 0) are cut into pieces of at most `length`.
The histogram of piece lengths has `length` entries whatever the input's size, so the
packing is solved on it alone: lengths are placed longest first, each piece into the
shortest open pack, which is the one with the most room, whole batches of equal packs at a
time; where even that has too little room, new packs are opened.  Patterns with their counts
then go back to the pieces by rank: the r-th piece of a length takes the r-th place that
the patterns have for that length.  Ranks are exact and need no task to see all pieces
of a length: every task numbers its own, and the offsets of the tasks are prefix sums.

Tokenising a text costs most, and words repeat; a segment (white space, then what follows
up to the next white space) is encoded once for each worker and then looked up by its hash;
its bytes are compared with those that were encoded, and a batch in which any differ is
encoded text by text.  The pre-tokeniser splits before every such white space, so the ids
are those of the whole text.  Strings of special tokens in a text get those tokens' ids,
as `Tokenizer.encode` does, or with `ordinary` are text like any other.

Defined cases: null or empty text is the end id alone; a text longer than a sequence is
cut freely; repeated rows are packed each; an empty table gives no rows; other columns
are left out; null doc_id stays null.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._scratch import Scratch, keep
from ._words import SPACE, U64, buffer_of, same_spans, slices, span_hashes

LENGTH = 1024
CACHED = 1_500_000


class SegmentCache:
    """Ids of segments already encoded, in sorted order of the segments' hashes; dropped when full."""

    def __init__(self, path: str, ordinary: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = ordinary
        # Such a token would reach over a segment's end.
        self.whole = any(t.lstrip or t.rstrip or t.single_word or any(c.isspace() for c in t.content) for t in self.tokenizer.get_added_tokens_decoder().values())
        self.clear()

    def plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def clear(self) -> None:
        self.raw, self.from_ = np.zeros(0, np.uint8), np.zeros(0, np.int64)
        self.keys, self.at, self.n = np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def add(self, keys: np.ndarray, pieces: list[bytes]) -> None:
        got = self.plain([x.decode("utf-8", "replace") for x in pieces])
        n = np.array([len(x) for x in got], np.int64)
        at = len(self.ids) + np.cumsum(n) - n
        self.ids = np.concatenate([self.ids, np.fromiter((i for x in got for i in x), np.int32, int(n.sum()))])
        size = np.array([len(x) for x in pieces], np.int64)
        from_ = len(self.raw) + np.cumsum(size) - size
        self.raw = np.concatenate([self.raw, np.frombuffer(b"".join(pieces), np.uint8)])
        every = [np.concatenate(x) for x in ((self.keys, keys), (self.at, at), (self.n, n), (self.from_, from_))]
        order = np.argsort(every[0])
        self.keys, self.at, self.n, self.from_ = (x[order] for x in every)


_CACHES: dict[tuple[str, bool], SegmentCache] = {}


def segments(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of segments and where each row's begin.

    A segment starts at a row's start and at every ASCII white space after something that
    is surely none: the non-ASCII white spaces (U+0085, U+00A0, U+1680, U+2000 to U+200A,
    U+2028, U+2029, U+202F, U+205F, U+3000) end in bytes that are looked at with the lead.
    """
    n = len(data)
    space = SPACE[data]
    first = np.zeros(n, bool)
    if n > 1:
        cut = space[1:] & ~space[:-1]
        # \x1c-\x1f count as white space in Unicode
        cut &= ~((data[:-1] >= 0x1C) & (data[:-1] <= 0x1F))
        two = np.zeros(n - 1, bool)
        two[1:] = (data[:-2] == 0xC2) & ((data[1:-1] == 0x85) | (data[1:-1] == 0xA0))
        three = np.zeros(n - 1, bool)
        three[2:] = ((data[:-3] == 0xE1) | (data[:-3] == 0xE2) | (data[:-3] == 0xE3)) & (data[1:-2] <= 0x9A)
        first[1:] = cut & ~two & ~three
    first[off[:-1][off[:-1] < off[1:]]] = True
    starts = np.flatnonzero(first)
    return starts, np.searchsorted(starts, off)


def _one_by_one(cache: SegmentCache, data: np.ndarray, off: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    raw = data.tobytes()
    ids = [[*x, end_id] for x in cache.plain([raw[s:e].decode("utf-8", "replace") for s, e in zip(off[:-1].tolist(), off[1:].tolist())])]
    return np.array([i for x in ids for i in x], np.int32), np.cumsum([0, *(len(x) for x in ids)])


def encode(data: np.ndarray, off: np.ndarray, path: str, end_id: int = 0, ordinary: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """All rows' ids, each row's followed by end_id, and the rows' bounds."""
    if (path, ordinary) not in _CACHES:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _CACHES[path, ordinary] = SegmentCache(path, ordinary)
    cache = _CACHES[path, ordinary]
    if cache.whole and not ordinary:
        return _one_by_one(cache, data, off, end_id)
    starts, seg = segments(data, off)
    ends = np.append(starts[1:], len(data))
    h = span_hashes(data, starts, ends)
    keys, one, back = np.unique(h, return_index=True, return_inverse=True)

    def places() -> tuple[np.ndarray, np.ndarray]:
        p = np.minimum(np.searchsorted(cache.keys, keys), max(0, len(cache.keys) - 1))
        return p, cache.keys[p] == keys if len(cache.keys) else np.zeros(len(keys), bool)

    p, known = places()
    if not known.all():
        if len(cache.keys) + (~known).sum() > CACHED:
            cache.clear()
            known[:] = False
        raw, new = data.tobytes(), np.flatnonzero(~known)
        cache.add(keys[new], [raw[s:e] for s, e in zip(starts[one[new]].tolist(), ends[one[new]].tolist())])
        p, known = places()
    if not same_spans(data, starts, ends, cache.raw, cache.from_[p][back]):
        return _one_by_one(cache, data, off, end_id)
    n, at = cache.n[p][back], cache.at[p][back]
    sums = np.concatenate([[0], np.cumsum(n)])
    own = sums[seg]  # ids before each row, without end ids
    out = np.full(int(sums[-1]) + len(off) - 1, end_id, np.int32)
    source = np.repeat(at - sums[:-1], n) + np.arange(sums[-1])
    row = np.repeat(np.repeat(np.arange(len(off) - 1), np.diff(seg)), n)
    out[np.arange(sums[-1]) + row] = cache.ids[source]
    return out, own + np.arange(len(off))


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, task long, local_rank long"


def pieces_of(docs: DataFrame, path: str, length: int = LENGTH, ordinary: bool = False) -> DataFrame:
    """Pieces with their task and, among the task's pieces of equal length, their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        seen = np.zeros(length + 1, np.int64)
        for b in slices(batches):
            ids, bounds = encode(*buffer_of(b.column("text")), path, ordinary=ordinary)
            raw = ids.astype("<u4").tobytes()
            total = np.diff(bounds)
            count = -(-total // length)
            row = np.repeat(np.arange(len(count)), count)
            start = (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)) * length
            n = np.minimum(length, total[row] - start)
            a = (bounds[:-1][row] + start) * 4
            crc = np.array([zlib.crc32(raw[x:y]) for x, y in zip(a.tolist(), (a + n * 4).tolist())], np.int64)
            order = np.argsort(n, kind="stable")
            group = n[order]
            fresh = np.arange(len(n)) - np.searchsorted(group, group)
            rank = np.empty(len(n), np.int64)
            rank[order] = fresh + seen[group]
            np.add.at(seen, n, 1)
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()).take(pa.array(row)), pa.array(start), pa.array(n), pa.array(crc), pa.array(total[row]), pa.array(np.full(len(n), task)), pa.array(rank)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "task", "local_rank"])

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


def shortest_pack_first(histogram: dict[int, int], length: int = LENGTH) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths, longest first) and how many sequences have each.

    Lengths go in longest first; each piece goes into the shortest open pack, which has the
    most room, and opens a new one if even that has too little. Equal packs take a piece
    each at once.
    """
    open_: dict[int, list[list]] = {}
    rooms: list[int] = []  # sorted rooms that have patterns

    def put(room: int, pattern: tuple[int, ...], n: int) -> None:
        own = open_.get(room)
        if own is None:
            own = open_[room] = []
            bisect.insort(rooms, room)
        own.append([pattern, n])

    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        while left:
            if not rooms or rooms[-1] < size:
                # No other pack has room, so a new one takes as many of this length as go in.
                fit = length // size
                full, rest = divmod(left, fit)
                if full:
                    put(length - fit * size, (size,) * fit, full)
                if rest:
                    put(length - rest * size, (size,) * rest, 1)
                break
            room = rooms[-1]
            own = open_[room]
            pattern, n = own.pop()
            if not own:
                del open_[room]
                rooms.pop()
            taken = min(n, left)
            put(room - size, pattern + (size,), taken)
            if n > taken:
                put(room, pattern, n - taken)
            left -= taken
    merged: dict[tuple[int, ...], int] = {}
    for own in open_.values():
        for pattern, n in own:
            merged[pattern] = merged.get(pattern, 0) + n
    return sorted(merged.items(), reverse=True)


def places(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """For each length its runs of places: (length, first rank, places, first sequence, offset, places a sequence)."""
    ranks: dict[int, int] = {}
    out, sequence = [], 0
    for pattern, n in patterns:
        at, k = 0, 0
        while k < len(pattern):
            size, same = pattern[k], 1
            while k + same < len(pattern) and pattern[k + same] == size:
                same += 1
            first = ranks.get(size, 0)
            out.append((size, first, n * same, sequence, at, same))
            ranks[size] = first + n * same
            at, k = at + same * size, k + same
        sequence += n
    return out


def pack(docs: DataFrame, path: str, *, length: int = LENGTH, ordinary: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset of every piece."""
    spark = docs.sparkSession
    with Scratch(spark) as scratch:
        pieces = scratch.table(pieces_of(docs, path, length, ordinary), "pieces")
        counts = scratch.table(pieces.groupBy("task", "length").agg(F.count("*").alias("n")), "counts")
        histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
        runs = places(shortest_pack_first(histogram, length))
        before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n"))
        by_task = scratch.table(before.groupBy("task").agg(F.map_from_entries(F.collect_list(F.struct("length", "before"))).alias("offsets")), "offsets")
        # Sorted runs of every length; a rank's run is the last that begins at or below it.
        table: dict[int, list] = {}
        for size, first, n, sequence, at, same in runs:
            table.setdefault(size, []).append((first, sequence, at, same))
        found = F.broadcast(spark.createDataFrame([(k, v) for k, v in table.items()], "length long, runs array<struct<first:long,sequence:long,at:long,same:long>>"))
        ranked = pieces.join(by_task, "task").withColumn("rank", F.col("local_rank") + F.col("offsets")[F.col("length")]).drop("offsets")
        last = F.element_at(F.filter("runs", lambda r: r["first"] <= F.col("rank")), -1)
        out = ranked.join(found, "length").withColumn("run", last)
        inside = F.col("rank") - F.col("run.first")
        return keep(
            out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("run.sequence") + F.floor(inside / F.col("run.same"))).cast("long").alias("sequence_id"), (F.col("run.at") + (inside % F.col("run.same")) * F.col("length")).cast("long").alias("offset"))
        )
