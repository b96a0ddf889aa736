"""Packed lookups: what a chunk of documents asks about its keys, answered by all chunks together.

Documents are dealt into chunks by a hash of their doc_id.  A chunk sorts the distinct
64-bit keys it holds and sends them, cut into `buckets` equal ranges of the key space, as
binary values; a bucket's task merges what all chunks sent for its range and sends each
chunk an answer for each of its keys, in the same order.  A key travels once from each
chunk however often it stands there, so neither a frequent key nor a third of equal
documents loads one task.  What a chunk sends depends on its rows alone and not on their
order, so a task that runs again on another executor sends the same.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._scratch import parts_for
from ._words import settle

U64 = np.uint64
CHUNK_STORED_BYTES = 5 << 20
LEAST_CHUNKS = 48
#: Stands for a null doc_id in orders.
NULL_ID = -(1 << 63)


def chunk_count(docs: DataFrame) -> int:
    return parts_for(docs, CHUNK_STORED_BYTES, LEAST_CHUNKS)


def chunked(docs: DataFrame, chunks: int, carry: list[str] | None = None) -> DataFrame:
    """chunk, doc_id, text and, prefixed with carried_, the columns to carry: the one exchange of whole texts."""
    own = [F.pmod(F.xxhash64(F.col("doc_id")), F.lit(chunks)).cast("int").alias("chunk"), F.col("doc_id").cast("long").alias("doc_id"), "text"]
    return docs.select(*own, *(F.col(f"`{c}`").alias(f"carried_{c}") for c in carry or [])).repartition(chunks, "chunk")


def ordered(table: pa.Table) -> pa.RecordBatch:
    """The chunk's rows by doc_id and text, as one batch, with doc_id's nulls least."""
    ids = pc.fill_null(table.column("doc_id"), NULL_ID)
    order = pc.sort_indices(pa.table({"i": ids, "t": table.column("text")}), [("i", "ascending"), ("t", "ascending")])
    out = table.take(order).combine_chunks()
    return out.to_batches()[0]


def bucket_bounds(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's range begins in sorted keys (buckets + 1 bounds)."""
    edges = np.array([(k << 64) // buckets for k in range(1, buckets)], U64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]]).astype(np.int64)


_ZSTD = pa.Codec("zstd", compression_level=1)


def packed(values: np.ndarray, *, rising: bool = False) -> bytes:
    """Integers as compressed byte planes (all first bytes, all second bytes, ...); rising ones by their differences."""
    if not len(values):
        return b""
    if rising:
        values = np.diff(values, prepend=values.dtype.type(0))
    width = values.dtype.itemsize
    planes = np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(-1, width).T)
    return len(values).to_bytes(8, "little") + _ZSTD.compress(planes, asbytes=True)


def unpacked(raw: bytes, kind: str, *, rising: bool = False) -> np.ndarray:
    kind = np.dtype(kind)
    if not raw:
        return np.zeros(0, kind)
    n = int.from_bytes(raw[:8], "little")
    planes = np.frombuffer(_ZSTD.decompress(raw[8:], n * kind.itemsize), np.uint8).reshape(kind.itemsize, n)
    out = np.ascontiguousarray(planes.T).reshape(-1).view(kind)
    return np.cumsum(out, dtype=kind) if rising else out


def request(chunk: int, keys: np.ndarray, buckets: int, *columns: np.ndarray) -> pa.Table:
    """bucket, chunk and, for each column aligned with the sorted keys, its part as a packed value."""
    at = bucket_bounds(keys, buckets)
    out = {"bucket": pa.array(np.arange(buckets, dtype=np.int32)), "chunk": pa.array(np.full(buckets, chunk, np.int32))}
    for k, c in enumerate((keys, *columns)):
        out[f"c{k}"] = pa.array([packed(c[x:y], rising=k == 0) for x, y in zip(at[:-1].tolist(), at[1:].tolist())], pa.binary())
    return pa.table(out)


def request_sql(columns: int) -> str:
    return "bucket int, chunk int, " + ", ".join(f"c{k} binary" for k in range(columns))


def parts(table: pa.Table, kinds: Iterable[str], order_by: str) -> tuple[list[int], np.ndarray, list[np.ndarray]]:
    """The other ids in order, the bounds of their parts, and the columns put together; requests have rising keys first."""
    ids = np.asarray(table.column(order_by))
    order = np.argsort(ids, kind="stable").tolist()
    out, bounds = [], np.zeros(len(order) + 1, np.int64)
    for k, kind in enumerate(kinds):
        own = [unpacked(table.column(f"c{k}")[i].as_py(), kind, rising=k == 0 and order_by == "chunk") for i in order]
        bounds[1:] = np.cumsum([len(x) for x in own])
        out.append(np.concatenate([np.zeros(0, kind), *own]))
    return ids[order].tolist(), bounds, out


def reply(bucket: int, chunks: list[int], bounds: np.ndarray, *columns: np.ndarray) -> pa.Table:
    out = {"bucket": pa.array(np.full(len(chunks), bucket, np.int32)), "chunk": pa.array(np.array(chunks, np.int32))}
    for k, c in enumerate(columns):
        out[f"c{k}"] = pa.array([packed(c[x:y]) for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist())], pa.binary())
    return pa.table(out)


def answer_shared(table: pa.Table) -> pa.Table:
    """Whether each key stands at more than one place; sent: keys, and how often each stands in the chunk (2: or more)."""
    chunks, bounds, (keys, n) = parts(table, ("u8", "u1"), "chunk")
    _, back, times = np.unique(keys, return_inverse=True, return_counts=True)
    return reply(table.column("bucket")[0].as_py(), chunks, bounds, ((times[back] > 1) | (n > 1)).astype(np.uint8))


def ask(texts: DataFrame, send: Callable[[pa.Table], pa.Table], sent: int, answer: Callable[[pa.Table], pa.Table], answered: int) -> DataFrame:
    """Replies to what `send` makes of each chunk."""

    def run(table: pa.Table) -> pa.Table:
        out = send(table)
        settle()
        return out

    return texts.groupBy("chunk").applyInArrow(run, request_sql(sent)).groupBy("bucket").applyInArrow(answer, request_sql(answered))


def with_replies(texts: DataFrame, replies: DataFrame, use: Callable[[pa.Table, pa.Table], pa.Table], sql: str) -> DataFrame:
    """Each chunk's rows together with the replies it got."""

    def run(table: pa.Table, got: pa.Table) -> pa.Table:
        out = use(table, got)
        settle()
        return out

    return texts.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(run, sql)
