"""Exact dedup by deterministic block naming.

A text (after lower-casing A-Z) is cut into blocks of a fixed number of bytes.  The
distinct blocks are sorted, and a block's place in the sorted order is its integer name:
two blocks have one name only if all their bytes are equal.  Then names of adjacent
pairs are named in the same way, again and again, until every document is left with one
name.  Documents of one level with one name have equal texts, so identity is proven by
comparing and sorting, never by a digest.

Bytes move once: each task drops the repeats among its own blocks first, so a text that
a third of all documents share travels once from each task.  A block's rows learn its
name by a 128-bit key instead of its bytes; the sorted table shows whether each key
belongs to one block only, and blocks for which it does not (none are known) are joined
on their bytes.

Defined cases: null text counts as empty; an empty text is one empty block; of equal
texts the row with the largest doc_id stays, a null doc_id being the least; rows
repeated with their doc_id all carry the same verdict, so `kept` marks all of them;
an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._scratch import Scratch, keep
from ._words import buffer_of, slices

BLOCK = 8192
REMEMBERED_BYTES = 32 << 20


def _cut(off: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of every block; an empty row has one empty block."""
    n = np.maximum(1, -(-np.diff(off) // block))
    row = np.repeat(np.arange(len(n)), n)
    start = off[:-1][row] + (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)) * block
    return row, start, np.minimum(start + block, off[1:][row])


def _key(piece: bytes, bits: int) -> tuple[int, int]:
    d = hashlib.blake2b(piece, digest_size=16).digest()
    one, two = int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)
    return (one, two) if bits >= 128 else (one & ((1 << bits) - 1), 0)


def _blocks(block: int, bits: int):
    """Blocks of a task without the repeats among those it still remembers; the rest go when they meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        held = 0
        for b in slices(batches):
            data, off = buffer_of(b.column("text"), lower=True)
            _, start, end = _cut(off, block)
            raw, out = data.tobytes(), []
            for s, e in zip(start.tolist(), end.tolist()):
                piece = raw[s:e]
                if piece not in seen:
                    seen.add(piece)
                    held += e - s + 100
                    out.append(piece)
            if held > REMEMBERED_BYTES:
                seen.clear()
                held = 0
            if out:
                keys = [_key(x, bits) for x in out]
                yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys]), pa.array(out, pa.binary())], names=["k1", "k2", "block"])

    return run


def _name_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Names the runs of equal blocks of a sorted part by their place; keeps the first row of each run."""
    name, last = TaskContext.get().partitionId() << 40, None
    for b in batches:
        first, names = [], []
        for x in b.column("block"):
            x = x.as_py()
            first.append(x != last)
            if x != last:
                name, last = name + 1, x
                names.append(name)
        kept = b.filter(pa.array(first))
        yield pa.RecordBatch.from_arrays([kept.column("k1"), kept.column("k2"), kept.column("block"), pa.array(names, pa.int64())], names=["k1", "k2", "block", "name"])


def _occurrences(block: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            data, off = buffer_of(b.column("text"), lower=True)
            row, start, end = _cut(off, block)
            raw = data.tobytes()
            keys = [_key(raw[s:e], bits) for s, e in zip(start.tolist(), end.tolist())]
            bounds = pa.array(np.searchsorted(row, np.arange(len(off))).astype(np.int32))
            sha = [hashlib.sha256(raw[s:e]).hexdigest() for s, e in zip(off[:-1].tolist(), off[1:].tolist())]
            pairs = pa.StructArray.from_arrays([pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64())], names=["k1", "k2"])
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("doc_id"), pa.array(sha), pa.ListArray.from_arrays(bounds, pairs)], names=["row", "doc_id", "sha", "keys"])

    return run


def _pieces(block: int, bits: int):
    """Every block with its bytes, for keys that more than one block has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            data, off = buffer_of(b.column("text"), lower=True)
            _, start, end = _cut(off, block)
            raw = data.tobytes()
            out = [raw[s:e] for s, e in zip(start.tolist(), end.tolist())]
            rows, pos = [], []
            for r, n in zip(b.column("row").to_pylist(), np.maximum(1, -(-np.diff(off) // block)).tolist()):
                rows += [r] * n
                pos += range(n)
            keys = [_key(x, bits) for x in out]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(pos, pa.int32()), pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), pa.array(out, pa.binary())], names=["row", "pos", "k1", "k2", "block"])

    return run


def block_identity(docs: DataFrame, scratch: Scratch, *, block: int = BLOCK, key_bits: int = 128) -> DataFrame:
    """row, doc_id, sha, level, name: two rows have equal texts just if level and name are equal."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    named = (
        source.select("text")
        .mapInArrow(_blocks(block, key_bits), "k1 long, k2 long, block binary")
        .repartition("k1", "k2")
        .sortWithinPartitions("block")
        .mapInArrow(_name_sorted, "k1 long, k2 long, block binary, name long")
    )
    occ = scratch.table(source.withColumn("row", F.monotonically_increasing_id()).mapInArrow(_occurrences(block, key_bits), "row long, doc_id long, sha string, keys array<struct<k1:long,k2:long>>"), "occurrences")
    names = scratch.table(named.select("k1", "k2", "name"), "names")
    shared = names.groupBy("k1", "k2").count().where("count > 1").select("k1", "k2")
    at = occ.select("row", F.posexplode("keys").alias("pos", "key")).select("row", "pos", "key.k1", "key.k2")
    if shared.isEmpty():  # every key belongs to one block, so the key finds the block
        found = at.join(names, ["k1", "k2"]).select("row", "pos", "name")
    else:
        scratch.table(named.join(shared, ["k1", "k2"], "left_semi"), "by_bytes")
        by_bytes = scratch.spark.read.parquet(f"{scratch.root}/by_bytes")
        numbered = scratch.table(source.withColumn("row", F.monotonically_increasing_id()).mapInArrow(_pieces(block, key_bits), "row long, pos int, k1 long, k2 long, block binary").join(shared, ["k1", "k2"], "left_semi"), "pieces")
        found = at.join(shared, ["k1", "k2"], "left_anti").join(names, ["k1", "k2"]).select("row", "pos", "name").unionByName(numbered.join(by_bytes, ["k1", "k2", "block"]).select("row", "pos", "name"))
    sizes = occ.select("row", F.size("keys").alias("n"))
    longest = sizes.agg(F.max("n")).first()[0] or 0
    now = scratch.table(found.join(sizes, "row"), "level0")
    done, level = now.where("n = 1").select("row", F.lit(0).alias("level"), "name"), 0
    while longest > 1:
        level, longest = level + 1, -(-longest // 2)
        pairs = (
            now.where("n > 1")
            .groupBy("row", F.floor(F.col("pos") / 2).cast("int").alias("pos"), F.ceil(F.col("n") / 2).cast("int").alias("n"))
            .agg(F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"))
        )
        pairs = scratch.table(pairs, f"pairs{level}")
        kinds = scratch.table(pairs.select("a", "b").distinct().sortWithinPartitions("a", "b").withColumn("name", F.monotonically_increasing_id()), f"kinds{level}")
        now = scratch.table(pairs.join(kinds, ["a", "b"]).select("row", "pos", "n", "name"), f"level{level}")
        done = done.unionByName(now.where("n = 1").select("row", F.lit(level).alias("level"), "name"))
    return occ.select("row", "doc_id", "sha").join(done, "row")


def exact_groups(docs: DataFrame, *, block: int = BLOCK, key_bits: int = 128) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row."""
    with Scratch(docs.sparkSession) as scratch:
        identity = scratch.table(block_identity(docs, scratch, block=block, key_bits=key_bits), "identity")
        groups = scratch.table(identity.groupBy("level", "name").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")), "groups")
        return keep(identity.join(groups, ["level", "name"]).select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256")))


def one_row_each(docs: DataFrame, kept: DataFrame, sha: Column) -> DataFrame:
    """The rows of docs that kept names by doc_id and sha, one of each where the column `many` says that several have both.

    A doc_id alone does not tell rows apart: it may be null or stand more than once.
    """
    named = kept.select(F.col("doc_id").alias("_id"), F.col("sha").alias("_named"), "many")
    rows = docs.withColumn("_sha", sha)
    has = lambda names: rows.join(names.drop("many"), rows["doc_id"].eqNullSafe(F.col("_id")) & (rows["_sha"] == F.col("_named")), "left_semi")
    many = named.where("many")
    if many.isEmpty():
        return has(named).drop("_sha")
    return has(named.where("not many")).unionByName(has(many).dropDuplicates(["doc_id", "_sha"])).drop("_sha")


def drop_copies(docs: DataFrame, *, block: int = BLOCK) -> DataFrame:
    """One row of each group of equal texts, with all its columns."""
    kept = exact_groups(docs, block=block).where("kept").groupBy("doc_id", F.col("text_sha256").alias("sha")).agg((F.count("*") > 1).alias("many"))
    lower = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return one_row_each(docs, kept, F.sha2(lower, 256))
