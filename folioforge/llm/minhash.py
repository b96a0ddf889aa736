"""Near-duplicates by circulant MinHash, banding and exact verification.

A text's set holds its distinct five-word shingles (64-bit hashes; 128 bits tell sets
apart).  One permutation of a 32-bit universe scatters the shingles, a second one orders
them, and the second, shifted once for each coordinate, gives all coordinates of the
signature: h_k = min over x of pi(sigma(x) + k * shift).  With 24 bands of 5 coordinates a
pair at the threshold of 0.85 shares no band with a probability of 8e-7.

Equal sets are one node from the start.  Every band value that several nodes have is a
bucket; its pivot is the member with the most bucket neighbours, and all other members are
compared with it on their full sets.  Pivots that these links put into one component share
an anchor, the best connected of them, and their buckets' members make one group.

Pairs of a group that lie in different components are found without comparing all of
them.  With r = (100 - threshold) / (100 + threshold), x and y are linked exactly if
|x ^ y| <= r * (|x| + |y|).  Let D(x) be the difference of x and the anchor and
g(x) = |D(x)| - r * |x|.  As x ^ y = D(x) ^ D(y), a link needs
|D(x) & D(y)| >= (g(x) + g(y)) / 2, and this is above zero for two members that are not
both in the anchor's component: g >= -r * |anchor| always, and g > r * |anchor| for
whatever is not linked with the anchor.  So a prefix filter on the differences is exact:
members are put into classes by g, a member offers to each class of its group the rarest
|D| - o + 1 shingles of its difference, o being the overlap that the class demands at
least, and only members of different components that meet on an offered shingle are
compared.  What all copies share with the anchor is in no difference, and a copy's own
edits meet nobody.  Every pair of a bucket is thereby compared, connected already, or
proven to have no link; a pair that shares no bucket is not looked at (see above for how
likely that is at the threshold).

Defined cases: null or empty text, or one without words, has an empty set and is linked
with nothing; fewer words than five make one shingle; equal doc_ids with equal texts are
one node, repeated rows get the same class; a null doc_id is smaller than none (its
component is that of the least other doc_id, or null); an empty table gives no rows;
other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._exchange import CHUNK_STORED_BYTES, LEAST_CHUNKS, ask, parts, reply, request, with_replies
from ._scratch import Scratch, keep, parts_for
from ._words import SPACE, U64, buffer_of, mix, slices, span_hashes, spans, window_hashes
from .graphs import components
from .naming import one_row_each

SHINGLE, THRESHOLD = 5, 85
BANDS, ROWS = 24, 5
BLOCK = 1 << 15
U32 = np.uint32
SHIFT = 0x9E3779B1


def shingle_sets(batch: pa.RecordBatch, width: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    data, off = buffer_of(batch.column("text"), lower=True)
    starts, ends, bounds = spans(data, off, SPACE)
    h = span_hashes(data, starts, ends)
    grams = window_hashes(h, width)
    out = []
    for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if y - x >= width:
            out.append(np.unique(grams[x : y - width + 1]))
        elif y > x:
            out.append(window_hashes(h[x:y], y - x))
        else:
            out.append(np.zeros(0, U64))
    return out


def signatures(values: np.ndarray, bounds: np.ndarray, size: int) -> np.ndarray:
    """Circulant MinHash of runs of values; no run may be empty."""
    x = (mix(values * U64(0xD1342543DE82EF95)) >> U64(32)).astype(U32)
    x = (x ^ (x >> U32(15))) * U32(0x2C1B3C6D)  # sigma
    x ^= x >> U32(12)
    out = np.full((len(bounds) - 1, size), 0xFFFFFFFF, U32)
    # Blocks that fit in the cache; runs that cross a block are met again in the next.
    for low in range(0, len(x), BLOCK):
        part = x[low : low + BLOCK]
        first, last = np.searchsorted(bounds, low, side="right") - 1, np.searchsorted(bounds, low + len(part), side="left")
        at = np.maximum(bounds[first:last] - low, 0)
        y, z = np.empty_like(part), np.empty_like(part)
        for k in range(size):
            np.add(part, U32(k * SHIFT & 0xFFFFFFFF), out=y)
            np.right_shift(y, U32(16), out=z)
            np.bitwise_xor(y, z, out=y)
            np.multiply(y, U32(0x7FEB352D), out=y)
            np.right_shift(y, U32(15), out=z)
            np.bitwise_xor(y, z, out=y)
            np.multiply(y, U32(0x846CA68B), out=y)
            own = out[first:last, k]
            np.minimum(own, np.minimum.reduceat(y, at), out=own)
    return out


def _digest(x: np.ndarray) -> bytes:
    return hashlib.blake2b(x.tobytes(), digest_size=16).digest()


def _signed(width: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, size=2 << 20):
            sets = shingle_sets(b, width)
            n = np.array([len(x) for x in sets], np.int64)
            full = np.flatnonzero(n)
            keys: list[list[int] | None] = [None] * len(sets)
            if len(full):
                bounds = np.concatenate([[0], np.cumsum(n[full])])
                sig = signatures(np.concatenate([sets[i] for i in full]), bounds, bands * rows).astype(U64).reshape(len(full), bands, rows)
                h = np.broadcast_to(np.arange(1, bands + 1, dtype=U64) * U64(0x9E3779B97F4A7C15), (len(full), bands)).copy()
                for r in range(rows):
                    h = mix(h ^ sig[:, :, r]) + U64(r)
                for i, x in zip(full.tolist(), h.astype(np.int64).tolist()):
                    keys[i] = x
            own = ["sha"] if "sha" in b.schema.names else []
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(b.column(c) for c in own), pa.array(n), pa.array([_digest(x) if len(x) else None for x in sets], pa.binary()), pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", *own, "n", "set_id", "bands"])

    return run


def _with_sets(width: int):
    """The sets of member texts, for the rows whose text is the one that was signed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            sets = shingle_sets(b, width)
            same = [_digest(x) == y.as_py() for x, y in zip(sets, b.column("set_id"))]
            yield pa.RecordBatch.from_arrays([b.column("node").filter(pa.array(same)), pa.array([x.tobytes() for x, s in zip(sets, same) if s], pa.binary())], names=["node", "shingles"])

    return run


def _compared(threshold: int):
    """Whether pairs of sets are linked; a run of pairs with one first set unpacks it once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, np.zeros(0, U64)
        for b in batches:
            out = []
            for x, y in zip(b.column("set_a"), b.column("set_b")):
                x = x.as_py()
                if x != last:
                    last, left = x, np.frombuffer(x, U64)
                right = np.frombuffer(y.as_py(), U64)
                both = int((left[np.minimum(np.searchsorted(left, right), len(left) - 1)] == right).sum())
                out.append(100 * both >= threshold * (len(left) + len(right) - both))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(out, pa.bool_())], names=["a", "b", "link"])

    return run


def _differences(threshold: int):
    """diff: the shingles that a member and its anchor do not share; class: see `_class_of`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            diffs, n, kinds = [], [], []
            for x, y, main in zip(b.column("set_a"), b.column("set_b"), b.column("main").to_pylist()):
                left, right = np.frombuffer(x.as_py(), U64), np.frombuffer(y.as_py(), U64)
                d = np.setxor1d(left, right, assume_unique=True)
                diffs.append(d.tobytes())
                n.append((len(left), len(right)))
                kinds.append(_class_of(len(d), len(right), len(left), threshold) * 2 + main)
            n_anchor, n_own = np.array(n, np.int64).reshape(-1, 2).T
            yield pa.RecordBatch.from_arrays([b.column("anchor"), b.column("node"), b.column("comp"), pa.array(n_anchor), pa.array(n_own), pa.array(kinds, pa.int32()), pa.array(diffs, pa.binary())], names=["anchor", "node", "comp", "n_anchor", "n", "kind", "diff"])

    return run


SLACK = 1e-6


def _far(threshold: int) -> float:
    return (100 - threshold) / (100 + threshold)


def _width(n_anchor: int, threshold: int) -> float:
    return max(1.0, _far(threshold) * n_anchor / 2)


def _class_of(differing: int, n: int, n_anchor: int, threshold: int) -> int:
    """The class of g = differing - r * n; classes of a group are equally wide."""
    return int(np.floor((differing - _far(threshold) * n + SLACK) / _width(n_anchor, threshold)))


def _offers(diffs: DataFrame, threshold: int) -> DataFrame:
    """anchor, shingle, low, high, kind, node, comp: what members offer to the classes of their groups.

    A kind is a class, doubled, plus one in the anchor's component, whose members need no
    partners there.  How many of a group have a shingle is told by packed lookups, so a
    shingle that a whole group shares is sent once from each chunk.
    """
    kinds = diffs.groupBy("anchor").agg(F.collect_set("kind").alias("kinds"))
    held = diffs.join(kinds, "anchor")
    count = parts_for(diffs, CHUNK_STORED_BYTES, LEAST_CHUNKS)
    held = held.select(F.pmod(F.xxhash64("anchor", "node"), F.lit(count)).cast("int").alias("chunk"), "*")

    def keys_of(table: pa.Table) -> tuple[list[np.ndarray], list[np.ndarray]]:
        values = [np.frombuffer(x.as_py(), U64) for x in table.column("diff")]
        salts = mix(np.asarray(table.column("anchor")).astype(np.int64).view(U64) + U64(SHIFT))
        return values, [mix(x ^ s) for x, s in zip(values, salts)]

    def send(table: pa.Table) -> pa.Table:
        keys, n = np.unique(np.concatenate(keys_of(table)[1]), return_counts=True)
        return request(table.column("chunk")[0].as_py(), keys, count, n.astype(np.uint32))

    def answer(table: pa.Table) -> pa.Table:
        chunks, bounds, (keys, n) = parts(table, ("u8", "u4"), "chunk")
        _, back = np.unique(keys, return_inverse=True)
        return reply(table.column("bucket")[0].as_py(), chunks, bounds, np.minimum(np.bincount(back, weights=n), 0xFFFFFFFF).astype(np.uint32)[back])

    def use(table: pa.Table, replies: pa.Table) -> pa.Table:
        values, keyed = keys_of(table)
        _, _, (holders,) = parts(replies, ("u4",), "bucket")
        keys = np.unique(np.concatenate(keyed))
        rows, shingles, low, high = [], [], [], []
        for k, (x, own, n, n_anchor, kind, others) in enumerate(zip(values, keyed, *(table.column(c).to_pylist() for c in ("n", "n_anchor", "kind", "kinds")))):
            times = holders[np.searchsorted(keys, own)]
            order = np.lexsort((x, times))
            shared, alone = int((times > 1).sum()), int((times <= 1).sum())
            g, width = len(x) - _far(threshold) * n, _width(n_anchor, threshold)
            for other in others:
                if kind % 2 and other % 2:
                    continue
                overlap = max(1, int(np.ceil((g + (other // 2) * width) / 2 - SLACK)))
                if overlap <= shared:  # the rarest come first; what nobody else has is not sent
                    offered = x[order[alone : len(x) - overlap + 1]]
                    rows += [k] * len(offered)
                    shingles.append(offered)
                    low += [min(kind, other)] * len(offered)
                    high += [max(kind, other)] * len(offered)
        of = table.select(["anchor", "kind", "node", "comp"]).take(pa.array(rows, pa.int64()))
        flat = np.concatenate([np.zeros(0, U64), *shingles]).astype(U64).view(np.int64)
        return pa.table({"anchor": of.column("anchor"), "shingle": pa.array(flat), "low": pa.array(low, pa.int32()), "high": pa.array(high, pa.int32()), "kind": of.column("kind"), "node": of.column("node"), "comp": of.column("comp")})

    return with_replies(held, ask(held, send, 2, answer, 1), lambda a, b: use(a, b), "anchor long, shingle long, low int, high int, kind int, node long, comp long")


def _meeting(offers: DataFrame) -> DataFrame:
    """a, b: members of different components that meet on a shingle each has offered to the other's class."""
    key = ["anchor", "shingle", "low", "high"]
    one = offers.where("kind = low")
    two = offers.where("kind = high").select(*key, F.col("node").alias("p_node"), F.col("comp").alias("p_comp"))
    met = one.join(two, key).where((F.col("comp") != F.col("p_comp")) & ((F.col("low") < F.col("high")) | (F.col("node") < F.col("p_node"))))
    return met.select(F.least("node", "p_node").alias("a"), F.greatest("node", "p_node").alias("b")).distinct()


def _only(source: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose doc_id is, but for a few, among the wanted ones.

    A bit for each hash of a wanted doc_id, 64 times as many bits as doc_ids, rounded up
    to a power of two and 2 ** 27 at most: the bitmaps, of 4 KB each, take 16 MB at most.
    Beyond that ever more other rows pass, which the join with the wanted ones removes.
    """
    n = wanted.count()
    size = min(1 << 27, max(1 << 15, 1 << (64 * n).bit_length()))
    at = lambda c: F.pmod(F.xxhash64(c), F.lit(size)) + 1
    spots = wanted.select(at("doc_id").alias("at"))
    bits = spots.groupBy(F.bitmap_bucket_number("at").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    found = source.withColumn("_at", at("doc_id")).join(F.broadcast(bits), F.bitmap_bucket_number("_at") == F.col("part"))
    place = F.bitmap_bit_position("_at")
    byte = F.conv(F.hex(F.substring("bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return found.where(F.getbit(byte, (place % 8).cast("int")) == 1).select(*source.columns)


def _sha() -> Column:
    return F.sha2(F.coalesce("text", F.lit("")), 256)


def _components_of(source: DataFrame, nodes: DataFrame, scratch: Scratch, width: int, threshold: int) -> DataFrame:
    """node, comp of every node that has a link."""
    entries = nodes.select("node", "n", F.explode("bands").alias("key"))
    buckets = entries.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = scratch.table(entries.join(buckets, "key"), "members")
    degrees = scratch.table(members.groupBy("node", "n").agg(F.sum("size").alias("degree")), "degrees")
    ranked = scratch.table(members.select("key", "node").join(degrees, "node"), "ranked")
    scratch.drop("members")
    rank = F.struct("degree", -F.col("node"))
    pivots = ranked.groupBy("key").agg(F.max_by(F.struct("node", "n", "degree"), rank).alias("pivot"))
    spokes = ranked.join(pivots, "key").where("node <> pivot.node").select(F.col("pivot.node").alias("pivot"), F.col("pivot.n").alias("pivot_n"), F.col("pivot.degree").alias("degree"), "node", "n").distinct()
    spokes = scratch.table(spokes, "spokes")
    scratch.drop("ranked")
    wanted = scratch.table(nodes.join(degrees.select("node"), "node").select("node", "set_id", F.col("doc_id")), "wanted")
    named = wanted.select("node", "set_id", F.col("doc_id").alias("_id"))
    texts = _only(source, wanted).join(named, F.col("doc_id").eqNullSafe(F.col("_id"))).select("node", "set_id", "text")
    sets = scratch.table(texts.mapInArrow(_with_sets(width), "node long, shingles binary").dropDuplicates(["node"]), "sets")

    def sets_of(pairs: DataFrame, a: str, b: str) -> DataFrame:
        return pairs.join(sets.select(F.col("node").alias(b), F.col("shingles").alias("set_b")), b).join(sets.select(F.col("node").alias(a), F.col("shingles").alias("set_a")), a)

    def compared(pairs: DataFrame, name: str) -> DataFrame:
        return scratch.table(sets_of(pairs, "a", "b").select("a", "b", "set_a", "set_b").mapInArrow(_compared(threshold), "a long, b long, link boolean"), name)

    alike = F.least("n", "pivot_n") * 100 >= F.greatest("n", "pivot_n") * threshold
    first = compared(spokes.where(alike).select(F.col("pivot").alias("a"), F.col("node").alias("b")), "first")
    links = first.where("link").select("a", "b")
    comps = components(links, scratch, "comps-first")

    # Pivots of one component share an anchor; a group is what stood in a bucket with any of them.
    labelled = spokes.select("pivot", "degree").distinct().join(comps.select(F.col("node").alias("pivot"), "comp"), "pivot", "left").withColumn("comp", F.coalesce("comp", "pivot"))
    labelled = scratch.table(labelled, "pivots")
    best = labelled.groupBy("comp").agg(F.max_by("pivot", F.struct("degree", -F.col("pivot"))).alias("anchor"))
    anchors = scratch.table(labelled.join(best, "comp").select("pivot", "anchor", F.col("comp").alias("home")), "anchors")
    group = spokes.select("pivot", "node").unionByName(labelled.select("pivot", F.col("pivot").alias("node"))).join(anchors, "pivot").where("node <> anchor").select("anchor", "home", "node").distinct()
    group = group.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    group = scratch.table(group, "group")
    apart = group.where("comp <> home").select("anchor", "node")
    # Members of other components that were not compared with the anchor because another pivot stood for it.
    more = apart.join(first.select(F.col("a").alias("anchor"), F.col("b").alias("node")), ["anchor", "node"], "left_anti")
    second = compared(more.select(F.col("anchor").alias("a"), F.col("node").alias("b")), "second").where("link").select("a", "b")
    group = group.join(second.select(F.col("a").alias("anchor"), F.col("b").alias("node"), F.lit(True).alias("joined")), ["anchor", "node"], "left")
    group = group.withColumn("comp", F.when(F.col("joined"), F.col("home")).otherwise(F.col("comp"))).withColumn("main", (F.col("comp") == F.col("home")).cast("int"))
    group = scratch.table(group.select("anchor", "node", "comp", "main"), "states")
    mixed = scratch.table(group.where("main = 0").select("anchor").distinct(), "mixed")
    open_ = scratch.table(group.join(mixed, "anchor", "left_semi"), "open")
    diffs = sets_of(open_, "anchor", "node").select("anchor", "node", "comp", "main", "set_a", "set_b")
    diffs = scratch.table(diffs.mapInArrow(_differences(threshold), "anchor long, node long, comp long, n_anchor long, n long, kind int, diff binary"), "diffs")
    offers = scratch.table(_offers(diffs, threshold), "offers")
    met = scratch.table(_meeting(offers), "met")
    third = compared(met, "third").where("link").select("a", "b")
    fresh = scratch.table(second.unionByName(third), "fresh")
    if fresh.isEmpty():
        return comps
    return components(links.unionByName(fresh), scratch, "comps-all")


def near_classes(docs: DataFrame, *, width: int = SHINGLE, threshold: int = THRESHOLD, bands: int = BANDS, rows: int = ROWS, stay: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row; links at 100 * intersection >= threshold * union.

    `stay`: instead doc_id and sha of the row that stays of each class, and whether many rows
    have both; rows without shingles are in no class and all stay.
    """
    spark = docs.sparkSession
    with Scratch(spark) as scratch:
        source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *([_sha().alias("sha")] if stay else []))
        signed = scratch.table(source.mapInArrow(_signed(width, bands, rows), f"doc_id long, {'sha string, ' if stay else ''}n long, set_id binary, bands array<long>"), "signed")
        # One node for equal sets.
        least = signed.where("n > 0").groupBy("set_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")).alias("least"), F.first("n").alias("n"), F.first("bands").alias("bands"))
        nodes = scratch.table(least.select(F.monotonically_increasing_id().alias("node"), "set_id", "least.doc_id", "n", "bands"), "nodes")
        comps = _components_of(source, nodes, scratch, width, threshold)
        named = nodes.select("node", "set_id", "doc_id").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        named = scratch.table(named, "named")
        if stay:
            alike = signed.where("n > 0").join(named.select("set_id", "comp"), "set_id").groupBy("comp", "doc_id", "sha").agg((F.count("*") > 1).alias("many"))
            least = alike.groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "sha", "many")).alias("least")).select("least.doc_id", "least.sha", "least.many")
            return keep(least.unionByName(signed.where("n = 0").select("doc_id", "sha", F.lit(False).alias("many")).distinct()))
        lowest = scratch.table(named.groupBy("comp").agg(F.min("doc_id").alias("component_id")), "lowest")
        classes = scratch.table(named.join(lowest, "comp").select("set_id", "component_id"), "classes")
        out = signed.select("doc_id", F.col("n").alias("n_shingles"), "set_id").join(classes, "set_id", "left")
        component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
        return keep(out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def drop_near_copies(docs: DataFrame, *, width: int = SHINGLE, threshold: int = 80, bands: int = 40, rows: int = ROWS) -> DataFrame:
    """The rows of docs that stand for their class, with all their columns.

    At a threshold of 0.8, 40 bands of 5 miss a pair with a probability of 1e-7.
    """
    return one_row_each(docs, near_classes(docs, width=width, threshold=threshold, bands=bands, rows=rows, stay=True), _sha())
