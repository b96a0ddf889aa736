"""Substring dedup by seed and extend.

Seeds are winnowed anchors: of every `window - anchor + 1` consecutive word 8-grams the
one with the least hash (the leftmost of equal ones) is the window's anchor, so equal
windows have equal anchors at equal places, and only windows over an anchor that stands
more than once need a look.  Documents meet on their anchors; each shared seed is then
extended to both sides over all windows that it anchors, these meet on their whole
content, and every window learns whether it has an earlier place.  Overlapping repeated
windows merge into maximal repeats.

Extending by content and not pair by pair is what bounds the work: a passage that stands
in n documents costs n rows and not n * n / 2 pairs, and nothing is lost, as every window
is compared with all others over the same anchor.

Both meetings go through packed lookups (`_exchange`): a chunk of documents sends each of
its anchors, and then each of its candidate windows, once.  Anchors are 64-bit hashes,
which only decide what is looked at; windows are equal if 96 bits of hashes are.

Defined cases: null or empty text has no words; a text shorter than a window never
repeats; equal texts keep their words only in the row with the smallest doc_id; a null
doc_id counts as the least; rows with one doc_id stand in the order of their texts; an
empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._exchange import NULL_ID, answer_shared, ask, chunk_count, chunked, ordered, parts, reply, request, with_replies
from ._scratch import keep
from ._words import SPACE, U64, buffer_of, joined, mix, row_of, slices, span_hashes, spans, window_hashes

WINDOW, ANCHOR = 20, 8
SALT = U64(0xD6E8FEB86659FD93)


def sliding_argmin(x: np.ndarray, width: int) -> np.ndarray:
    """For every window of `width` items the index of its least item, the leftmost of equal ones."""
    n = len(x) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, at, have = x, np.arange(len(x)), 1
    while have < width:
        step = min(have, width - have)
        m = len(best) - step
        take = best[step:] < best[:m]
        at = np.where(take, at[step:], at[:m])
        best = np.where(take, best[step:], best[:m])
        have += step
    return at[:n]


class Windows:
    """All windows of some rows: first word, row, and the hash of the anchor."""

    def __init__(self, batch: pa.RecordBatch, window: int, anchor: int):
        self.window = window
        self.data, off = buffer_of(batch.column("text"))
        self.starts, self.ends, self.bounds = spans(self.data, off, SPACE)
        self.hash = span_hashes(self.data, self.starts, self.ends)
        rows = row_of(self.bounds)
        self.first = np.flatnonzero(np.arange(len(rows)) + window <= self.bounds[1:][rows])
        self.row = rows[self.first]
        grams = window_hashes(self.hash, anchor)
        if len(self.first):
            at = sliding_argmin(grams, window - anchor + 1)[self.first]
            # least hashes are small ones; mixed again, they spread over all buckets
            self.anchor, self.place = mix(grams[at]), at
        else:
            self.anchor, self.place = np.zeros(0, U64), np.zeros(0, np.int64)

    def seeds(self) -> np.ndarray:
        """The anchors' hashes, one for each place that is the anchor of some window of its row."""
        new = np.ones(len(self.place), bool)
        new[1:] = (self.place[1:] != self.place[:-1]) | (self.row[1:] != self.row[:-1])
        return self.anchor[new]

    def content(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """96 bits of hashes of the chosen windows' words."""
        one = window_hashes(self.hash, self.window)[self.first[chosen]]
        two = (window_hashes(mix(self.hash ^ SALT), self.window)[self.first[chosen]] >> U64(32)).astype(np.uint32)
        return one, two


def _slices(table: pa.Table, window: int, anchor: int):
    at = 0
    for part in slices(iter([ordered(table)])):
        yield at, part, Windows(part, window, anchor)
        at += part.num_rows


def _send_anchors(table: pa.Table, *, window: int, anchor: int, buckets: int) -> pa.Table:
    found = [w.seeds() for _, _, w in _slices(table, window, anchor)]
    keys, n = np.unique(np.concatenate(found), return_counts=True)
    return request(table.column("chunk")[0].as_py(), keys, buckets, np.minimum(n, 2).astype(np.uint8))


def _candidates(table: pa.Table, replies: pa.Table, window: int, anchor: int):
    """The windows over anchors that stand twice: slices and chosen windows, and their contents, doc_ids and first words."""
    cut, seeds = [], []
    for at, part, w in _slices(table, window, anchor):
        seeds.append(w.seeds())
        cut.append((at, part, w))
    keys = np.unique(np.concatenate(seeds))
    _, _, (shared,) = parts(replies, ("u1",), "bucket")
    keys = keys[shared.astype(bool)]
    out = []
    for at, part, w in cut:
        p = np.minimum(np.searchsorted(keys, w.anchor), max(0, len(keys) - 1))
        chosen = np.flatnonzero(keys[p] == w.anchor) if len(keys) else np.zeros(0, np.int64)
        one, two = w.content(chosen)
        rows = w.row[chosen]
        out.append((w, part, chosen, one, two, at + rows, w.first[chosen] - w.bounds[rows]))
    ids = np.concatenate([np.asarray(x[1].column("doc_id").fill_null(NULL_ID)) for x in out])
    one, two, row, start = (np.concatenate([x[k] for x in out]) for k in (3, 4, 5, 6))
    order = np.lexsort((start, row, two, one))
    new = np.ones(len(order), bool)
    new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
    return out, ids, one, two, row, start, order, new


def _send_windows(table: pa.Table, replies: pa.Table, *, window: int, anchor: int, buckets: int) -> pa.Table:
    _, ids, one, two, row, start, order, new = _candidates(table, replies, window, anchor)
    first = order[new]
    return request(table.column("chunk")[0].as_py(), one[first], buckets, two[first], ids[row[first]], start[first].astype(np.int32))


def _answer_windows(table: pa.Table) -> pa.Table:
    """Whether each chunk's first place of a window is the first of all."""
    chunks, bounds, (one, two, doc, start) = parts(table, ("u8", "u4", "i8", "i4"), "chunk")
    order = np.lexsort((start, doc, two, one))
    new = np.ones(len(order), bool)
    new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
    least = np.zeros(len(order), np.uint8)
    least[order[new]] = 1
    return reply(table.column("bucket")[0].as_py(), chunks, bounds, least)


def _covered(table: pa.Table, anchors: pa.Table, answers: pa.Table, window: int, anchor: int):
    """For each slice its rows, words and which of them a repeated window covers."""
    out, _, one, two, row, start, order, new = _candidates(table, anchors, window, anchor)
    _, _, (least,) = parts(answers, ("u1",), "bucket")
    again = np.ones(len(order), bool)
    again[order[new]] = ~least.astype(bool)
    at = 0
    for w, part, chosen, *_ in out:
        hit = w.first[chosen[again[at : at + len(chosen)]]]
        at += len(chosen)
        edge = np.zeros(len(w.starts) + 1, np.int32)
        np.add.at(edge, hit, 1)
        np.add.at(edge, hit + window, -1)
        yield part, w, np.cumsum(edge[:-1]) > 0


def _kept_texts(w: Windows, covered: np.ndarray) -> list[bytes]:
    out, at = joined(w.data, w.starts, w.ends, w.bounds, ~covered)
    raw = out.tobytes()
    return [raw[x:y] for x, y in zip(at[:-1].tolist(), at[1:].tolist())]


def _digest_rows(part: pa.RecordBatch, w: Windows, covered: np.ndarray) -> pa.Table:
    removed = np.bincount(row_of(w.bounds)[covered], minlength=len(w.bounds) - 1)
    digests = [hashlib.sha256(x).hexdigest() for x in _kept_texts(w, covered)]
    return pa.table({"doc_id": part.column("doc_id"), "n_words": pa.array(np.diff(w.bounds)), "n_removed": pa.array(removed), "kept_sha256": pa.array(digests)})


def _cut_rows(part: pa.RecordBatch, w: Windows, covered: np.ndarray) -> pa.Table:
    """Carried columns, and the text without what repeats; a text that loses nothing stays as it is."""
    touched = np.bincount(row_of(w.bounds)[covered], minlength=len(w.bounds) - 1) > 0
    texts = [x.decode("utf-8", "replace") if t else old for x, t, old in zip(_kept_texts(w, covered), touched.tolist(), part.column("text").to_pylist())]
    names = [n for n in part.schema.names if n.startswith("carried_")]
    return pa.table({"doc_id": part.column("doc_id"), "text": pa.array(texts, pa.string()), **{n: part.column(n) for n in names}})


def _span_rows(part: pa.RecordBatch, w: Windows, covered: np.ndarray) -> pa.Table:
    """Maximal repeats: first and last word of every run of covered words."""
    rows = row_of(w.bounds)
    before, after = np.zeros(len(covered), bool), np.zeros(len(covered), bool)
    before[1:], after[:-1] = covered[:-1] & (rows[1:] == rows[:-1]), covered[1:] & (rows[1:] == rows[:-1])
    first, last = np.flatnonzero(covered & ~before), np.flatnonzero(covered & ~after)
    base = w.bounds[rows[first]]
    return pa.table({"doc_id": part.column("doc_id").take(pa.array(rows[first])), "first_word": pa.array(first - base), "last_word": pa.array(last - base)})


def _meet(docs: DataFrame, make: Callable[..., pa.Table], sql: str, window: int, anchor: int, carry: list[str] | None = None) -> DataFrame:
    chunks = buckets = chunk_count(docs)
    plain = chunked(docs, chunks)
    texts = chunked(docs, chunks, carry) if carry else plain
    size = {"window": window, "anchor": anchor}
    anchors = ask(plain, partial(_send_anchors, buckets=buckets, **size), 2, answer_shared, 1)

    def send(table: pa.Table, replies: pa.Table) -> pa.Table:
        return _send_windows(table, replies, buckets=buckets, **size)

    answers = with_replies(plain, anchors, send, "bucket int, chunk int, c0 binary, c1 binary, c2 binary, c3 binary").groupBy("bucket").applyInArrow(_answer_windows, "bucket int, chunk int, c0 binary")
    both = anchors.selectExpr("chunk", "bucket", "c0", "0 AS of").unionByName(answers.selectExpr("chunk", "bucket", "c0", "1 AS of"))

    def use(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            raise ValueError("replies to a chunk without rows")
        of = np.asarray(replies.column("of"))
        own = [replies.filter(pa.array(of == k)) for k in (0, 1)]
        return pa.concat_tables([make(*x) for x in _covered(table, *own, window, anchor)])

    return with_replies(texts, both, use, sql)


def repeats(docs: DataFrame, *, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """doc_id, first_word and last_word (from 0, inclusive) of every maximal run of words that repeated windows cover."""
    return _meet(docs, _span_rows, "doc_id long, first_word long, last_word long", window, anchor)


def repeat_digest(docs: DataFrame, *, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row."""
    return keep(_meet(docs, _digest_rows, "doc_id long, n_words long, n_removed long, kept_sha256 string", window, anchor))


def cut_repeats(docs: DataFrame, *, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """The rows of docs with all their columns, the text without repeated windows (n_chars, if there, follows it)."""
    carry = [c for c in docs.columns if c not in ("doc_id", "text")]
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    sql = "doc_id long, text string" + "".join(f", `carried_{c}` {kinds[c]}" for c in carry)
    out = _meet(docs, _cut_rows, sql, window, anchor, carry)
    back = {c: F.col(f"`carried_{c}`") for c in carry} | {"doc_id": F.col("doc_id").cast(kinds["doc_id"]), "text": F.col("text")}
    if "n_chars" in back:
        back["n_chars"] = F.when(F.col("text").isNotNull(), F.length("text")).otherwise(back["n_chars"]).cast(kinds["n_chars"])
    return out.select(*(back[c].alias(c) for c in docs.columns))
