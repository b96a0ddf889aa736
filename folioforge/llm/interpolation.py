"""Language-model scores by deleted interpolation.

Counts of all n-grams up to `order` come from the training documents.  An n-gram's
maximum-likelihood estimate is mixed with the estimate one order lower,

    P_k(w | h) = lambda_k(b) * c(h w) / c(h) + (1 - lambda_k(b)) * P_(k-1)(w | h'),

down to P_0 = 1 / (V + 1) over the V known words and one unknown; b is the bucket of the
context's frequency c(h), a power of two.  The weights are learned by expectation-
maximisation on counts that are held out of the estimates: the training documents whose
crc32 modulo 5 is 0 are the deleted part, the estimates used for learning come from the
others.  The weights then serve with the counts of all training documents.

Counting and looking up go through packed lookups (`_exchange`), so every chunk of
documents sends each of its n-grams once and gets its counts back.  The deleted part is
summed up in cells (buckets, and estimates to half a power of two, with the estimates'
means kept), whose number does not grow with the corpus; EM runs on the cells.

Defined cases: null or empty text is the end token alone; without training documents the
score is 0 for every text; a null doc_id counts as the empty text in the split; repeated
rows count as often as they stand; an empty table gives no rows; other columns are left
out.  n-grams are told apart by 63-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._exchange import ask, chunk_count, chunked, ordered, packed, parts, reply, request, unpacked, with_replies
from ._scratch import Scratch, keep
from ._words import SPACE, U64, buffer_of, crc_mod, mix, slices, span_hashes, spans

ORDER = 2
FOLDS, HELD_OUT, DELETED = 5, 1, 0
BUCKETS, STEPS = 40, 64
END, BEGIN = U64(0x51ED270B0F4A7C15), U64(0x2545F4914F6CDD1D)
ODD = U64(0x9E6C63D0876A9A47)


def tokens_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens (words and, after each row's words, the end) and the rows' bounds."""
    data, off = buffer_of(batch.column("text"), lower=True)
    starts, ends, bounds = spans(data, off, SPACE)
    n = len(bounds) - 1
    out = np.full(len(starts) + n, END, U64)
    out[np.arange(len(starts)) + np.repeat(np.arange(n), np.diff(bounds))] = span_hashes(data, starts, ends)
    return out, bounds + np.arange(n + 1)


def gram_keys(tokens: np.ndarray, bounds: np.ndarray, order: int) -> list[np.ndarray]:
    """For k = 1 to order the key of the k-gram that ends at each token; single tokens have odd keys, others even ones."""
    first = bounds[:-1]
    history, out = np.zeros(len(tokens), U64), []
    before = tokens
    for k in range(1, order + 1):
        key = mix(history * ODD + mix(tokens + U64(k)))
        out.append(key | U64(1) if k == 1 else key & ~U64(1))
        if k < order:
            shifted = np.empty_like(before)
            shifted[1:] = before[:-1]
            shifted[first] = BEGIN
            before = shifted
            history = mix(history + before * U64(2 * k + 1))
    return out


def _keys(table: pa.Table, order: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, list[np.ndarray]]]:
    for part in slices(iter([ordered(table)])):
        tokens, bounds = tokens_of(part)
        yield part, bounds, gram_keys(tokens, bounds, order)


def _send(table: pa.Table, order: int, buckets: int) -> pa.Table:
    keys, counts = [], []
    for part, bounds, grams in _keys(table, order):
        fold = np.repeat(crc_mod(part.column("doc_id"), FOLDS), np.diff(bounds))
        for g in grams:
            # main and deleted counts in one pass: 2**32 stands for one deleted
            one = np.where(fold == HELD_OUT, 0, np.where(fold == DELETED, 1 << 32, 1)).astype(np.int64)
            u, back = np.unique(g, return_inverse=True)
            keys.append(u)
            counts.append(np.bincount(back, weights=one, minlength=len(u)).astype(np.int64))
    u, back = np.unique(np.concatenate(keys), return_inverse=True)
    n = np.zeros(len(u), np.int64)
    np.add.at(n, back, np.concatenate(counts))
    return request(table.column("chunk")[0].as_py(), u, buckets, (n & 0xFFFFFFFF).astype(np.uint32), (n >> 32).astype(np.uint32))


def _answer(table: pa.Table) -> pa.Table:
    """Each key's count in all training documents and without the deleted part; and the totals of the bucket's single tokens."""
    chunks, bounds, (keys, main, deleted) = parts(table, ("u8", "u4", "u4"), "chunk")
    u, back = np.unique(keys, return_inverse=True)
    a, b = (np.bincount(back, weights=x, minlength=len(u)).astype(np.uint64) for x in (main, deleted))
    single = (u & U64(1)).astype(bool)
    totals = np.array([((a + b)[single] > 0).sum(), (a + b)[single].sum(), a[single].sum()], np.uint64)
    out = reply(table.column("bucket")[0].as_py(), chunks, bounds, (a + b)[back], a[back])
    return out.append_column("c2", pa.array([totals.tobytes()] * len(chunks), pa.binary()))


def _contexts(counts: list[np.ndarray], bounds: np.ndarray, total: int) -> list[np.ndarray]:
    """For k = 1 to order how often the context of each token's k-gram stands before a token."""
    out = [np.full(len(counts[0]), float(total))]
    first = bounds[:-1]
    for c in counts[:-1]:
        x = np.empty(len(c))
        x[1:] = c[:-1]
        x[first] = counts[0][bounds[1:] - 1]  # as often as texts begin, they end
        out.append(x)
    return out


def _estimates(counts: list[np.ndarray], contexts: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Maximum-likelihood estimates and buckets of the contexts (0: never seen)."""
    f = [np.divide(c, x, out=np.zeros(len(x)), where=x > 0) for c, x in zip(counts, contexts)]
    b = [np.minimum(np.frexp(x)[1], BUCKETS - 1) for x in contexts]
    return f, b


def _steps(f: np.ndarray) -> np.ndarray:
    """An estimate's step: 0 for none, else by halves of powers of two from 1 down."""
    with np.errstate(divide="ignore"):
        return np.where(f > 0, np.clip(np.rint(-2 * np.log2(f)) + 1, 1, STEPS - 1), 0).astype(np.int64)


ROWS = "kind int, doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, vocabulary long, base_score double, counts array<binary>"
SCHEMA = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("vocabulary", pa.int64()), ("base_score", pa.float64()), ("counts", pa.list_(pa.binary()))])


def _use(table: pa.Table, replies: pa.Table, order: int) -> pa.Table:
    """A row for each document with its tokens' counts, and one with the cells of the chunk's deleted part."""
    if not table.num_rows:
        raise ValueError("replies to a chunk without rows")
    _, _, (every, main) = parts(replies.select(["bucket", "c0", "c1"]), ("u8", "u8"), "bucket")
    vocabulary, total, total_main = (int(x) for x in sum(np.frombuffer(x.as_py(), np.uint64) for x in replies.column("c2")))
    held = list(_keys(table, order))
    keys = np.unique(np.concatenate([g for _, _, grams in held for g in grams]))
    out, cells = [], {}
    for part, bounds, grams in held:
        at = [np.searchsorted(keys, g) for g in grams]
        counts = [every[x] for x in at]
        n = np.diff(bounds)
        fold = crc_mod(part.column("doc_id"), FOLDS)
        base = np.add.reduceat(np.log10((counts[0] + 0.5) / (total + 0.5 * (vocabulary + 1))), bounds[:-1])
        known = np.add.reduceat((counts[0] > 0).astype(np.int64), bounds[:-1])
        columns = [[packed(c[x:y]) for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist())] for c in counts]
        rows = len(n)
        out.append(pa.table([pa.array(np.zeros(rows, np.int32)), part.column("doc_id"), pa.array(fold == HELD_OUT), pa.array(n), pa.array(known), pa.array(np.full(rows, total)), pa.array(np.full(rows, vocabulary)), pa.array(base), pa.array([list(x) for x in zip(*columns)], pa.list_(pa.binary()))], schema=SCHEMA))
        chosen = np.repeat(fold == DELETED, n)
        if chosen.any():
            c = [main[x].astype(float) for x in at]
            f, b = _estimates(c, _contexts(c, bounds, total_main))
            code = np.zeros(int(chosen.sum()), np.int64)
            for k in range(order):
                code = (code * BUCKETS + (b[k][chosen] if k else 0)) * STEPS + _steps(f[k][chosen])
            u, back = np.unique(code, return_inverse=True)
            for x, *v in zip(u.tolist(), *[np.bincount(back, weights=w) for w in (np.ones(len(code)), *(y[chosen] for y in f))]):
                cells[x] = cells.get(x, 0) + np.array(v)
    if cells:
        codes, sums = np.array(list(cells), np.int64), np.stack(list(cells.values()))
        out.append(pa.table([pa.array([1], pa.int32()), *(pa.nulls(1, SCHEMA.field(k).type) for k in range(1, 6)), pa.array([vocabulary], pa.int64()), pa.nulls(1, pa.float64()), pa.array([[codes.tobytes(), sums.tobytes()]], pa.list_(pa.binary()))], schema=SCHEMA))
    return pa.concat_tables(out)


def _cell_rows(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for codes, sums in b.column("counts").to_pylist():
                s = np.frombuffer(sums, float).reshape(-1, order + 1)
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(codes, np.int64)), *(pa.array(s[:, k].copy()) for k in range(order + 1))], names=["code", *(f"s{k}" for k in range(order + 1))])

    return run


def learn_weights(codes: np.ndarray, sums: np.ndarray, vocabulary: int, order: int, rounds: int = 60) -> np.ndarray:
    """EM over cells (weight and summed estimates): weights by order and context bucket."""
    weights = np.full((order, BUCKETS), 0.5)
    weights[1:, 0] = 0.0
    if not len(codes):
        return weights
    w = sums[:, 0]
    f = [sums[:, 1 + k] / w for k in range(order)]
    b, rest = [], codes.copy()
    for k in reversed(range(order)):
        rest //= STEPS
        b.append(rest % BUCKETS)
        rest //= BUCKETS
    b.reverse()
    for _ in range(rounds):
        p = [np.full(len(w), 1 / (vocabulary + 1))]
        for k in range(order):
            l = weights[k][b[k]]
            p.append(l * f[k] + (1 - l) * p[-1])
        reach = w.copy()  # the posterior weight with which a token passes to this order
        for k in reversed(range(order)):
            l = weights[k][b[k]]
            here = np.divide(reach * l * f[k], p[k + 1], out=np.zeros(len(w)), where=p[k + 1] > 0)
            up = np.bincount(b[k], weights=here, minlength=BUCKETS)
            down = np.bincount(b[k], weights=reach, minlength=BUCKETS)
            # two tokens' worth of doubt, so that no bucket reaches 0 or 1
            weights[k] = np.where(down > 0, (up + 1) / (down + 2), weights[k])
            if k:
                weights[k][0] = 0.0
            reach = reach - here
    return weights


def _scores(weights: np.ndarray, order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = np.asarray(b.column("n_tokens"))
            bounds = np.concatenate([[0], np.cumsum(n)])
            counts = [[] for _ in range(order)]
            for row in b.column("counts").to_pylist():
                for k, x in enumerate(row):
                    counts[k].append(unpacked(x, "u8").astype(float))
            counts = [np.concatenate(c) for c in counts]
            total, vocabulary = b.column("train_tokens")[0].as_py(), b.column("vocabulary")[0].as_py()
            f, bucket = _estimates(counts, _contexts(counts, bounds, total))
            p = np.full(len(counts[0]), 1 / (vocabulary + 1))
            if total:
                for k in range(order):
                    l = weights[k][bucket[k] if k else 0]
                    p = l * f[k] + (1 - l) * p
            score = np.add.reduceat(np.log10(p), bounds[:-1])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), b.column("n_tokens"), b.column("n_known"), b.column("train_tokens"), b.column("base_score"), pa.array(score)], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def _small(batches: Iterator[pa.RecordBatch], size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about `size` tokens."""
    for b in batches:
        ends, at = np.cumsum(np.asarray(b.column("n_tokens"))), 0
        while at < b.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, side="right")))
            yield b.slice(at, to - at)
            at = to


def deleted_interpolation(docs: DataFrame, *, order: int = ORDER) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    spark = docs.sparkSession
    chunks = chunk_count(docs)
    with Scratch(spark) as scratch:
        texts = chunked(docs, chunks)
        replies = ask(texts, lambda t: _send(t, order, chunks), 3, _answer, 3)
        counted = scratch.table(with_replies(texts, replies, lambda a, b: _use(a, b, order), ROWS), "counted")
        names = [f"s{k}" for k in range(order + 1)]
        cells = counted.where("kind = 1").select("counts").mapInArrow(_cell_rows(order), "code long, " + ", ".join(f"{n} double" for n in names))
        found = cells.groupBy("code").agg(*(F.sum(n).alias(n) for n in names)).orderBy("code").toArrow()
        vocabulary = counted.where("kind = 1").agg(F.max("vocabulary")).first()[0] or 0
        weights = learn_weights(np.asarray(found.column("code"), dtype=np.int64), np.stack([np.asarray(found.column(n), dtype=float) for n in names], 1), vocabulary, order)
        score = _scores(weights, order)
        scored = counted.where("kind = 0").mapInArrow(lambda bs: score(_small(bs)), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
        return keep(scored)
