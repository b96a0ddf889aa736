"""Toxic passages by maximum-scoring segments.

A token's score is its log-odds between toxic and other labelled texts, counted once for
each text that holds it.  The counts have Dirichlet priors in two layers: a stem (the
first letters of a word) has pseudo-counts in the ratio of all tokens, a word has them in
the ratio of its stem, so rare and unseen forms lean on their kin and frequent ones stand
on their own counts.  From every score a drift is taken, which makes the expected score
of a clean text negative.

One linear scan finds all maximal-scoring segments of a text: disjoint passages of which
none gains by growing or shrinking.  Only tokens with positive scores can open or close a
segment, so the scan walks those alone, with prefix sums for what lies between.

Scores of passages are calibrated by their extreme-value law: a clean text of n tokens
holds about E = K n exp(-lambda x) segments of score x or more, one at least with a chance
of 1 - exp(-E); lambda and K are fitted on clean labelled texts.  A text's evidence is the sum over its segments of
-log E where the expected number E of such segments is below 1; labels turn evidence
into a probability (logistic, fitted on labelled texts that had no part in the counts
they are scored with: two halves score each other).

The model is learned from at most `sample` labelled rows (those with the least crc32 of
doc_id), a fixed bound, so counts, model and broadcast do not grow with the corpus; every
text is scored whole.

Defined cases: null or empty text has no evidence and the score of that; without labels
of both kinds every score is the share of toxic labels (0 without any), and passages are
none; repeated rows repeat; a null label is no label, a null doc_id is never learned
from; an empty table gives no rows; other columns are left out, labels of one doc_id that
differ count as toxic if any is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._scratch import Scratch
from ._words import NOT_ALNUM, U64, buffer_of, crc_mod, mix, row_of, slices, span_hashes, spans

SAMPLE = 20_000
FOLDS, HELD_OUT = 5, 0
STEM = 5
PRIOR = 10.0
DRIFT = 1.0
TAIL = 0.5  # segments from here on show the law's tail
MOST = 8.0


def _tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of words and of their stems, and the rows' bounds."""
    data, off = buffer_of(batch.column("text"), lower=True)
    starts, ends, bounds = spans(data, off, NOT_ALNUM)
    stem_end = np.minimum(ends, starts + STEM)
    return span_hashes(data, starts, ends), mix(span_hashes(data, starts, stem_end) ^ U64(0xA5A5A5A5A5A5A5A5)), bounds


def _look(table: np.ndarray, values: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(keys), np.float32), np.zeros(len(keys), bool)
    p = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return values[p], table[p] == keys


@dataclass
class Model:
    words: np.ndarray
    scores: np.ndarray
    stems: np.ndarray
    stem_scores: np.ndarray
    rate: float = 1.0  # lambda of the extreme-value law
    size: float = 1.0  # K
    slope: float = 0.0
    offset: float = -5.0

    def token_scores(self, words: np.ndarray, stems: np.ndarray) -> np.ndarray:
        own, known = _look(self.words, self.scores, words)
        kin, akin = _look(self.stems, self.stem_scores, stems)
        return np.where(known, own, np.where(akin, kin, 0)) - DRIFT

    def evidence(self, scores: np.ndarray, n: int) -> float:
        """Sum of -log E over the segments whose E is below 1."""
        e = self.rate * scores - np.log(self.size * max(n, 1))
        return float(e[e > 0].sum())

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.offset + self.slope * np.log1p(evidence), -50, 50)))


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, end, score), in order, in time linear in the positive scores."""
    up = np.flatnonzero(scores > 0)
    if not len(up):
        return []
    total = np.concatenate([[0.0], np.cumsum(scores)])
    # Stack of candidates: first, end, sum before it, sum at its end, and the nearest earlier one with a lesser sum before.
    stack: list[list] = []
    for i in up.tolist():
        first, end, low, high = i, i + 1, total[i], total[i + 1]
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= low:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= high:
                stack.append([first, end, low, high, j])
                break
            first, low = stack[j][0], stack[j][2]
            del stack[j:]
    return [(a, b, float(h - l)) for a, b, l, h, _ in stack]


def _segments(batch: pa.RecordBatch, models: list[Model], which: np.ndarray) -> tuple[list[list[tuple[int, int, float]]], np.ndarray]:
    """Each row's segments under the model that `which` names for it, and its number of tokens."""
    words, stems, bounds = _tokens(batch)
    rows = row_of(bounds)
    scores = np.empty(len(words))
    for k, m in enumerate(models):
        own = which[rows] == k
        scores[own] = m.token_scores(words[own], stems[own])
    out: list[list[tuple[int, int, float]]] = [[] for _ in range(len(bounds) - 1)]
    for r in np.unique(rows[scores > 0]).tolist():
        out[r] = maximal_segments(scores[bounds[r] : bounds[r + 1]])
    return out, np.diff(bounds)


def _presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts each word (kind 0) and stem (kind 1) stands, by half and label, with a word's stem."""
    for b in slices(batches):
        words, stems, bounds = _tokens(b)
        rows = row_of(bounds)
        cls = np.asarray(b.column("half")).astype(np.int64) * 2 + np.asarray(b.column("toxic")).astype(np.int64)
        for kind, keys in ((0, words), (1, stems)):
            order = np.lexsort((keys, rows))
            new = np.ones(len(order), bool)
            new[1:] = (keys[order][1:] != keys[order][:-1]) | (rows[order][1:] != rows[order][:-1])
            at = order[new]
            c = cls[rows[at]]
            for k in range(4):
                u, first, n = np.unique(keys[at[c == k]], return_index=True, return_counts=True)
                stem = stems[at[c == k]][first] if kind == 0 else u
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(u), kind, np.int32)), pa.array(np.full(len(u), k, np.int32)), pa.array(u.astype(np.int64)), pa.array(stem.astype(np.int64)), pa.array(n)], names=["kind", "cls", "key", "stem", "n"])


def fit_tokens(kind: np.ndarray, key: np.ndarray, stem: np.ndarray, toxic: np.ndarray, clean: np.ndarray, total_toxic: float, total_clean: float) -> Model:
    """Log-odds of words and stems from the numbers of toxic and other texts that hold them, and their totals over all words."""
    of_word = kind == 0
    if not total_toxic or not total_clean or not (~of_word).any():
        none = np.zeros(0, U64)
        return Model(none, np.zeros(0, np.float32), none, np.zeros(0, np.float32))
    share = total_toxic / (total_toxic + total_clean)
    odds = lambda p: np.clip(np.log(p / (1 - p)) - np.log(share / (1 - share)), -MOST, MOST).astype(np.float32)
    stems = key[~of_word].astype(U64)
    order = np.argsort(stems)
    stems, t, c = stems[order], toxic[~of_word][order], clean[~of_word][order]
    stem_share = (t + PRIOR * share) / (t + c + PRIOR)
    # A word in one text tells no more than its stem does.
    often = of_word & (toxic + clean >= 2)
    words = key[often].astype(U64)
    order = np.argsort(words)
    words, t, c = words[order], toxic[often][order], clean[often][order]
    p = np.minimum(np.searchsorted(stems, stem[often].astype(U64)[order]), len(stems) - 1)
    return Model(words, odds((t + PRIOR * stem_share[p]) / (t + c + PRIOR)), stems, odds(stem_share))


def fit_law(scores: np.ndarray, tokens: int) -> tuple[float, float]:
    """lambda and K from the segments of clean texts with `tokens` tokens in all."""
    tail = scores[scores >= TAIL]
    if len(tail) < 5 or not tokens:
        return 1.0, 1.0 / max(tokens, 1)
    rate = 1.0 / max(float((tail - TAIL).mean()), 0.05)
    return rate, len(tail) / tokens * float(np.exp(rate * TAIL))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.01) -> tuple[float, float]:
    """Slope (0 at least) and offset of P(y) = logistic(offset + slope * x)."""
    if not len(y) or y.min() == y.max():
        p = np.clip(y.mean() if len(y) else 0.0, 1e-6, 1 - 1e-6)
        return 0.0, float(np.log(p / (1 - p)))
    b = np.zeros(2)
    a = np.stack([np.ones(len(x)), x], 1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-9)
        step = np.linalg.solve((a * w[:, None]).T @ a + ridge * np.eye(2), a.T @ (y - p) - ridge * b)
        b += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(b[1]), 0.0), float(b[0])


def learn(docs: DataFrame, labels: DataFrame, scratch: Scratch, *, sample: int = SAMPLE) -> Model:
    """A model from the labelled rows whose crc32(doc_id) modulo 5 is not 0, at most `sample` of them."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    drawn = known.withColumn("crc", crc).where(F.col("crc") % FOLDS != HELD_OUT).orderBy("crc", "doc_id").limit(sample)
    drawn = drawn.select("doc_id", "toxic", (F.floor(F.col("crc") / FOLDS) % 2).cast("int").alias("half"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(drawn), "doc_id")
    # Copies of one text are one example.
    texts = scratch.table(texts.groupBy(F.xxhash64("text").alias("h"), "text").agg(F.max("toxic").alias("toxic"), F.min("half").alias("half")), "labelled")
    counted = texts.select("text", "toxic", "half").mapInArrow(_presence, "kind int, cls int, key long, stem long, n long")
    names = [f"n{k}" for k in range(4)]
    counts = scratch.table(counted.groupBy("kind", "key").agg(F.min("stem").alias("stem"), *(F.sum(F.when(F.col("cls") == k, F.col("n")).otherwise(0)).alias(n) for k, n in enumerate(names))), "counts")
    totals = [float(x or 0) for x in counts.where("kind = 0").agg(*(F.sum(n) for n in names)).first()]
    # What stands in one text only tells nothing of its own and stays behind.
    table = counts.where("n0 + n1 + n2 + n3 >= 2").toArrow()
    columns = [np.asarray(table.column(c)) for c in ("kind", "key", "stem")]
    n = [np.asarray(table.column(c)).astype(float) for c in names]
    # A half is scored by what the other half taught.
    halves = [fit_tokens(*columns, n[3], n[2], totals[3], totals[2]), fit_tokens(*columns, n[1], n[0], totals[1], totals[0])]
    shared = docs.sparkSession.sparkContext.broadcast(halves)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found, size = _segments(b, shared.value, np.asarray(b.column("half")))
            yield pa.RecordBatch.from_arrays([b.column("toxic"), pa.array(size), pa.array([[s for _, _, s in x] for x in found], pa.list_(pa.float64()))], names=["toxic", "n", "scores"])

    seen = texts.select("text", "toxic", "half").mapInArrow(run, "toxic int, n long, scores array<double>").toArrow()
    toxic, sizes = np.asarray(seen.column("toxic")).astype(float), np.asarray(seen.column("n"))
    scores = [np.array(x, float) for x in seen.column("scores").to_pylist()]
    clean = [s for s, t in zip(scores, toxic) if not t]
    model = fit_tokens(*columns, n[1] + n[3], n[0] + n[2], totals[1] + totals[3], totals[0] + totals[2])
    model.rate, model.size = fit_law(np.concatenate([np.zeros(0), *clean]), int(sizes[toxic == 0].sum()))
    evidence = np.array([model.evidence(s, k) for s, k in zip(scores, sizes)], float)
    model.slope, model.offset = fit_logistic(np.log1p(evidence), toxic)
    return model


def toxicity_scores(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted, and the number of significant passages with their evidence, of every row."""
    with Scratch(docs.sparkSession) as scratch:
        model = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, scratch, sample=sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for b in slices(batches):
            found, size = _segments(b, [m], np.zeros(b.num_rows, np.int64))
            scores = [np.array([s for _, _, s in x]) for x in found]
            evidence = np.array([m.evidence(s, n) for s, n in zip(scores, size)])
            p = m.probability(evidence)
            passages = np.array([int((m.rate * s > np.log(m.size * max(n, 1))).sum()) for s, n in zip(scores, size)])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(crc_mod(b.column("doc_id"), FOLDS) == HELD_OUT), pa.array(p), pa.array((p >= 0.5).astype(np.int32)), pa.array(passages), pa.array(evidence)], names=["doc_id", "held_out", "score", "predicted", "passages", "evidence"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, passages long, evidence double")


def drop_toxic(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE, at: float = 0.5) -> DataFrame:
    """The rows of docs, with all their columns, whose score is below `at`."""
    with Scratch(docs.sparkSession) as scratch:
        model = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, scratch, sample=sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for b in slices(batches):
            found, size = _segments(b, [m], np.zeros(b.num_rows, np.int64))
            evidence = np.array([m.evidence(np.array([s for _, _, s in x]), n) for x, n in zip(found, size)])
            yield b.filter(pa.array(m.probability(evidence) < at))

    return docs.mapInArrow(run, docs.schema)


def toxic_passages(docs: DataFrame, model: Model, *, most_expected: float = 0.01) -> DataFrame:
    """doc_id, first_word, last_word (from 0, inclusive), score and the expected number in clean text, of every significant passage."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in slices(batches):
            found, size = _segments(b, [m], np.zeros(b.num_rows, np.int64))
            rows = [(d, x, y - 1, s, float(m.size * max(n, 1) * np.exp(-m.rate * s))) for d, own, n in zip(b.column("doc_id").to_pylist(), found, size.tolist()) for x, y, s in own]
            rows = [r for r in rows if r[4] <= most_expected]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()))], names=["doc_id", "first_word", "last_word", "score", "expected"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, first_word long, last_word long, score double, expected double")
