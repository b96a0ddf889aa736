"""SentencePiece encoding and decoding by batched Viterbi.

The file holds merge pieces with scores: the model joins, again and again, the adjacent
pair whose union is the piece with the best score, the leftmost first.  What it ends with
is the one segmentation in which no two neighbours would have been joined across their
border before they were complete.  So it is the best path of a Viterbi search whose
transitions cost nothing where the border of two pieces holds, and are forbidden where it
does not; a prefix has exactly one such path, hence one last piece for each place.
Whether a border holds follows from the two pieces alone: going back through the merges
that made them, latest first, no two symbols that met at the border may have a union that
ranks before the merges that took them up (`Vocabulary.holds`).

Words of equal length advance together: for every start and end the substring hashes of
all words are probed in the sorted piece keys at once, all their borders are judged
together, and the piece and the backpointer of those that hold are stored.  Words are
what lies between two characters that no piece has next to each other, so nothing is ever
joined across their ends; distinct words are solved once for each worker and looked up by
hash, and their bytes compared.  Words over `LONG` bytes are solved one by one, in blocks,
with one backpointer kept for a byte.

A text gets a space in front, if it is not empty.  Runs of spaces are joined last of all,
from the left, as the scores of their pieces say.  Characters without a piece are spelled in byte
pieces.  Decoding puts the pieces' bytes together and drops the first space; what comes
back is the text itself, but that U+2581, which stands for the space in the file, comes
back as a space, as with the model's own program.

Defined cases: null or empty text has no pieces and comes back as empty; repeated rows
repeat; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._words import U64, buffer_of, lists, mix, same_spans, slices, span_hashes

SPACE_MARK = "▁"
CACHED = 1_500_000
LONG = 96  # words over so many bytes are solved one by one
BLOCK = 1 << 14
BASE = U64(0x9E3779B97F4A7C15)
NEVER = 1 << 40


def poly(piece: bytes) -> int:
    h = 0
    for b in piece:
        h = (h * int(BASE) + b + 1) & 0xFFFFFFFFFFFFFFFF
    return h


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the characters of UTF-8 bytes begin, and which they are."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[at].astype(np.int64)
    out = lead.copy()
    wide = np.append(data, np.zeros(3, np.uint8))
    for more, low, high, mask in ((1, 0xC0, 0xE0, 0x1F), (2, 0xE0, 0xF0, 0x0F), (3, 0xF0, 0x100, 0x07)):
        own = np.flatnonzero((lead >= low) & (lead < high))
        c = lead[own] & mask
        for k in range(1, more + 1):
            c = (c << 6) | (wide[at[own] + k] & 0x3F)
        out[own] = c
    return at, out


class Vocabulary:
    """The pieces by sorted keys, with ids, ranks and the two pieces each was joined from."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        m = SentencePieceProcessor(model_file=path)
        self.byte_ids = np.full(256, -1, np.int32)
        raw, score, spaces = [], {}, {}
        for i in range(m.vocab_size()):
            piece = m.id_to_piece(i)
            if m.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                raw.append(bytes([int(piece[3:5], 16)]))
                continue
            if m.is_control(i) or m.is_unknown(i) or m.is_unused(i):
                raw.append(b"")
                continue
            own = piece.replace(SPACE_MARK, " ")
            raw.append(own.encode())
            if not own.strip(" "):
                spaces[len(own)] = (i, m.get_score(i))
            if own.strip(" ") or own == " ":
                score[own] = (m.get_score(i), i)
        if (self.byte_ids < 0).any():
            raise ValueError("the vocabulary has no byte pieces")
        joined = sorted((x for x in score if len(x) > 1), key=lambda x: -score[x][0])
        self.most_spaces = max(spaces)
        low = min(score[x][0] for x in joined)
        if any(v[1] >= low for n, v in spaces.items() if n > 1) or any(" " in x[1:] for x in joined) or len({score[x][0] for x in joined}) < len(joined):
            raise ValueError("runs of spaces are not joined last, or two pieces rank alike")
        self.space_ids = np.array([spaces.get(n, (0,))[0] for n in range(self.most_spaces + 1)], np.int32)
        runs = [self._spaces(n, set(spaces)) for n in range(4 * self.most_spaces)]
        if any(x != [self.most_spaces, *runs[n - self.most_spaces]] for n, x in enumerate(runs) if n >= self.most_spaces):
            raise ValueError("runs of spaces do not repeat")
        #: For a run of so many spaces, at most the longest, and a place in it: how many spaces the piece has that begins there.
        self.space_pieces = np.zeros((self.most_spaces + 1, self.most_spaces), np.int64)
        for n in range(1, self.most_spaces + 1):
            for k, size in enumerate(runs[n]):
                self.space_pieces[n, sum(runs[n][:k])] = size
        rank = {x: k for k, x in enumerate(joined)}
        single = [x for x in score if len(x) == 1]
        pairs = {x + y for p in joined for x, y in zip(p, p[1:])}
        names = [*single, *joined]
        poly_ = np.array([poly(x.encode()) for x in names], U64)
        order = np.argsort(mix(poly_))
        place = {names[k]: j for j, k in enumerate(order.tolist())}
        names = [names[k] for k in order.tolist()]
        self.poly = poly_[order]
        self.keys = mix(self.poly)
        self.ids = np.array([score[x][1] for x in names], np.int32)
        self.rank = np.array([rank.get(x, -1) for x in names], np.int64)
        size = [len(x.encode()) for x in names]
        self.power = np.array([pow(int(BASE), n, 1 << 64) for n in size], U64)
        self.left, self.right = np.full(len(names), -1, np.int32), np.full(len(names), -1, np.int32)
        for x in joined:
            a, b = self._made_from(x, rank)
            self.left[place[x]], self.right[place[x]] = place[a], place[b]
        self.longest = max(size)
        self.ascii_pairs = np.zeros((128, 128), bool)
        wide = []
        for x in pairs:
            if x.isascii():
                self.ascii_pairs[ord(x[0]), ord(x[1])] = True
            else:
                wide.append(ord(x[0]) << 21 | ord(x[1]))
        self.wide_pairs = np.array(sorted(wide), np.int64)
        self.n = np.array([len(b) for b in raw], np.int64)
        self.at = np.cumsum(self.n) - self.n
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.judged: dict[tuple[int, int], bool] = {}

    @staticmethod
    def _spaces(n: int, known: set[int]) -> list[int]:
        """What becomes of n spaces: the leftmost two that make a piece are joined, again and again."""
        sizes = [1] * n
        while (k := next((k for k in range(len(sizes) - 1) if sizes[k] + sizes[k + 1] in known), None)) is not None:
            sizes[k : k + 2] = [sizes[k] + sizes[k + 1]]
        return sizes

    @staticmethod
    def _made_from(piece: str, rank: dict[str, int]) -> tuple[str, str]:
        """The two symbols that the last merge within a piece joins; each merge must rank after those it builds on."""
        symbols, last = list(piece), -1
        while len(symbols) > 2:
            found = min(((rank[x + y], k) for k, (x, y) in enumerate(zip(symbols, symbols[1:])) if x + y in rank), default=None)
            if found is None:
                break
            last, k = found
            symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]
        if len(symbols) != 2 or any(rank.get(x, -1) > rank[piece] for x in symbols):
            raise ValueError(f"no merges lead to the piece {piece!r}")
        return symbols[0], symbols[1]

    def probe(self, h: np.ndarray) -> np.ndarray:
        """Places of the pieces with these polynomial hashes, -1 where there is none."""
        k = mix(h)
        p = np.minimum(np.searchsorted(self.keys, k), len(self.keys) - 1)
        return np.where(self.keys[p] == k, p, -1)

    def holds(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Whether pieces stay apart when the second follows the first."""
        out = np.ones(len(one), bool)
        live, a, b = np.arange(len(one)), one.copy(), two.copy()
        taken_a, taken_b = np.full(len(one), NEVER), np.full(len(one), NEVER)  # ranks of the merges that take them up
        while len(live):
            union = self.probe(self.poly[a] * self.power[b] + self.poly[b])
            rank = np.where(union >= 0, self.rank[union], NEVER)
            # Equal merges go from left to right: one that takes up the first symbol is to the left of the border.
            crossed = (rank < taken_a) & (rank <= taken_b) & (rank < NEVER)
            out[live[crossed]] = False
            go = ~crossed & ((self.rank[a] >= 0) | (self.rank[b] >= 0))
            live, a, b, taken_a, taken_b = live[go], a[go], b[go], taken_a[go], taken_b[go]
            back = self.rank[a] > self.rank[b]  # the later merge is undone; of equal ones the right
            taken_a, taken_b = np.where(back, self.rank[a], taken_a), np.where(back, taken_b, self.rank[b])
            a, b = np.where(back, self.right[a], a), np.where(back, b, self.left[b])
        return out

    def solve(self, words: np.ndarray) -> list[np.ndarray]:
        """Ids of equally long words (rows of bytes); words without a path are spelled in bytes."""
        count, size = words.shape
        last = np.full((size + 1, count), -1, np.int32)
        back = np.zeros((size + 1, count), np.int32)
        codes = words.T.astype(U64) + U64(1)
        for s in range(size):
            rows = np.arange(count) if s == 0 else np.flatnonzero(last[s] >= 0)
            h = np.zeros(len(rows), U64)
            for e in range(s + 1, min(size, s + self.longest) + 1):
                if not len(rows):
                    break
                h = h * BASE + codes[e - 1, rows]
                open_ = np.flatnonzero(last[e, rows] < 0)  # a prefix has one path
                piece = self.probe(h[open_])
                hit = piece >= 0
                open_, piece = open_[hit], piece[hit]
                if s and len(open_):
                    good = self.holds(last[s, rows[open_]], piece)
                    open_, piece = open_[good], piece[good]
                last[e, rows[open_]], back[e, rows[open_]] = piece, s
        taken = np.zeros((count, size), np.int32)
        found = last[size] >= 0
        n, at = np.zeros(count, np.int64), np.where(found, size, 0)
        while len(live := np.flatnonzero(at > 0)):
            taken[live, n[live]] = self.ids[last[at[live], live]]
            n[live] += 1
            at[live] = back[at[live], live]
        return [taken[i, : n[i]][::-1] if found[i] else self.byte_ids[words[i]] for i in range(count)]

    def _holds(self, one: int, two: int) -> bool:
        got = self.judged.get((one, two))
        if got is None:
            if len(self.judged) > CACHED:
                self.judged.clear()
            got = self.judged[one, two] = bool(self.holds(np.array([one]), np.array([two]))[0])
        return got

    def solve_long(self, word: np.ndarray) -> np.ndarray:
        """One long word: a block's substrings are probed together; four bytes of memory for a byte, and a block's."""
        size = len(word)
        last = np.full(size + 1, -1, np.int32)
        codes = np.append(word.astype(np.uint16) + 1, np.zeros(self.longest, np.uint16))
        for low in range(0, size, BLOCK):
            high = min(low + BLOCK, size)
            own = codes[low : high + self.longest].astype(U64)
            h, found = np.zeros(high - low, U64), []
            for m in range(1, self.longest + 1):
                h = h * BASE + own[m - 1 : m - 1 + high - low]
                p = self.probe(h)
                p[max(0, size - m + 1 - low) :] = -1
                at = np.flatnonzero(p >= 0)
                found.append(np.stack([at + low, np.full(len(at), m), p[at]]))
            places = np.concatenate(found, axis=1)
            places = places[:, np.lexsort((places[1], places[0]))]
            for s, m, p in places.T.tolist():
                if last[s + m] < 0 and (s == 0 or last[s] >= 0 and self._holds(int(last[s]), p)):
                    last[s + m] = p
        if last[size] < 0:
            return self.byte_ids[word]
        out, at = [], size
        bytes_of = self.n[self.ids]
        while at:
            p = int(last[at])
            out.append(p)
            at -= int(bytes_of[p])
        return self.ids[np.array(out[::-1], np.int64)]

    def cut(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Where words begin: at rows' starts, and between characters that no piece has next to each other."""
        at, c = code_points(data)
        new = np.ones(len(at), bool)
        one, two = c[:-1], c[1:]
        plain = (one < 128) & (two < 128)
        new[1:] = ~self.ascii_pairs[np.where(plain, one, 0), np.where(plain, two, 0)] | ~plain
        wide = np.flatnonzero(~plain)
        if len(wide) and len(self.wide_pairs):
            key = one[wide] << 21 | two[wide]
            p = np.minimum(np.searchsorted(self.wide_pairs, key), len(self.wide_pairs) - 1)
            new[wide + 1] = self.wide_pairs[p] != key
        first = np.zeros(len(data) + 1, bool)
        first[at[new]] = True
        first[off] = True
        return np.flatnonzero(first[: len(data)])

    def join_spaces(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Runs of single spaces within a row become pieces of many."""
        space = ids == self.space_ids[1]
        before = np.zeros(len(ids), bool)
        before[1:] = space[:-1]
        before[bounds[:-1][bounds[:-1] < bounds[1:]]] = False
        first = np.flatnonzero(space & ~before)
        if not (space & before).any():
            return ids, bounds
        run = np.cumsum(space & ~before) - 1
        number = np.arange(len(ids)) - first[np.maximum(run, 0)]  # place of a space in its run
        length = np.bincount(run[space], minlength=len(first))
        own = np.flatnonzero(space)
        part = number[own] // self.most_spaces * self.most_spaces
        size = self.space_pieces[np.minimum(self.most_spaces, length[run[own]] - part), number[own] - part]
        out, kept = ids.copy(), ~space
        kept[own] = size > 0
        out[own] = self.space_ids[size]
        return out[kept], np.concatenate([[0], np.cumsum(kept)])[bounds]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all rows together and their bounds, without the space in front."""
        n = self.n[ids]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ids) else 0
        data = self.raw[np.repeat(self.at[ids] - (ends - n), n) + np.arange(total)] if total else np.zeros(0, np.uint8)
        at = np.concatenate([[0], ends])[bounds]
        full = at[:-1] < at[1:]
        kept = np.ones(total, bool)
        kept[at[:-1][full]] = False
        return data[kept], at - np.concatenate([[0], np.cumsum(full)])


class WordCache:
    """Ids of the words a worker has solved, in the order of the words' hashes; dropped when full."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.clear()

    def clear(self) -> None:
        self.keys, self.at, self.n, self.from_ = np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.raw = np.zeros(0, np.int32), np.zeros(0, np.uint8)

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        p = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return p, self.keys[p] == keys

    def solved(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        size = ends - starts
        ids: list[np.ndarray] = [np.zeros(0, np.int32)] * len(starts)
        for n in np.unique(size).tolist():
            own = np.flatnonzero(size == n)
            if n > LONG:
                for i in own.tolist():
                    ids[i] = self.vocabulary.solve_long(data[starts[i] : ends[i]])
            else:
                for i, x in zip(own.tolist(), self.vocabulary.solve(data[starts[own][:, None] + np.arange(n)])):
                    ids[i] = x
        return ids

    def add(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        ids = self.solved(data, starts, ends)
        n, size = np.array([len(x) for x in ids], np.int64), ends - starts
        at, from_ = len(self.ids) + np.cumsum(n) - n, len(self.raw) + np.cumsum(size) - size
        self.ids = np.concatenate([self.ids, *ids])
        self.raw = np.concatenate([self.raw, data[np.repeat(starts - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]])
        every = [np.concatenate(x) for x in ((self.keys, keys), (self.at, at), (self.n, n), (self.from_, from_))]
        order = np.argsort(every[0])
        self.keys, self.at, self.n, self.from_ = (x[order] for x in every)


_CACHES: dict[str, WordCache] = {}


def _cache(path: str) -> WordCache:
    if path not in _CACHES:
        _CACHES[path] = WordCache(path)
    return _CACHES[path]


def marks_to_spaces(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mark = np.frombuffer(SPACE_MARK.encode(), np.uint8)
    at = np.flatnonzero((data[:-2] == mark[0]) & (data[1:-1] == mark[1]) & (data[2:] == mark[2])) if len(data) > 2 else np.zeros(0, np.int64)
    if not len(at):
        return data, off
    out, kept = data.copy(), np.ones(len(data), bool)
    out[at] = 0x20
    kept[at + 1] = kept[at + 2] = False
    return out[kept], np.concatenate([[0], np.cumsum(kept)])[off]


def with_front_space(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A space before every non-empty row."""
    full = off[:-1] < off[1:]
    shift = np.concatenate([[0], np.cumsum(full)])
    out = np.full(len(data) + int(shift[-1]), 0x20, np.uint8)
    out[np.arange(len(data)) + np.repeat(shift[1:], np.diff(off))] = data
    return out, off + shift


def encode(data: np.ndarray, off: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """All rows' ids and the rows' bounds."""
    cache = _cache(path)
    data, off = with_front_space(*marks_to_spaces(data, off))
    starts = cache.vocabulary.cut(data, off)
    ends = np.append(starts[1:], len(data))
    words = np.searchsorted(starts, off)
    keys, one, back = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
    p, known = cache.places(keys)
    if not known.all():
        if len(cache.keys) + (~known).sum() > CACHED:
            cache.clear()
            known[:] = False
        new = np.flatnonzero(~known)
        cache.add(keys[new], data, starts[one[new]], ends[one[new]])
        p, _ = cache.places(keys)
    if same_spans(data, starts, ends, cache.raw, cache.from_[p][back]):
        n = cache.n[p][back]
        sums = np.concatenate([[0], np.cumsum(n)])
        ids = cache.ids[np.repeat(cache.at[p][back] - sums[:-1], n) + np.arange(sums[-1])]
    else:  # two words have one hash
        each = cache.solved(data, starts, ends)
        sums = np.concatenate([[0], np.cumsum([len(x) for x in each])])
        ids = np.concatenate([np.zeros(0, np.int32), *each])
    return cache.vocabulary.join_spaces(ids, sums[words])


def encode_pieces(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_pieces, ids, decoded_sha256 (of what the ids decode to) and exact (whether that is the text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_pieces", "ids", "decoded_sha256", "exact"]
        for b in slices(batches, size=2 << 20):
            data, off = buffer_of(b.column("text"))
            ids, bounds = encode(data, off, path)
            text, at = _cache(path).vocabulary.decode(ids, bounds)
            raw, was = text.tobytes(), data.tobytes()
            rows = [raw[x:y] for x, y in zip(at[:-1].tolist(), at[1:].tolist())]
            same = [x == was[s:e] for x, s, e in zip(rows, off[:-1].tolist(), off[1:].tolist())]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.diff(bounds)), lists(ids, bounds, pa.int32()), pa.array([hashlib.sha256(x).hexdigest() for x in rows]), pa.array(same, pa.bool_())], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_pieces long, ids array<int>, decoded_sha256 string, exact boolean")


def decode_pieces(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of rows with ids; null ids give a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _cache(path).vocabulary
        for b in batches:
            out = []
            for x in b.column("ids"):
                x = x.values
                if x is None:
                    out.append(None)
                    continue
                data, _ = vocabulary.decode(np.asarray(x, np.int64), np.array([0, len(x)]))
                out.append(data.tobytes().decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
