"""Which items' pieces stand in texts, without a row for each piece.

Pieces are numbered through their halves: characters that items have, pairs of those that
stand in items, and so on up to the size.  Numbers are equal exactly when pieces are, and
what no item has is number 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Keys up to which pairs are looked up in a table, characters worked on together, counts held together.
TABLE, SLICE, COUNTS = 1 << 22, 1 << 20, 1 << 22


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class _Pairs:
    """Numbers from 1 for the pairs (a, b) of numbers that stand in items; 0 for all others."""

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.base = int(b.max(initial=0)) + 1
        self.keys = np.unique(a[(a > 0) & (b > 0)] * self.base + b[(a > 0) & (b > 0)])
        top = (int(a.max(initial=0)) + 1) * self.base
        self.table = None
        if top <= TABLE:
            self.table = np.zeros(top, np.int32)
            self.table[self.keys] = np.arange(1, len(self.keys) + 1)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if self.table is not None:
            return self.table[a * self.base + b].astype(np.int64)
        out = np.zeros(len(a), np.int64)
        live = np.flatnonzero((a > 0) & (b > 0))
        if len(live) and len(self.keys):
            key = a[live] * self.base + b[live]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            out[live] = np.where(self.keys[at] == key, at + 1, 0)
        return out


class Items:
    """Items and their distinct pieces of `size` (4 or 12) characters; a key of 2 to size - 1 characters is one piece."""

    def __init__(self, ids: list, keys: list[str], size: int):
        if size not in (4, 12):
            raise ValueError("pieces have 4 or 12 characters")
        self.size = size
        self.ids = sorted(set(ids))
        place = {x: i for i, x in enumerate(self.ids)}
        short: dict[str, set[int]] = {}
        for x, k in zip(ids, keys):
            if 2 <= len(k) < size:
                short.setdefault(k, set()).add(place[x])
        self.short = {k: np.array(sorted(v), np.int64) for k, v in short.items()}
        long = [(place[x], k) for x, k in zip(ids, keys) if len(k) >= size]
        codes = _codes("\n".join(k for _, k in long))
        self.chars = np.unique(codes[codes != 10])
        self._pairs: list[_Pairs] = []
        numbers = self._numbers(codes, learn=True)
        owner = np.repeat([i for i, _ in long], [len(k) + 1 for _, k in long])[: len(numbers)] if long else np.zeros(0, np.int64)
        both = np.unique(numbers[numbers > 0] * np.int64(len(self.ids) + 1) + owner[numbers > 0])
        piece, self.owner = both // (len(self.ids) + 1), both % (len(self.ids) + 1)
        #: owners of piece p are owner[first[p] : first[p + 1]]
        self.first = np.searchsorted(piece, np.arange(int(piece.max(initial=0)) + 2))
        self.n = np.bincount(self.owner, minlength=len(self.ids))
        for v in self.short.values():
            self.n[v] += 1

    def _numbers(self, codes: np.ndarray, *, learn: bool = False) -> np.ndarray:
        """The number of the piece that begins at each place; pieces do not go over a line feed."""
        table = np.zeros(0x110000, np.int64)
        table[self.chars] = np.arange(1, len(self.chars) + 1)
        x = table[codes]
        halves, step = {1: x}, iter(self._pairs)
        for a, b in ((1, 1), (2, 2), (4, 4), (8, 4))[: 2 if self.size == 4 else 4]:
            n = max(len(codes) - (a + b) + 1, 0)
            one, two = halves[a][:n], halves[b][a : a + n]
            if learn:
                self._pairs.append(_Pairs(one, two))
            halves[a + b] = (self._pairs[-1] if learn else next(step))(one, two)
        return halves[self.size]

    def counts(self, keys: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(text, item, how many of the item's pieces the text holds) where there are any, texts by their places."""
        width, at = len(self.ids), 0
        while at < len(keys):
            part, held = [], 0
            while at + len(part) < len(keys) and (not part or held < SLICE and (len(part) + 1) * width <= COUNTS):
                part.append(keys[at + len(part)])
                held += len(part[-1]) + 1
            numbers = self._numbers(_codes("\n".join(part)))
            starts = np.cumsum([0] + [len(k) + 1 for k in part])
            hits = np.flatnonzero(numbers)
            one = np.unique((np.searchsorted(starts, hits, "right") - 1) * np.int64(len(self.first)) + numbers[hits])
            text, piece = one // len(self.first), one % len(self.first)
            # the owners of all pieces, one after another, in parts of bounded size
            size = self.first[piece + 1] - self.first[piece]
            total = np.zeros(len(part) * width, np.int64)
            ends = np.cumsum(size)
            low = 0
            while low < len(size):
                high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + COUNTS, "right")))
                n = size[low:high]
                own = self.owner[np.repeat(self.first[piece[low:high]] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
                total += np.bincount(np.repeat(text[low:high], n) * width + own, minlength=len(total))
                low = high
            for i, k in enumerate(part):
                if len(k) < self.size and k in self.short:
                    total[i * width + self.short[k]] += 1
            found = np.flatnonzero(total)
            yield found // width + at, found % width, total[found]
            at += len(part)

    def pairs(self, batches: Iterator[pa.RecordBatch], least: float, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """item, text, c and n of pairs with c / n of `least` or more, from batches of (text, key)."""
        ids = pa.array(self.ids, schema.field(0).type)
        for b in batches:
            for text, item, c in self.counts(b.column(1).to_pylist()):
                kept = c >= least * self.n[item] * (1 - 1e-9)
                item = item[kept]
                yield pa.record_batch([ids.take(pa.array(item)), b.column(0).take(pa.array(text[kept])), pa.array(c[kept]), pa.array(self.n[item])], schema=schema)

    def best(self, batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """item, c and n: most pieces that one text holds, from batches of (text, key)."""
        most = np.zeros(len(self.ids), np.int64)
        for b in batches:
            for _, item, c in self.counts(b.column(1).to_pylist()):
                np.maximum.at(most, item, c)
        found = np.flatnonzero(most)
        yield pa.record_batch([pa.array(self.ids, schema.field(0).type).take(pa.array(found)), pa.array(most[found]), pa.array(self.n[found])], schema=schema)
