"""How much of each line of a page the page before already holds, in pieces of four characters.

The comparison needs no join of pieces: a page has one predecessor, so both texts come to
one row and the pieces are numbered inside it.  Pairs of characters get dense numbers,
two of these make a piece's number, so numbers are equal exactly when pieces are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

BREAK = 10
# Texts whose shares are Python objects at once.
ROWS = 200


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _runs(codes: np.ndarray) -> list[tuple[int, int]]:
    """First and last + 1 of every line."""
    ends = np.append(np.flatnonzero(codes == BREAK), len(codes))
    return list(zip(np.append(0, ends[:-1] + 1).tolist(), ends.tolist()))


def line_shares(keys: str, before: str) -> list[float | None]:
    """For each line of `keys` the share of its distinct pieces that stand in `before`.

    A line of two or three characters is one piece, which stands in `before` only if it is
    all of it; a shorter one has no pieces and no share.
    """
    own, old = _codes(keys), _codes(before)
    lines = _runs(own)
    shares: list[float | None] = [None] * len(lines)
    both = np.concatenate([own, np.array([BREAK], np.uint64), old])
    if len(both) >= 4:
        _, pair = np.unique((both[:-1] << np.uint64(32)) | both[1:], return_inverse=True)
        _, piece = np.unique((pair[:-2].astype(np.uint64) << np.uint64(32)) | pair[2:].astype(np.uint64), return_inverse=True)
        held = np.zeros(int(piece.max()) + 1, bool)
        if len(old) >= 4:
            held[piece[len(own) + 1 :]] = True
        for i, (a, b) in enumerate(lines):
            if b - a >= 4:
                found = np.unique(piece[a : b - 3])
                shares[i] = float(np.count_nonzero(held[found]) / len(found))
    for i, (a, b) in enumerate(lines):
        if b - a in (2, 3):
            shares[i] = float(np.array_equal(own[a:b], old))
    return shares


def held_shares(keys: Column, before: Column) -> Column:
    """`line_shares` of columns: comparison keys of lines, joined by line feeds, and the key of the page before."""

    # texts stay in the Arrow batch and become strings one by one
    @F.arrow_udf("array<double>")
    def run(x: pa.Array, y: pa.Array) -> pa.Array:
        parts = [pa.array([], kind)]
        for k in range(0, len(x), ROWS):
            parts.append(pa.array([line_shares(p.as_py() or "", q.as_py() or "") for p, q in zip(x[k : k + ROWS], y[k : k + ROWS])], kind))
        return pa.concat_arrays(parts)

    kind = pa.list_(pa.float64())

    return run(keys, before)
