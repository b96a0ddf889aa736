"""Alignment of two readings: matching blocks and ratio of the standard library's matcher.

Its measure is neither an edit distance nor a longest common subsequence, so it has no
built-in form; rows go to Python in Arrow batches.  Texts are aligned word by word and
counted in characters, which keeps whole texts affordable.  It is quadratic at worst:
callers pair only what blocking keys bring together.
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def matched(a: str, b: str) -> tuple[int, float, int]:
    """Characters in matching words, the ratio 2 * matched / both, and the longer side's characters."""
    x, y = a.split(), b.split()
    n = sum(len(w) for m in SequenceMatcher(None, x, y, autojunk=False).get_matching_blocks() for w in x[m.a : m.a + m.size])
    p, q = sum(map(len, x)), sum(map(len, y))
    return n, 2 * n / (p + q) if p + q else 1.0, max(p, q)


def substitutions(a: str, b: str) -> list[tuple[str, str]]:
    """Characters replaced inside words of equal length, in order."""
    x, y, out = a.split(), b.split(), []
    for tag, i, j, k, m in SequenceMatcher(None, x, y, autojunk=False).get_opcodes():
        if tag == "replace" and j - i == m - k:
            out += [(c, d) for v, w in zip(x[i:j], y[k:m]) if len(v) == len(w) for c, d in zip(v, w) if c != d]
    return out


def page_errors(golden: str, read: str) -> int:
    """Errors of a reading in characters: each stretch of words that differs costs its longer side."""
    x, y = golden.split(), read.split()
    size = lambda w: sum(map(len, w))
    return sum(max(size(x[i:j]), size(y[k:m])) for tag, i, j, k, m in SequenceMatcher(None, x, y, autojunk=False).get_opcodes() if tag != "equal")


def agreement(a: Column, b: Column) -> Column:
    """Struct of the matched characters, the ratio and the share of the longer side."""

    @F.pandas_udf("matched long, ratio double, share double")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for x, y in batches:
            rows = [matched(p or "", q or "") for p, q in zip(x, y)]
            yield pd.DataFrame([(n, r, n / m if m else 1.0) for n, r, m in rows], columns=["matched", "ratio", "share"])

    return run(a, b)


def substitution_pairs(a: Column, b: Column) -> Column:
    @F.pandas_udf("array<struct<a:string,b:string>>")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([[{"a": p, "b": q} for p, q in substitutions(s or "", t or "")] for s, t in zip(x, y)], dtype=object)

    return run(a, b)


def errors_against(golden: Column, read: Column) -> Column:
    @F.pandas_udf("long")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([page_errors(s or "", t or "") for s, t in zip(x, y)], dtype="int64")

    return run(golden, read)
