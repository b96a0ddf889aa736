"""Common runs and rising chains, which have no built-in form."""

from __future__ import annotations

from bisect import bisect_left
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def common_run(a: Column, b: Column) -> Column:
    """The longest text that stands in both, the first in `a` of equally long ones."""

    @F.pandas_udf("string")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        out = []
        for p, q in zip(x, y):
            p, q = p or "", q or ""
            m = SequenceMatcher(None, p, q, autojunk=False).find_longest_match()
            out.append(p[m.a : m.a + m.size])
        return pd.Series(out, dtype=object)

    return run(a, b)


def is_subsequence(part: Column, whole: Column) -> Column:
    """Whether all characters of `part` stand in `whole` in order, with anything between them."""
    left = F.aggregate(F.split(whole, ""), part, lambda rest, ch: F.when((rest != "") & (F.left(rest, F.lit(1)) == ch), F.substr(rest, F.lit(2))).otherwise(rest))
    return left == ""


def rising_chain(values: list[int]) -> list[int]:
    """Places of a longest strictly rising chain; of several the one whose last values are least."""
    tails: list[int] = []
    ends: list[int] = []
    before = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tails, v)
        before[i] = ends[k - 1] if k else -1
        tails[k : k + 1], ends[k : k + 1] = [v], [i]
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def chain_places(values: Column) -> Column:
    """`rising_chain` of an array: places from 0."""

    @F.pandas_udf("array<long>")
    def run(x: pd.Series) -> pd.Series:
        return pd.Series([rising_chain(list(v)) if v is not None else [] for v in x], dtype=object)

    return run(values)
