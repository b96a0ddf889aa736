"""Streams: loops at the end of growing texts, and progress."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.loops import TailRule, tail_loop

FOUND = "stream long, at_char long, period long, copies double, repeated long"
STATE = "text string, pending string, seq long"


def watch_loops(pieces: DataFrame, rule: TailRule = TailRule()) -> DataFrame:
    """The first loop of each stream of text pieces (stream, seq, piece).

    The text is looked at whenever `step` new characters have come since the last look.
    A found loop is kept and reported once; from then on the stream's state is a mark
    only.  How far the repetition reaches back is unbounded, so the text is kept until then.
    """

    def update(key: tuple[Any, ...], batches: Iterator[pd.DataFrame], state: Any) -> Iterator[pd.DataFrame]:
        text, pending, seq = state.get if state.exists else ("", "", -1)
        if seq == -2:  # a loop was found before
            for _ in batches:
                pass
            return
        rows = pd.concat(list(batches)).sort_values("seq")
        for n, piece in zip(rows["seq"], rows["piece"]):
            pending, seq = pending + (piece or ""), int(n)
            if len(pending) >= rule.step:
                text, pending = text + pending, ""
                found = tail_loop(text, rule)
                if found:
                    state.update(("", "", -2))
                    yield pd.DataFrame({"stream": [key[0]], "at_char": [len(text)], "period": [found[0]], "copies": [found[1]], "repeated": [found[2]]})
                    return
        state.update((text, pending, seq))

    return pieces.groupBy("stream").applyInPandasWithState(update, FOUND, STATE, "append", "NoTimeout")


def progress(events: DataFrame) -> DataFrame:
    """Running counts by kind; on a stream, in update or complete mode."""
    return events.groupBy("event_type").agg(F.count("*").alias("events"), F.max("event_id").alias("last_id"))
