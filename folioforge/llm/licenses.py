"""License scans by diagonal voting.

Texts and templates are read as words.  All rolling word k-gram hashes of all texts are
joined with the templates' positions; what meets is compared word by word, and hits vote
for their diagonal (text position minus template position).  Neighbouring diagonals of a
text and a template whose spans touch, but for a few words, are merged, which bridges
words put in or left out; a merged span is scored by the share of the template's words
that its hits cover.

k is `GRAM` for templates with as many words and else the template's whole length, so a
base phrase is a template with one k-gram and its places are its verified spans.

The table of template k-grams has a fixed size, given by the templates here, so it is
broadcast, and the join needs no exchange.  A text's hashes come in runs of at most `RUN`,
so no row grows with the text; each run brings its words, which only hits look at.  A
run of its own stands for the text as such and meets a row of its own in the table.

Defined cases: null or empty text, or one without words: no words, no labels, score 0,
null first_word and last_word; repeated rows give repeated results; an empty table gives
no rows; other columns are left out.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._scratch import Scratch, keep
from ._words import NOT_ALNUM, buffer_of, joined, lists, slices, span_hashes, spans, window_hashes

GRAM = 4
RUN = 4096
SLACK = 3  # diagonals this near, with spans this near, are one span
TEXT_ITSELF = -1
COVER = 0.6

# Base phrases and their labels.
PHRASES = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]

# Opening words of published license notices.
NOTICES = [
    ("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0-notice", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("bsd-text", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa-4.0", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("mit-release", "Released under the MIT License"),
    ("isc-text", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]


@dataclass(frozen=True)
class Template:
    template_id: int
    label: str
    base: bool
    words: tuple[str, ...]

    @property
    def k(self) -> int:
        return min(GRAM, len(self.words))


def words_of(text: str | None) -> list[str]:
    """Lower-cases A-Z; letters and digits, and everything outside ASCII, make words."""
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


@functools.cache
def templates() -> tuple[Template, ...]:
    both = [(label, True, text) for text, label in PHRASES] + [(label, False, text) for label, text in NOTICES]
    return tuple(Template(k, label, base, tuple(words_of(text))) for k, (label, base, text) in enumerate(both))


def _hashes(words: list[str]) -> np.ndarray:
    raw = [w.encode() for w in words]
    ends = np.cumsum([len(x) for x in raw])
    return span_hashes(np.frombuffer(b"".join(raw), np.uint8), ends - np.array([len(x) for x in raw]), ends)


@functools.cache
def template_grams() -> tuple[tuple[int, int, int, int, str], ...]:
    """(hash, k, template, position, words) of every k-gram of every template."""
    out = []
    for t in templates():
        for p, h in enumerate(window_hashes(_hashes(list(t.words)), t.k).astype(np.int64).tolist()):
            out.append((h, t.k, t.template_id, p, " ".join(t.words[p : p + t.k])))
    return tuple(out)


def gram_runs(docs: DataFrame, ks: list[int]) -> DataFrame:
    """row, doc_id, n_words, k, first, words and hashes: the texts' rolling k-grams in runs, and a run with k = 0 for each text."""
    names = ["row", "doc_id", "n_words", "k", "first", "words", "hashes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, size=1 << 20):
            data, off = buffer_of(b.column("text"), lower=True)
            starts, ends, bounds = spans(data, off, NOT_ALNUM)
            h, n, size = span_hashes(data, starts, ends), np.diff(bounds), ends - starts
            plain, _ = joined(data, starts, ends, np.array([0, len(starts)]), np.ones(len(starts), bool))
            at = np.cumsum(size + 1) - (size + 1)
            rows = [np.arange(len(n))]
            kinds, firsts, words, counts, hashes = [np.zeros(len(n), np.int32)], [np.zeros(len(n), np.int64)], [b""] * len(n), [np.ones(len(n), np.int64)], [np.zeros(len(n), np.int64)]
            raw = plain.tobytes()
            for k in ks:
                grams = np.maximum(n - k + 1, 0)
                runs = -(-grams // RUN)
                row = np.repeat(np.arange(len(n)), runs)
                first = (np.arange(len(row)) - np.repeat(np.cumsum(runs) - runs, runs)) * RUN
                count = np.minimum(RUN, grams[row] - first)
                low = bounds[:-1][row] + first
                high = low + count + k - 2  # the last word
                words += [raw[x:y] for x, y in zip(at[low].tolist(), (at[high] + size[high]).tolist())]
                rows.append(row)
                kinds.append(np.full(len(row), k, np.int32))
                firsts.append(first)
                counts.append(count)
                every = window_hashes(h, k).astype(np.int64)
                hashes.append(every[np.repeat(low - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))])
            row, count = np.concatenate(rows), np.concatenate(counts)
            values = lists(np.concatenate(hashes), np.concatenate([[0], np.cumsum(count)]), pa.int64())
            take = pa.array(row)
            out = [b.column("row").take(take), b.column("doc_id").take(take), pa.array(n[row]), pa.array(np.concatenate(kinds)), pa.array(np.concatenate(firsts)), pa.array(words, pa.binary()).cast(pa.string()), values]
            whole = pa.RecordBatch.from_arrays(out, names=names)
            for low in range(0, whole.num_rows, 256):  # what one batch holds in the JVM
                yield whole.slice(low, 256)

    return docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "row long, doc_id long, n_words long, k int, first long, words string, hashes array<long>")


def gram_hits(docs: DataFrame) -> DataFrame:
    """row, doc_id, n_words, k, pos, template_id and at of every k-gram that stands in a template, and one row with TEXT_ITSELF for every text."""
    spark = docs.sparkSession
    table = [(0, 0, TEXT_ITSELF, 0, ""), *template_grams()]
    grams = F.broadcast(spark.createDataFrame(table, "hash long, k int, template_id int, at int, template_words string"))
    every = gram_runs(docs, sorted({t.k for t in templates()})).select("row", "doc_id", "n_words", "k", "first", "words", F.posexplode("hashes").alias("i", "hash"))
    own = F.when(F.col("k") > 0, F.array_join(F.slice(F.split("words", " "), F.col("i") + 1, F.col("k")), " ")).otherwise("")
    # Each begins with the other: as an equality this would become a join key and be computed for every k-gram.
    same = own.startswith(F.col("template_words")) & F.col("template_words").startswith(own)
    return every.join(grams, ["hash", "k"]).where(same).select("row", "doc_id", "n_words", "k", (F.col("first") + F.col("i")).alias("pos"), "template_id", "at")


def license_spans(hits: DataFrame, *, slack: int = SLACK, cover: float = COVER) -> DataFrame:
    """row, template_id, label, base, first_word, last_word (inclusive) and score of verified spans."""
    spark = hits.sparkSession
    kinds = F.broadcast(spark.createDataFrame([(t.template_id, t.label, t.base, len(t.words)) for t in templates()], "template_id int, label string, base boolean, size int"))
    votes = hits.where(F.col("template_id") != TEXT_ITSELF)
    diagonal = ["row", "template_id", (F.col("pos") - F.col("at")).alias("diagonal")]
    lines = votes.groupBy(*diagonal).agg(
        F.count("*").alias("votes"), F.min("pos").alias("low"), F.max(F.col("pos") + F.col("k") - 1).alias("high"), F.collect_set(F.struct("at", "k")).alias("held")
    )
    order = Window.partitionBy("row", "template_id").orderBy("diagonal", "low")
    # A base phrase is one k-gram: each of its diagonals is a place of its own and is not merged.
    lines = lines.join(kinds, "template_id")
    before = lambda c: F.lag(c).over(order)
    touch = (F.col("low") <= before("high") + slack + 1) & (F.col("high") >= before("low") - slack - 1)
    apart = F.col("base") | before("diagonal").isNull() | (F.col("diagonal") - before("diagonal") > slack) | ~touch
    merged = lines.withColumn("span", F.sum(apart.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    spans_ = merged.groupBy("row", "template_id", "span", "label", "base", "size").agg(F.sum("votes").alias("votes"), F.min("low").alias("first_word"), F.max("high").alias("last_word"), F.flatten(F.collect_list("held")).alias("held"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("held", lambda x: F.sequence(x["at"], x["at"] + x["k"] - 1)))))
    return spans_.withColumn("score", F.round(covered / F.col("size"), 6)).where(F.col("score") >= cover).drop("held", "size", "span")


def license_labels(docs: DataFrame, *, slack: int = SLACK, cover: float = COVER) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of every row."""
    with Scratch(docs.sparkSession) as scratch:
        hits = scratch.table(gram_hits(docs), "hits")
        spans_ = license_spans(hits, slack=slack, cover=cover)
        found = scratch.table(
            spans_.groupBy("row").agg(
                F.count_if("base").alias("n_base"),
                F.min(F.when(F.col("base"), F.col("first_word"))).alias("first_word"),
                F.max(F.when(F.col("base"), F.col("first_word"))).alias("last_word"),
                F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
                F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
                F.max("score").alias("score"),
            ),
            "found",
        )
        none = {"n_base": 0, "base_labels": "", "labels": "", "score": 0.0}
        texts = hits.where(F.col("template_id") == TEXT_ITSELF).select("row", "doc_id", "n_words")
        return keep(texts.join(found, "row", "left").drop("row").fillna(none).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"))
