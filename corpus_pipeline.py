"""A training corpus from documents: toxic texts go, then exact copies, near copies and repeated passages; the rest is packed."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from folioforge.llm._scratch import Scratch
from folioforge.llm.minhash import drop_near_copies
from folioforge.llm.naming import drop_copies
from folioforge.llm.packing import pack
from folioforge.llm.seeds import cut_repeats
from folioforge.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies (five words, 0.8 or more) the one with the smallest doc_id."""
    return drop_near_copies(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of windows of 20 words that stand earlier."""
    return cut_repeats(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1,024 tokens."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), length=1024)


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup), ("packing", packing)]

#: Learned weights, components and a packing heuristic are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another, each on the written result of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with Scratch(spark) as scratch:
        for k, (name, stage) in enumerate(STAGES):
            docs = stage(spark, docs, sf_dir)
            if k < len(STAGES) - 1:
                docs = scratch.table(docs, name)
                if k:
                    scratch.drop(STAGES[k - 1][0])
    return docs  # the last stage's result is checkpointed
