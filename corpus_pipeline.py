"""Documents to training shards: language, near copies, benchmark passages, mixing, sharding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from longhouse.llm import common, decontaminate, langid, mixing, rtreejoin, sharding
from longhouse.session import scratch, stage

#: The language classifiers learn from documents outside this fold of doc_id's crc32.
FOLDS, HELD_OUT = 4, 2
SHARDS = 8


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have a language."""
    labelled = docs.where(common.crc_rest("doc_id", FOLDS) != HELD_OUT)
    return langid.keep_identified(docs, labelled)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: five-word shingles, a similarity of 0.8."""
    return rtreejoin.keep_one(docs, words=5, similar=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate.keep_clean(docs, common.table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources to the square root of their sizes, whole documents repeated, in random order."""
    return mixing.mix(docs).select(*docs.columns)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with shard, slot and curve index."""
    return sharding.hilbert_shards(docs, SHARDS)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language_id", language),
    ("ngram_jaccard_join", near_copies),
    ("benchmark_decontamination", decontamination),
    ("mixing", mixture),
    ("sharding", shards),
]

#: Models, components and crc32 have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each reads what the one before has written.

    What a stage itself has staged is deleted when its result is written.
    """
    docs = common.table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        with scratch(spark):
            docs = stage(apply(spark, docs, sf_dir), name, keep=True)
    return docs
