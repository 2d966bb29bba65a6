"""From raw documents to packed sequences: quality, near-duplicates, repeated passages, mixture, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next stage's ``docs``; all but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterline.llm import mixing, near, packing, quality, substring
from meterline.llm.queries import MIX_WEIGHTS, domain, table, tokenizer
from meterline.plans.cluster import Scratch

#: Share of the tokens left that the mixture takes; a document is taken once at most.
MIX_BUDGET = 0.8


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject (score of 0.3 or more)."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each near-duplicate group (five words, 0.8)."""
    return near.without_near_duplicates(docs)


def fresh(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 20 words and more that start earlier in the corpus."""
    return substring.without_repeats(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A seeded selection whose tokens follow the target weights of domains and languages."""
    got = mixing.mix(docs, MIX_WEIGHTS, domain(), budget=MIX_BUDGET, epochs=1)
    return got.where("epochs_ > 0 or partial_").select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces placed in sequences of at most 2048 tokens."""
    return packing.pack(docs, tokenizer())


STAGES = [("quality", good), ("near-dedup", distinct), ("substring-dedup", fresh), ("mixing", mixed), ("packing", packed)]

#: The classifier, the mixture and the packing cannot be written in SQL; tests/llm/test_pipeline.py holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; every stage's result but the last is written and read again."""
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
