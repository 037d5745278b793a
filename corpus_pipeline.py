"""From raw documents to training shards: five stages, each on everything that the one before it kept.

Each stage takes (spark, docs, sf_dir). All but the last return the columns of ``documents``; the last adds ``shard``.
Null texts, repeated rows and empty tables are handled by the operators as their modules say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedloom.llm import leaks, mixing, quality, sharding, simhash
from feedloom.llm.common import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the least id stays."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark go, and documents that are mostly such passages."""
    return leaks.clean(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the weights of their sources ask for."""
    return mixing.mixed(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with the name of its shard."""
    return sharding.with_shard(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("source_mixing", source_mixing),
    ("extendible_sharding", sharding_stage),
]

#: Fingerprints and the tests behind the quality cutoffs are not expressible; tests compare with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
