"""Clean, mix and shard ``documents``: python corpus_pipeline.py <folder of the tables> <output>.

Every stage is one operator.  It gets what the stage before kept, written as Parquet, and all
but the last return the columns of ``documents``.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession

from cellscope.llm import decontaminate, mixing, rules, sharding, simhash
from cellscope.sources import stage_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor a certified cutoff rejects."""
    return rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of linked fingerprints."""
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The copies that the curriculum takes, in training order."""
    return mixing.training_stream(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row with its shard and its slot in the shard."""
    return sharding.interleave(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mix", source_mix),
    ("shards", shards),
]

# the fingerprints of the second stage are 64-bit XXH64 votes, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


if __name__ == "__main__":
    session = SparkSession.builder.appName("corpus").getOrCreate()
    run(session, sys.argv[1]).write.partitionBy("shard").parquet(sys.argv[2])
