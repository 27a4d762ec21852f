"""A corpus from raw documents to sharded training data, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as
Parquet and reread as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.llm import decontaminate, mixing, near_dedup, quality, sharding
from shardloom.llm.tables import clear_name, kept, quoted


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no rule of the policy."""
    return quality.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the least id."""
    return near_dedup.without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, none up to three times."""
    copies, copy = clear_name(docs, "_copies"), clear_name(docs, "_copy")
    mixed = mixing.mix(docs)
    times = mixed.withColumn(copies, F.when(F.col("size") > 0, F.col("taken") / F.col("size")).cast("int"))
    repeated = times.filter(F.col(copies) > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), copies)))
    return repeated.select(*map(quoted, docs.columns))


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard and its place there."""
    return sharding.shard(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing", mixture),
    ("sharding", shards),
]

# Fitting a word budget as a subset sum and the checksums of the last stage are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
