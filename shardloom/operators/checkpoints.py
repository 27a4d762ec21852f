"""Checkpoints: one per full shard, their latest, and where a run resumes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.functions.naming import (
    CHECKPOINT_SUFFIX,
    checkpoint_id,
    checkpoint_name,
    checkpoint_value,
    parse_checkpoint,
)
from shardloom.operators.packing import SHARD_SIZE, shard_slices
from shardloom.sources.objects import read_text_objects, write_text_objects
from shardloom.sources.paths import exists

CHECKPOINT_SCHEMA = "shard_id bigint, doc_id string, docs_consumed bigint, updated timestamp"


def checkpoint_log(manifest: DataFrame, shard_size: int = SHARD_SIZE) -> DataFrame:
    """For every full shard the document that reached its cut and the documents consumed."""
    return manifest.filter(F.col("n_tokens") == shard_size).select(
        "shard_id", F.col("last_doc").alias("doc_id"), "docs_consumed"
    )


def latest_checkpoint(checkpoints: DataFrame) -> DataFrame:
    """One row: the checkpoint updated last, the larger shard on a tie.

    Without any checkpoint the row says shard -1 and no documents: a fresh start.
    """
    last = F.max_by(F.struct("*"), F.struct("updated", "shard_id"))
    return checkpoints.agg(last.alias("last")).select(
        F.coalesce("last.shard_id", F.lit(-1).cast("bigint")).alias("shard_id"),
        F.col("last.doc_id").alias("doc_id"),
        F.coalesce("last.docs_consumed", F.lit(0).cast("bigint")).alias("docs_consumed"),
    )


def append_checkpoint(log: DataFrame, path: str) -> None:
    """Add checkpoint rows, stamped with the time of the append, to the table at ``path``."""
    log.select(
        "shard_id",
        F.col("doc_id").cast("string").alias("doc_id"),
        "docs_consumed",
        F.current_timestamp().alias("updated"),
    ).write.mode("append").parquet(path)


def read_checkpoints(spark: SparkSession, path: str) -> DataFrame:
    if not exists(path):
        return spark.createDataFrame([], CHECKPOINT_SCHEMA)
    return spark.read.schema(CHECKPOINT_SCHEMA).parquet(path)


def write_text_checkpoints(log: DataFrame, path: str, with_docs: bool = True) -> int:
    """Write a log as objects ``checkpoints/<doc id>.txt`` holding ``shard:docs``, or ``shard``.

    A document that reaches several cuts has one object, for the last of them. A column
    ``updated`` of the log becomes the objects' time where the store allows that.
    """
    last = F.max_by(F.struct("*"), "shard_id").alias("last")
    rows = log.groupBy("doc_id").agg(last).select("last.*")
    value = checkpoint_value(F.col("shard_id"), F.col("docs_consumed"))
    objects = rows.select(
        checkpoint_name(F.col("doc_id")).alias("name"),
        (value if with_docs else F.col("shard_id").cast("string")).alias("value"),
        *(["updated"] if "updated" in log.columns else []),
    )
    return write_text_objects(objects, path)


def read_text_checkpoints(spark: SparkSession, path: str) -> DataFrame:
    """Checkpoints kept as objects ``<doc id>.txt`` holding ``shard:docs`` or ``shard``."""
    shard, docs = parse_checkpoint(F.col("value"))
    return read_text_objects(spark, path, CHECKPOINT_SUFFIX).select(
        shard.alias("shard_id"),
        checkpoint_id(F.col("name")).alias("doc_id"),
        docs.alias("docs_consumed"),
        "updated",
    )


def resume_slices(
    offsets: DataFrame, after_shard: int, shard_size: int = SHARD_SIZE
) -> DataFrame:
    """The slices still to write when shards up to ``after_shard`` are done.

    Exact: the tail of the document at the cut belongs to the next shard and is kept.
    """
    edge = (after_shard + 1) * shard_size
    return shard_slices(offsets.filter(F.col("end") > edge), shard_size).filter(
        F.col("shard_id") > after_shard
    )
