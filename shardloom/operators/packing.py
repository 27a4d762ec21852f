"""Cutting the token stream into shards, and bringing each shard's tokens together."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shardloom.functions.naming import ThreeWay, TwoWay, with_layout

SHARD_SIZE = 100_000_000

# Cuts sent to the tasks: 48 bytes each, so 48 MB at most. A longer list is
# worked off in rounds, each scanning only its own span of positions.
MAX_BROADCAST_CUTS = 1 << 20

# Tokens that one task assembles and writes at most, but for shards that are larger: 1 GB of file.
TASK_TOKENS = 1 << 28

CUT_COLUMNS = ["shard_id", "first_pos", "first_from", "last_pos", "last_to", "n_tokens"]


def shard_slices(offsets: DataFrame, shard_size: int = SHARD_SIZE) -> DataFrame:
    """One row per document and shard it touches.

    Tokens ``[doc_from, doc_to)`` of the document are shard ``shard_id``'s tokens from
    ``shard_offset`` on. A document may span any number of shards; one without tokens has
    no slice.
    """
    size = F.lit(shard_size).cast("bigint")
    touched = F.sequence(_div("start", shard_size), _div("end - 1", shard_size))
    edge = F.col("shard_id") * size
    return (
        offsets.filter(F.col("n") > 0)
        .withColumn("shard_id", F.explode(touched))
        .withColumn("doc_from", F.greatest(edge - F.col("start"), F.lit(0)))
        .withColumn("doc_to", F.least(edge + size - F.col("start"), F.col("n")))
        .withColumn("shard_offset", F.greatest(F.col("start") - edge, F.lit(0)))
    )


def shard_manifest(
    offsets: DataFrame,
    shard_size: int = SHARD_SIZE,
    layout: ThreeWay | TwoWay = ThreeWay(),
) -> DataFrame:
    """One row per shard: name, split, size, documents, and the exact cuts at both ends.

    ``first_from``/``last_to`` are token offsets inside the first and last document;
    ``docs_consumed`` counts the documents up to and including the last one.
    """
    by_pos = {"first": F.min_by, "last": F.max_by}
    shards = (
        shard_slices(offsets, shard_size)
        .groupBy("shard_id")
        .agg(
            F.sum(F.col("doc_to") - F.col("doc_from")).alias("n_tokens"),
            F.count("*").alias("n_docs"),
            (F.max("ordinal") + 1).alias("docs_consumed"),
            F.min("pos").alias("first_pos"),
            F.max("pos").alias("last_pos"),
            F.min_by("doc_from", "pos").alias("first_from"),
            F.max_by("doc_to", "pos").alias("last_to"),
            *[pick("id", "pos").alias(f"{end}_doc") for end, pick in by_pos.items()],
        )
    )
    return with_layout(shards, layout)


def progress(manifest: DataFrame, shard_size: int = SHARD_SIZE) -> DataFrame:
    """Documents and tokens placed, shards filled, and the fill of the one left open."""
    full = F.col("n_tokens") == shard_size
    return manifest.agg(
        F.coalesce(F.max("docs_consumed"), F.lit(0)).alias("documents"),
        F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("tokens"),
        F.count_if(full).alias("full_shards"),
        F.coalesce(F.sum(F.when(~full, F.col("n_tokens"))), F.lit(0)).alias("open_tokens"),
    )


def observed(tokens: DataFrame, name: str = "progress") -> tuple[DataFrame, Observation]:
    """``tokens`` and the documents and tokens counted as an action passes over them."""
    counts = Observation(name)
    rows = tokens.observe(counts, F.count("*").alias("documents"), F.sum("n").alias("tokens"))
    return rows, counts


def shard_tokens(
    tokens: DataFrame, cuts: DataFrame, codec, keep: tuple[str, ...] = ()
) -> DataFrame:
    """The shards in ``cuts``, assembled: ordered ``(shard_id, pos, n_tokens, *keep, payload)``.

    ``tokens`` is a tokenized corpus ``(pos, id, n, body)``, ``cuts`` any rows of its
    manifest. One shuffle moves each wanted token range once, still in compact form;
    documents outside the wanted shards are dropped before it. Every shard is whole and in
    order inside one partition, and partitions get equally many shards; their number grows
    with the tokens (``TASK_TOKENS``), whatever ``spark.sql.shuffle.partitions`` says.
    """
    wanted = cuts.select(*CUT_COLUMNS)
    table = _collected(wanted.limit(MAX_BROADCAST_CUTS + 1))
    if len(table) <= MAX_BROADCAST_CUTS:
        return _assemble(tokens, table, codec, keep)
    low, high = wanted.agg(F.min("shard_id"), F.max("shard_id")).first()
    rounds = [
        F.col("shard_id").between(at, at + MAX_BROADCAST_CUTS - 1)
        for at in range(low, high + 1, MAX_BROADCAST_CUTS)
    ]
    return reduce(
        DataFrame.union,
        [_assemble(tokens, _collected(wanted.filter(part)), codec, keep) for part in rounds],
    )


def _collected(cuts: DataFrame) -> np.ndarray:
    """Cuts by rising shard id, one column per name in ``CUT_COLUMNS``."""
    table = np.array([tuple(row) for row in cuts.collect()], np.int64)
    table = table.reshape(-1, len(CUT_COLUMNS))
    return table[np.argsort(table[:, 0], kind="stable")]


def _assemble(
    tokens: DataFrame, table: np.ndarray, codec, keep: tuple[str, ...]
) -> DataFrame:
    spark = tokens.sparkSession
    parallel = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism
    )
    tasks = -(-int(table[:, -1].sum()) // TASK_TOKENS)
    parts = max(1, min(len(table), max(parallel, tasks)))
    # The span of the wanted shards, for the scan; nothing is wanted from an empty list.
    span = F.col("pos").between(int(table[0, 1]), int(table[-1, 3])) if len(table) else F.lit(False)
    place = placement(spark, table, parts)
    lo, hi = F.col("at.lo"), F.coalesce("at.hi", "n")
    return (
        tokens.filter(span)
        .select("pos", "n", *keep, "body", F.explode(place("pos")).alias("at"))
        .select(
            "at.part", "at.shard_id", "pos", "at.n_tokens", "at.lo", *keep,
            codec.cut(F.col("body"), lo, hi).alias("cut"),
        )
        .repartitionById(parts, F.col("part"))
        .sortWithinPartitions("shard_id", "pos")
        .select(
            "shard_id", "pos", "n_tokens", *keep,
            codec.payload(F.col("cut"), F.col("lo")).alias("payload"),
        )
    )


def placement(spark: SparkSession, table: np.ndarray, parts: int):
    """A function from ``pos`` to the wanted shards the document touches.

    ``table`` holds ``CUT_COLUMNS`` by rising shard id. Both ends of a shard rise with its
    id, so two binary searches find the first and the last shard. ``lo`` and ``hi`` bound
    the document's tokens in a shard; a null ``hi`` is the document's end.
    """
    shared = spark.sparkContext.broadcast(table)

    @F.arrow_udf("array<struct<part:int,shard_id:bigint,n_tokens:bigint,lo:bigint,hi:bigint>>")
    def place(pos: pa.Array) -> pa.Array:
        shard_id, first_pos, first_from, last_pos, last_to, n_tokens = shared.value.T
        at = pos.to_numpy()
        first = np.searchsorted(last_pos, at, side="left")
        count = np.maximum(np.searchsorted(first_pos, at, side="right") - first, 0)
        bounds = np.concatenate([[0], np.cumsum(count)])
        row = np.repeat(np.arange(len(at)), count)
        pick = first[row] + np.arange(bounds[-1]) - bounds[row]
        begins_before = first_pos[pick] == at[row]
        ends_here = last_pos[pick] == at[row]
        places = pa.StructArray.from_arrays(
            [
                pa.array(pick * parts // len(shard_id), pa.int32()),
                pa.array(shard_id[pick]),
                pa.array(n_tokens[pick]),
                pa.array(np.where(begins_before, first_from[pick], 0)),
                pa.array(last_to[pick], mask=~ends_here),
            ],
            names=["part", "shard_id", "n_tokens", "lo", "hi"],
        )
        return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), places)

    return place


def _div(expression: str, shard_size: int) -> Column:
    # Integer division: floor(a / b) would go through DOUBLE.
    return F.expr(f"(({expression}) div {int(shard_size)}L)")
