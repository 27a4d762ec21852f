"""Ordered corpus scans: every row gets a unique BIGINT ``pos`` that fixes its place."""

from __future__ import annotations

import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, ShortType

from shardloom.operators.rows import take
from shardloom.session import written

SOURCE_ORDER = "source"

# What a stream carries in place of file metadata, in the order files and rows arrived.
ARRIVAL_COLUMNS = ("source_time", "source_path", "source_row")

# A file's rows take the low bits of the position, the file's rank the high ones.
ROW_BITS = 40

# Fingerprints of paths tried, until one tells all apart.
SEEDS = 8

# Fixed value: how many low bits of monotonically_increasing_id count rows.
PARTITION_ROW_BITS = 33

# So many files have a rank: what is left of a position's bits. Their fingerprints and ranks are
# broadcast, 16 bytes each, 134 MB at most.
MAX_FILES = 1 << (63 - ROW_BITS)


def corpus(
    spark: SparkSession,
    path: str | Sequence[str],
    id_col: str = "id",
    text_col: str = "text",
    order_by: str | Sequence[str] | None = SOURCE_ORDER,
    glob: str | None = None,
    limit: int | None = None,
    span: tuple[int, int] | None = None,
) -> DataFrame:
    """``(pos, id, text)`` of a Parquet corpus, whole or only its first ``limit`` rows.

    ``path`` may be a sub-corpus folder, one dump's folder, a glob or several of these.
    ``order_by`` is ``"source"`` (file path, then row), column names, or ``None`` for
    arrival order (see :func:`positioned`). ``span`` keeps the positions between two, both
    included; in source order files outside it are not opened.
    """
    reader = spark.read
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    df = reader.parquet(*([path] if isinstance(path, str) else path))
    keep = [F.col(id_col).alias("id"), F.col(text_col).alias("text")]
    if order_by == SOURCE_ORDER:
        df = _source_positions(df, keep, span)
    else:
        df = positioned(df, order_by, keep)
    if span is not None:
        df = df.filter(F.col("pos").between(*span))
    return df if limit is None else take(df, limit)


def positioned(
    df: DataFrame,
    order_by: str | Sequence[str] | None,
    keep: Sequence[Column | str] = ("*",),
    path: str | None = None,
) -> DataFrame:
    """Add ``pos`` to the columns in ``keep``.

    * one integral column: it is the position itself, so filters on it reach the scan;
    * ``"source"``: ``rank of the file << 40 | row in the file``, no sort and no shuffle;
    * anything else: the row's place in the sorted corpus, by one range-partitioned sort that
      is written once; equal keys are ordered by the kept columns, texts last, so runs agree;
    * ``None``: the order rows happen to arrive in, written once for the same reason.

    ``path`` is where rows are written, the scratch folder by default.
    """
    if order_by is None:
        arrived = df.select(F.monotonically_increasing_id().alias("pos"), *keep)
        return written(arrived, "arrival", path)
    if order_by == SOURCE_ORDER:
        if not set(ARRIVAL_COLUMNS) <= set(df.columns):
            return _source_positions(df, keep)
        order_by = ARRIVAL_COLUMNS
    names = [order_by] if isinstance(order_by, str) else list(order_by)
    if len(names) == 1 and isinstance(
        df.schema[names[0]].dataType, (LongType, IntegerType, ShortType)
    ):
        return df.select(F.col(names[0]).cast("bigint").alias("pos"), *keep)
    return _sorted_positions(df, names, keep, path)


def _sorted_positions(
    df: DataFrame, names: Sequence[str], keep: Sequence[Column | str], path: str | None
) -> DataFrame:
    keys = [f"_key{i}" for i in range(len(names))]
    keyed = df.select(*[F.col(n).alias(k) for n, k in zip(names, keys, strict=True)], *keep)
    # The splitters are sampled over all sort columns and what else tells rows apart, so that a
    # frequent key, or one key for all, is cut as finely as any other. Texts stay out of them.
    apart = [name for name in keyed.columns if name not in (*keys, "text")]
    ranged = keyed.repartitionByRange(*keys, *apart).sortWithinPartitions(*keys, *apart, *_texts(keyed))
    numbered = ranged.drop(*keys).select(F.monotonically_increasing_id().alias("_at"), "*")
    ordered = written(numbered, "sorted", path)
    # The id is a partition number and a row number; partitions follow each other in key
    # order, so their sizes, one row each, turn it into the place in the whole corpus.
    part = F.shiftright("_at", PARTITION_ROW_BITS)
    sizes = ordered.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_base"))
    row = F.col("_at").bitwiseAND((1 << PARTITION_ROW_BITS) - 1)
    # A row for each partition of the sort.
    return ordered.join(F.broadcast(bases), part == F.col("_part")).select(
        (F.col("_base") + row).alias("pos"), *[name for name in ordered.columns if name != "_at"]
    )


def _texts(df: DataFrame) -> list[str]:
    return [name for name in df.columns if name == "text"]


def _source_positions(
    df: DataFrame, keep: Sequence[Column | str], span: tuple[int, int] | None = None
) -> DataFrame:
    paths = ranked_files(df)
    if span is not None and paths:
        low, high = (min(max(pos >> ROW_BITS, 0), len(paths) - 1) for pos in span)
        df = df.filter(_listed("_metadata.file_path").between(paths[low], paths[high]))
    ranks, seed = file_ranks(df.sparkSession, paths)
    placed = df.select(
        F.xxhash64(_listed("_metadata.file_path"), F.lit(seed)).alias("_file"),
        F.col("_metadata.row_index").alias("_row"), *keep,
    )
    kept = [name for name in placed.columns if name not in ("_file", "_row")]
    unlisted = F.raise_error(F.lit("a row of a file that was not listed")).cast("bigint")
    pos = F.shiftleft(F.coalesce("_rank", unlisted), ROW_BITS) + F.col("_row")
    return placed.join(F.broadcast(ranks), "_file", "left").select(pos.alias("pos"), *kept)


def _listed(path: str) -> Column:
    """A row's file as the listing names it: local ones with three slashes, not one."""
    return F.regexp_replace(path, "^file:/+", "file:///")


def ranked_files(df: DataFrame) -> list[str]:
    """The input's files in path order, from its listing; no row is read."""
    listed = {re.sub("^file:/+", "file:///", path) for path in df.inputFiles()}
    paths = sorted(listed, key=lambda path: path.encode())
    if len(paths) >= MAX_FILES:
        raise ValueError(f"{len(paths)} files, but positions hold the ranks of {MAX_FILES - 1} only: merge files")
    return paths


def file_ranks(spark: SparkSession, paths: Sequence[str]) -> tuple[DataFrame, int]:
    """``(_file, _rank)``: a fingerprint of each path and its place, and the fingerprint's seed.

    The seed is one under which no two paths agree, nearly always the first.
    """
    listed = spark.createDataFrame(
        pa.table({"_path": pa.array(paths, pa.string()), "_rank": pa.array(range(len(paths)), pa.int64())})
    )
    for seed in range(SEEDS):
        ranks = listed.select(F.xxhash64("_path", F.lit(seed)).alias("_file"), "_rank")
        if len(paths) < 2 or ranks.agg(F.count_distinct("_file")).first()[0] == len(paths):
            return ranks, seed
    raise ValueError("paths could not be told apart by fingerprints")


def corpus_stream(
    spark: SparkSession, path: str, schema, max_files: int = 16, glob: str | None = None
) -> DataFrame:
    """The corpus as files arrive, ``max_files`` of them per micro-batch, oldest first.

    ``ARRIVAL_COLUMNS`` are added; give a ``schema`` of just the columns needed.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path).select(
        "*",
        F.col("_metadata.file_modification_time").alias("source_time"),
        F.col("_metadata.file_path").alias("source_path"),
        F.col("_metadata.row_index").alias("source_row"),
    )
