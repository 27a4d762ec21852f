"""Row-level operators over a corpus with an order key: filter, skip, take, seek, map, count."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.operators.offsets import exclusive_totals

# Buckets that a step of a search for the n-th key counts, at most one more.
BUCKET_BITS = 16


def filter_contains(df: DataFrame, needle: str, text_col: str = "text") -> DataFrame:
    return df.filter(F.col(text_col).contains(needle))


def filter_rows(df: DataFrame, predicate: Column) -> DataFrame:
    return df.filter(predicate)


def numbered(df: DataFrame, pos: str = "pos") -> DataFrame:
    """Add ``ordinal``, each row's place in ``pos`` order, counted from 0."""
    counted = df.withColumn("_one", F.lit(1).cast("bigint"))
    return exclusive_totals(counted, pos, {"ordinal": "_one"}).drop("_one")


def nth_position(df: DataFrame, n: int, pos: str = "pos") -> int | None:
    """The position of row ``n``, counted from 0; None when there are not that many rows.

    Counts keys by their leading bits, goes on inside the bucket that holds row ``n``, and so
    on: the key column alone is read, a few times at most, later steps read their span of it,
    and no task and not the driver holds more than ``2^BUCKET_BITS`` counts.
    """
    keys = df.select(F.col(pos).cast("bigint").alias("k")).filter(F.col("k").isNotNull())
    low, high, total = keys.agg(F.min("k"), F.max("k"), F.count("k")).first()
    if n >= total:
        return None
    while low < high:
        shift = max(0, (high - low).bit_length() - BUCKET_BITS)
        inside = keys.filter(F.col("k").between(low, high))
        counts = inside.groupBy(F.shiftright("k", shift).alias("bucket")).count().orderBy("bucket").collect()
        for bucket, count in counts:
            if n < count:
                break
            n -= count
        low, high = max(low, bucket << shift), min(high, ((bucket + 1) << shift) - 1)
    return low


def skip(df: DataFrame, n: int, pos: str = "pos") -> DataFrame:
    """All rows but the first ``n``, by a filter on the position that reaches the scan."""
    if n <= 0:
        return df
    edge = nth_position(df, n, pos)
    return df.filter(F.lit(False) if edge is None else F.col(pos) >= edge)


def take(df: DataFrame, n: int, pos: str = "pos") -> DataFrame:
    """The first ``n`` rows, by a filter on the position that reaches the scan."""
    edge = nth_position(df, n, pos)
    return df if edge is None else df.filter(F.col(pos) < edge)


def position_of(df: DataFrame, doc_id, pos: str = "pos", id_col: str = "id") -> int:
    """The position of one document; an absent or repeated id is an error."""
    found = df.filter(F.col(id_col) == doc_id).select(pos).limit(2).collect()
    if len(found) != 1:
        raise ValueError(f"{'no' if not found else 'more than one'} document {doc_id!r}")
    return found[0][0]


def seek_after(df: DataFrame, doc_id, pos: str = "pos", id_col: str = "id") -> DataFrame:
    """The documents after ``doc_id``; its position becomes a filter the scan can use."""
    return df.filter(F.col(pos) > position_of(df, doc_id, pos, id_col))


def seek_report(df: DataFrame, doc_id, pos: str = "pos", id_col: str = "id") -> DataFrame:
    """How many documents a seek to ``doc_id`` passes over, the document itself not counted."""
    at = position_of(df, doc_id, pos, id_col)
    return df.select(pos).agg(F.count_if(F.col(pos) < at).alias("skipped"))


def map_rows(df: DataFrame, **columns: Column) -> DataFrame:
    """Per-row map by built-in expressions; rows keep their order key."""
    return df.withColumns(columns)


def map_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str
) -> DataFrame:
    """Per-batch map by a Python function, for what expressions cannot say."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return map(function, batches)

    return df.mapInArrow(each, schema)


def count_by_key(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).count()


def count_items(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("items"))


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).json(path)
