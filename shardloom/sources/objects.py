"""Stored objects as tables: listings, small text objects and what is still to publish."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator, Sequence
from urllib.parse import urlparse

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.sources.paths import exists, resolve

# Below it objects are written before they get their names; Spark's readers pass it over.
HIDDEN = "_writing"

_EMPTY_LISTING = "name string, updated timestamp, length bigint"


def list_objects(
    spark: SparkSession, path: str, prefix: str = "", suffix: str = ""
) -> DataFrame:
    """``(name, updated, length)`` of the objects below ``path``; contents are not read.

    ``name`` is relative to ``path``; ``prefix`` and ``suffix`` keep matching names only.
    """
    if not exists(path):
        return spark.createDataFrame([], _EMPTY_LISTING)
    listed = _binary(spark, path, "*" + suffix).select(
        _relative(path, F.col("path")).alias("name"),
        F.col("modificationTime").alias("updated"),
        "length",
    ).union(_empty(spark, path, suffix))
    return listed.filter(F.col("name").startswith(prefix) & F.col("name").endswith(suffix))


def read_text_objects(spark: SparkSession, path: str, suffix: str = ".txt") -> DataFrame:
    """``(name, updated, value)`` of small UTF-8 objects, each read whole."""
    if not exists(path):
        return spark.createDataFrame([], "name string, updated timestamp, value string")
    return (
        _binary(spark, path, "*" + suffix)
        .select(
            _relative(path, F.col("path")).alias("name"),
            F.col("modificationTime").alias("updated"),
            F.decode("content", "UTF-8").alias("value"),
        )
        .filter(F.col("name").endswith(suffix))
        .union(_empty(spark, path, suffix).withColumn("length", F.lit("")))
    )


def write_text_objects(objects: DataFrame, path: str) -> int:
    """Write rows ``(name, value)`` as small UTF-8 objects below ``path``; returns how many.

    Tasks write them, each under a hidden name that is then changed, so no reader sees half an
    object and a task that runs again only writes the same once more. A column ``updated``
    becomes the object's time where the store lets a writer set it. Names must be unique.
    """
    stamped = "updated" in objects.columns
    rows = objects.select("name", "value", *(["updated"] if stamped else []))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = resolve(path)
        for batch in batches:
            for row in batch.to_pylist():
                target, hidden = f"{root}/{row['name']}", f"{root}/{HIDDEN}/{uuid.uuid4().hex}"
                for file in (target, hidden):
                    fs.create_dir(file.rpartition("/")[0], recursive=True)
                with fs.open_output_stream(hidden) as out:
                    out.write(row["value"].encode())
                if stamped and fs.type_name == "local":
                    os.utime(hidden, (row["updated"].timestamp(),) * 2)
                fs.move(hidden, target)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    done = rows.mapInArrow(write, "n bigint").agg(F.sum("n")).first()[0] or 0
    fs, root = resolve(path)
    if fs.get_file_info(f"{root}/{HIDDEN}").type != pafs.FileType.NotFound:
        fs.delete_dir(f"{root}/{HIDDEN}")
    return done


def pending(
    plan: DataFrame, existing: DataFrame, key: str | Sequence[str] = "file_name"
) -> DataFrame:
    """Planned files that are not at the destination yet."""
    keys = [key] if isinstance(key, str) else list(key)
    return plan.join(existing.select(*keys).distinct(), keys, "left_anti")


def outcome(plan: DataFrame, report: DataFrame, key: str = "file_name") -> DataFrame:
    """Each planned file with its reported ``status`` and ``error``, paired by name."""
    return plan.join(report.select(key, "status", "error"), key)


def _binary(spark: SparkSession, path: str, glob: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
    )


def _empty(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """``(name, updated, length)`` of objects without bytes, which Spark's file sources pass over."""
    fs, root = resolve(path)
    found: list[tuple] = []
    if fs.get_file_info(root).type == pafs.FileType.Directory:
        for info in fs.get_file_info(pafs.FileSelector(root, recursive=True)):
            name = info.path[len(root.rstrip("/")) + 1 :]
            hidden = any(part.startswith(("_", ".")) for part in name.split("/"))
            if info.type == pafs.FileType.File and info.size == 0 and name.endswith(suffix) and not hidden:
                found.append((name, info.mtime, 0))
    names, times, sizes = zip(*found) if found else ((), (), ())
    return spark.createDataFrame(
        pa.table({
            "name": pa.array(names, pa.string()),
            "updated": pa.array(times, pa.timestamp("us", "UTC")),
            "length": pa.array(sizes, pa.int64()),
        })
    )


def _relative(path: str, column: Column) -> Column:
    # Spark lists absolute URLs; what follows the root's own path is the object's name.
    parsed = urlparse(path)
    root = parsed.path if parsed.scheme not in ("", "file") else resolve(path)[1]
    return F.regexp_replace(column, "^[^:]+:(//[^/]*)?\\Q" + root.rstrip("/") + "/\\E", "")
