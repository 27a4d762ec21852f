"""Global running totals in key order without a shuffle of rows that are in order already.

One pass over narrow rows adds up running totals within runs: stretches of a task's rows whose
keys rise, such as the rows of a file block. Where runs do not overlap, a run starts from the
totals of all runs before it, a row for each. Rows that come in another order are sorted by
one range-partitioned shuffle first, so a run is then a task's whole range, whatever the keys
look like.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shardloom.session import attach, written

# Runs whose totals are accumulated by one task and broadcast, 64 bytes or so each; rows in
# more runs than that are not in order and are sorted.
MAX_RUNS = 1 << 20

# Fixed value: low bits of a run's number that count a task's runs.
_RUN_BITS = 40


def token_offsets(lengths: DataFrame) -> DataFrame:
    """Add ``ordinal``, ``start`` and ``end`` to rows with a unique ``pos`` and a length ``n``.

    ``[start, end)`` is the row's place in the corpus-wide token stream, ``ordinal`` its
    place among the documents; all count from 0.
    """
    counted = lengths.withColumn("_one", F.lit(1).cast("bigint"))
    return (
        exclusive_totals(counted, "pos", {"start": "n", "ordinal": "_one"})
        .withColumn("end", F.col("start") + F.col("n"))
        .drop("_one")
    )


def exclusive_totals(df: DataFrame, key: str, totals: dict[str, str]) -> DataFrame:
    """Add, for each ``{out: column}``, the sum of ``column`` over all rows with a smaller key.

    The columns summed are BIGINT and not negative. Rows are written once, here and now, with
    their local totals; a null or repeated key fails in doing so, and nothing in the plan that
    is returned can fail on a row, whatever filters are put on it.
    """
    attach(df.sparkSession)
    local, runs = _in_runs(df, key, totals)
    if runs.count() > MAX_RUNS or not _apart(runs):
        ranged = df.repartitionByRange(key).sortWithinPartitions(key)
        local, runs = _in_runs(ranged, key, totals)
        if not _apart(runs):
            raise ValueError(f"repeated {key}: {_repeated(df, key)}")
    before = Window.orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)
    bases = runs.select(
        "_run", *[F.coalesce(F.sum(f"_all_{out}").over(before), F.lit(0)).alias(f"_base_{out}") for out in totals]
    )
    return local.join(F.broadcast(bases), "_run").select(
        *df.columns, *[(F.col(f"_base_{out}") + F.col(out)).alias(out) for out in totals]
    )


def _in_runs(df: DataFrame, key: str, totals: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Rows with totals inside their run, and the runs with their span and whole totals."""
    added = {"_run": "bigint", **dict.fromkeys(totals, "bigint")}
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema] + [f"`{c}` {t}" for c, t in added.items()]
    )
    local = written(df.mapInArrow(_running(key, totals), schema), "runs")
    whole = [F.max(F.col(out) + F.col(column)).alias(f"_all_{out}") for out, column in totals.items()]
    runs = local.groupBy("_run").agg(F.min(key).alias("_first"), F.max(key).alias("_last"), *whole)
    return local, written(runs, "run_totals")


def _apart(runs: DataFrame) -> bool:
    """Whether no run reaches into another."""
    before = Window.orderBy("_first", "_last").rowsBetween(Window.unboundedPreceding, -1)
    reaching = runs.withColumn("_upto", F.max("_last").over(before)).filter("_first <= _upto")
    return reaching.isEmpty()


def _repeated(df: DataFrame, key: str):
    return df.groupBy(key).count().filter("count > 1").select(key).first()[0]


def _running(key: str, totals: dict[str, str]):
    """Numbers each run, and adds up what comes before a row in its run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << _RUN_BITS
        last: int | None = None
        carried = dict.fromkeys(totals, 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            if batch.column(key).null_count:
                raise ValueError(f"row without {key}")
            keys = batch.column(key).to_numpy()
            starts = np.empty(len(keys), bool)
            starts[0] = last is not None and int(keys[0]) <= last
            starts[1:] = keys[1:] <= keys[:-1]
            opened = np.cumsum(starts)
            begins = np.concatenate([[0], np.flatnonzero(starts)])  # of what is added to which base
            columns = [pa.array(number + opened)]
            for out, column in totals.items():
                values = batch.column(column).fill_null(0).to_numpy()
                before = np.cumsum(values) - values
                # The first stretch goes on from the batch before, each other one from nothing.
                base = before[begins] - np.concatenate([[carried[out]], np.zeros(len(begins) - 1, np.int64)])
                inside = before - base[opened]
                carried[out] = int(inside[-1] + values[-1])
                columns.append(pa.array(inside))
            number, last = number + int(opened[-1]), int(keys[-1])
            names = [*batch.schema.names, "_run", *totals]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names)

    return run
