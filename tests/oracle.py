"""Runs registered queries against their SQL oracles on DuckDB: ``python -m tests.oracle``."""

from __future__ import annotations

import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def mismatch(spark: SparkSession, connection, sf_dir: str, name: str) -> str | None:
    """What differs between query ``name`` and its oracle; None when nothing does."""
    frame = entry.queries()[name](spark, sf_dir)
    columns = sorted(frame.columns)
    got = sorted(map(repr, map(tuple, frame.select(*columns).collect())))
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    if sorted(names) != columns:
        return f"columns {columns} against {sorted(names)}"
    order = [names.index(column) for column in columns]
    want = sorted(repr(tuple(row[i] for i in order)) for row in result.fetchall())
    if got != want:
        pairs = [(g, w) for g, w in zip(got, want) if g != w]
        return f"{len(got)} rows against {len(want)}; first difference {pairs[:1]}"
    return None


if __name__ == "__main__":
    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    database = connect(sf_dir)
    for query in sys.argv[1:] or entry.queries():
        began = time.time()
        try:
            problem = mismatch(session, database, sf_dir, query)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok ' if problem is None else 'BAD'} {query} {time.time() - began:.2f}s", problem or "")
