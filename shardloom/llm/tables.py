"""Intermediate tables in the shared folder, with their shuffles freed once written."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shardloom.session import written

_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when the query that wrote them has ended."""
    before = spark.conf.get(_FREE, "false")
    spark.conf.set(_FREE, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREE, before)


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the folder of ``spark.checkpoint.dir``: lineage ends there."""
    with freed(df.sparkSession):
        return written(df, name, compression="zstd")


def clear_name(df: DataFrame, name: str) -> str:
    """``name``, or a variant that no column of ``df`` has (names differ by more than case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def quoted(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")


def least_hashed(df: DataFrame, at: str, n: int) -> DataFrame:
    """The ``n`` distinct rows of the least ``at``, a 64-bit hash, or all if there are fewer.

    A top-n alone would send up to ``n`` rows of every task to the driver. Distinct hashes are
    counted first (within a few per cent), and only rows below the bound that some ``2 n`` of
    them keep are ordered. That fewer than ``n`` do has a probability below 1e-20 for n >= 200.
    """
    total = df.agg(F.approx_count_distinct(at)).first()[0]
    low = -(1 << 63) + int((1 << 64) * min(1.0, (2 * n + 64) / max(total, 1)))
    below = df.filter(quoted(at) <= F.lit(min(low, (1 << 63) - 1)))
    return below.distinct().orderBy(at, *[quoted(c) for c in df.columns if c != at]).limit(n)


def least_hashed_of_each(df: DataFrame, key: str, at: str, n: int) -> DataFrame:
    """For each value of ``key`` what :func:`least_hashed` gives of its rows, by key and ``at``.

    The values' counts are broadcast: a row for each. A null key is no value.
    """
    value, low, place = (clear_name(df, c) for c in ("_value", "_low", "_place"))
    share = F.lit(2.0 * n + 64) / F.approx_count_distinct(at)
    bound = F.when(share >= 1, F.lit((1 << 63) - 1)).otherwise((share * 2.0**64 - 2.0**63).cast("bigint"))
    bounds = df.groupBy(quoted(key).alias(value)).agg(bound.alias(low))
    below = df.join(F.broadcast(bounds), quoted(key) == F.col(value)).filter(quoted(at) <= F.col(low))
    own = [quoted(c) for c in df.columns]
    order = [quoted(at), *[quoted(c) for c in df.columns if c not in (key, at)]]
    placed = below.select(*own).distinct().withColumn(
        place, F.row_number().over(Window.partitionBy(quoted(key)).orderBy(*order))
    )
    return placed.filter(F.col(place) <= n).orderBy(quoted(key), *order).select(*own)


def number_rows(
    df: DataFrame,
    out: str,
    keys: Sequence[str],
    order: Sequence[str],
    mix: str,
    buckets: int,
    facts: DataFrame | None = None,
) -> DataFrame:
    """Add ``out``: 0, 1, 2... within equal ``keys``, without a task that holds a whole group.

    Rows are dealt to ``buckets`` by the BIGINT column ``mix``; a window numbers the rows of
    one group and bucket by ``order``, and the buckets' counts, added up per group, are
    joined back. Null keys are a group. ``mix`` should be a hash of what tells rows apart.
    ``facts`` has a row per group, the keys and further columns, which every row gets too.
    """
    group, part, base = (clear_name(df, c) for c in ("_group", "_part", "_base"))
    # A struct is never null, and null fields in it are equal: one key for window and join.
    key = F.struct(*[quoted(c).alias(f"k{i}") for i, c in enumerate(keys)])
    dealt = df.withColumns(
        {
            group: key,
            part: F.pmod(quoted(mix), F.lit(buckets)).cast("int"),
        }
    )
    counts = dealt.groupBy(group, part).agg(F.count(F.lit(1)).alias(base))
    before = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.withColumn(base, F.coalesce(F.sum(base).over(before), F.lit(0)))
    added = []
    if facts is not None:
        added = [c for c in facts.columns if c not in keys]
        bases = bases.join(facts.select(key.alias(group), *map(quoted, added)), group)
    within = Window.partitionBy(group, part).orderBy(*map(quoted, [mix, *order]))
    local = dealt.withColumn(out, F.row_number().over(within).cast("bigint") - 1)
    joined = local.join(bases, [group, part])
    return joined.select(*map(quoted, [*df.columns, *added]), (F.col(out) + F.col(base)).alias(out))
