"""Sketches of single bits that bound how much two sets differ, and comparing buckets by blocks.

Each element flips one bit. What two sets share cancels out, so the bits in which two sketches
differ are at most as many as the elements that only one of the sets has: a pair that exceeds
what similar sets can have is left out for certain, and no similar pair ever is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shardloom.functions.arrays import binary_parts
from shardloom.llm.text import mixed

# 64-bit words of a sketch: four bits an element, between these.
FEWEST_WORDS, MOST_WORDS = 1 << 4, 1 << 9
# Members of a bucket that one task compares with as many others.
BLOCK = 1 << 10
# Pairs whose ids, 16 bytes a pair, are broadcast to find their sets; for more, all sets are shuffled.
BROADCAST_PAIRS = 1 << 19

_SALT = np.uint64(0x6C8E9CF570932BD5)


def most_unlike(both: int | np.ndarray, percent: int) -> int | np.ndarray:
    """Elements that only one of two similar sets can have, by the sum of their sizes."""
    return both * (100 - percent) // (100 + percent)


def bit_sketch(values: np.ndarray) -> bytes:
    """One bit for each element's parity; its length is a power of two that follows the size."""
    size = 1 << max(0, (len(values) // 16 - 1)).bit_length()
    size = min(max(size, FEWEST_WORDS), MOST_WORDS)
    at = (mixed(values ^ _SALT) & np.uint64(64 * size - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=64 * size).astype(np.uint8) & 1).tobytes()


def folded(sketch: bytes, words: int) -> np.ndarray:
    """A sketch as ``words`` 64-bit words, its parts laid over each other: again a sketch."""
    return np.bitwise_xor.reduce(np.frombuffer(sketch, np.uint64).reshape(-1, words), axis=0)


def differing(left: pa.Array, right: pa.Array) -> np.ndarray:
    """In how many bits sketches differ, pair by pair; the longer one is folded."""
    found = np.zeros(len(left), np.int64)
    a, b = (pc.binary_length(x).to_numpy() // 8 for x in (left, right))
    for both in np.unique(a * (2 * MOST_WORDS) + b).tolist():
        m, n = divmod(both, 2 * MOST_WORDS)
        rows = np.flatnonzero((a == m) & (b == n))
        x, y = (
            np.bitwise_xor.reduce(_words(side.take(pa.array(rows))).reshape(len(rows), -1, min(m, n)), axis=1)
            for side in (left, right)
        )
        found[rows] = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
    return found


def _words(sketches: pa.Array) -> np.ndarray:
    bounds, data = binary_parts(sketches)
    return np.frombuffer(data, np.uint64, (bounds[-1] - bounds[0]) // 8, bounds[0])


def could_be_similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs ``(x, c)`` whose sizes and sketches do not rule similarity out.

    Sketches are a tenth of the sets: what they rule out is not sent to be compared.
    """

    @F.arrow_udf("boolean")
    def near(x: pa.Array, x_n: pa.Array, c: pa.Array, c_n: pa.Array) -> pa.Array:
        both = x_n.to_numpy() + c_n.to_numpy()
        return pa.array(differing(x, c) <= most_unlike(both, percent), pa.bool_())

    small = sets.select("rep", F.col("n").alias("m"), "bits")
    x = small.toDF("x", "x_n", "x_bits")
    c = small.toDF("c", "c_n", "c_bits")
    fitting = 100 * F.least("x_n", "c_n") >= percent * F.greatest("x_n", "c_n")
    described = pairs.join(x, "x").join(c, "c").filter(fitting)
    return described.filter(near("x_bits", "x_n", "c_bits", "c_n")).select("x", "c")


def of_pairs(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The rows of ``sets`` that a join with ``pairs`` needs: what is in no pair is not shuffled.

    ``pairs`` has rows ``(x, c)`` and is read several times.
    """
    if pairs.count() > BROADCAST_PAIRS:
        return sets
    ids = pairs.select(F.explode(F.array("x", "c")).alias("id")).distinct()
    return sets.join(F.broadcast(ids), F.col("rep") == F.col("id"), "left_semi")


def one_of_equal(labelled: DataFrame) -> DataFrame:
    """Members ``(key, rep, label)`` of buckets with several labels, and each one's ``members``.

    Of buckets with the same members, by 128 bits, one is enough. A member that comes twice counts
    twice: hashes are added up, by halves so that sums fit.
    """
    hashes = [F.xxhash64("rep", F.lit(salt)) for salt in (1, 2)]
    halves = [half for h in hashes for half in (F.shiftright(h, 32), h.bitwiseAND(F.lit((1 << 32) - 1)))]
    content = {f"of{i}": F.sum(half) for i, half in enumerate(halves)}
    facts = labelled.groupBy("key").agg(
        F.min("label").alias("least"), F.max("label").alias("greatest"), F.count(F.lit(1)).alias("members"),
        *[total.alias(name) for name, total in content.items()],
    )
    one = facts.filter("least != greatest").groupBy(*content, "members").agg(F.min("key").alias("key"))
    return labelled.join(one.select("key", "members"), "key")


def dealt_blocks(apart: DataFrame) -> DataFrame:
    """``(key, lo, hi, block, rep, label)``: members of a bucket in groups of two blocks.

    ``apart`` has rows ``(key, rep, label, members)``. Any two members of different labels are in
    one group of their bucket. Members of its largest label come last, and no two blocks of theirs
    meet: rows grow with the members times the blocks of those outside of the largest label, not
    with the square of the bucket.
    """
    parts = apart.groupBy("key", "label").agg(F.count(F.lit(1)).alias("size"))
    main = parts.groupBy("key").agg(F.max(F.struct("size", "label")).alias("top"))
    order = [F.col("label") == F.col("top.label"), F.col("rep")]
    place = F.row_number().over(Window.partitionBy("key").orderBy(*order)) - 1
    last, last_outside = (
        F.expr(f"cast(({n} - 1) div {BLOCK} as int)") for n in ("members", "members - top.size")
    )
    block = F.floor(place / BLOCK).cast("int")
    reach = F.when(F.col("block") <= last_outside, last).otherwise(last_outside)
    dealt = apart.join(main, "key").withColumn("block", block).withColumn(
        "other", F.explode(F.sequence(F.lit(0), reach))
    )
    return dealt.select(
        "key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
        "block", "rep", "label",
    )


def pairs_by_blocks(apart: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs ``(x, c)``, ``x > c``, of a bucket's members that could be similar.

    ``apart`` has rows ``(key, rep, label, members)``, members of one label are no pair;
    ``sets`` has ``(rep, n, bits)``. A bucket is cut into blocks, and two blocks, or a block with
    itself, are one group: no task holds more than two, however large the bucket.
    """
    grouped = dealt_blocks(apart).join(sets.select("rep", "n", "bits"), "rep")

    def compare(table: pa.Table) -> pa.Table:
        return _compared(table, percent)

    return grouped.groupBy("key", "lo", "hi").applyInArrow(compare, "x bigint, c bigint").distinct()


def _compared(table: pa.Table, percent: int) -> pa.Table:
    block, rep, label, n = (table.column(c).to_numpy() for c in ("block", "rep", "label", "n"))
    bits = [b.as_py() for b in table.column("bits")]
    words = min(map(len, bits)) // 8
    sketches = np.stack([folded(b, words) for b in bits])
    lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
    left, right = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
    x, c = [rep[:0]], [rep[:0]]
    for i in left.tolist():
        unlike = np.bitwise_count(sketches[right] ^ sketches[i]).sum(axis=1, dtype=np.int64)
        least, most = np.minimum(n[right], n[i]), np.maximum(n[right], n[i])
        could = (unlike <= most_unlike(n[right] + n[i], percent)) & (100 * least >= percent * most)
        could &= label[right] != label[i]
        if lo == hi:
            could &= rep[right] < rep[i]
        others = rep[right[could]]
        x.append(np.maximum(others, rep[i]))
        c.append(np.minimum(others, rep[i]))
    return pa.table({"x": np.concatenate(x), "c": np.concatenate(c)})
