"""Documents to shards by a hierarchical weighted hash tree, in DataFrame functions only.

Shards sit in racks, racks in regions. A row draws one exponential number per shard from a
hash of its id and the shard, divided by the shard's weight; a rack's draw is the least of
its shards', a region's the least of its racks'. The least of exponentials is exponential
with the sum of the rates, so each node is drawn with its subtree's weight. The row
descends region, rack and shard, to the least draw each time.

A draw depends on its own shard alone. A heavier shard therefore only lowers its own draw
and those of the nodes above it: rows move into that shard and nowhere else, a lighter one
only gives rows away, and one more shard takes rows only into itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.llm.tables import clear_name, number_rows, quoted

SHARDS = 24
RACK_SHARDS = 4
REGION_RACKS = 3
SEED = 5
FRAME_BYTES = 8
# Rows that one window numbers, about.
NUMBERED_TOGETHER = 16_384


def tree(
    weights: Sequence[float], rack_shards: int = RACK_SHARDS, region_racks: int = REGION_RACKS
) -> list[list[list[tuple[int, float]]]]:
    """Regions of racks of ``(shard, weight)``, filled in order of the shard number."""
    if not weights or any(w <= 0 for w in weights):
        raise ValueError("every shard needs a positive weight")
    leaves = list(enumerate(weights))
    racks = [leaves[i : i + rack_shards] for i in range(0, len(leaves), rack_shards)]
    return [racks[i : i + region_racks] for i in range(0, len(racks), region_racks)]


def _draw(key: Column, shard: int, weight: float, seed: int) -> Column:
    """An exponential number of rate ``weight``, from 52 bits of a hash."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard), F.lit(seed)), 12)
    return -F.log((bits.cast("double") + 0.5) / F.lit(float(1 << 52))) / F.lit(float(weight))


def _least(nodes: list[Column]) -> Column:
    """The node struct with the least draw, then the lowest first shard."""
    return nodes[0] if len(nodes) == 1 else F.array_min(F.array(*nodes))


def assigned(key: Column, weights: Sequence[float], seed: int = SEED) -> Column:
    """Struct ``(draw, shard)`` that ``key`` descends to; a null key is a key as well."""
    regions = []
    for region in tree(weights):
        racks = []
        for rack in region:
            leaves = [
                F.struct(_draw(key, s, w, seed).alias("draw"), F.lit(s).alias("shard"))
                for s, w in rack
            ]
            racks.append(_least(leaves))
        regions.append(_least(racks))
    return _least(regions)


def shard(
    docs: DataFrame,
    shards: int = SHARDS,
    weights: Sequence[float] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = SEED,
    rows: int | None = None,
) -> DataFrame:
    """All columns of ``docs`` and ``size, text_crc32, law, shard, slot, grown_shard``.

    ``shard`` depends on the id, the weights and the seed only; ``grown_shard`` is the one
    with one more shard of weight 1. ``size`` is the text's UTF-8 bytes plus 8, ``slot`` numbers a
    shard's rows from 0 without a gap, in a seeded order. A null id is an id like any
    other; a null text has no bytes and the checksum 0; repeated rows each get a slot; an
    empty table gives an empty one. Columns of ``docs`` named like a new one are replaced.
    ``rows``, about the number of rows, sets how finely the numbering is split; counted if
    not given.
    """
    weights = list(weights or [1.0] * shards)
    if len(weights) != shards:
        raise ValueError("one weight per shard")
    total = docs.count() if rows is None else rows
    buckets = max(1, -(-total // (NUMBERED_TOGETHER * shards)))
    made = {"size", "text_crc32", "law", "shard", "slot", "grown_shard"}
    mix = clear_name(docs, "_mix")
    key, text = quoted(id_col).cast("string"), F.coalesce(quoted(text_col), F.lit(""))
    placed = docs.select(
        *[quoted(c) for c in docs.columns if c.lower() not in made],
        (F.octet_length(text).cast("bigint") + FRAME_BYTES).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.lit("key").alias("law"),
        assigned(key, weights, seed).getField("shard").alias("shard"),
        assigned(key, [*weights, 1.0], seed).getField("shard").alias("grown_shard"),
    )
    mixed = placed.withColumn(mix, F.xxhash64(quoted(id_col), "text_crc32", F.lit(seed)))
    numbered = number_rows(mixed, "slot", ["shard"], [id_col, "text_crc32"], mix, buckets)
    return numbered.drop(mix)
