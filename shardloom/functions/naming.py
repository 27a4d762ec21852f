"""Split rules, shard file names and checkpoint names."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Shards held out by the three-way rule, and where each range ends.
VAL_END = 350
TEST_END = 700

# Fixed value: leading part of two-way file names.
TWO_WAY_PREFIX = "edufineweb"

CHECKPOINT_FOLDER = "checkpoints/"
CHECKPOINT_SUFFIX = ".txt"


@dataclass(frozen=True)
class ThreeWay:
    """Shards ``[0, val_end)`` are val, ``[val_end, test_end)`` test, the rest train.

    Shards are renumbered inside their split: ``val/val_0000.npy``.
    """

    val_end: int = VAL_END
    test_end: int = TEST_END

    def split(self, shard: Column) -> Column:
        return (
            F.when(shard < self.val_end, "val").when(shard < self.test_end, "test")
        ).otherwise("train")

    def split_index(self, shard: Column) -> Column:
        return (
            F.when(shard < self.val_end, shard)
            .when(shard < self.test_end, shard - self.val_end)
            .otherwise(shard - self.test_end)
        )

    def file_name(self, shard: Column) -> Column:
        split = self.split(shard)
        return F.format_string("%s/%s_%04d.npy", split, split, self.split_index(shard))


@dataclass(frozen=True)
class TwoWay:
    """Shard 0 is val, the rest train; one flat folder, shard numbers kept."""

    prefix: str = TWO_WAY_PREFIX

    def split(self, shard: Column) -> Column:
        return F.when(shard == 0, "val").otherwise("train")

    def split_index(self, shard: Column) -> Column:
        return shard

    def file_name(self, shard: Column) -> Column:
        return F.format_string("%s_%s_%06d.npy", F.lit(self.prefix), self.split(shard), shard)


def with_layout(shards: DataFrame, layout: ThreeWay | TwoWay) -> DataFrame:
    """Add ``split``, ``split_index`` and ``file_name`` to rows with a ``shard_id``."""
    shard = F.col("shard_id")
    return shards.withColumns(
        {
            "split": layout.split(shard),
            "split_index": layout.split_index(shard),
            "file_name": layout.file_name(shard),
        }
    )


def checkpoint_name(doc_id: Column) -> Column:
    return F.concat(F.lit(CHECKPOINT_FOLDER), doc_id.cast("string"), F.lit(CHECKPOINT_SUFFIX))


def checkpoint_id(name: Column) -> Column:
    """The document id inside ``checkpoints/<id>.txt``; the folder part is optional."""
    head = F.when(name.startswith(CHECKPOINT_FOLDER), len(CHECKPOINT_FOLDER)).otherwise(0)
    keep = F.length(name) - head - len(CHECKPOINT_SUFFIX)
    return F.substring(name, head + 1, keep)


def checkpoint_value(shard: Column, docs: Column) -> Column:
    return F.concat_ws(":", shard.cast("string"), docs.cast("string"))


def parse_checkpoint(value: Column) -> tuple[Column, Column]:
    """``(shard_id, docs_consumed)`` of ``"shard:docs"`` or of ``"shard"`` (docs is null then).

    Anything else fails the run.
    """
    malformed = F.raise_error(F.concat(F.lit("malformed checkpoint: "), value))
    checked = F.when(value.rlike("^[0-9]+(:[0-9]+)?$"), F.split(value, ":")).otherwise(malformed)
    return checked[0].cast("bigint"), F.get(checked, F.lit(1)).cast("bigint")
