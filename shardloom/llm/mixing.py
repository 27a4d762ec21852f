"""Sources mixed to target weights by fitting a word budget as a subset sum.

A source below its target is taken whole as often as it fits. What is left of the target is
a budget for one more pass: the source's documents are counted by exact length, every
length gives its share, rounded down, and a bounded-knapsack dynamic programme over the
documents left brings the remainder as near to the budget as lengths allow. Only then are
documents named: of each length, as many as counted, in a seeded order.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardloom.llm.tables import clear_name, kept, number_rows, quoted
from shardloom.session import attach

CYCLE = (1.0, 2.0, 3.0)
MOST_PASSES = 3
SEED = 9
BUCKETS = 512
# Words that the dynamic programme fits; what is left above it goes to the longest
# documents first, which changes nothing but how much the programme has to try.
KNAPSACK_WORDS = 1 << 16

_WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Number of words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("bigint")


def targets(sources: DataFrame, cycle=CYCLE, share: float = 1.0, most: float = MOST_PASSES) -> DataFrame:
    """Add ``target`` to one row per source ``(source, source_size)``.

    Weights repeat ``cycle`` over the sources by code point, null last. A target stops at
    ``most`` times its source's size, and the excess is shared by weight among the others
    until none is above: every target is ``min(most * size, level * weight)``, and the one
    level is found from running sums over the sources by ``size / weight``.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    place = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(cycle))) + 1
    weighted = sources.withColumn(
        "_weight", F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), place.cast("int"))
    ).withColumn("_cap", F.col("source_size") * F.lit(float(most)))
    everything = Window.partitionBy()
    filling = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("source").isNull(), "source")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    rest = filling.rowsBetween(0, Window.unboundedFollowing)
    budget = F.sum("source_size").over(everything) * F.lit(float(share))
    # The level if this source and all after it are not capped, and all before it are. Taking
    # one that is not for capped lowers it, so the greatest that holds is the right one.
    level = (budget - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_weight").over(rest)
    holds = level * F.col("_weight") <= F.col("_cap")
    found = weighted.withColumn("_level", F.when(holds, level))
    found_level = F.max("_level").over(everything)
    target = F.when(found_level.isNull(), F.col("_cap")).otherwise(
        F.least(F.col("_cap"), found_level * F.col("_weight"))
    )
    return found.select("source", "source_size", target.cast("double").alias("target"))


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int, limit: int = KNAPSACK_WORDS) -> np.ndarray:
    """How many documents of each length to take so that their sum is as near below ``budget``.

    Proportional shares first, then whole lengths from the longest down to ``limit`` words
    of rest, then the exact best subset of what is left by dynamic programming.
    """
    lengths, counts = np.asarray(lengths, np.int64), np.asarray(counts, np.int64)
    taken = np.zeros(len(lengths), np.int64)
    total = sum(int(a) * int(b) for a, b in zip(lengths, counts, strict=True))
    if budget <= 0 or not total:
        return taken
    if budget >= total:
        return counts.copy()
    taken = np.array([int(c) * int(budget) // total for c in counts], np.int64)
    rest = int(budget) - sum(int(a) * int(b) for a, b in zip(lengths, taken, strict=True))
    for i in np.argsort(-lengths, kind="stable"):
        if rest <= limit:
            break
        if lengths[i] > 0:
            more = min(int(counts[i] - taken[i]), (rest - limit) // int(lengths[i]))
            taken[i] += more
            rest -= more * int(lengths[i])
    return taken + _knapsack(lengths, counts - taken, rest)


def _knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Reachable sums as the bits of one integer; counts split into powers of two."""
    chosen = np.zeros(len(lengths), np.int64)
    whole = (1 << (budget + 1)) - 1
    reach, items = 1, []
    origin = np.full(budget + 1, -1, np.int64)
    for i in np.argsort(-lengths, kind="stable"):
        length, left, block = int(lengths[i]), int(counts[i]), 1
        if not 0 < length <= budget:
            continue
        left = min(left, budget // length)
        while left > 0 and not reach >> budget & 1:
            part = min(block, left)
            new = (reach << (part * length)) & whole & ~reach
            if new:
                bits = np.unpackbits(
                    np.frombuffer(new.to_bytes(budget // 8 + 1, "little"), np.uint8), bitorder="little"
                )
                origin[np.flatnonzero(bits[: budget + 1])] = len(items)
                items.append((i, part, part * length))
                reach |= new
            left, block = left - part, block * 2
    best = reach.bit_length() - 1
    while best > 0:
        i, part, size = items[origin[best]]
        chosen[i] += part
        best -= size
    return chosen


def _fit_source(group: pd.DataFrame) -> pd.DataFrame:
    """Full passes and the fitted counts of one source's lengths."""
    group = group.sort_values("size").reset_index(drop=True)
    size, target = int(group["source_size"].iloc[0]), float(group["target"].iloc[0])
    passes = int(target // size) if size else 0
    budget = int(round(target - passes * size))
    group["passes"] = passes
    group["extra"] = fit(group["size"].to_numpy(), group["n"].to_numpy(), budget)
    return group[["source", "size", "source_size", "target", "passes", "extra"]]


def mix(
    docs: DataFrame,
    source_col: str = "source",
    text_col: str = "text",
    id_col: str = "doc_id",
    cycle=CYCLE,
    share: float = 1.0,
    most: int = MOST_PASSES,
    seed: int = SEED,
) -> DataFrame:
    """All columns of ``docs`` and ``size, source_size, target, taken``.

    ``size`` is the text's words, ``taken`` the words the mix takes of the document, repeats
    counted: a multiple of ``size`` of at most ``most`` times. A null source is a source of
    its own; a null or wordless text has size 0 and takes nothing; repeated rows are rows of
    their own; a source without words has target 0. Reruns agree: the order within a length
    is a hash of seed, id and text. Columns of ``docs`` named like a new one are replaced,
    except the source, text and id columns.
    """
    attach(docs.sparkSession)
    made = {"size", "source_size", "target", "taken"} - {source_col, text_col, id_col}
    docs = docs.select(*[quoted(c) for c in docs.columns if c.lower() not in made])
    sized = docs.withColumn("size", words(quoted(text_col)))
    histogram = sized.groupBy(quoted(source_col).alias("source"), "size").agg(
        F.count(F.lit(1)).alias("n")
    )
    histogram = kept(histogram, "lengths")
    totals = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    goals = targets(totals, cycle, share, most).select(
        F.struct("source").alias("key"), "source_size", "target"
    )
    # One row per length: a source has no more of them than its longest text has words.
    fitted = (
        histogram.withColumn("key", F.struct("source"))
        .join(goals, "key")
        .groupBy("key")
        .applyInPandas(
            _fit_source,
            "source string, size bigint, source_size bigint, target double, passes bigint, extra bigint",
        )
    )
    fitted = kept(fitted, "fitted")
    tie, rank = (clear_name(sized, c) for c in ("_mix", "_rank"))
    mixed = sized.withColumn(tie, F.xxhash64(F.lit(seed), quoted(id_col), quoted(text_col)))
    plan = fitted.withColumnRenamed("source", source_col)
    ranked = number_rows(mixed, rank, [source_col, "size"], [id_col], tie, BUCKETS, plan)
    copies = F.col("passes") + (F.col(rank) < F.col("extra")).cast("bigint")
    return ranked.select(
        *map(quoted, docs.columns), "size", "source_size", "target",
        (F.col("size") * copies).alias("taken"),
    )
