"""Joining documents whose word n-gram sets are similar, by parity sketches.

A set's sketch has ``m`` words of 64 bits; every element flips the bits of its hash in one of
them. What two sets share cancels out, so the words in which two sketches differ are at most
as many as the elements that only one of the sets has. Similar sets differ in ``t`` elements
at most, ``t`` following from their sizes, and with more than ``t`` words one must be equal:
sketches are cut at their words, and sets with an equal word meet. Sizes are dealt into bands,
each with ``t`` and ``m`` of its largest set; a set stands in its own band and, if large enough
to be similar to the next band's smallest, in that one as well.

A word that no element falls on is equal in most sketches and says nothing. ``m`` leaves room
for some; a set with more stands under a further choice of words as well, so two sets that
both lack words meet there. Only those that lack words under every choice meet at empty words.

Sets that meet are compared on the sets themselves: first with the least of their bucket, then
with members of its largest component, as long as that links members of the bucket, and
whatever is still apart by blocks of a bucket against blocks. There a second sketch, in which
each element flips a single bit, leaves out pairs whose bits differ more often than similar
sets' can. No pair that could be linked is left out.
"""

from __future__ import annotations

import math
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardloom.llm.graph import components
from shardloom.llm.near_dedup import shingle_sets
from shardloom.llm.sketches import (
    bit_sketch,
    could_be_similar,
    most_unlike,
    of_pairs,
    one_of_equal,
    pairs_by_blocks,
)
from shardloom.llm.tables import kept, quoted
from shardloom.llm.text import encoded, groups, mixed, starts_of
from shardloom.session import attach

SHINGLE = 4
SIMILAR_PERCENT = 85
# How much larger a band's largest set is than its smallest; more than a similar pair's sizes.
BAND = 1.6
# Choices of words, and the share of a band's smallest sets that need more than the first.
CHOICES, NEEDY = 6, 0.05
# Classes, 16 bytes each, that are broadcast to find their rows; more are shuffled.
BROADCAST_CLASSES = 1 << 20
# Rounds that attach what is apart to a bucket's largest component, at most.
ATTACHING = 3

_SALTS = np.random.default_rng(20240612).integers(1, 1 << 63, CHOICES + 1, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


@lru_cache
def bands(largest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Smallest size of each band up to ``largest`` and one beyond, its ``t`` and its ``m``."""
    edges = [1]
    while edges[-1] <= largest or len(edges) < 2:
        edges.append(max(edges[-1] + 1, int(edges[-1] * BAND)))
    unlike, words = [], []
    for low, above in zip(edges, [*edges[1:], int(edges[-1] * BAND) + 1]):
        t = most_unlike(2 * (above - 1), SIMILAR_PERCENT)
        smallest = -(-low * SIMILAR_PERCENT // 100)
        spare = 0
        while _lacking(smallest, t + 1 + spare, spare) > NEEDY and spare < t + 1:
            spare += 1 + spare // 8
        unlike.append(t)
        words.append(t + 1 + spare)
    return np.array(edges), np.array(unlike), np.array(words)


def _lacking(elements: int, words: int, spare: int) -> float:
    """About how likely more than ``spare`` of ``words`` get none of ``elements``."""
    if words == 1:
        return 0.0
    mean = words * (1 - 1 / words) ** elements
    if mean > 50:
        return math.erfc((spare + 0.5 - mean) / math.sqrt(2 * mean)) / 2
    term = total = math.exp(-mean)
    for k in range(1, spare + 1):
        term *= mean / k
        total += term
    return 1 - total


def join_keys(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys at which sets meet, set after set, and their number for each set."""
    edges, unlike, words = bands(1 << int(counts.max(initial=1)).bit_length())
    owner = np.repeat(np.arange(len(counts)), counts)
    own = np.searchsorted(edges, counts, side="right") - 1
    keys, owners = [], []
    reaching = 100 * counts >= SIMILAR_PERCENT * edges[own + 1]
    for band, inside in ((own, counts > 0), (own + 1, (counts > 0) & reaching)):
        for choice in range(CHOICES):
            chosen = inside[owner]
            found, of, full = _sketch(values[chosen], owner[chosen], band, words, choice)
            filled = np.bincount(of, minlength=len(counts))
            # At least m - t words of two similar sets are equal. Where one has fewer empty ones,
            # an equal word is not empty.
            lacking = inside & (filled <= unlike[band])
            keys.append(found)
            owners.append(of)
            if not lacking.any():
                break
            if choice == CHOICES - 1:
                empty, of = _empty(full, of, lacking, band, words, choice)
                keys.append(empty)
                owners.append(of)
            inside = lacking
    keys, owners = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return keys[order], np.bincount(owners, minlength=len(counts))


def _sketch(
    values: np.ndarray, owner: np.ndarray, band: np.ndarray, words: np.ndarray, choice: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the words that are not empty, their sets, and which words these are."""
    draw = values if choice == 0 else mixed(values ^ _SALTS[choice])
    word = (((draw >> np.uint64(32)) * words[band[owner]].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
    if choice:  # by the values themselves words rise already
        order = np.lexsort((word, owner))
        values, owner, word = values[order], owner[order], word[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (word[1:] != word[:-1])
    starts = np.flatnonzero(fresh)
    bits = mixed(values ^ _SALTS[-1])
    parity = np.bitwise_xor.reduceat(bits, starts) if len(starts) else bits
    of, which = owner[starts], word[starts]
    return _named(parity, band[of], which, choice), of, which


def _named(parity: np.ndarray, band: np.ndarray, word: np.ndarray, choice: int) -> np.ndarray:
    place = mixed((band * CHOICES + choice).astype(np.uint64) * _STEP + word.astype(np.uint64))
    return mixed(parity + place)


def _empty(
    full: np.ndarray, of: np.ndarray, lacking: np.ndarray, band: np.ndarray, words: np.ndarray, choice: int
) -> tuple[np.ndarray, np.ndarray]:
    keys, owners = [], []
    for i in np.flatnonzero(lacking).tolist():
        bare = np.setdiff1d(np.arange(words[band[i]]), full[of == i])
        keys.append(_named(np.zeros(len(bare), np.uint64), np.full(len(bare), band[i]), bare, choice))
        owners.append(np.full(len(bare), i))
    return np.concatenate(keys), np.concatenate(owners)


def described(text: Column) -> Column:
    """Struct of a text's n-gram set: its size, 128 bits of fingerprint, the keys it meets at."""

    @F.arrow_udf("struct<n:bigint,f1:bigint,f2:bigint,keys:array<bigint>>")
    def describe(column: pa.Array) -> pa.Array:
        texts = encoded(column)
        none = np.zeros(0, np.int64)
        sizes, prints, keys, numbers = [none], ([none], [none]), [none], [none]
        for lo, hi in groups([len(t) for t in texts]):
            values, counts = shingle_sets(texts[lo:hi], SHINGLE)
            begins = starts_of(counts)
            sizes.append(counts)
            for out, salt in zip(prints, _SALTS[:2], strict=True):
                sums = np.zeros(len(values) + 1, np.uint64)
                np.cumsum(mixed(values + salt), out=sums[1:])
                out.append((sums[begins[1:]] - sums[begins[:-1]]).view(np.int64))
            found, number = join_keys(values, counts)
            keys.append(found.view(np.int64))
            numbers.append(number)
        offsets = pa.array(starts_of(np.concatenate(numbers)), pa.int32())
        columns = [*map(np.concatenate, (sizes, *prints))]
        return pa.StructArray.from_arrays(
            [*map(pa.array, columns), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(keys)))],
            ["n", "f1", "f2", "keys"],
        )

    return describe(text)


def whole_sets(text: Column) -> Column:
    """Struct of the n-gram set as 64-bit fingerprints, and its sketch of single bits."""

    @F.arrow_udf("struct<set:array<bigint>,bits:binary>")
    def whole(column: pa.Array) -> pa.Array:
        texts = encoded(column)
        flat, sizes, bits = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
        for lo, hi in groups([len(t) for t in texts]):
            values, counts = shingle_sets(texts[lo:hi], SHINGLE)
            begins = starts_of(counts)
            bits.extend(bit_sketch(values[a:b]) for a, b in zip(begins[:-1], begins[1:], strict=True))
            flat.append(values.view(np.int64))
            sizes.append(counts)
        offsets = pa.array(starts_of(np.concatenate(sizes)), pa.int32())
        return pa.StructArray.from_arrays(
            [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(flat))), pa.array(bits, pa.binary())],
            ["set", "bits"],
        )

    return whole(text)


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row per row of ``docs``.

    Documents are linked if 100 times their common n-grams are at least 85 times all of both;
    ``component_id`` is the least id reachable by links, itself included. A null, empty or
    wordless text has no n-grams and is linked with nothing. Ids are integers; rows that share
    an id are one node; a row without id is linked with nothing and has a null component.
    Other columns of ``docs`` play no part.
    """
    attach(docs.sparkSession)
    texts = docs.select(quoted(id_col).cast("bigint").alias("doc_id"), quoted(text_col).alias("text"))
    sketched = texts.select("doc_id", F.xxhash64("text").alias("text_hash"), described(F.col("text")).alias("s"))
    rows = kept(sketched.select("doc_id", "text_hash", "s.*"), "sketches")
    known = rows.filter("doc_id is not null and n > 0")
    # A class per set: the least id stands for it.
    classes = known.groupBy("f1", "f2", "n").agg(F.min(F.struct("doc_id", "text_hash")).alias("least"))
    classes = kept(
        classes.select("f1", "f2", "n", F.col("least.doc_id").alias("rep"), "least.text_hash"), "classes"
    )
    labels = _labels(texts, known, classes)
    labelled = classes.join(labels, F.col("rep") == F.col("node"), "left").withColumn(
        "component", F.coalesce("component", "rep")
    )
    by_set = kept(labelled.select("f1", "f2", "n", "component"), "components")
    # An id with several texts ties their classes together.
    several = known.groupBy("doc_id").agg(F.min("f1").alias("x"), F.max("f1").alias("y")).filter("x != y")
    if not several.isEmpty():
        ties = known.join(several, "doc_id", "left_semi").join(by_set, ["f1", "f2", "n"])
        tied = components(ties.select(F.col("doc_id").alias("a"), F.col("component").alias("b")))
        tied = kept(tied.withColumnRenamed("component", "lower"), "ties")
        by_set = by_set.join(tied, F.col("component") == F.col("node"), "left").select(
            "f1", "f2", "n", F.coalesce("lower", "component").alias("component")
        )
    found = rows.select("doc_id", "f1", "f2", "n").join(by_set, ["f1", "f2", "n"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def _labels(texts: DataFrame, known: DataFrame, classes: DataFrame) -> DataFrame:
    """``(node, component)`` of all classes that are linked with another."""
    reps = known.select(F.col("doc_id").alias("rep"), "text_hash", "keys").join(
        _small(classes.select("rep", "text_hash")), ["rep", "text_hash"]
    )
    at_key = Window.partitionBy("key")
    met = reps.select("rep", "text_hash", F.explode("keys").alias("key")).withColumns(
        {"low": F.min("rep").over(at_key), "high": F.max("rep").over(at_key), "size": F.count("rep").over(at_key)}
    )
    buckets = kept(met.filter("low != high").drop("high"), "buckets")
    meeting = kept(buckets.select(F.col("rep").alias("doc_id"), "text_hash").distinct(), "meeting")
    keyed = texts.withColumn("text_hash", F.xxhash64("text")).join(_small(meeting), ["doc_id", "text_hash"], "left_semi")
    rows = known.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("rows"))
    if not rows.filter("rows > 1").isEmpty():  # texts are shuffled only where rows are repeated
        keyed = keyed.dropDuplicates(["doc_id", "text_hash"])
    members = keyed.select(F.col("doc_id").alias("rep"), whole_sets(F.col("text")).alias("s"))
    sets = kept(members.select("rep", F.size("s.set").cast("bigint").alias("n"), "s.set", "s.bits"), "sets")

    pairs = buckets.filter("rep != low").select(F.col("rep").alias("x"), F.col("low").alias("c")).distinct()
    labels = texts.sparkSession.createDataFrame([], "node bigint, component bigint")
    compared: list[DataFrame] = []
    near, apart, active, last = sets, None, None, False
    while True:
        if compared:
            pairs = pairs.join(reduce(DataFrame.union, compared), ["x", "c"], "left_anti")
        if not last:
            pairs = could_be_similar(pairs, near, SIMILAR_PERCENT)
        compared.append(kept(pairs, "pairs"))
        links = kept(_verified(compared[-1], sets), "links")
        found = not links.isEmpty()
        if found:
            labels = kept(components(links.union(labels.toDF("a", "b"))), "labels")
        if last:
            return labels
        if apart is None:
            apart = active = _apart(buckets, labels)
            if apart is None:
                return labels
        elif found:  # buckets without a new link wait for the blocks
            active = _still_apart(active, labels, "low != high and moved")
        last = not found or active is None or len(compared) > ATTACHING
        if not last:
            pairs = kept(_with_largest(active, len(compared)), "candidates")
            near = of_pairs(sets, pairs)
            continue
        if len(compared) > 1:
            apart = _still_apart(apart, labels, "low != high")
            if apart is None:
                return labels
        pairs = pairs_by_blocks(apart, sets, SIMILAR_PERCENT)


def _small(classes: DataFrame) -> DataFrame:
    return F.broadcast(classes) if classes.count() <= BROADCAST_CLASSES else classes


def _pair(a: Column, b: Column) -> list[Column]:
    return [F.greatest(a, b).alias("x"), F.least(a, b).alias("c")]


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that are similar, on the sets themselves."""
    small = of_pairs(sets.select("rep", "n", "set"), pairs)
    x = small.select(F.col("rep").alias("x"), F.col("n").alias("x_n"), F.col("set").alias("x_set"))
    c = small.select(F.col("rep").alias("c"), F.col("n").alias("c_n"), F.col("set").alias("c_set"))
    common = F.size(F.array_intersect("x_set", "c_set")).cast("bigint")
    both = pairs.join(x, "x").join(c, "c").filter(_fitting(F.col("x_n"), F.col("c_n")))
    similar = 100 * common >= SIMILAR_PERCENT * (F.col("x_n") + F.col("c_n") - common)
    return both.filter(similar).select(F.col("x").alias("a"), F.col("c").alias("b"))


def _fitting(n: Column, m: Column) -> Column:
    return 100 * F.least(n, m) >= SIMILAR_PERCENT * F.greatest(n, m)


def _apart(buckets: DataFrame, labels: DataFrame) -> DataFrame | None:
    """Buckets with several components, their members labelled; of equal buckets one.

    Members that have been compared with all others, the least ones, are left out.
    """
    open_ = buckets.filter("size > 2 and rep != low")
    labelled = open_.join(labels, F.col("rep") == F.col("node"), "left").withColumn(
        "label", F.coalesce("component", "rep")
    )
    left = kept(one_of_equal(labelled.select("key", "rep", "label")), "apart")
    return None if left.isEmpty() else left


def _still_apart(apart: DataFrame, labels: DataFrame, which: str) -> DataFrame | None:
    """Those of the buckets that ``which`` tells by their labels' bounds and whether one has ``moved``."""
    new = apart.join(labels, F.col("rep") == F.col("node"), "left").select(
        "key", "rep", F.coalesce("component", "rep").alias("label"), "members", F.col("label").alias("before")
    )
    facts = new.groupBy("key").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.max(F.expr("label != before")).alias("moved")
    )
    left = kept(new.drop("before").join(facts.filter(which), "key", "left_semi"), "apart")
    return None if left.isEmpty() else left


def _with_largest(apart: DataFrame, round_: int) -> DataFrame:
    """Members outside of a bucket's largest component with one of it, another one each round."""
    one = F.min(F.struct(F.xxhash64("rep", F.lit(round_)), "rep")).alias("one")
    parts = apart.groupBy("key", "label").agg(F.count(F.lit(1)).alias("size"), one)
    top = parts.groupBy("key").agg(F.max(F.struct("size", "label", "one")).alias("top"))
    chosen = top.select("key", F.col("top.label").alias("of"), F.col("top.one.rep").alias("one"))
    outside = apart.join(chosen, "key").filter(F.col("label") != F.col("of"))
    return outside.select(*_pair(F.col("rep"), F.col("one"))).distinct()
