"""Near-duplicate documents: SuperMinHash signatures, banding, verification, union-find.

A document is its set of distinct word shingles. Equal sets are one class from the start, so
copies cost a row of an aggregation each. The classes' SuperMinHash signatures are cut into
bands, and classes with an equal band meet in a bucket. In a bucket the least class is
compared with all others, on full sets, and the links join into components. Where several
components are left, those besides the largest are compared with a seeded member of it, as
long as that finds links: large groups of near copies come together at a row per member
and round. What is then still apart is settled by an exact prefix filter on the rarest
shingles, which leaves out no pair and does not grow with the square of a bucket.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.llm.graph import components
from shardloom.llm.sketches import bit_sketch, could_be_similar, of_pairs, one_of_equal, pairs_by_blocks
from shardloom.llm.tables import clear_name, kept, quoted
from shardloom.llm.text import (
    encoded,
    groups,
    mixed,
    starts_of,
    window_fingerprints,
    word_fingerprints,
)
from shardloom.session import attach

SHINGLE = 5
SIMILAR_PERCENT = 75
# 85 bands of 6: a pair at the threshold is missed by all with probability 6e-8, one of
# similarity 0.3 meets in a given band with 7e-4.
BANDS, BAND_ROWS = 85, 6
SIGNATURE = BANDS * BAND_ROWS
SEED = np.uint64(0x8A5CD789635D2DFF)
# Rounds that attach what is apart to a bucket's largest component, at most.
ATTACHING = 6
# Elements whose permutations are held at once, SIGNATURE bytes each.
ELEMENTS = 1 << 15

_STEP = np.uint64(0x9E3779B97F4A7C15)
_SETS = "struct<n:bigint,f1:bigint,f2:bigint,bands:array<bigint>>"


def shingle_sets(texts: list[bytes], width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle fingerprints of each text, one after another, and their numbers.

    A-Z count as a-z. A text of fewer words is one shingle, without words it has none.
    """
    words, counts = word_fingerprints([t.lower() for t in texts])
    begins = starts_of(counts)
    owner = np.repeat(np.arange(len(texts)), counts)
    values = window_fingerprints(words, width)
    whole = owner[: len(values)] == owner[width - 1 :][: len(values)]
    values, owners = values[whole], owner[: len(whole)][whole]
    few = np.flatnonzero((counts > 0) & (counts < width))
    if len(few):
        ends = [
            int(window_fingerprints(words[begins[i] : begins[i + 1]], int(counts[i]))[0] ^ np.uint64(counts[i]))
            for i in few
        ]
        values = np.concatenate([values, np.array(ends, np.uint64)])
        owners = np.concatenate([owners, few])
    order = np.lexsort((values, owners))
    values, owners = values[order], owners[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])
    return values[fresh], np.bincount(owners[fresh], minlength=len(texts)).astype(np.int64)


def superminhash(values: np.ndarray, counts: np.ndarray, size: int = SIGNATURE) -> np.ndarray:
    """Signatures of sets of distinct elements, a row per set; empty sets keep infinity.

    Element by element, step ``j`` draws a fraction and the next slot of the element's own
    random permutation, and lowers that slot to ``j`` plus the fraction. As a slot that has
    less than ``j`` cannot be lowered in step ``j``, a set stops when all its slots have.
    """
    table = np.full((len(counts), size), np.inf)
    begins = starts_of(counts)
    for lo, hi in groups(counts.tolist(), ELEMENTS):
        for at in range(int(begins[lo]), int(begins[hi]), 4 * ELEMENTS):  # a larger set, in lots
            end = min(at + 4 * ELEMENTS, int(begins[hi]))
            owner = np.searchsorted(begins, np.arange(at, end), side="right") - 1
            _lower(table, values[at:end], owner)
    return table


def _lower(table: np.ndarray, values: np.ndarray, owner: np.ndarray) -> None:
    size = table.shape[1]
    flat = table.reshape(-1)
    slots = np.tile(np.arange(size, dtype=np.uint8 if size <= 256 else np.uint16), (len(values), 1))
    at = np.arange(len(values))
    first, last = int(owner.min()), int(owner.max()) + 1
    for j in range(size):
        draw = mixed(values[at] ^ _salt(2 * j))
        fraction = (draw >> np.uint64(11)).astype(np.float64) * 2.0**-53
        draw = mixed(values[at] ^ _salt(2 * j + 1))
        k = j + (((draw >> np.uint64(32)) * np.uint64(size - j)) >> np.uint64(32)).astype(np.int64)
        slot = slots[at, k]
        slots[at, k] = slots[at, j]
        np.minimum.at(flat, owner * size + slot, fraction + j)
        left = table[first:last].max(axis=1) >= j + 1
        go_on = left[owner - first]
        if not go_on.all():
            at, owner = at[go_on], owner[go_on]
            if not len(at):
                break


def _salt(k: int) -> np.uint64:
    return np.uint64((int(SEED) + (k + 1) * int(_STEP)) % (1 << 64))


def bands_of(signatures: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key per band, different from band to band."""
    bits = np.ascontiguousarray(signatures).view(np.uint64).reshape(len(signatures), bands, -1)
    keys = np.broadcast_to(np.arange(bands, dtype=np.uint64), bits.shape[:2]).copy()
    for k in range(bits.shape[2]):
        keys = mixed(keys * _STEP + bits[:, :, k])
    return keys.view(np.int64)


def described(text: Column) -> Column:
    """Struct of a text's shingle set: size, 128-bit fingerprint and band keys (null if empty)."""

    @F.arrow_udf(_SETS)
    def describe(column: pa.Array) -> pa.Array:
        texts = encoded(column)
        sizes, prints, keys = [], [], []
        for lo, hi in groups([len(t) for t in texts]):
            values, counts = shingle_sets(texts[lo:hi])
            begins = starts_of(counts)
            sizes.append(counts)
            for salt in (SEED, _STEP):
                sums = np.zeros(len(values) + 1, np.uint64)
                np.cumsum(mixed(values + salt), out=sums[1:])
                prints.append(sums[begins[1:]] - sums[begins[:-1]])
            keys.append(bands_of(superminhash(values, counts)))
        n = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)

        def joined(parts: list[np.ndarray]) -> pa.Array:
            return pa.array(np.concatenate(parts).view(np.int64) if parts else n)

        def lists(parts: list[np.ndarray], width: int) -> pa.Array:
            flat = np.concatenate(parts)[n > 0].reshape(-1) if parts else n
            offsets = pa.array(np.concatenate([[0], np.cumsum((n > 0) * width)]), pa.int32())
            return pa.ListArray.from_arrays(offsets, pa.array(flat), mask=pa.array(n == 0))

        return pa.StructArray.from_arrays(
            [pa.array(n), joined(prints[::2]), joined(prints[1::2]), lists(keys, BANDS)],
            ["n", "f1", "f2", "bands"],
        )

    return describe(text)


def full_sets(text: Column) -> Column:
    """Struct of the shingle set as an array of 64-bit fingerprints, and its parity sketch."""

    @F.arrow_udf("struct<set:array<bigint>,bits:binary>")
    def full(column: pa.Array) -> pa.Array:
        texts, none = encoded(column), np.zeros(0, np.int64)
        flat, sizes, bits = [none], [none], []
        for lo, hi in groups([len(t) for t in texts]):
            values, counts = shingle_sets(texts[lo:hi])
            begins = starts_of(counts)
            bits.extend(bit_sketch(values[a:b]) for a, b in zip(begins[:-1], begins[1:], strict=True))
            flat.append(values.view(np.int64))
            sizes.append(counts)
        offsets = pa.array(starts_of(np.concatenate(sizes)), pa.int32())
        return pa.StructArray.from_arrays(
            [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(flat))), pa.array(bits, pa.binary())],
            ["set", "bits"],
        )

    return full(text)


def similar(left: Column, n: Column, right: Column, m: Column) -> Column:
    """Whether 100 times the intersection is at least ``SIMILAR_PERCENT`` times the union."""
    common = F.size(F.array_intersect(left, right)).cast("bigint")
    return 100 * common >= SIMILAR_PERCENT * (n + m - common)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per row of ``docs``.

    Documents are linked if 100 times the common shingles are at least 75 times all of both;
    ``component_id`` is the least id reachable by links, itself included; ``kept`` tells
    whether it is the document's own. A null, empty or wordless text has no shingles and is
    linked with nothing. Ids are integers; rows that share an id are one node, and all are
    kept or none; a row without id is linked with nothing, has a null component and is kept.
    Other columns of ``docs`` play no part.
    """
    attach(docs.sparkSession)
    texts = docs.select(quoted(id_col).cast("bigint").alias("doc_id"), quoted(text_col).alias("text"))
    by_text = F.xxhash64("text").alias("text_hash")
    sets = texts.select("doc_id", by_text, described(F.col("text")).alias("s"))
    rows = kept(sets.select("doc_id", "text_hash", "s.*"), "sets")
    known = rows.filter("doc_id is not null and n > 0")
    # A class per set: the least id stands for it.
    classes = kept(
        known.groupBy("f1", "f2", "n")
        .agg(F.min(F.struct("doc_id", "text_hash")).alias("least"), F.first("bands").alias("bands"))
        .select("f1", "f2", "n", F.col("least.doc_id").alias("rep"), "least.text_hash", "bands"),
        "classes",
    )
    labels = _labels(texts, known, classes)
    by_set = classes.join(labels, F.col("rep") == F.col("node"), "left").select(
        "f1", "f2", "n", F.coalesce("component", "rep").alias("component")
    )
    by_set = kept(by_set, "components")
    # An id with several texts ties their classes together.
    several = known.groupBy("doc_id").agg(F.min("f1").alias("x"), F.max("f1").alias("y")).filter("x != y")
    if not several.isEmpty():
        ties = known.join(several, "doc_id", "left_semi").join(by_set, ["f1", "f2", "n"])
        more = components(ties.select(F.col("doc_id").alias("a"), F.col("component").alias("b")))
        more = kept(more.withColumnRenamed("component", "lower"), "ties")
        by_set = by_set.join(more, F.col("component") == F.col("node"), "left").select(
            "f1", "f2", "n", F.coalesce("lower", "component").alias("component")
        )
    found = rows.join(by_set, ["f1", "f2", "n"], "left")
    component = F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("component")), F.col("doc_id"))
    return found.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def _labels(texts: DataFrame, known: DataFrame, classes: DataFrame) -> DataFrame:
    """``(node, component)`` of all classes that are linked with another."""
    banded = classes.select("rep", "text_hash", "n", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    buckets = kept(banded.join(shared.select("band"), "band"), "buckets")
    meeting = buckets.select(F.col("rep").alias("doc_id"), "text_hash").distinct()
    keyed = texts.withColumn("text_hash", F.xxhash64("text")).join(meeting, ["doc_id", "text_hash"], "left_semi")
    copies = known.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("rows"))
    if not copies.filter("rows > 1").isEmpty():  # texts are shuffled only where rows are repeated
        keyed = keyed.dropDuplicates(["doc_id", "text_hash"])
    sets = keyed.select(F.col("doc_id").alias("rep"), full_sets(F.col("text")).alias("s"))
    sets = kept(sets.select("rep", F.size("s.set").cast("bigint").alias("n"), "s.set", "s.bits"), "full_sets")
    compared: list[DataFrame] = []
    labels, apart, rounds = None, buckets, 0
    while True:
        last = labels is not None and rounds == 0
        if labels is None:
            pairs = _with_least(buckets)
        elif rounds:
            pairs = _with_largest(apart, rounds)
        else:
            blocks = one_of_equal(apart.select(F.col("band").alias("key"), "rep", "label").distinct())
            pairs = pairs_by_blocks(kept(blocks, "blocks"), sets, SIMILAR_PERCENT)
        if compared:
            pairs = pairs.join(reduce(DataFrame.union, compared), ["x", "c"], "left_anti")
        if not last:
            pairs = could_be_similar(pairs, sets, SIMILAR_PERCENT)
        compared.append(kept(pairs, "pairs"))
        new = kept(_verified(compared[-1], sets), "verified")
        found = not new.isEmpty()
        if labels is None or found:
            linked = new if labels is None else new.union(labels.toDF("a", "b"))
            labels = kept(components(linked), "labels")
        if last:
            return labels
        rounds = rounds + 1 if found and rounds < ATTACHING else 0
        apart = _still_apart(buckets, labels)
        if apart is None:
            return labels


def _fitting(joined: DataFrame, apart: Column) -> DataFrame:
    """Distinct pairs ``(x, c)``, without sizes that cannot reach the similarity."""
    fits = 100 * F.least("n", "cn") >= SIMILAR_PERCENT * F.greatest("n", "cn")
    ends = joined.filter(fits & apart).select(F.greatest("rep", "c").alias("x"), F.least("rep", "c").alias("c"))
    return ends.distinct()


def _with_least(buckets: DataFrame) -> DataFrame:
    """Members of a bucket with the least of them."""
    least = buckets.groupBy("band").agg(F.min(F.struct("rep", "n")).alias("least"))
    centres = least.select("band", F.col("least.rep").alias("c"), F.col("least.n").alias("cn"))
    return _fitting(buckets.join(centres, "band"), F.col("rep") > F.col("c"))


def _with_largest(buckets: DataFrame, round_: int) -> DataFrame:
    """Members outside of a bucket's largest component with one member of it, another each round."""
    drawn = F.min(F.struct(F.xxhash64("rep", F.lit(round_)).alias("at"), "rep", "n"))
    groups_ = buckets.groupBy("band", "label").agg(F.count(F.lit(1)).alias("members"), drawn.alias("one"))
    largest = groups_.groupBy("band").agg(F.max(F.struct("members", "label", "one")).alias("top"))
    centres = largest.filter("top.members > 1").select(
        "band", F.col("top.label").alias("c_label"), F.col("top.one.rep").alias("c"),
        F.col("top.one.n").alias("cn"),
    )
    return _fitting(buckets.join(centres, "band"), F.col("label") != F.col("c_label"))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    small = of_pairs(sets.select("rep", "n", "set"), pairs)
    left = pairs.join(small.select(F.col("rep").alias("c"), F.col("n").alias("c_n"), F.col("set").alias("c_set")), "c")
    both = left.join(small.select(F.col("rep").alias("x"), F.col("n").alias("x_n"), F.col("set").alias("x_set")), "x")
    found = both.filter(similar(F.col("x_set"), F.col("x_n"), F.col("c_set"), F.col("c_n")))
    return found.select(F.col("x").alias("a"), F.col("c").alias("b"))


def _still_apart(buckets: DataFrame, labels: DataFrame) -> DataFrame | None:
    """Buckets with several components, their members labelled."""
    labelled = buckets.join(labels, F.col("rep") == F.col("node"), "left").select(
        "band", "rep", "n", F.coalesce("component", "rep").alias("label")
    )
    several = labelled.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    left = kept(labelled.join(several.filter("low != high").select("band"), "band"), "apart")
    return None if left.isEmpty() else left


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` of each component of near duplicates, columns as they were.

    It is a row whose id stands for its component; of several rows of that id, the least by
    their columns. A row without id takes part by its text, behind all rows with one; without
    words it is linked with nothing and stays. ``docs`` is read several times and must give
    the same rows each time, as tables do.
    """
    key, row = (clear_name(docs, name) for name in ("_key", "_row"))
    text = quoted(text_col)
    # Stands for the text of a row without id; beyond ids in use, so that rows with one come first.
    by_text = F.xxhash64(text).bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    own = F.when(quoted(id_col).isNotNull(), quoted(id_col).cast("bigint")).when(
        text.rlike(r"[^\x20\x09-\x0D]"), by_text
    )
    found = near_duplicates(docs.select(own.alias("doc_id"), text.alias("text")))
    gone = kept(found.filter(~F.col("kept")).select(F.col("doc_id").alias(key)).distinct(), "gone")
    rows = docs.withColumn(key, own).join(gone, key, "left_anti")
    again = rows.filter(quoted(key).isNotNull()).groupBy(quoted(key)).count().filter("count > 1")
    again = kept(again.select(key), "repeated_ids")
    if again.isEmpty():
        return rows.select(*map(quoted, docs.columns))
    columns = [quoted(c) for c in docs.columns]
    once = rows.join(again, key, "left_anti").select(*columns)
    first = rows.join(again, key, "left_semi").groupBy(quoted(key)).agg(F.min(F.struct(*columns)).alias(row))
    return once.union(first.select(*[quoted(row).getField(c).alias(c) for c in docs.columns]))
