"""Product codes of vectors: integer codebooks trained in rounds, nearest entries found by GNAT.

A vector is cut into equal parts, and each part is coded by the nearest entry of its part's
codebook. Components are integers, ``floor(256 x)``, so every distance, sum and mean is exact
and runs agree however the rows are dealt out.

The entries of a codebook stand in a geometric near-neighbour access tree: a node has a few
split points, every other entry belongs to the nearest of them, and for each pair of a split
point and a child the least and greatest distance between them are stored. By the triangle
inequality a child is left out where its range lies strictly beyond what the best entry found
so far allows. These tests are made with roots rounded outwards; which entry is nearest, and
the lower index among equals, is decided on integer squares.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.llm.tables import kept, quoted
from shardloom.session import attach

PARTS, ENTRIES, ROUNDS = 16, 64, 2
SCALE = 256
# Split points of a node, and entries that are compared one by one rather than split further.
SPLITS, LEAF = 8, 8
# Rows coded at once.
LOT = 1 << 14
# Labels whose totals are broadcast (16 bytes each); more are joined by a salted shuffle.
BROADCAST_LABELS = 1 << 20
SALTS = 16

# Relative room for the rounding of a root and of a sum of two of them.
_ROOM = 2.0**-48


def squares(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Squared distances of int64 points, a row per point and a column per other point."""
    total = np.zeros((len(points), len(others)), np.int64)
    for c in range(points.shape[1]):
        apart = points[:, c, None] - others[None, :, c]
        total += apart * apart
    return total


@dataclass
class Child:
    """A subtree, and its members' least and greatest distance from each split point."""

    node: Node
    low: np.ndarray
    high: np.ndarray


class Node:
    """Entries ``members`` (row numbers) of a codebook: split points with children, or a leaf."""

    def __init__(self, entries: np.ndarray, members: np.ndarray) -> None:
        self.ids = members
        self.children: list[Child | None] = []
        if len(members) > LEAF:
            self.ids = _far_apart(entries, members)
        self.points = entries[self.ids]
        rest = members[~np.isin(members, self.ids)]
        if not len(rest):
            return
        apart = squares(entries[rest], self.points)
        home = apart.argmin(axis=1)
        for j in range(len(self.ids)):
            mine = home == j
            if not mine.any():
                self.children.append(None)
                continue
            roots = np.sqrt(apart[mine].astype(np.float64))
            low, high = roots.min(axis=0) * (1 - _ROOM), roots.max(axis=0) * (1 + _ROOM)
            self.children.append(Child(Node(entries, rest[mine]), low, high))


def _far_apart(entries: np.ndarray, members: np.ndarray) -> np.ndarray:
    """Split points: the first member, then always the one farthest from those chosen."""
    chosen = [0]
    away = squares(entries[members], entries[members[:1]])[:, 0]
    while len(chosen) < SPLITS and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, squares(entries[members], entries[members[chosen[-1:]]])[:, 0])
    if len(chosen) < 2:  # all alike: nothing to split by
        return members
    return members[np.sort(chosen)]


class Gnat:
    """The nearest of some entries, for many points at once."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        self.root = Node(entries, np.arange(len(entries)))
        self.compared = 0

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry (the lower among equals) and the squared distance."""
        best = np.full(len(points), np.iinfo(np.int64).max)
        index = np.full(len(points), len(self.entries), np.int64)
        self._search(self.root, points, np.arange(len(points)), best, index)
        return index, best

    def _search(
        self, node: Node, points: np.ndarray, rows: np.ndarray, best: np.ndarray, index: np.ndarray
    ) -> None:
        apart = squares(points[rows], node.points)
        self.compared += apart.size
        home = apart.argmin(axis=1)  # the first of equals: split points stand by rising index
        there, entry = apart[np.arange(len(rows)), home], node.ids[home]
        least = best[rows]
        closer = (there < least) | ((there == least) & (entry < index[rows]))
        best[rows[closer]], index[rows[closer]] = there[closer], entry[closer]
        if not node.children:
            return
        # The child of the nearest split point first: what it finds narrows the search in others.
        for j, child in enumerate(node.children):
            mine = rows[home == j] if child is not None else ()
            if len(mine):
                self._search(child.node, points, mine, best, index)
        roots = np.sqrt(apart.astype(np.float64))
        reach = np.sqrt(best[rows].astype(np.float64))[:, None] * (1 + _ROOM)
        inner = (roots * (1 - _ROOM) - reach) * (1 - _ROOM)
        outer = (roots * (1 + _ROOM) + reach) * (1 + _ROOM)
        for j, child in enumerate(node.children):
            if child is None:
                continue
            beyond = ((inner > child.high) | (outer < child.low)).any(axis=1)
            left = rows[~beyond & (home != j)]
            if len(left):
                self._search(child.node, points, left, best, index)


def valid(vector: str):
    """Whether a vector has components, and all of them are finite."""
    column = quoted(vector)
    finite = F.forall(column, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return column.isNotNull() & (F.size(column) > 0) & finite


def whole_parts(vectors: pa.Array | pa.ChunkedArray, parts: int, width: int) -> np.ndarray:
    """Integer components ``[row, part, position]``; lengths must agree, values be in range."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    lengths = np.diff(vectors.offsets.to_numpy())
    if (lengths != parts * width).any():
        raise ValueError(f"a vector's length is not {parts * width}, as the first one's is")
    # Doubles hold a float times 256 exactly, so the floor is exact as well.
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE
    if len(flat) and np.abs(flat).max() >= _limit(parts * width):
        raise ValueError("a component is too large for exact distances of 64 bits")
    return np.floor(flat).astype(np.int64).reshape(-1, parts, width)


def _limit(length: int) -> float:
    """Components below it have squared distances that add up to less than 2^62."""
    return float((1 << 30) / np.sqrt(length))


def first_entries(
    vectors: DataFrame, id_col: str, vector_col: str, parts: int, entries: int
) -> np.ndarray:
    """Codebooks ``[part, entry, position]`` made of the vectors of the smallest ids.

    Rows of one id are taken by their components, those without id last. At most ``entries``
    rows come to the driver. Without vectors there are no entries.
    """
    rows = vectors.select(quoted(id_col).alias("i"), quoted(vector_col).alias("v"))
    seeds = rows.orderBy(F.col("i").asc_nulls_last(), "v").limit(entries).toArrow()
    if not seeds.num_rows:
        return np.zeros((parts, 0, 0), np.int64)
    column = seeds.column("v").combine_chunks()
    length = len(column[0])
    if length % parts:
        raise ValueError(f"vectors of {length} components cannot be cut into {parts} equal parts")
    return whole_parts(column, parts, length // parts).transpose(1, 0, 2).copy()


def train(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> np.ndarray:
    """Integer codebooks ``[part, entry, position]`` after ``rounds`` of assigning and averaging.

    Tasks add up the parts of each entry and pass on a row per entry and position; only these
    totals, whose number the parameters fix, come to the driver. Means are rounded down,
    entries that no part is nearest to stay. Vectors that are null, empty or hold null or
    non-finite components play no part; one of another length than the first, or with
    components whose distances do not fit 64 bits (about 130,000 for 64 components), fails the run.
    """
    attach(vectors.sparkSession)
    known = vectors.filter(valid(vector_col))
    books = first_entries(known, id_col, vector_col, parts, entries)
    rows = known.select(quoted(vector_col).alias("v"))
    for _ in range(rounds if books.size else 0):
        totals = rows.mapInArrow(_adding(books), "slot bigint, total bigint")
        summed = totals.groupBy("slot").agg(F.sum("total").alias("total")).toArrow()
        flat = np.zeros(books.shape[0] * books.shape[1] * (books.shape[2] + 1), np.int64)
        flat[summed.column("slot").to_numpy()] = summed.column("total").to_numpy()
        flat = flat.reshape(*books.shape[:2], books.shape[2] + 1)
        counts = flat[:, :, -1:]
        # Integer division of numpy goes down, as the floor does.
        books = np.where(counts > 0, flat[:, :, :-1] // np.maximum(counts, 1), books)
    return books


def _adding(books: np.ndarray):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(book) for book in books]
        parts, entries, width = books.shape
        totals = np.zeros((parts, width + 1, entries), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, LOT):
                points = whole_parts(batch.column("v").slice(at, LOT), parts, width)
                for p, tree in enumerate(trees):
                    index, _ = tree.nearest(points[:, p])
                    for c in range(width):
                        np.add.at(totals[p, c], index, points[:, p, c])
                    totals[p, width] += np.bincount(index, minlength=entries)
        flat = totals.transpose(0, 2, 1).reshape(-1)
        slots = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(flat[slots])], ["slot", "total"])

    return add


def encode(
    vectors: DataFrame,
    books: np.ndarray,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``(id, label, code, error)`` of every vector that :func:`train` takes.

    ``code`` has two hexadecimal digits for each part (at most 256 entries), ``error`` is the
    sum of the squared distances of all parts. Null ids and labels stay null, repeated rows
    stay, other columns play no part.
    """
    attach(vectors.sparkSession)
    if books.shape[1] > 256:
        raise ValueError("two digits hold 256 entries at most")
    digits = np.array([f"{i:02x}".encode() for i in range(256)], "S2")

    @F.arrow_udf("struct<code:string,error:bigint>")
    def coded(column: pa.Array) -> pa.Array:
        trees = [Gnat(book) for book in books]
        parts, _, width = books.shape
        codes, errors = [], []
        for at in range(0, len(column), LOT):
            points = whole_parts(column.slice(at, LOT), parts, width)
            found = [tree.nearest(points[:, p]) for p, tree in enumerate(trees)]
            text = np.stack([digits[index] for index, _ in found], axis=1)
            codes.append(np.ascontiguousarray(text).view(f"S{2 * parts}")[:, 0])
            errors.append(sum(square for _, square in found))
        code = np.concatenate(codes) if codes else np.zeros(0, "S2")
        error = np.concatenate(errors) if errors else np.zeros(0, np.int64)
        return pa.StructArray.from_arrays(
            [pa.array(code.astype(str), pa.string()), pa.array(error)], ["code", "error"]
        )

    known = vectors.filter(valid(vector_col)).select(
        quoted(id_col).alias("id"), quoted(label_col).alias("label"), quoted(vector_col).alias("v")
    )
    return known.select("id", "label", coded("v").alias("c")).select("id", "label", "c.code", "c.error")


def with_label_errors(coded: DataFrame) -> DataFrame:
    """Add ``label_error``: ``error`` summed over the rows of an equal label, nulls together.

    Totals come from partial sums. Up to ``BROADCAST_LABELS`` of them are broadcast; of more,
    each is given ``SALTS`` times, so that the rows of a frequent label spread over tasks.
    """
    key = F.struct(F.col("label").alias("of"))  # never null, and nulls in it are equal
    totals = kept(
        coded.groupBy(key.alias("_label")).agg(F.sum("error").alias("label_error")), "label_errors"
    )
    rows = coded.withColumn("_label", key)
    if totals.count() <= BROADCAST_LABELS:
        joined = rows.join(F.broadcast(totals), "_label")
    else:
        salted = totals.withColumn("_salt", F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")))
        rows = rows.withColumn("_salt", F.pmod(F.xxhash64("id", "code"), F.lit(SALTS)))
        joined = rows.join(salted, ["_label", "_salt"])
    return joined.select(*coded.columns, "label_error")


def digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' components by part, entry and position, with commas between."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compress(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """Coded vectors ``(id, label, code, error, label_error)`` and the codebooks.

    A table without valid vectors gives no rows. The coded rows are written once, as both
    their label's totals and the result read them.
    """
    books = train(vectors, id_col, vector_col, parts, entries, rounds)
    if not books.size:
        columns = "code string, error bigint, label_error bigint"
        names = vectors.select(quoted(id_col).alias("id"), quoted(label_col).alias("label"))
        added = [F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in columns.split(", ")]
        return names.filter(F.lit(False)).select("*", *added), books
    coded = kept(encode(vectors, books, id_col, vector_col, label_col), "codes")
    return with_label_errors(coded), books
