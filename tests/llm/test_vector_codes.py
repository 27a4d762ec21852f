"""Product codes against plain loops over Python integers."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardloom.llm import vector_codes
from shardloom.llm.vector_codes import Gnat

SCHEMA = "vec_id bigint, embedding array<float>, label int, Code string, `a.b` int"


def by_brute_force(rows, parts, entries, rounds):
    """``{(vec_id, code, error, label_error): count}`` of valid rows, and the codebooks."""
    known = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    known.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = [[math.floor(256 * x) for x in r[1]] for r in known]
    width = len(whole[0]) // parts if whole else 0

    def part(v, p):
        return v[p * width : (p + 1) * width]

    def near(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), i) for i, e in enumerate(book))

    books = [[part(v, p) for v in whole[:entries]] for p in range(parts)]
    for _ in range(rounds):
        for p in range(parts):
            mine: dict[int, list] = {}
            for v in whole:
                mine.setdefault(near(part(v, p), books[p])[1], []).append(part(v, p))
            books[p] = [
                [sum(c) // len(mine[i]) for c in zip(*mine[i])] if i in mine else e
                for i, e in enumerate(books[p])
            ]
    coded = []
    for r, v in zip(known, whole):
        found = [near(part(v, p), books[p]) for p in range(parts)]
        coded.append((r[0], r[2], "".join(f"{i:02x}" for _, i in found), sum(d for d, _ in found)))
    totals: dict = {}
    for _, label, _, error in coded:
        totals[label] = totals.get(label, 0) + error
    return sorted(((i, c, e, totals[l]) for i, l, c, e in coded), key=repr), books


def vectors(rng, n, length):
    return [[rng.choice((-1.5, -0.3, 0.0, 0.26, 0.5)) + rng.randint(0, 3) / 256 for _ in range(length)] for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    made = [(i, v, rng.choice((None, 1, 2)), "x", i) for i, v in enumerate(vectors(rng, 150, 8), 3)]
    odd = [
        (0, None, 1, None, None), (1, [1.0] * 7 + [None], 1, None, None),
        (2, [float("nan")] + [0.0] * 7, 1, None, None), (5000, [float("inf")] * 8, 1, None, None),
        (5001, [], None, None, None), (None, [0.25] * 8, None, None, None), (None, None, None, None, None),
        made[4], (7, made[9][1], None, None, None),
    ]
    return made + odd


@pytest.mark.parametrize("parts,entries,rounds", [(4, 16, 2), (2, 64, 2), (8, 3, 0), (1, 40, 3)])
def test_codes_equal_brute_force(spark, rows, parts, entries, rounds):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    coded, books = vector_codes.compress(df, parts=parts, entries=entries, rounds=rounds)
    got = sorted(((r.id, r.code, r.error, r.label_error) for r in coded.collect()), key=repr)
    want, plain = by_brute_force([(r[0], r[1] and [None if x is None else float(np.float32(x)) for x in r[1]], r[2]) for r in rows], parts, entries, rounds)
    assert books.tolist() == plain
    assert got == want


def test_many_labels_are_joined_by_salt(spark, rows, monkeypatch):
    df = spark.createDataFrame(rows, SCHEMA)
    coded = vector_codes.compress(df, parts=2)[0].orderBy("id", "code").collect()
    monkeypatch.setattr(vector_codes, "BROADCAST_LABELS", 1)
    assert vector_codes.compress(df, parts=2)[0].orderBy("id", "code").collect() == coded


@pytest.mark.parametrize("size,width", [(1, 1), (2, 2), (9, 2), (64, 4), (200, 3)])
def test_the_tree_finds_the_first_nearest(size, width):
    rng = np.random.default_rng(size)
    for spread in (1, 4, 1 << 28):  # few values make many ties, squares of large ones lose bits as doubles
        entries = rng.integers(-spread, spread + 1, (size, width))
        points = np.concatenate([rng.integers(-spread, spread + 1, (500, width)), entries])
        index, square = Gnat(entries).nearest(points)
        all_ = vector_codes.squares(points, entries)
        assert (index == all_.argmin(axis=1)).all() and (square == all_.min(axis=1)).all()


def test_the_tree_leaves_subtrees_out():
    rng = np.random.default_rng(1)
    entries, points = rng.integers(-200, 200, (256, 4)), rng.integers(-200, 200, (4000, 4))
    tree = Gnat(entries)
    tree.nearest(points)
    assert tree.compared < 0.5 * len(points) * len(entries)


def test_no_vectors(spark):
    for rows in ([], [(1, None, 2, None, None), (2, [], None, None, None)]):
        coded, books = vector_codes.compress(spark.createDataFrame(rows, SCHEMA))
        assert coded.columns == ["id", "label", "code", "error", "label_error"]
        assert coded.count() == 0 and vector_codes.digest(books) == vector_codes.digest(books[:0])


def test_what_cannot_be_coded_fails(spark):
    ragged = spark.createDataFrame([(1, [0.0] * 4), (2, [0.0] * 8)], "vec_id bigint, embedding array<float>")
    with pytest.raises(Exception, match="length is not"):
        vector_codes.train(ragged, parts=4)
    huge = ragged.withColumn("embedding", F.array(*[F.lit(1e30).cast("float")] * 4))
    with pytest.raises(Exception, match="too large"):
        vector_codes.train(huge, parts=4)
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes.train(ragged.filter("vec_id = 1"), parts=3)
