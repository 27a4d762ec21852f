"""The similarity join against comparing all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardloom.llm import ngram_join, sketches
from shardloom.llm.near_dedup import shingle_sets

SCHEMA = "doc_id bigint, text string, Key string, `a.b` int"
WORDS = [a + b for a in "ba ce di fo gu la".split() for b in "ro sa te vi xo".split()]


def grams(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))} if words else set()


def joined(rows):
    """``{(doc_id, n, component)}`` by comparing all pairs of rows."""
    sets = [grams(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            same = rows[i][0] is not None and rows[i][0] == rows[j][0] and a and b
            if rows[i][0] is None or rows[j][0] is None:
                continue
            if same or (a and b and 100 * len(a & b) >= 85 * len(a | b)):
                parent[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), r[0]), r[0])
    return sorted(
        ((r[0], len(s), None if r[0] is None else least[root(i)]) for i, (r, s) in enumerate(zip(rows, sets))),
        key=repr,
    )


def words(rng, n):
    return [rng.choice(WORDS) + str(rng.randint(0, 9)) for _ in range(n)]


def edited(rng, base, edits):
    out = list(base)
    for _ in range(edits):
        at = rng.randrange(len(out))
        out[at : at + rng.randint(0, 2)] = words(rng, rng.randint(0, 2))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    texts = [None, "", " \n", "one", "One", "a b c", "a b c d", "a b c d e", "é 😀 a b"]
    for n in (5, 8, 12, 25, 60, 150, 400, 900):  # around the threshold at all sizes
        base = words(rng, n)
        texts += [" ".join(edited(rng, base, rng.randint(0, max(1, n // 40)))) for _ in range(14)]
        texts += [" ".join(base[k:]) for k in range(0, n // 8, max(1, n // 60))]
    long_ = words(rng, 20_000)
    texts += [" ".join(long_), " ".join(edited(rng, long_, 200)).upper(), " ".join(edited(rng, long_, 900))]
    made = [(i, t, "clash", i) for i, t in enumerate(texts)]
    rng.shuffle(made)
    return [*made, made[5], (None, "a b c d e", None, None), (None, None, None, None), (700, texts[20], "x", 1)]


@pytest.mark.parametrize("attaching,block", [(3, 256), (0, 3)])
def test_components_equal_all_pairs(spark, rows, monkeypatch, attaching, block):
    monkeypatch.setattr(ngram_join, "ATTACHING", attaching)
    monkeypatch.setattr(sketches, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "BROADCAST_CLASSES", attaching)
    found = ngram_join.ngram_components(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, found.collect()), key=repr) == joined(rows)


def test_one_id_with_several_texts(spark):
    rng = random.Random(9)
    a, b, c = (" ".join(words(rng, 40)) for _ in range(3))
    rows = [(5, a, None, None), (5, b, None, None), (2, a, None, None), (9, b, None, None), (3, c, None, None)]
    found = ngram_join.ngram_components(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, found.collect()), key=repr) == joined(rows)


def test_a_group_of_edited_copies_without_its_base(spark):
    """Some pairs are linked, most lie just below: none may be lost."""
    rng = random.Random(12)
    base = words(rng, 120)
    rows = [(i, " ".join(edited(rng, base, 4)), None, None) for i in range(150)]
    found = ngram_join.ngram_components(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, found.collect()), key=repr) == joined(rows)


def test_buckets_whose_members_come_twice_are_not_equal(spark):
    rows = [(key, rep, rep) for key, reps in {1: (1, 2), 2: (3, 4), 3: (1, 2)}.items() for rep in reps * 2]
    one = sketches.one_of_equal(spark.createDataFrame(rows, "key bigint, rep bigint, label bigint"))
    assert sorted({(r.key, r.members) for r in one.collect()}) == [(1, 4), (2, 4)]


def test_the_least_of_a_bucket_is_compared_once(spark, monkeypatch):
    """It has met all others: buckets of two are settled, of larger ones the others are left."""
    rng = random.Random(6)
    sizes = {1: 2, 2: 2, 3: 4, 4: 3}
    rows = [(10 * key + i, " ".join(words(rng, 50)), [key]) for key, n in sizes.items() for i in range(n)]
    known = spark.createDataFrame(rows, "doc_id bigint, text string, keys array<bigint>")
    known = known.withColumn("text_hash", F.xxhash64("text"))
    given, blocks = [], ngram_join.pairs_by_blocks
    monkeypatch.setattr(
        ngram_join, "pairs_by_blocks",
        lambda apart, *rest: given.extend(r.rep for r in apart.collect()) or blocks(apart, *rest),
    )
    classes = known.select(F.col("doc_id").alias("rep"), "text_hash")
    assert ngram_join._labels(known.select("doc_id", "text"), known, classes).isEmpty()
    assert sorted(given) == [31, 32, 33, 41, 42]


def test_rounds_go_on_where_the_last_one_found_links(spark, monkeypatch):
    rng = random.Random(21)
    base, pair = words(rng, 90), words(rng, 60)
    texts = {i: (1, base[i:] if i > 1 else words(rng, 50)) for i in range(8)}  # 2 to 7 are linked
    texts |= {10 + i: (2, words(rng, 50)) for i in range(6)} | {20 + i: (3, pair[i:]) for i in range(2)}
    rows = [(i, " ".join(t), [key]) for i, (key, t) in texts.items()]
    known = spark.createDataFrame(rows, "doc_id bigint, text string, keys array<bigint>")
    known = known.withColumn("text_hash", F.xxhash64("text"))
    given, attach = [], ngram_join._with_largest

    def recorded(apart, round_):
        given.append({r.key for r in apart.collect()})
        return attach(apart, round_)

    monkeypatch.setattr(ngram_join, "_with_largest", recorded)
    classes = known.select(F.col("doc_id").alias("rep"), "text_hash")
    found = ngram_join._labels(known.select("doc_id", "text"), known, classes)
    assert sorted(map(tuple, found.collect())) == [(i, 2) for i in range(2, 8)] + [(20, 20), (21, 20)]
    assert given == [{1, 2}, {1}]


def test_only_sets_of_pairs_are_sent(spark, monkeypatch):
    rows = [(i, 40, list(range(i // 2 * 100, i // 2 * 100 + 40 - i % 2))) for i in range(40)]
    sets = spark.createDataFrame([(r, len(s), s) for r, _, s in rows], "rep bigint, n bigint, set array<bigint>")
    pairs = spark.createDataFrame([(1, 0), (3, 2), (5, 2), (5, 4)], "x bigint, c bigint")
    assert sorted(r.rep for r in sketches.of_pairs(sets, pairs).collect()) == [0, 1, 2, 3, 4, 5]
    for most in (4, 3):
        monkeypatch.setattr(sketches, "BROADCAST_PAIRS", most)
        linked = ngram_join._verified(pairs, sets)
        assert ("LeftSemi" in linked._jdf.queryExecution().toString()) == (most == 4)
        assert sorted(map(tuple, linked.collect())) == [(1, 0), (3, 2), (5, 4)]


def pairs_around_the_threshold(rng, trials, smallest=1, largest=600):
    for _ in range(trials):
        small = rng.randint(smallest, largest)
        large = rng.randint(small, max(small, small * 100 // 85))
        common = -(-85 * (small + large) // 185)
        if common <= small:
            pool = np.unique(np.random.default_rng(rng.randint(0, 1 << 30)).integers(0, 1 << 64, 2 * large + 8, dtype=np.uint64))
            a = np.sort(pool[:small])
            yield a, np.sort(np.concatenate([pool[:common], pool[small : small + large - common]]))


@pytest.mark.parametrize("choices", [1, 2, 6])
def test_similar_sets_always_meet(monkeypatch, choices):
    monkeypatch.setattr(ngram_join, "CHOICES", choices)
    for a, b in pairs_around_the_threshold(random.Random(choices), 800):
        keys, number = ngram_join.join_keys(np.concatenate([a, b]), np.array([len(a), len(b)]))
        assert set(keys[: number[0]].tolist()) & set(keys[number[0] :].tolist())


def test_bits_bound_the_difference():
    for a, b in pairs_around_the_threshold(random.Random(1), 300, 1, 9000):
        x, y = sketches.bit_sketch(a), sketches.bit_sketch(b)
        size = min(len(x), len(y)) // 8
        unlike = sketches.folded(x, size) ^ sketches.folded(y, size)
        apart = len(np.setxor1d(a, b))
        assert int(np.bitwise_count(unlike).sum()) <= apart <= sketches.most_unlike(len(a) + len(b), 85)


def test_blocks_of_the_largest_component_do_not_meet(spark, monkeypatch):
    monkeypatch.setattr(sketches, "BLOCK", 8)
    rows = [(1, i, 0 if i % 100 else i) for i in range(1, 400)]  # three members outside of one component
    rows += [(2, i, i) for i in range(20)] + [(3, 1, 1), (3, 2, 2)]
    apart = sketches.one_of_equal(spark.createDataFrame(rows, "key bigint, rep bigint, label bigint"))
    groups = {}
    for r in sketches.dealt_blocks(apart).collect():
        groups.setdefault((r.key, r.lo, r.hi), []).append((r.rep, r.label))
    met = {(g[0], *sorted((a, b))) for g, of in groups.items() for a, x in of for b, y in of if x != y}
    assert met == {(k, a, b) for k, a, x in rows for j, b, y in rows if j == k and a < b and x != y}
    assert sum(len(of) for g, of in groups.items() if g[0] == 1) <= 2 * 400  # 19,900 for all blocks
    assert max(map(len, groups.values())) <= 16


def test_empty_table(spark):
    assert ngram_join.ngram_components(spark.createDataFrame([], SCHEMA)).collect() == []


def test_sets_of_four_words():
    values, counts = shingle_sets([b"a b c d e a b c d", b"x", b""], ngram_join.SHINGLE)
    assert counts.tolist() == [5, 1, 0] and len(values) == 6
