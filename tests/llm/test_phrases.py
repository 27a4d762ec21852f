"""Phrase counts and collocations against plain counting over all windows."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from shardloom.llm import phrases

SCHEMA = "doc_id bigint, text string, lang string, Lot string, `a.b` int"
WORDS = "the of cat dog é ünï run red big a.c x".split()


def cut(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
        yield re.findall(r"[^\x20\x09]+", piece)


def counted(rows):
    f = defaultdict(Counter)
    for _, text, lang, *_ in rows:
        for words in cut(text):
            for i in range(len(words)):
                for k in range(1, min(5, len(words) - i) + 1):
                    f[lang or "und"][tuple(words[i : i + k])] += 1
    return f


def collocated(rows, least, top):
    out = []
    for lang, f in counted(rows).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        found = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        inside = {
            p[i : i + k]
            for p, c in found.items() for k in range(2, len(p)) for i in range(len(p) - k + 1)
            if 100 * c >= 100 * f[p[i : i + k]]
        }
        ranked = []
        for p, a in found.items():
            if p in inside:
                continue
            score, _, l, r = min(
                (1000 * a * n // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))
            )
            ranked.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n, -score))
    return sorted(out)


def text(rng, n):
    words = []
    for _ in range(n):
        words.append(rng.choice(WORDS[: rng.randint(1, len(WORDS))]))
        if rng.random() < 0.15:
            words[-1] += rng.choice([".", ", ", "\n", "\t", "  ", "!?", "\r"])
        if rng.random() < 0.1:
            words.append("red Cat run THE dog")
    return " ".join(words)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    texts = [text(rng, rng.randint(1, 60)) for _ in range(120)]
    texts += [None, "", " \t\n.,", "x", texts[0], texts[0], "one line of words " * 300, "a\x00b \x01 É" * 20]
    langs = ["en", "de", None, "und", "en", "en"]
    made = [(i, t, rng.choice(langs), "clash", i) for i, t in enumerate(texts)]
    return [*made, made[3], (None, texts[5], "en", None, None), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


# A budget of a few suffixes makes prefixes of all lengths too frequent for one group.
@pytest.mark.parametrize("budget,lot_words", [(1 << 20, 1 << 19), (40, 64), (3, 7)])
def test_counts_equal_plain_counting(spark, docs, rows, monkeypatch, budget, lot_words):
    monkeypatch.setattr(phrases, "LOT_WORDS", lot_words)
    monkeypatch.setattr(phrases, "LOT_BYTES", 4 * lot_words)
    monkeypatch.setattr(phrases, "BROADCAST_BYTES", budget)
    counts, sizes = phrases.phrase_counts(docs, min_count=4, budget=budget)
    got = {(r.lang, tuple(r.words)): r.f for r in counts.collect()}
    plain = counted(rows)
    assert got == {(lang, p): c for lang, f in plain.items() for p, c in f.items() if c >= 4}
    assert {r.lang: r.n for r in sizes.collect()} == {
        lang: sum(c for p, c in f.items() if len(p) == 1) for lang, f in plain.items() if f
    }


@pytest.mark.parametrize("least,top", [(3, 2000), (8, 5)])
def test_collocations_equal_brute_force(docs, rows, least, top):
    found = phrases.best_collocations(docs, min_count=least, top=top)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == collocated(rows, least, top)


def test_products_beyond_64_bits(spark):
    names = "lang string, words array<string>, f bigint"
    big = 3 * 10**12
    counts = spark.createDataFrame(
        [("en", ["a"], big), ("en", ["b"], big - 7), ("en", ["a", "b"], big // 3)], names
    )
    sizes = spark.createDataFrame([("en", 10**13 + 1)], "lang string, n bigint")
    (row,) = phrases.collocations(counts, sizes).collect()
    assert row.score == 1000 * (big // 3) * (10**13 + 1) // (big * (big - 7))


def test_a_long_text_is_cut_up_without_seams(monkeypatch):
    rng = random.Random(8)
    data = " ".join(text(rng, 300).split(" ")).encode().translate(phrases._LOWER_AND_PIECES)
    whole = phrases._cut_up(data)
    monkeypatch.setattr(phrases, "PIECE_BYTES", 10)
    for a, b in zip(whole, phrases._cut_up(data), strict=True):
        assert (a == b).all()
    words = [data[s:e].decode() for s, e in zip(whole[1], whole[2])]
    assert words == [w for piece in cut(data.decode()) for w in piece]
    assert int(np.sum(whole[3])) == sum(bool(piece) for piece in cut(data.decode()))


def test_lots_without_a_phrase(spark):
    """Frequent words that are never followed by one: nothing to deal out."""
    rows = [(i, "yes.", "en", None, None) for i in range(9)] + [(9, "yes no", "en", None, None)]
    counts, _ = phrases.phrase_counts(spark.createDataFrame(rows, SCHEMA).repartition(2), min_count=4)
    assert [(r.words, r.f) for r in counts.collect()] == [(["yes"], 10)]


def test_no_words(spark):
    for rows in ([], [(1, None, "en", None, None), (2, " ,", None, None, None)]):
        assert phrases.best_collocations(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_blobs_are_small_and_come_back(monkeypatch):
    rng = np.random.default_rng(3)
    windows = np.minimum(rng.zipf(1.3, (20_000, 5)), 60_000).astype(np.int32)
    windows[rng.random(20_000) < 0.3, 3:] = -1
    batch = phrases._blobs(windows, windows[:, 0] % 3, np.zeros(20_000, np.int64))
    found = [phrases._restored(b.as_buffer()) for b in batch.column("suffixes")]
    back = np.concatenate(found, axis=1)
    each = Counter(map(tuple, windows.tolist()))
    assert {tuple(c[:5]): c[5] for c in back.T.tolist()} == each
    assert batch.column("suffixes").nbytes < 12 * len(each)  # 24 bytes each as they are


def test_a_lot_without_frequent_words(spark):
    rows = [(1, "a b " * 5, "en", "", 1), (2, "c d e", "fr", "", 2), (3, None, None, "", 3)]
    counts, sizes = phrases.phrase_counts(spark.createDataFrame(rows, SCHEMA).repartition(2), min_count=4)
    assert {(r.lang, *r.words): r.f for r in counts.collect() if len(r.words) < 3} == {
        ("en", "a"): 5, ("en", "b"): 5, ("en", "a", "b"): 5, ("en", "b", "a"): 4,
    }
    assert {(r.lang, r.n) for r in sizes.collect()} == {("en", 10), ("fr", 3)}
