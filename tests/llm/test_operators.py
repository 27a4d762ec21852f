"""The training-data operators against brute force, and on awkward rows."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardloom.llm import (
    chat,
    decontaminate,
    graph,
    html,
    language,
    mixing,
    near_dedup,
    quality,
    repeats,
    sharding,
    token_counts,
)

SCHEMA = "doc_id bigint, text string, source string, Size string, `a.b` int"
WORDS = [f"{a}{b}" for a in "ba ce di fo gu la me ni".split() for b in "ro sa te vi xo zu".split()]


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """Null, empty, blank, short and very long texts, copies, near copies, shared passages, repeated rows."""
    rng = random.Random(3)
    base, passage = sentence(rng, 120), sentence(rng, 60)
    edited = base.split()
    edited[7], edited[80] = "alpha", "beta"
    texts = [
        None, "", " \n\t ", "one", "a b c d", base, base, " ".join(edited), base.upper(),
        sentence(rng, 40) + " " + passage + " " + sentence(rng, 30),
        sentence(rng, 50) + "\n" + passage, passage + passage, "ä€😀 " * 90, "x" * 5000,
        sentence(rng, 60_000), "\n".join(["same line here"] * 30),
    ]
    made = [(i, t, ("s1", "s2", None)[i % 3], "clash", i) for i, t in enumerate(texts)]
    return [*made, made[9], (None, base, "s1", None, None), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def removed_by_brute_force(texts: list[bytes], length: int):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    for t in texts:
        gone = np.zeros(len(t) + 1, int)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i] += 1
                gone[i + length - 1] -= 0
                gone[i : i + length] = 1
        yield gone[:-1] > 0


def test_repeats_equal_brute_force(docs, rows):
    found = repeats.without_repeats(docs).collect()
    texts = [(r[1] or "").encode() for r in rows]
    want = Counter()
    for row, t, gone in zip(rows, texts, removed_by_brute_force(texts, 200), strict=True):
        rest = np.frombuffer(t, np.uint8)[~gone].tobytes()
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        want[row[0], hashlib.sha256(rest).hexdigest(), runs] += 1
    got = Counter((r.doc_id, hashlib.sha256(r.kept_bytes).hexdigest(), len(r.spans)) for r in found)
    assert got == want


@pytest.mark.parametrize("together", [0, 10_000])
def test_repeats_by_sorting_and_by_counting(spark, monkeypatch, together):
    monkeypatch.setattr(repeats, "SORTED_TOGETHER", together)
    rng = random.Random(11)
    shared = sentence(rng, 90)
    texts = [sentence(rng, rng.randint(5, 60)) + shared[rng.randint(0, 99) :] + sentence(rng, 20) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: bytes(r.kept_bytes) for r in repeats.without_repeats(df).collect()}
    raw = [t.encode() for t in texts]
    for i, gone in enumerate(removed_by_brute_force(raw, 200)):
        assert found[i] == np.frombuffer(raw[i], np.uint8)[~gone].tobytes()


def test_parse_in_pieces_covers_every_window(monkeypatch):
    text = sentence(random.Random(1), 900).encode()
    monkeypatch.setattr(repeats, "PIECE_BYTES", 1000)
    _, _, low, further = repeats.parse(text)
    covered = sorted(x for a, n in zip(low.tolist(), further.tolist()) for x in range(a, a + n + 1))
    assert covered == list(range(len(text) - 199))


def shingle_set(text: str | None) -> frozenset:
    low = (text or "").encode().lower().split()
    if len(low) < 5:
        return frozenset([tuple(low)] if low else [])
    return frozenset(tuple(low[i : i + 5]) for i in range(len(low) - 4))


def components_by_brute_force(rows) -> dict:
    sets = [(r[0], shingle_set(r[1])) for r in rows if r[0] is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in sets:
        for j, b in sets:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in parent}


def test_near_duplicates_equal_brute_force(docs, rows):
    want = components_by_brute_force(rows)
    found = near_dedup.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.component_id == want.get(r.doc_id)
        assert r.kept == (r.doc_id == r.component_id)
    sizes = {r[0]: len(shingle_set(r[1])) for r in rows if r[0] is not None}
    assert all(r.n_shingles == sizes[r.doc_id] for r in found if r.doc_id is not None)
    kept = near_dedup.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, c in want.items() if i == c} | {None}


def test_near_duplicates_of_edited_copies(spark):
    """A base that is absent, copies edited to similarities around the threshold."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(120):
        words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(150)] = f"e{rng.random()}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = components_by_brute_force(rows)
    assert {r.doc_id: r.component_id for r in near_dedup.near_duplicates(df).collect()} == want


def test_an_id_with_several_texts_is_one_node(spark):
    a, b = sentence(random.Random(1), 50), sentence(random.Random(2), 50)
    df = spark.createDataFrame([(5, a), (5, b), (3, a), (4, b), (9, "z")], "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(df).collect()}
    assert got == {5: 3, 3: 3, 4: 3, 9: 9}


def test_signature_estimates_similarity():
    rng = np.random.default_rng(0)
    common, x, y = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (300, 50, 50))
    values = np.concatenate([common, x, common, y])
    table = near_dedup.superminhash(values, np.array([350, 350, 0]))
    assert abs((table[0] == table[1]).mean() - 0.75) < 0.08
    assert np.isinf(table[2]).all()
    alone = near_dedup.superminhash(values[:350], np.array([350]))
    assert (alone[0] == table[0]).all()


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1200)]
    df = spark.createDataFrame([*links, (None, 3)], "a bigint, b bigint").repartition(7)
    got = {r.node: r.component for r in graph.components(df).collect()}
    parent = {x: x for link in links for x in link}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    assert got == {x: root(x) for x in parent}


def test_quality_rules(docs, rows):
    ledger = quality.ledger(docs)
    assert set(docs.columns) <= set(ledger.columns)
    found = ledger.collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    for i in (0, 1, 2):
        assert by_id[i].n_words == 0 and by_id[i].fail_bits == 1
    lines = by_id[15]
    assert (lines.n_words, lines.n_dup_lines, lines.n_repeat_words) == (90, 29, 90)
    assert lines.fail_bits & quality.mask(["repeated_passages", "duplicate_lines"])
    assert by_id[12].word_chars == 270 and by_id[14].n_words == 60_000
    assert by_id[8].fail_bits & quality.mask(["capitals"])
    kept = {r.doc_id for r in quality.accepted(docs).collect()}
    assert {5, 6, 7} <= kept and not {0, 1, 2, 3, 4, 8, 15} & kept
    report = {r.rule: (r.n_broken, r.n_only_this) for r in quality.ablations(ledger).collect()}
    for i, rule in enumerate(quality.RULES):
        bits = [r.fail_bits for r in found]
        assert report[rule.name] == (sum(b >> i & 1 for b in bits), sum(b == 1 << i for b in bits))


def test_sharding(docs, rows):
    placed = sharding.shard(docs, shards=5).collect()
    grown = sharding.shard(docs, shards=6).collect()
    assert len(placed) == len(rows)
    slots = defaultdict(list)
    for r in placed:
        text = next((x[1] for x in rows if x[0] == r.doc_id and (x[0] is not None or x[1] or "") != 0), None)
        if r.doc_id is not None:
            assert r.size == len((text or "").encode()) + 8
            assert r.text_crc32 == zlib.crc32((text or "").encode())
        assert r.grown_shard in (r.shard, 5)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    after = {r.doc_id: r.shard for r in grown}
    assert all(after[r.doc_id] == r.grown_shard for r in placed)


def test_shards_follow_weights(spark):
    df = spark.range(20_000).selectExpr("id as doc_id", "'t' as text")
    light, heavy = [1.0, 2.0, 1.0, 4.0, 1.0], [1.0, 2.0, 3.0, 4.0, 1.0]
    a = {r.doc_id: r.shard for r in sharding.shard(df, 5, light).collect()}
    b = {r.doc_id: r.shard for r in sharding.shard(df, 5, heavy).collect()}
    share = Counter(a.values())
    assert all(abs(share[s] / 20_000 - w / 9) < 0.02 for s, w in enumerate(light))
    assert all(b[i] in (s, 2) for i, s in a.items())


def test_mixing(docs, rows):
    mixed = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(5)).collect()
    key = lambda r: (str(r.doc_id), r.size, r.taken)
    assert sorted(map(key, mixed)) == sorted(map(key, again))
    assert len(mixed) == len(rows)
    total, taken, target = Counter(), Counter(), {}
    for r in mixed:
        assert r.taken == 0 if r.size == 0 else r.taken % r.size == 0 and r.taken <= 3 * r.size
        total[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(r.source_size == total[r.source] for r in mixed)
    assert sum(target.values()) == pytest.approx(sum(total.values()))


def test_targets_by_resharing(spark):
    sizes = {"a": 10, "b": 1000, "c": 5, None: 400, "d": 0}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    weight = dict(zip(["a", "b", "c", "d", None], (1, 2, 3, 1, 2), strict=True))
    target, free = {}, dict(weight)
    while True:
        left = sum(sizes.values()) - sum(target.values())
        level = left / sum(free.values())
        over = [s for s in free if level * weight[s] > 3 * sizes[s]]
        if not over:
            break
        for s in over:
            target[s] = 3 * sizes[s]
            del free[s]
    target |= {s: level * weight[s] for s in free}
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    assert got == pytest.approx(target)


def test_fit_is_the_best_subset():
    rng = random.Random(2)
    for _ in range(60):
        lengths = rng.sample(range(1, 40), 5)
        counts = [rng.randint(0, 4) for _ in lengths]
        budget = rng.randint(0, 150)
        taken = mixing.fit(lengths, counts, budget, limit=1 << 16)
        assert all(0 <= t <= c for t, c in zip(taken, counts, strict=True))
        assert int(np.dot(taken, lengths)) <= budget
        best = mixing._knapsack(np.array(lengths), np.array(counts), budget)
        sums = {0}
        for length, n in zip(lengths, counts, strict=True):
            sums = {s + k * length for s in sums for k in range(n + 1)}
        assert int(np.dot(best, lengths)) == max(s for s in sums if s <= budget)


@pytest.fixture(scope="module")
def model(spark):
    return token_counts.load(spark)


def brute_tokens(scores: dict[bytes, float], word: bytes) -> int:
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        options = [
            (best[start][0] + scores[word[start:end]], -best[start][1] - 1)
            for start in range(end) if word[start:end] in scores
        ]
        score, count = max(options)
        best.append((score, -count))
    return best[-1][1]


def test_token_counts(docs, rows, model):
    found = token_counts.count_tokens(docs, model).collect()
    assert len(found) == len(rows)
    want = {}
    for r in rows:
        parts = token_counts.PRE_TOKEN.findall((r[1] or "").encode())
        assert b"".join(parts) == (r[1] or "").encode()
        want[r[0], r[1]] = (len(parts), sum(brute_tokens(model.scores, p) for p in parts)) if len(parts) < 1000 else None
    for r in found:
        if want[r.doc_id, r.text] is not None:
            assert (r.n_pretokens, r.n_tokens) == want[r.doc_id, r.text]


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(8)
    items = [(k, f"{sentence(rng, 12)}. {sentence(rng, 14)}") for k in range(9)] + [(90, None), (91, "  "), (92, "x")]
    texts = [None, "", sentence(rng, 30), items[3][1], sentence(rng, 300) + "*** " + items[5][1].upper() + "!!! " + sentence(rng, 90)]
    texts += [items[3][1], sentence(rng, 200) + items[0][1][: len(items[0][1]) // 3]]
    docs = spark.createDataFrame([(i, t, "e") for i, t in enumerate(texts)], "doc_id bigint, text string, item_id string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()}
    assert found == {(3, 3), (4, 5), (5, 3)}
    split = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench, most_bytes=300).collect()}
    assert split == found
    assert sorted(r.doc_id for r in decontaminate.clean(docs, bench).collect()) == [0, 1, 2, 6]
    assert decontaminate.clean(docs, bench.limit(0)).count() == len(texts)


def test_edited_and_truncated_items_are_found(spark):
    rng = random.Random(10)
    long = sentence(rng, 40).split()
    first, five, short = sentence(rng, 3), sentence(rng, 5), sentence(rng, 15).split()
    words = " ".join(long)
    texts = [f"{first}. {words}.", f"{words}. {first}.", f"{five}. {words}", " ".join(short)]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id bigint, text string")
    one = " ".join(["other", *first.split()[1:]])
    copies = [(0, f"{one}. {words}."), (0, f"{words}."), (1, f"{words}. {one}"), (2, f"{five[:-3]}x. {words}"), (2, words)]
    copies += [(3, " ".join([*short[:i], "other", *short[i + 1 :]])) for i in range(15)]
    alone = [first, f"{first}. {' '.join(long[:9])}", " ".join(short[:8]), f"{sentence(rng, 50)} {short[0]}"]
    rows = [(k, f"{sentence(rng, 30)} {text} {sentence(rng, 30)}") for k, text in enumerate([*(t for _, t in copies), *alone])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()}
    assert {(k, item) for k, (item, _) in enumerate(copies)} <= found
    assert not {k for k, _ in found} & set(range(len(copies), len(rows)))
    assert decontaminate.clean(docs, items).count() == len(alone)


def test_items_are_cut_near_the_middle():
    for text in ("", "...", "one", "a b. c d", "Yes. " + "w " * 30, "w " * 20 + "end. " + "w " * 18, "a.\u00a0b " * 9):
        parts = [decontaminate.words_of(part.encode()) for part in decontaminate.split_item(text)]
        assert parts[0] + parts[1] == decontaminate.words_of(text.encode())
        assert abs(len(parts[0]) - len(parts[1])) <= 3
    assert decontaminate.split_item("w " * 20 + "end. " + "w " * 18)[0].endswith("end.")
    assert decontaminate.split_item("o p q r s t. u v w x y z.")[0] == "o p q r s t."


def test_block_bounds_lose_no_item():
    rng = random.Random(9)
    texts = [sentence(rng, rng.randint(10, 30)) for _ in range(25)]
    words = [decontaminate.words_of(t.encode()) for t in texts]
    frequency = Counter(w for ws in words for w in set(ws))
    average = sum(map(len, words)) / len(words)
    index = decontaminate.Index(
        [str(i) for i in range(25)], [(t.encode(), *(x.encode() for x in decontaminate.split_item(t))) for t in texts],
        frequency, 25, average,
    )
    passages = [sentence(rng, 20) + " " + t + " " + sentence(rng, 40) for t in texts]
    for i, hits in enumerate(index.search([p.encode() for p in passages])):
        assert str(i) in {h["item"] for h in hits}


def test_preferences(spark):
    turns = [
        (1, True, 0, "user", "hi"), (1, False, 0, "user", "hi"), (1, True, 1, "assistant", "good"),
        (1, False, 1, "assistant", "bad"), (1, True, 0, "user", "hi"), (2, True, 0, None, None),
        (2, False, 0, None, None), (3, True, 0, "user", ""), (None, True, 0, "user", "x"),
    ]
    df = spark.createDataFrame(turns, "pair_id bigint, chosen boolean, turn bigint, role string, text string")
    found = {r.pair_id: r for r in chat.examples(df).collect()}
    assert set(found) == {1, 2, 3}
    assert found[1].prompt == "<|user|>\nhi<|end|>\n" and found[1].prompt_turns == 1
    assert found[1].chosen == "<|assistant|>\ngood<|end|>\n" and found[1].rejected.endswith("bad<|end|>\n")
    assert [tuple(x) for x in found[1].chosen_mask] == [(False, 14), (True, 12)]
    assert found[2].prompt == "<||>\n<|end|>\n" and found[2].chosen == found[2].rejected == ""
    assert found[3].prompt == "" and found[3].rejected_mask == []
    parts = chat.segments(df).filter("pair_id = 1").select("part", "trained").collect()
    assert sorted(map(tuple, parts)) == [("chosen", True), ("prompt", False), ("rejected", True)]
    conversations = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.examples(chat.swapped_answers(conversations)).count() == 0


def test_the_next_conversation_may_be_ids_away(spark):
    ids = [-70_000, -5, 3, 4, 10, 70_000, 1 << 40]
    rows = [(i, t, ("user", "assistant")[t], f"{i} says {t}") for i in ids for t in (0, 1)]
    rows += [(5, None, "user", "no turn"), (None, 0, "user", "no id"), rows[3]]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(3)
    found = {r.pair_id: r for r in chat.examples(chat.swapped_answers(df)).collect()}
    assert set(found) == set(ids)
    for i, after in zip(ids, [*ids[1:], None], strict=True):
        said = lambda x: f"<|assistant|>\n{x} says 1<|end|>\n"
        assert found[i].prompt_turns == 1 and found[i].chosen == said(i)
        assert found[i].rejected == ("" if after is None else said(after))


PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><script>var a='</p>';</script></head><body><nav><ul><li>"
    "<a href='/a'>Menu one</a></li></ul></nav><div class='ad'>Buy now.</div><article><h1>The  head</h1>"
    "<p><b>First &amp; line<br><p>It goes on and on, and on it goes, in many words. It goes on.</p></article>"
    "<div id='comments'><p>I disagree.</p></div><footer>&copy; me</footer></body></html>"
)


def test_html(spark):
    rng = random.Random(6)
    pages = [
        (i, f"u{i}", PAGE.replace("It goes on and on", sentence(rng, 30) + ". " + sentence(rng, 20)), "clash")
        for i in range(40)
    ]
    odd = [(100, "n", None, ""), (101, "e", "", ""), (102, None, "<p>", ""), (103, "t", PAGE[:420], ""), pages[0]]
    df = spark.createDataFrame([*pages, *odd], "page_id bigint, url string, html string, TEXT string")
    model = html.train(df)
    found = html.extract(df, model).collect()
    assert len(found) == 45
    for r in found:
        if r.page_id < 100:
            assert r.text.startswith("The head First & line") and r.text.endswith("It goes on.")
            assert not any(x in r.text for x in ("Menu", "Buy", "disagree", "me", "var") if x != "me")
        assert r.n_chars == len(r.text)
    assert {r.page_id: r.text for r in found if r.page_id in (100, 101, 102)} == {100: "", 101: "", 102: ""}
    assert html.train(df.limit(0)) is None
    assert html.extract(df.limit(0), None).count() == 0


@pytest.mark.parametrize(
    "attributes, hidden, good, bad",
    [
        (' href="/wiki/Hidden_Figures"', False, 0, 0), (' title="The hidden valley"', False, 0, 0),
        (' data-hidden="false"', False, 0, 0), (" href=/a/hidden", False, 0, 0), (" hidden-x class=story", False, 1, 0),
        (' data-class="sidebar" alt="x class=nav"', False, 0, 0), (""" title='a role="menu" hidden'""", False, 0, 0),
        (" hidden", True, 0, 0), (" HIDDEN", True, 0, 0), (' class="post" hidden=""', True, 1, 0), (" id = 'nav'/", False, 0, 1),
        (' aria-hidden="true"', True, 0, 0), (' aria-hidden="false"', False, 0, 0), (' style="display: none"', True, 0, 0),
        (' title="cut off hidden', False, 0, 0), ("", False, 0, 0),
    ],
)
def test_attributes_are_whole_names(attributes, hidden, good, bad):
    node = html.parse(f"<div{attributes}>text")[1]
    assert (node.hidden, node.good, node.bad) == (hidden, good, bad)


def test_pages_without_article_or_main(spark):
    body = "<div><h1>Head</h1><p>First line.</p><p>A <a href='/wiki/Hidden_Figures'>link</a> in it.</p></div>"
    around = "<nav><a href='/'>Menu</a></nav><div class='sidebar'>Side</div>{}<div hidden>Gone</div><footer>End</footer>"
    pages = {
        1: f"<html><body class='no-sidebar'>{around.format(body)}</body></html>", 2: around.format(body),
        3: f"<form><input name='q'>{body}</form>", 4: f"<div class='page has-sidebar'>{body}</div>",
        5: "<nav>Menu</nav>", 6: "<p></p>", 7: None,
    }
    df = spark.createDataFrame([(i, f"u{i}", page) for i, page in pages.items()], "page_id bigint, url string, html string")
    model = html.train(df)
    assert model is None
    found = {r.page_id: r.text for r in html.extract(df, model).collect()}
    assert found == {i: "Head First line. A link in it." if i < 5 else "" for i in pages}
    odd = df.withColumn("html", F.concat(F.lit("<article\n id='a'>"), "html", F.lit("</article>")))
    assert html.train(odd) is not None


def test_decoding_keeps_nothing_inside_a_dropped_element():
    nodes = html.parse("<div><p>one two three</p><div><p>four</p></div></div>")
    odds = np.array([0, -1.0, 2.0, -9.0, 0.5])
    assert html.decode(nodes, odds) == [True, True, True, True, True]
    assert html.decode(nodes, -np.abs(odds)) == [True, False, False, False, False]


def test_language(spark):
    rng = random.Random(7)
    alphabets = {"x": "abcde", "y": "fghij", "z": "äöüßé"}
    rows = []
    for i in range(300):
        lang = "xyz"[i % 3]
        words = ["".join(rng.choice(alphabets[lang]) for _ in range(5)) for _ in range(rng.randint(5, 200))]
        rows.append((i, " ".join(words), lang if i % 10 else None))
    rows += [(900, None, "x"), (901, "123 !?", "y"), (902, "", None), (None, "abc dea", "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    net = language.train(df, steps=150)
    found = {r.doc_id: r for r in language.identify(df.withColumn("score", F.lit("clash")), net).collect()}
    assert len(found) == len(rows)
    assert all(found[i].lang_pred == "xyz"[i % 3] for i in range(300))
    assert all(found[i].lang_pred == "und" and found[i].score == 0 for i in (900, 901, 902))
    assert all(r.held_out == (i is not None and zlib.crc32(str(i).encode()) % 4 == 2) for i, r in found.items())
    assert language.train(df.limit(0)) is None
    assert language.identify(df, None).filter("lang_pred != 'und'").count() == 0


def test_a_rare_language_is_learnt(spark):
    table = {"x": "abcde", "y": "fghij", "z": "klmno"}
    rows = spark.range(40_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 10_000 == 77, "z").when(F.col("id") % 2 == 0, "x").otherwise("y").alias("lang"),
    )
    letters = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[F.col("lang")]
    word = F.concat(*[F.substr(letters, F.pmod(F.xxhash64("doc_id", F.lit(k)), F.lit(5)) + 1, F.lit(1)) for k in range(5)])
    df = rows.withColumn("text", F.repeat(F.concat(word, F.lit(" ")), F.lit(12)))
    rare = df.filter("lang = 'z'")
    assert rare.filter(~language.held_out(F.col("doc_id"))).count() > 0
    net = language.train(df, steps=80)
    assert net.labels == ["x", "y", "z"]
    assert language.identify(rare, net).filter("lang_pred != 'z'").count() == 0


def test_least_hashed_of_each(spark):
    from shardloom.llm.tables import least_hashed_of_each

    key = F.when(F.col("id") < 9, "rare").when(F.col("id") < 20, None).otherwise("often")
    rows = spark.range(9000).select("id", key.alias("key"), F.xxhash64("id").alias("at"))
    rows = rows.union(rows.filter("id < 4000"))
    for n in (5, 300, 20_000):
        wanted = []
        for k in ("often", "rare"):
            of = rows.filter(F.col("key") == k).distinct().orderBy("at").limit(n)
            wanted += [(r.key, r.id) for r in of.collect()]
        assert [(r.key, r.id) for r in least_hashed_of_each(rows, "key", "at", n).collect()] == wanted
    assert least_hashed_of_each(rows.filter("false"), "key", "at", 5).collect() == []


def test_empty_tables(none, model):
    assert repeats.without_repeats(none).count() == 0
    assert near_dedup.near_duplicates(none).count() == 0
    assert near_dedup.without_near_duplicates(none).count() == 0
    assert quality.accepted(none).count() == 0
    assert sharding.shard(none).count() == 0
    assert mixing.mix(none).count() == 0
    assert token_counts.count_tokens(none, model).count() == 0


def test_least_hashed_is_the_top_n_of_distinct_rows(spark):
    from shardloom.llm.tables import least_hashed

    rows = spark.range(5000).select("id", F.xxhash64("id").alias("at"))
    rows = rows.union(rows.filter("id < 3000"))
    for n in (200, 1000, 20_000):
        wanted = [r.id for r in rows.distinct().orderBy("at").limit(n).collect()]
        assert [r.id for r in least_hashed(rows, "at", n).collect()] == wanted
    assert least_hashed(rows.filter("false"), "at", 5).collect() == []


@pytest.mark.parametrize("ids", [[0, 1, 2, 3, 4], [5, 70_000, -3, 1 << 40, 1 << 62, -(1 << 62)], [9]])
def test_preferences_under_filters(spark, ids):
    """A filter on the result gives what filtering the collected rows gives."""
    rows = [(i, t, "assistant" if t else "user", f"text {i} {t}") for i in ids for t in range(2)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(3)
    whole = {r.pair_id: r for r in chat.examples(chat.swapped_answers(turns)).collect()}
    assert sorted(whole) == sorted(ids)
    after = dict(zip(sorted(ids), sorted(ids)[1:]))
    for i in ids:
        (row,) = chat.examples(chat.swapped_answers(turns)).filter(F.col("pair_id") == i).collect()
        assert row == whole[i]
        assert row.rejected == (f"<|assistant|>\ntext {after[i]} 1<|end|>\n" if i in after else "")


def test_every_query_under_a_filter(spark):
    """Filters on a query's key, pushed wherever they go, change nothing else."""
    from shardloom.llm import queries

    keys = {"op2_chat_preferences": ("conv_id", 3), "op5_sharding": ("doc_id", 7), "op9_mixing": ("doc_id", 7),
            "op13_vector_codes": ("vec_id", 7), "op10_quality_rules": ("doc_id", 7)}
    for name, (key, value) in keys.items():
        frame = queries.queries()[name](spark, "/root/testdata/sf0.001")
        want = [r for r in frame.collect() if r[key] == value]
        assert frame.filter(F.col(key) == value).collect() == want and len(want) == 1


def test_long_turns_and_clashing_columns(spark):
    long_ = "word " * 200_000
    rows = [(1, 0, "user", long_, "x"), (1, 1, "assistant", long_ + "!", "x"), (2, 0, "assistant", "b", "y")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, part string")
    found = {r.pair_id: r for r in chat.examples(chat.swapped_answers(turns)).collect()}
    assert found[1].prompt == f"<|user|>\n{long_}<|end|>\n"
    assert found[1].chosen == f"<|assistant|>\n{long_}!<|end|>\n" and found[1].rejected == "<|assistant|>\nb<|end|>\n"


@pytest.mark.parametrize("text,letters", [
    ("²½ ①②③", False), ("Ⅷ Ⅸ", False), ("12 ٣", False), ("́_", False),
    ("中", True), ("1ª", True), ("ǅ", True), ("ʰ", True), ("", False), (None, False),
])
def test_only_letters_have_a_language(spark, text, letters):
    net = language.ByteNet(["de", "en"])
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    (row,) = language.identify(df, net).collect()
    assert (row.lang_pred != "und") == letters and (row.score > 0) == letters


def test_languages_of_long_texts_copies_and_empty_tables(spark, none):
    net = language.ByteNet(["de", "en"])
    long_ = "these are words " * 100_000
    df = spark.createDataFrame([(1, long_), (2, long_), (3, "these are words "), (3, None)], "doc_id bigint, text string")
    rows = language.identify(df, net).orderBy("doc_id", F.desc("text")).collect()
    assert (rows[0].lang_pred, rows[0].score) == (rows[1].lang_pred, rows[1].score)
    assert len(rows) == 4 and language.identify(none, net).count() == 0


def test_many_labels_share_the_sample(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_IN_ALL", 60)
    monkeypatch.setattr(language, "SAMPLE_OF_EACH", 2)
    rows = [(i, f"text of language {i % 40} and number {i}", f"l{i % 40}") for i in range(800)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    net = language.train(df, steps=2)
    assert sorted(net.labels) == sorted({f"l{i}" for i in range(40)})


def test_one_row_of_each_group_stays(spark):
    base, other = " ".join(WORDS[:30]), " ".join(WORDS[20:50])
    near = base + " and more"
    rows = [
        (1, base, "a", None, 1), (1, base, "b", None, 2), (None, base, "c", None, 3), (None, near, "d", None, 4),
        (None, other, "e", None, 5), (None, other, "f", None, 6), (4, near, "g", None, 7), (7, "", "h", None, 8),
        (None, "", "i", None, 9), (None, None, "j", None, 10), (None, " ", "k", None, 11), (9, "x y", "l", None, 12),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    left = near_dedup.without_near_duplicates(df)
    assert left.columns == df.columns
    assert sorted(r.source for r in left.collect()) == list("aehijkl")


def test_a_group_of_edited_copies_just_below_the_similarity(spark):
    """No base, most pairs apart: every link must be found."""
    rng = random.Random(21)
    base = sentence(rng, 120).split()
    texts = []
    for _ in range(120):
        words = list(base)
        for _ in range(4):
            words[rng.randrange(len(words))] = rng.choice(WORDS) + "x"
        texts.append(" ".join(words))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in texts)]
    label = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]) and label[i] != label[j]:
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(df).collect()}
    assert got == dict(enumerate(label))
