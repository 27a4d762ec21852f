"""Frequent phrases and how strongly their words belong together.

Every position of a text starts a suffix of words, cut off after five words or at the end of
its piece. A phrase's count is the number of suffixes that begin with it: the leaves below its
node in the tree of all suffixes. The tree is never built as a whole. Word counts part the
suffixes by their first word into groups that fit a memory budget; a word too frequent for one
group is extended by the next word, and so on, until every prefix fits. Each group's subtree
is then laid out on its own, as its sorted suffixes, and counts are read off as sums over the
leaves of each node.

Texts are first turned into lots: a local dictionary of words, and one small number a word.
Only dictionaries are joined with the frequent words, never the words of the texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shardloom.llm.tables import kept, quoted
from shardloom.llm.text import PIECE_BYTES, Fingerprints, encoded, mixed
from shardloom.operators.offsets import exclusive_totals
from shardloom.session import attach

LONGEST = 5
MIN_COUNT = 100
TOP = 2000
# Suffixes of a group, the memory budget: 24 bytes each before they are sorted.
BUDGET = 1 << 20
# Text gathered before it becomes lots, and words of a lot.
LOT_BYTES = 1 << 22
LOT_WORDS = 1 << 19
# Frequent words are broadcast to the lots' dictionaries up to so many bytes; more are shuffled.
BROADCAST_BYTES = 1 << 26
# Tasks that rank a language's phrases before one takes the best of each.
RANKERS = 64

UNKNOWN_LANG = "und"

_LOWER_AND_PIECES = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\x0d", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9
)
_BLANK = re.compile(rb"[\x20\x09\x0A]")
_LOTS = "lot bigint, lang string, own int, size int, words array<string>, counts array<bigint>, ids binary, firsts binary"


def _cut_up(data: bytes) -> tuple[np.ndarray, ...]:
    """Fingerprint, start and end of every word, and whether it is the first of its piece."""
    found = []
    at, pieces = 0, 0
    while at < len(data):
        cut = _BLANK.search(data, at + PIECE_BYTES) if len(data) - at > PIECE_BYTES else None
        end = cut.start() if cut else len(data)
        chars = np.frombuffer(data[at:end] + b"\n", np.uint8)
        blank = np.ones(len(chars) + 1, bool)
        blank[1:] = (chars == 32) | (chars == 9) | (chars == 10)
        starts = np.flatnonzero(blank[:-1] & ~blank[1:])
        ends = np.flatnonzero(~blank[:-1] & blank[1:])
        ended = np.cumsum(chars[:-1] == 10)  # pieces that have ended before a character
        piece = pieces + (ended[starts] if len(ended) else starts)
        pieces += int(ended[-1]) if len(ended) else 0
        found.append((Fingerprints(chars).of(starts, ends), starts + at, ends + at, piece))
        at = end
    if not found:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none.astype(bool)
    words, starts, ends, piece = map(np.concatenate, zip(*found))
    firsts = np.ones(len(words), bool)
    firsts[1:] = piece[1:] != piece[:-1]
    return words, starts, ends, firsts


def _lots_of(data: bytes) -> Iterator[tuple]:
    """``(own, size, words, counts, ids, firsts)``; words beyond ``own`` only end suffixes."""
    words, starts, ends, firsts = _cut_up(data)
    for at in range(0, len(words), LOT_WORDS):
        own = min(LOT_WORDS, len(words) - at)
        part = slice(at, min(at + own + LONGEST - 1, len(words)))
        _, example, ids = np.unique(words[part], return_index=True, return_inverse=True)
        spelled = [data[starts[i] : ends[i]] for i in (example + at).tolist()]
        counts = np.bincount(ids[:own], minlength=len(example))
        small = np.uint16 if len(example) <= 1 << 16 else np.uint32
        yield own, len(ids), spelled, counts, ids.astype(small).tobytes(), np.packbits(firsts[part]).tobytes()


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    number = TaskContext.get().partitionId() << 32

    def flush(lang: str) -> Iterator[pa.RecordBatch]:
        nonlocal number
        data = b"\n".join(waiting.pop(lang)).translate(_LOWER_AND_PIECES)
        del sizes[lang]
        for own, size, words, counts, ids, firsts in _lots_of(data):
            dictionary = pa.array(words, pa.binary()).cast(pa.string())
            offsets = pa.array([0, len(words)], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number]), pa.array([lang]),
                    pa.array([own], pa.int32()), pa.array([size], pa.int32()),
                    pa.ListArray.from_arrays(offsets, dictionary),
                    pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64())),
                    pa.array([ids], pa.binary()), pa.array([firsts], pa.binary()),
                ],
                [column.split()[0] for column in _LOTS.split(", ")],
            )
            number += 1

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), encoded(batch.column("text")), strict=True):
            waiting.setdefault(lang, []).append(text)
            sizes[lang] = sizes.get(lang, 0) + len(text) + 1
            if sizes[lang] >= LOT_BYTES:
                yield from flush(lang)
            elif len(sizes) > 1 and sum(sizes.values()) >= 4 * LOT_BYTES:
                yield from flush(max(sizes, key=sizes.get))
    for lang in sorted(waiting):
        yield from flush(lang)


@dataclass
class Prefixes:
    """Prefixes too frequent for one group, level by level, and where their suffixes go.

    A prefix of ``d`` words is a key ``index of its first d - 1 words << 32 | last word``;
    ``keys[d - 1]`` holds them sorted, ``counts`` how often they occur. There is at most one
    for every ``BUDGET`` words of the corpus and level.
    """

    keys: list[np.ndarray] = field(default_factory=list)
    counts: list[np.ndarray] = field(default_factory=list)

    def levels(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each suffix the words of its longest prefix in here, and that one's index."""
        depth, index = np.zeros(len(windows), np.int64), np.full(len(windows), -1)
        rows = np.arange(len(windows))
        for level, keys in enumerate(self.keys):
            rows = rows[windows[rows, level] >= 0]
            before = index[rows] if level else np.zeros(len(rows), np.int64)
            key = (before << 32) | windows[rows, level]
            at = np.searchsorted(keys, key)
            there = at < len(keys)
            there[there] = keys[at[there]] == key[there]
            rows = rows[there]
            depth[rows], index[rows] = level + 1, at[there]
        return depth, index

    def spelled(self, level: int, index: int) -> list[int]:
        words = []
        for keys in reversed(self.keys[: level + 1]):
            key = int(keys[index])
            words.append(key & 0xFFFFFFFF)
            index = key >> 32
        return words[::-1]

    def parts(self, budget: int) -> list[np.ndarray]:
        """Into how many groups the suffixes below each prefix are dealt."""
        return [-(-counts // budget) for counts in self.counts]


def _windows(own: int, local: np.ndarray, firsts: np.ndarray, at: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Suffixes of a lot as rows of frequent words' numbers; -1 from where they end.

    A suffix also ends before a word that is not frequent, as no phrase across it is.
    """
    names = np.full(int(local.max(initial=0)) + 1, -1, np.int32)
    names[at] = known
    words = np.concatenate([names[local], np.full(LONGEST, -1, np.int32)])
    ends = np.ones(len(words), bool)
    ends[: len(local)] = firsts
    rows = np.empty((own, LONGEST), np.int32)
    open_ = np.ones(own, bool)
    for k in range(LONGEST):
        if k:
            open_ &= ~ends[k : k + own]
        open_ &= words[k : k + own] >= 0
        rows[:, k] = np.where(open_, words[k : k + own], -1)
    return rows


def _suffixes(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Lot by lot: windows, and the group that each frequent word heads (by its number)."""
    for row in range(batch.num_rows):
        known = batch.column("known")[row].values
        at, ids, groups_ = (known.field(name).to_numpy() for name in ("at", "id", "grp"))
        own, size = batch.column("own")[row].as_py(), batch.column("size")[row].as_py()
        blob = batch.column("ids")[row].as_py()
        local = np.frombuffer(blob, np.uint16 if len(blob) == 2 * size else np.uint32)
        bits = np.frombuffer(batch.column("firsts")[row].as_py(), np.uint8)
        windows = _windows(own, local, np.unpackbits(bits, count=size), at, ids)
        heads = np.full(int(ids.max(initial=0)) + 1, -1, np.int64)
        heads[ids] = groups_
        yield windows, heads


def _extensions(prefixes: Prefixes):
    """Counts of the last level's prefixes with one more word."""
    last = len(prefixes.keys)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for windows, _ in _suffixes(batch):
                depth, index = prefixes.levels(windows)
                longer = (depth == last) & (windows[:, last] >= 0)
                key, n = np.unique((index[longer] << 32) | windows[longer, last], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["key", "n"])

    return count


def _dealt(prefixes: Prefixes, first_group: int, budget: int):
    """Suffixes as sorted blobs, one a lot and group, equal ones counted."""
    parts = prefixes.parts(budget)
    sizes = [int(p.sum()) for p in parts]
    bases, at = [], first_group
    for p, size in zip(parts, sizes, strict=True):
        bases.append(at + np.cumsum(p) - p)
        at += size

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for windows, heads in _suffixes(batch):
                depth, index = prefixes.levels(windows)
                need = np.maximum(depth + 1, 2)  # words that the shortest phrase counted here has
                sent = need <= LONGEST
                sent[sent] = windows[sent, need[sent] - 1] >= 0
                windows, depth, index = windows[sent], depth[sent], index[sent]
                group = np.zeros(len(windows), np.int64)
                plain = depth == 0
                group[plain] = heads[windows[plain, 0]]
                for level in range(min(len(parts), LONGEST - 1)):  # below five words is nothing
                    mine = np.flatnonzero(depth == level + 1)
                    of = index[mine]
                    draw = mixed(windows[mine, level + 1].astype(np.uint64)) % parts[level][of].astype(np.uint64)
                    group[mine] = bases[level][of] + draw.astype(np.int64)
                yield _blobs(windows, group, depth)

    return deal


def _packed(windows: np.ndarray) -> list[np.ndarray]:
    """The same order in two columns of 64 bits and one of 32, words after the end lowest."""
    w = windows.astype(np.int64) + 1
    return [(w[:, 0] << 32) | w[:, 1], (w[:, 2] << 32) | w[:, 3], w[:, 4]]


def _blobs(windows: np.ndarray, group: np.ndarray, depth: np.ndarray) -> pa.RecordBatch:
    a, b, c = _packed(windows)
    order = np.lexsort((c, b, a, group))
    windows, group, depth = windows[order], group[order], depth[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (windows[1:] != windows[:-1]).any(axis=1)  # equal suffixes have one group
    starts = np.flatnonzero(fresh)
    counts = np.diff(np.append(starts, len(order))).astype(np.int32)
    windows, group, depth = windows[starts], group[starts], depth[starts]
    edges = np.flatnonzero(np.diff(group, prepend=-1))  # groups are 0 or more
    ends = np.append(edges, len(group))[1:]
    columns = np.concatenate([windows, counts[:, None]], axis=1).astype("<i4")
    return pa.RecordBatch.from_arrays(
        [
            pa.array(group[edges]),
            pa.array(depth[edges]),
            pa.array([_shrunk(columns[s:e]) for s, e in zip(edges, ends, strict=True)], pa.binary()),
        ],
        ["grp", "depth", "suffixes"],
    )


def _shrunk(columns: np.ndarray) -> bytes:
    """Rows of small integers by column and then by byte, where sorted and high bytes repeat."""
    planes = np.ascontiguousarray(columns.T).view(np.uint8).reshape(LONGEST + 1, -1, 4)
    data = planes.transpose(0, 2, 1).tobytes()
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _restored(blob: pa.Buffer) -> np.ndarray:
    size = int.from_bytes(blob[:8].to_pybytes(), "little")
    data = np.frombuffer(pa.decompress(blob[8:], size, codec="zstd"), np.uint8)
    planes = data.reshape(LONGEST + 1, 4, -1).transpose(0, 2, 1)
    return np.ascontiguousarray(planes).view("<i4").reshape(LONGEST + 1, -1)


def _subtree(min_count: int):
    """Phrases of a group's subtree: its sorted suffixes, a node's leaves side by side."""

    def read(table: pa.Table) -> pa.Table:
        depth = table.column("depth")[0].as_py()
        blobs = [_restored(b.as_buffer()) for b in table.column("suffixes")]
        columns = np.concatenate(blobs, axis=1)
        windows, counts = columns[:LONGEST].T, columns[LONGEST].astype(np.int64)
        a, b, c = _packed(windows)
        order = np.lexsort((c, b, a))
        windows, counts = windows[order], counts[order]
        fresh = np.zeros(len(order), bool)
        fresh[:1] = True
        found, sums = [], []
        for k in range(LONGEST):
            fresh[1:] |= windows[1:, k] != windows[:-1, k]
            if k < max(depth, 1):
                continue  # counted before: words, and the prefixes that were extended
            nodes = np.flatnonzero(fresh)
            leaves = np.add.reduceat(counts, nodes) if len(nodes) else counts
            whole = (windows[nodes, k] >= 0) & (leaves >= min_count)
            found.extend(windows[nodes[whole], : k + 1].tolist())
            sums.append(leaves[whole])
        total = np.concatenate(sums) if sums else counts[:0]
        return pa.table({"ids": pa.array(found, pa.list_(pa.int32())), "a": pa.array(total, pa.int64())})

    return read


def frequent_words(lots: DataFrame, min_count: int, budget: int) -> tuple[DataFrame, DataFrame]:
    """Words of at least ``min_count`` occurrences, numbered and grouped; words of each language.

    ``grp`` is the group of the suffixes that a word heads, -1 for one that needs several.
    """
    each = lots.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w"))
    counts = each.groupBy("lang", F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("f"))
    counts = kept(counts, "words")
    sizes = kept(counts.groupBy("lang").agg(F.sum("f").alias("n")), "language_sizes")
    often = kept(
        counts.filter(F.col("f") >= min_count).withColumns(
            {"at": F.monotonically_increasing_id(), "one": F.lit(1).cast("bigint")}
        ),
        "frequent_words",
    )
    numbered = exclusive_totals(often, "at", {"id": "one", "before": "f"})
    group = F.when(F.col("f") > budget, F.lit(-1).cast("bigint")).otherwise(F.expr(f"before div {budget}L"))
    return kept(
        numbered.select("lang", "word", "f", F.col("id").cast("int").alias("id"), group.alias("grp")),
        "vocabulary",
    ), sizes


def phrase_counts(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    min_count: int = MIN_COUNT,
    budget: int = BUDGET,
) -> tuple[DataFrame, DataFrame]:
    """``(lang, words, f)`` of all phrases of 1 to 5 words with at least ``min_count``, and ``(lang, n)``.

    A-Z count as a-z; phrases lie within pieces, overlaps count. A null language is ``und``;
    null, empty and blank texts have no words; repeated rows count each time. Counts are
    exact up to equal 64-bit fingerprints of two words in one lot.
    """
    attach(docs.sparkSession)
    rows = docs.select(
        F.coalesce(quoted(lang_col).cast("string"), F.lit(UNKNOWN_LANG)).alias("lang"),
        quoted(text_col).alias("text"),
    )
    lots = kept(rows.mapInArrow(_gather, _LOTS), "lots")
    vocabulary, sizes = frequent_words(lots, min_count, budget)
    spread = lots.select("lot", "lang", F.posexplode("words").alias("at", "word"))
    size = vocabulary.agg(F.sum(F.octet_length("word") + 64)).first()[0] or 0
    frequent = F.broadcast(vocabulary) if size <= BROADCAST_BYTES else vocabulary
    # Each word of a lot stays a row, frequent or not, so that rows follow the words of the lots.
    entry = F.when(F.col("id").isNotNull(), F.struct("at", "id", F.col("grp").cast("int").alias("grp")))
    known = spread.join(frequent, ["lang", "word"], "left").groupBy("lot").agg(F.collect_list(entry).alias("known"))
    numbered = kept(lots.select("lot", "own", "size", "ids", "firsts").join(known, "lot"), "numbered_lots")

    prefixes = Prefixes()
    hot = vocabulary.filter("grp = -1").select(F.col("id").cast("bigint").alias("key"), F.col("f").alias("n"))
    for _ in range(LONGEST):
        found = hot.orderBy("key").toArrow()
        if not found.num_rows:
            break
        prefixes.keys.append(found.column("key").to_numpy())
        prefixes.counts.append(found.column("n").to_numpy())
        if len(prefixes.keys) < LONGEST:
            longer = numbered.mapInArrow(_extensions(prefixes), "key bigint, n bigint")
            hot = longer.groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") > budget)
    last = vocabulary.agg(F.max("grp")).first()[0] or 0
    dealt = numbered.mapInArrow(
        _dealt(prefixes, max(int(last), 0) + 1, budget), "grp bigint, depth bigint, suffixes binary"
    )
    nodes = dealt.groupBy("grp").applyInArrow(_subtree(min_count), "ids array<int>, a bigint")
    extended = [
        (prefixes.spelled(level, i), int(n))
        for level, counts in enumerate(prefixes.counts) if level
        for i, n in enumerate(counts) if n >= min_count
    ]
    if extended:
        nodes = nodes.union(docs.sparkSession.createDataFrame(extended, "ids array<int>, a bigint"))
    nodes = kept(nodes.withColumn("node", F.monotonically_increasing_id()), "phrases")
    spelled = nodes.select("node", "a", F.posexplode("ids").alias("at", "id")).join(
        vocabulary.select("id", "lang", "word"), "id"
    )
    named = spelled.groupBy("node", "a", "lang").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda w: w["word"]).alias("words")
    )
    single = vocabulary.select("lang", F.array("word").alias("words"), "f")
    return kept(named.select("lang", "words", F.col("a").alias("f")).union(single), "phrase_counts"), sizes


def collocations(counts: DataFrame, sizes: DataFrame) -> DataFrame:
    """``(lang, phrase, a, l, r, n, score, dropped)`` of every phrase of two words or more.

    ``score`` is the least over all cuts of ``floor(1000 a n / (l r))``, reckoned in decimals
    of 38 digits; ``l`` and ``r`` are those of the cut, the earliest among equals. ``dropped``
    tells whether a phrase of one word more contains it as often as it occurs itself; where a
    longer one does, so does one of a word more.
    """
    phrases = counts.select("lang", F.array_join("words", " ").alias("phrase"), "words", "f")
    size = F.size("words")
    cuts = (
        phrases.filter(size > 1)
        .select("lang", "phrase", F.col("f").alias("a"), "words", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
        .select(
            "lang", "phrase", "a", "k", size.alias("size"),
            F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("left"),
            F.array_join(F.slice("words", F.col("k") + 1, size - F.col("k")), " ").alias("right"),
        )
    )
    of = phrases.select("lang", "phrase", "f")
    for side, out in (("left", "l"), ("right", "r")):
        cuts = cuts.join(of.withColumnsRenamed({"phrase": side, "f": out}), ["lang", side])
    score = (
        "(cast(1000 as decimal(4,0)) * (cast(a as decimal(17,0)) * cast(n as decimal(17,0))))"
        " div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"
    )
    cuts = kept(cuts.join(sizes, "lang").withColumn("score", F.expr(score).cast("bigint")), "cuts")
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    inside = cuts.filter("size > 2 and k = size - 1 and l = a").select("lang", F.col("left").alias("phrase"))
    inside = inside.union(cuts.filter("size > 2 and k = 1 and r = a").select("lang", F.col("right").alias("phrase")))
    inside = inside.distinct().withColumn("inside", F.lit(True))
    return best.join(inside, ["lang", "phrase"], "left").select(
        "lang", "phrase", "a", "b.l", "b.r", "n", "b.score", F.coalesce("inside", F.lit(False)).alias("dropped")
    )


def best_collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    min_count: int = MIN_COUNT,
    top: int = TOP,
    budget: int = BUDGET,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's ``top`` phrases not dropped.

    By falling score, falling count and the phrase's bytes. A table without frequent phrases
    gives no rows. Columns besides text and language play no part.
    """
    counts, sizes = phrase_counts(docs, text_col, lang_col, min_count, budget)
    left = collocations(counts, sizes).filter(~F.col("dropped"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANKERS))
    some = left.withColumn("part", part)
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    ranked = some.filter(F.col("rank") <= top).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")
    )
    return ranked.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
