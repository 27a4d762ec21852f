"""Benchmark passages in training documents, by BM25 with block-max bounds.

Test items are a BM25 inverted index. A document is cut into passages, windows of words that
overlap by half, long enough that any item lies whole in one. Every passage is a query, and
every item that scores at least a share of what it scores on itself is retrieved: blocks
of items are skipped while the sum of their terms' greatest impacts stays below it, the
rest are scored term by term. Retrieved items are then verified: enough of the question's
and of the answer's word shingles must stand in the passage. An item that has one text is cut
near its middle; shingles are narrower in parts so short that one edited word could break most.

The index goes to the tasks, so documents are neither shuffled nor joined. Beyond a checked
size it is split, and the documents are scanned once for each split.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from functools import reduce
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.llm.tables import clear_name, kept, quoted
from shardloom.llm.text import encoded, groups, ranges
from shardloom.session import attach

K1, B = 1.2, 0.75
# Share of an item's own score that a passage must reach.
THRESHOLD = 0.5
# Words to a shingle, and the share of question and answer shingles that must be found.
SHINGLE, OVERLAP = 5, 0.5
BLOCK_ITEMS = 4
MIN_PASSAGE = 64
# Text of the items in one broadcast index.
INDEX_BYTES = 32 << 20
# Cells of the table of bounds, passages by blocks, that is filled at once.
BOUND_CELLS = 1 << 21

_HIT = "struct<item:string,score:double,question:double,answer:double,at:bigint>"
# Bytes of words, capitals folded; all others become blanks.
_FOLDED = bytes(ord(chr(b).lower()) if chr(b).isalnum() or b > 127 else 32 for b in range(128)) + bytes(range(128, 256))
# The same words in Spark's regular expressions, for text in lower case.
_SPARK_WORD = r"[0-9a-z\x{80}-\x{10FFFF}]+"
_SENTENCE = re.compile(r"[.?!](?=\s)")
# The same words in text.
_WORD = re.compile(r"[0-9A-Za-z\x80-\U0010FFFF]+")


def words_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and digits, lower case, and of all characters beyond ASCII.

    Marks and symbols that cling to a word are no part of it.
    """
    return text.translate(_FOLDED).split()


def split_item(text: str) -> tuple[str, str]:
    """Two parts of an item that has one text, cut at the sentence end nearest the middle.

    Each part has at least a third of the words, and five; without such a sentence end the cut
    is at half the words. So an edit or omission of a tenth leaves the greater part of both.
    """
    starts = [word.start() for word in _WORD.finditer(text)]
    least = max(SHINGLE, -(-len(starts) // 3))
    ends = [(sentence.end(), bisect_left(starts, sentence.end())) for sentence in _SENTENCE.finditer(text)]
    ends = [(cut, before) for cut, before in ends if least <= before <= len(starts) - least]
    half = (len(starts) + 1) // 2
    if ends:
        cut = min(ends, key=lambda end: abs(2 * end[1] - len(starts)))[0]
    else:
        cut = starts[half] if half < len(starts) else len(text)
    return text[:cut], text[cut:]


def tolerant_width(n: int) -> int:
    """Words to a shingle of a part of ``n`` words that was cut from a text.

    The widest up to ``SHINGLE`` of which one edited word leaves half, and two at least.
    """
    return max(2, min(SHINGLE, (n + 1) // 3))


def shingles(words: list[bytes], width: int = SHINGLE) -> set[tuple[bytes, ...]]:
    """Distinct runs of ``width`` words; a shorter text is one run, no words are none."""
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


class Index:
    """Postings of items, impacts divided by the item's own score, and their maxima by block."""

    def __init__(
        self,
        ids: list[str | None],
        items: list[tuple[bytes, bytes, bytes]],
        frequency: dict[bytes, int],
        n: int,
        average: float,
        own_parts: bool = False,
    ):
        """``items``: whole text, question, answer. The rest is counted over all items there are.

        ``own_parts``: question and answer were given, not cut from the text.
        """
        self.ids = ids
        self.threshold = THRESHOLD
        self.items = []
        for _, *parts in items:
            of = [words_of(part) for part in parts]
            widths = [SHINGLE if own_parts else tolerant_width(len(words)) for words in of]
            self.items.append([(width, shingles(words, width)) for width, words in zip(widths, of, strict=True)])
        postings: dict[bytes, list[tuple[int, float]]] = defaultdict(list)
        self.impacts: list[list[tuple[bytes, float]]] = []
        longest = 0
        for i, (text, _, _) in enumerate(items):
            words = words_of(text)
            longest = max(longest, len(words))
            times = defaultdict(int)
            for word in words:
                times[word] += 1
            norm = K1 * (1 - B + B * len(words) / max(average, 1e-9))
            impact = {
                w: np.log(1 + (n - frequency[w] + 0.5) / (frequency[w] + 0.5)) * tf * (K1 + 1) / (tf + norm)
                for w, tf in times.items()
            }
            own = sum(impact.values())
            self.impacts.append([(word, value / own) for word, value in impact.items()])
            for word, value in impact.items():
                postings[word].append((i, value / own))
        self.term = {word: k for k, word in enumerate(postings)}
        self.postings = list(postings.values())
        self.stride = max(MIN_PASSAGE // 2, longest)
        self.n_blocks = -(-len(items) // BLOCK_ITEMS)
        blocks, bounds, sizes = [], [], []
        for rows in self.postings:
            best: dict[int, float] = defaultdict(float)
            for i, value in rows:
                best[i // BLOCK_ITEMS] = max(best[i // BLOCK_ITEMS], value)
            blocks.extend(best.keys())
            bounds.extend(best.values())
            sizes.append(len(best))
        self.blocks, self.bounds = np.array(blocks, np.int64), np.array(bounds)
        self.sizes = np.array(sizes, np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes

    def search(self, texts: list[bytes]) -> list[list[dict]]:
        """Verified hits of each text, the best passage of each item, by item."""
        found: list[list[dict]] = [[] for _ in texts]
        if not self.items:
            return found
        words = [words_of(text) for text in texts]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        per_text = -(-sizes // self.stride)  # segments, a passage being one and the next
        first = np.cumsum(per_text) - per_text
        ids = np.fromiter(
            map(self.term.get, chain.from_iterable(words), repeat(-1)), np.int64, int(sizes.sum())
        )
        within = ranges(np.zeros(len(words), np.int64), sizes)
        segment = np.repeat(first, sizes) + within // self.stride
        known = ids >= 0
        pairs = np.unique(segment[known] * len(self.postings) + ids[known])
        segment, ids = pairs // len(self.postings), pairs % len(self.postings)
        total = int(per_text.sum())
        owner = np.repeat(np.arange(len(words)), per_text)
        hits: dict[tuple[int, int], dict] = {}
        step = max(1, BOUND_CELLS // self.n_blocks - 1)
        for lo in range(0, total, step):
            hi = min(lo + step, total)
            for row, block in self._candidates(segment, ids, owner, lo, hi):
                i = int(owner[row])
                at = int(row - first[i]) * self.stride
                self._score(words[i][at : at + 2 * self.stride], int(block), i, at, hits)
        for (i, _), hit in sorted(hits.items()):
            found[i].append(hit)
        return found

    def _candidates(self, segment, ids, owner, lo: int, hi: int):
        """Passages that begin with segments ``lo`` to ``hi``, and blocks whose bound reaches the threshold."""
        last = min(hi + 1, len(owner))  # the second segment of the last passage
        part = slice(*np.searchsorted(segment, [lo, last]))
        segment, ids = segment[part] - lo, ids[part]
        sizes = self.sizes[ids]
        at = ranges(self.begins[ids], sizes)
        cell = np.repeat(segment, sizes) * self.n_blocks + self.blocks[at]
        table = np.bincount(cell, self.bounds[at], minlength=(last - lo) * self.n_blocks)
        table = table.reshape(last - lo, self.n_blocks)
        bound = table.copy()
        follows = owner[lo : last - 1] == owner[lo + 1 : last]
        bound[:-1][follows] += table[1:][follows]
        rows, blocks = np.nonzero(bound[: hi - lo] >= self.threshold - 1e-9)
        return zip(rows + lo, blocks, strict=True)

    def _score(self, passage: list[bytes], block: int, text: int, at: int, hits) -> None:
        words = set(passage)
        there: dict[int, set[tuple[bytes, ...]]] = {}  # by width
        for i in range(block * BLOCK_ITEMS, min((block + 1) * BLOCK_ITEMS, len(self.items))):
            score = sum(value for word, value in self.impacts[i] if word in words)
            if score < self.threshold:
                continue
            question, answer = (_share(part, width, there, passage) for width, part in self.items[i])
            known = hits.get((text, i))
            if min(question, answer) >= OVERLAP and (known is None or score > known["score"]):
                hits[text, i] = {
                    "item": self.ids[i], "score": score, "question": question, "answer": answer, "at": at,
                }


def _share(
    part: set[tuple[bytes, ...]], width: int, there: dict[int, set[tuple[bytes, ...]]], passage: list[bytes]
) -> float:
    """Share of the shingles that the passage has; an empty part is there."""
    if not part:
        return 1.0
    width = min(width, len(next(iter(part))))  # a part of fewer words is looked up as it is
    if width not in there:
        there[width] = shingles(passage, width)
    return len(part & there[width]) / len(part)


def _halves(text: Column) -> Column:
    @F.arrow_udf("struct<question:string,answer:string>")
    def apply(column: pa.Array) -> pa.Array:
        pairs = [split_item(text or "") for text in column.to_pylist()]
        return pa.StructArray.from_arrays(
            [pa.array([p[k] for p in pairs], pa.string()) for k in (0, 1)], ["question", "answer"]
        )

    return apply(text)


def _has_parts(items: DataFrame) -> bool:
    return {"question", "answer"} <= {c.lower() for c in items.columns}


def _parted(items: DataFrame, id_col: str) -> DataFrame:
    """``(item, text, question, answer)`` of the items with a word; answers may be columns of their own."""
    if _has_parts(items):
        text = F.concat_ws(" ", F.col("question"), F.col("answer"))
        parts = items.select(quoted(id_col).alias("item"), text.alias("text"), "question", "answer")
    else:
        halves = _halves(F.col("text"))
        parts = items.select(quoted(id_col).alias("item"), "text", halves.alias("_h")).select(
            "item", "text", "_h.question", "_h.answer"
        )
    return parts.filter(F.col("text").rlike(f"(?i){_SPARK_WORD}")).fillna("", ["question", "answer"])


def indexes(items: DataFrame, id_col: str = "item_id", most_bytes: int = INDEX_BYTES):
    """An index of each split of the items; statistics are over all items."""
    table = kept(_parted(items, id_col), "items")
    # Lower case as in words_of, for ASCII letters alone.
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.regexp_extract_all(lower, F.lit(_SPARK_WORD), F.lit(0))
    facts = table.agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.size(words)).alias("average"),
        F.sum(F.octet_length("text")).alias("bytes"),
    ).first()
    splits = max(1, -(-int(facts.bytes or 0) // most_bytes))
    split = F.pmod(F.xxhash64("item", "text"), F.lit(splits))
    spread = table.select(split.alias("split"), F.explode(F.array_distinct(words)).alias("word"))
    frequency = spread.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    used = kept(spread.distinct().join(frequency, "word"), "terms")
    own_parts = _has_parts(items)
    for k in range(splits):
        rows = table.filter(split == k).orderBy("item", "text").collect()
        df = {row.word.encode(): row.df for row in used.filter(F.col("split") == k).collect()}
        texts = [tuple(x.encode() for x in (r.text, r.question, r.answer)) for r in rows]
        ids = [None if r.item is None else str(r.item) for r in rows]
        yield Index(ids, texts, df, facts.n, float(facts.average or 0), own_parts)


def hits_in(text: Column, index: Broadcast) -> Column:
    """Array of hit structs of a whole text; null counts as empty."""

    @F.arrow_udf(f"array<{_HIT}>")
    def search(column: pa.Array) -> pa.Array:
        texts = encoded(column)
        rows = []
        for lo, hi in groups([len(t) for t in texts]):
            rows.extend(index.value.search(texts[lo:hi]))
        kind = pa.list_(pa.struct([
            ("item", pa.string()), ("score", pa.float64()), ("question", pa.float64()),
            ("answer", pa.float64()), ("at", pa.int64()),
        ]))
        return pa.array(rows, kind)

    return search(text)


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    most_bytes: int = INDEX_BYTES,
) -> DataFrame:
    """``(doc_id, item_id, score, question_overlap, answer_overlap, word_at)``: a row per document and item found.

    ``score`` is the best passage's share of the item's own BM25 score, ``word_at`` its first
    word. Null and empty texts hold nothing, null items and those without a letter or digit are found nowhere;
    repeated documents are each reported, repeated items too; without items or documents the
    result is empty. Other columns of either table play no part.
    """
    spark = attach(docs.sparkSession)
    found = []
    id_type = items.schema[item_col].dataType
    for index in indexes(items, item_col, most_bytes):
        shared = spark.sparkContext.broadcast(index)
        rows = docs.select(
            quoted(id_col).alias("doc_id"), F.explode(hits_in(quoted(text_col), shared)).alias("hit")
        )
        found.append(
            rows.select(
                "doc_id", F.col("hit.item").cast(id_type).alias("item_id"),
                F.col("hit.score").alias("score"),
                F.col("hit.question").alias("question_overlap"),
                F.col("hit.answer").alias("answer_overlap"), F.col("hit.at").alias("word_at"),
            )
        )
    return reduce(DataFrame.unionByName, found)


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """The rows of ``docs`` in which no item is found, columns as they were."""
    spark = attach(docs.sparkSession)
    left = docs
    for index in indexes(items, item_col):
        shared = spark.sparkContext.broadcast(index)
        hits = clear_name(docs, "_hits")
        left = left.withColumn(hits, hits_in(quoted(text_col), shared)).filter(F.size(hits) == 0)
        left = left.select(*map(quoted, docs.columns))
    return left
