"""Token counts under a unigram model, by dynamic programming over a trie of pre-tokens.

Distinct pre-tokens go into a trie. The best segmentation score of a prefix depends on the
prefix alone, so it is computed once per trie node, for all pre-tokens that share it, level
by level in arrays; where a pre-token ends, the number of tokens is stored. A document's
count is the sum over its pre-tokens.

The tries are built per task: a count needs only the vocabulary, so nothing is shuffled,
and what a task keeps of earlier pre-tokens is bounded.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.llm.tables import clear_name, quoted
from shardloom.llm.text import encoded, groups, ranges, starts_of
from shardloom.session import attach

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# The vocabulary is broadcast; a larger file is refused.
MAX_PIECES = 1 << 20
# Counts of pre-tokens that a task remembers between its batches.
REMEMBERED = 400_000

# A word with the one blank before it, or a run of white space, cut after 256 bytes, which
# bounds the trie's depth. Together they are the whole text.
PRE_TOKEN = re.compile(rb" ?[^\x20\x09-\x0D]{1,256}|[\x20\x09-\x0D]{1,256}")


class Unigram:
    """Pieces with log-probabilities, as a trie in sorted arrays."""

    def __init__(self, scores: dict[bytes, float]):
        if len(scores) > MAX_PIECES:
            raise ValueError(f"more than {MAX_PIECES} pieces")
        missing = [b for b in range(256) if bytes([b]) not in scores]
        if missing:
            raise ValueError("every single byte must be a piece")
        self.scores = scores
        children: dict[int, int] = {}
        values = [-np.inf]
        for piece, score in sorted(scores.items()):
            state = 0
            for byte in piece:
                state = children.setdefault(state << 8 | byte, len(values))
                if state == len(values):
                    values.append(-np.inf)
            values[state] = score
        keys = np.fromiter(children.keys(), np.int64, len(children))
        order = np.argsort(keys)
        self.keys = keys[order]
        self.targets = np.fromiter(children.values(), np.int64, len(children))[order]
        self.values = np.array(values)

    def step(self, states: np.ndarray, bytes_: np.ndarray) -> np.ndarray:
        """The states after a byte, -1 where no piece goes on."""
        wanted = states << 8 | bytes_
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.targets[at], -1)


def from_ranks(lines: Sequence[bytes]) -> Unigram:
    """A model from a file of ``base64 rank`` lines: Zipf's law, a piece's probability falls as its rank."""
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
    total = float(np.log(np.sum(1.0 / (np.arange(len(ranks)) + 1.0))))
    return Unigram({piece: -float(np.log(rank + 1.0)) - total for piece, rank in ranks.items()})


def counts(model: Unigram, words: Sequence[bytes]) -> np.ndarray:
    """Tokens of each distinct non-empty word: fewest among the best-scored segmentations.

    ``words`` must be sorted, so that the words of a trie node stand together.
    """
    n = len(words)
    result = np.zeros(n, np.int64)
    lengths = np.fromiter(map(len, words), np.int64, n)
    begins = starts_of(lengths)
    data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
    alive = np.arange(n)
    node_of = np.zeros(n, np.int64)  # of each living word, in the level before
    score, tokens = np.zeros(1), np.zeros(1, np.int64)  # of each node in the level before
    # Pieces under way at each node: where they began is only a score and a count.
    held = np.zeros(2, np.int64)
    states, at_score, at_tokens = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
    level = 0
    while len(alive):
        byte = data[begins[alive] + level]
        fresh = np.ones(len(alive), bool)
        fresh[1:] = (node_of[1:] != node_of[:-1]) | (byte[1:] != byte[:-1])
        head = np.flatnonzero(fresh)
        parent, byte_of = node_of[head], byte[head]
        # Each child goes on with its parent's pieces, and a new one begins at the parent.
        reps = np.diff(held)[parent]
        pick = ranges(held[parent], reps)
        child = np.concatenate([np.repeat(np.arange(len(head)), reps), np.arange(len(head))])
        state = model.step(
            np.concatenate([states[pick], np.zeros(len(head), np.int64)]), byte_of[child]
        )
        from_score = np.concatenate([at_score[pick], score[parent]])
        from_tokens = np.concatenate([at_tokens[pick], tokens[parent]])
        go_on = np.flatnonzero(state >= 0)
        go_on = go_on[np.argsort(child[go_on], kind="stable")]
        child, states = child[go_on], state[go_on]
        at_score, at_tokens = from_score[go_on], from_tokens[go_on]
        held = np.searchsorted(child, np.arange(len(head) + 1))
        ending = at_score + model.values[states]
        score = np.maximum.reduceat(ending, held[:-1])
        few = np.where(ending == score[child], at_tokens + 1, np.iinfo(np.int64).max)
        tokens = np.minimum.reduceat(few, held[:-1])
        node_of = np.cumsum(fresh) - 1
        level += 1
        done = lengths[alive] == level
        result[alive[done]] = tokens[node_of[done]]
        # Nodes whose words all end here are left behind.
        alive, node_of = alive[~done], node_of[~done]
    return result


def token_counts(text: Column, model: Broadcast) -> Column:
    """Struct ``(n_pretokens, n_tokens)`` of a whole text; null counts as empty."""

    @F.arrow_udf("struct<n_pretokens:bigint,n_tokens:bigint>")
    def count(column: pa.Array) -> pa.Array:
        texts = encoded(column)
        total, tokens = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        for lo, hi in groups([len(t) for t in texts]):
            found = [PRE_TOKEN.findall(t) for t in texts[lo:hi]]
            if len(_known) > REMEMBERED:
                _known.clear()
            new = sorted({w for words in found for w in words}.difference(_known))
            _known.update(zip(new, counts(model.value, new).tolist(), strict=True))
            total[lo:hi] = [len(words) for words in found]
            tokens[lo:hi] = [sum(map(_known.__getitem__, words)) for words in found]
        return pa.StructArray.from_arrays([pa.array(total), pa.array(tokens)], ["n_pretokens", "n_tokens"])

    _known: dict[bytes, int] = {}
    return count(text)


def load(spark: SparkSession, path: str = RANKS) -> Unigram:
    """The model of a rank file, read by Spark; refused above ``MAX_PIECES`` lines."""
    rows = spark.read.text(path).limit(MAX_PIECES + 1).collect()
    return from_ranks([row.value.encode() for row in rows])


def count_tokens(docs: DataFrame, model: Unigram, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``n_pretokens, n_tokens``.

    Pre-tokens cover the text, white space included. A null or empty text has none; any
    byte string can be segmented, as every byte is a piece. Columns of ``docs`` named like
    a new one are replaced.
    """
    spark = attach(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    made = {"n_pretokens", "n_tokens"}
    own = [quoted(c) for c in docs.columns if c.lower() not in made]
    both = clear_name(docs, "_counts")
    counted = docs.select(*own, token_counts(quoted(text_col), shared).alias(both))
    return counted.select(
        *own, F.col(f"{both}.n_pretokens").alias("n_pretokens"), F.col(f"{both}.n_tokens").alias("n_tokens")
    )
