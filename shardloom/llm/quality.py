"""Quality rules as a ledger of failure bits.

Every rule is measured once per document; the ledger keeps the measurements and one bit per
failed rule. A policy is a version name and a mask of the rules that it applies, so a new
policy, or the question what one rule alone costs, reads the ledger and no text.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.llm.tables import clear_name, quoted
from shardloom.llm.text import (
    PIECE_BYTES,
    encoded,
    groups,
    starts_of,
    window_fingerprints,
    word_fingerprints,
)
from shardloom.session import attach

REPEAT_WORDS = 8
SYMBOLS = b"#*$%&|<>"

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
    "n_upper_words", "n_echo_words",
)
_TYPE = f"struct<{','.join(f'{name}:bigint' for name in MEASURES)}>"


@dataclass(frozen=True)
class Rule:
    """``fails`` is true for documents that break the rule; its place in the list is its bit."""

    name: str
    fails: str


# An echo is a word equal to the one before it.
RULES = (
    Rule("too_few_words", "n_words < 20"),
    Rule("repeated_passages", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("duplicate_lines", "2 * n_dup_lines > n_lines"),
    Rule("capitals", "2 * n_upper_words > n_words"),
    Rule("echoed_words", "5 * n_echo_words > 2 * n_words"),
    Rule("word_length", "word_chars < 2 * n_words or word_chars > 15 * n_words"),
)

POLICIES = {
    "base-v1": ("too_few_words", "repeated_passages"),
    "full-v1": tuple(rule.name for rule in RULES),
}
BASE, POLICY = "base-v1", "full-v1"


def mask(policy: str | Sequence[str], rules: Sequence[Rule] = RULES) -> int:
    names = POLICIES[policy] if isinstance(policy, str) else policy
    bit = {rule.name: 1 << i for i, rule in enumerate(rules)}
    return sum(bit[name] for name in set(names))


def _measured(texts: list[bytes]) -> list[np.ndarray]:
    """The measures of a piece of texts, in the order of ``MEASURES``."""
    words, counts = word_fingerprints(texts)
    begins, n = starts_of(counts), len(texts)
    owner = np.repeat(np.arange(n), counts)

    def per_text(flags: np.ndarray) -> np.ndarray:
        return np.bincount(owner[: len(flags)][flags], minlength=n).astype(np.int64)

    # Windows of one text are told from those of others by their text's number.
    windows = window_fingerprints(words, REPEAT_WORDS)
    inside = np.flatnonzero(owner[: len(windows)] == owner[REPEAT_WORDS - 1 :][: len(windows)])
    order = inside[np.lexsort((windows[inside], owner[inside]))]
    same = (windows[order[1:]] == windows[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
    found = np.zeros(len(order), bool)
    found[1:] |= same
    found[:-1] |= same
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, order[found], 1)
    np.add.at(covered, order[found] + REPEAT_WORDS, -1)
    echo = np.zeros(len(words), bool)
    echo[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
    chars, symbols, lines, doubled, upper = np.array(
        [_lines_and_chars(text) for text in texts], np.int64
    ).reshape(-1, 5).T
    return [
        counts, chars, symbols, doubled, per_text(np.cumsum(covered[:-1]) > 0), lines, upper,
        per_text(echo),
    ]


def _lines_and_chars(text: bytes) -> tuple[int, int, int, int, int]:
    """Code points in words, symbols, lines with a word, those seen before, words in ASCII capitals."""
    solid = text.translate(None, b" \t\n\x0b\x0c\r")
    data = np.frombuffer(solid, np.uint8)
    chars = int(np.count_nonzero((data & 0xC0) != 0x80))
    symbols = len(solid) - len(solid.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\x0b\x0c\r")]
    upper = sum(map(bytes.isupper, text.split()))
    return chars, symbols, len(lines), len(lines) - len(set(lines)), upper


def measures(text: Column) -> Column:
    """Struct of ``MEASURES`` of a whole text; null counts as empty."""

    @F.arrow_udf(_TYPE)
    def measure(column: pa.Array) -> pa.Array:
        texts = encoded(column)
        parts = [
            np.stack(_measured(texts[lo:hi]))
            for lo, hi in groups([len(t) for t in texts], PIECE_BYTES)
        ]
        table = np.concatenate(parts, axis=1) if parts else np.zeros((len(MEASURES), 0), np.int64)
        return pa.StructArray.from_arrays([pa.array(row) for row in table], list(MEASURES))

    return measure(text)


def ledger(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """All columns of ``docs``, the measures and ``fail_bits``, a BIGINT with a bit per failed rule.

    One pass without a shuffle. A null or empty text has no words and fails the rules that
    zeros fail; repeated rows are judged alike, each for itself. Columns of ``docs`` named
    like a new one are replaced.
    """
    attach(docs.sparkSession)
    made = {*MEASURES, "fail_bits"}
    own = [c for c in docs.columns if c.lower() not in made or c == text_col]
    all_of = clear_name(docs, "_measures")
    measured = docs.select(*map(quoted, own), measures(quoted(text_col)).alias(all_of))
    bits = F.lit(0).cast("bigint")
    flat = measured.select(*map(quoted, own), *[F.col(f"{all_of}.{m}").alias(m) for m in MEASURES])
    for i, rule in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint"))
    return flat.withColumn("fail_bits", bits)


def passes(policy: str | Sequence[str], rules: Sequence[Rule] = RULES) -> Column:
    """Whether a ledger row breaks none of the policy's rules."""
    return F.col("fail_bits").bitwiseAND(F.lit(mask(policy, rules)).cast("bigint")) == 0


def ablations(
    rows: DataFrame, policy: str | Sequence[str] = POLICY, rules: Sequence[Rule] = RULES
) -> DataFrame:
    """Per rule of the policy: documents that break it, and those that it alone rejects.

    Works on distinct bit patterns, of which there are 2 to the number of rules at most, so
    any number of policies costs one small aggregation of the ledger.
    """
    whole = mask(policy, rules)
    names = POLICIES[policy] if isinstance(policy, str) else policy
    patterns = rows.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    broken = F.col("fail_bits").bitwiseAND(F.lit(whole).cast("bigint"))
    listed = F.explode(
        F.array(*[
            F.struct(F.lit(r.name).alias("rule"), F.lit(1 << i).cast("bigint").alias("bit"))
            for i, r in enumerate(rules) if r.name in names
        ])
    )
    each = patterns.select("n", broken.alias("broken"), listed.alias("r"))
    hit = F.col("broken").bitwiseAND(F.col("r.bit")) != 0
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("n_broken"),
        F.coalesce(F.sum(F.when(F.col("broken") == F.col("r.bit"), F.col("n"))), F.lit(0)).alias(
            "n_only_this"
        ),
    )


def accepted(docs: DataFrame, policy: str = POLICY, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the policy keeps, columns as they were."""
    judged = ledger(docs, text_col).filter(passes(policy))
    return judged.select(*map(quoted, docs.columns))
