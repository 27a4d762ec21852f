"""Words and fingerprints of whole texts, vectorised over Arrow batches.

A word is a run of bytes other than ``\\x20`` and ``\\x09-\\x0D``. Texts are worked off in
pieces of bounded size, so memory follows the piece, not the batch or the longest text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x2545F4914F6CDD1D
_BYTE_CODES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)

_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def encoded(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """Texts as UTF-8 bytes; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit (splitmix64's finish)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Fingerprints:
    """64-bit fingerprints of any substring of ``data``, from polynomial prefix sums."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        _reach(n + 1)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_CODES[data] * _powers[:n], out=self.prefix[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.prefix[end] - self.prefix[start]) * _inverses[start])

    def all(self, length: int) -> np.ndarray:
        """Fingerprints of every substring of ``length`` bytes, by start."""
        count = max(0, len(self.prefix) - length)
        return mixed(
            (self.prefix[length : length + count] - self.prefix[:count]) * _inverses[:count]
        )


def _reach(n: int) -> None:
    global _powers, _inverses
    if len(_powers) < n:
        steps = np.full(max(n, PIECE_BYTES + 4096), np.uint64(_BASE))
        steps[0] = 1
        _powers = np.multiply.accumulate(steps)
        steps[1:] = np.uint64(pow(_BASE, -1, 1 << 64))
        _inverses = np.multiply.accumulate(steps)


def groups(sizes: Sequence[int], limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of items of about ``limit`` in sum; a larger item stands alone."""
    first, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > limit:
            yield first, i
            first, total = i, 0
        total += size + 1
    if first < len(sizes):
        yield first, len(sizes)


def word_fingerprints(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all words in order, and the number of words of each text."""
    parts, owner = [], []
    for i, text in enumerate(texts):
        start = 0
        while len(text) - start > PIECE_BYTES:  # cut at white space: no word is broken
            cut = _SPACE.search(text, start + PIECE_BYTES)
            if cut is None:
                break
            parts.append(text[start : cut.start()])
            owner.append(i)
            start = cut.start()
        parts.append(text[start:] if start else text)
        owner.append(i)
    found, counts = [], np.zeros(len(texts), np.int64)
    for lo, hi in groups([len(p) for p in parts]):
        hashes, per_part = _joined_words(parts[lo:hi])
        found.append(hashes)
        np.add.at(counts, owner[lo:hi], per_part)
    return (np.concatenate(found) if found else np.zeros(0, np.uint64)), counts


def _joined_words(parts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
    blank = np.ones(len(data) + 1, bool)
    blank[1:] = (data == 32) | ((data >= 9) & (data <= 13))
    starts = np.flatnonzero(blank[:-1] & ~blank[1:])
    ends = np.flatnonzero(~blank[:-1] & blank[1:])
    edges = np.cumsum([len(p) + 1 for p in parts])
    per_part = np.diff(np.searchsorted(starts, edges), prepend=0)
    return Fingerprints(data).of(starts, ends), per_part


def window_fingerprints(words: np.ndarray, width: int) -> np.ndarray:
    """Fingerprints of ``width`` words in a row, by first word (over all texts alike)."""
    count = max(0, len(words) - width + 1)
    total = np.zeros(count, np.uint64)
    for k in range(width):
        total = total * _GOLDEN + words[k : k + count]
        total ^= total >> np.uint64(29)
    return mixed(total)


def starts_of(counts: np.ndarray) -> np.ndarray:
    """Where each text's items begin in a flat array, and the end as last entry."""
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``start, start + 1, ...`` for each pair, one after another."""
    lengths = np.asarray(lengths, np.int64)
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return np.zeros(0, np.int64)
    return np.arange(ends[-1]) + np.repeat(np.asarray(starts, np.int64) - (ends - lengths), lengths)
