"""Numpy helpers used inside tasks on Arrow buffers; no per-row Python work."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Fixed value: modulus of the position-weighted checksum (the Mersenne prime 2^31 - 1).
CHECKSUM_MODULUS = (1 << 31) - 1

# Tokens digested at a time: small enough to stay in cache, and for a step's weighted sum,
# below 2^14 x 2^14 x 2^32, to fit in 64 bits.
_STEP = 1 << 14
_RAMP = np.arange(_STEP, dtype=np.int64)


def runs(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """``[lo, hi)`` of each stretch of equal neighbours."""
    if len(keys):
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        yield from zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)], strict=True)


def binary_parts(column: pa.Array) -> tuple[np.ndarray, pa.Buffer | None]:
    """``(byte offsets, data buffer)`` of a binary column, slices included."""
    _, offsets, data = column.buffers()
    width = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    bounds = np.frombuffer(offsets, dtype=width)[column.offset : column.offset + len(column) + 1]
    return bounds.astype(np.int64), data


def token_run(payload: pa.Array, lo: int, hi: int, width: int) -> np.ndarray:
    """Tokens of rows ``[lo, hi)`` in native order; neighbouring rows share one buffer."""
    bounds, data = binary_parts(payload)
    size = int(bounds[hi] - bounds[lo])
    if size == 0:
        return np.empty(0, dtype=f"=u{width}")
    packed = np.frombuffer(data, f"=u{width}", count=size // width, offset=int(bounds[lo]))
    return packed.byteswap() if sys.byteorder == "little" else packed


def lists_of(bounds: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), pa.array(values)).cast(
        pa.list_(pa.int64())
    )


class ShardDigest:
    """Running count, sum, range and position-weighted checksum of a shard's tokens.

    checksum = sum((position + 1) * token) mod CHECKSUM_MODULUS, positions from 0.
    """

    def __init__(self, position: int = 0) -> None:
        self.count = position
        self.token_sum = self.checksum = 0
        self.min_id: int | None = None
        self.max_id: int | None = None

    def add(self, tokens: np.ndarray) -> None:
        for at in range(0, len(tokens), _STEP):
            part = tokens[at : at + _STEP].astype(np.int64)
            total = int(part.sum())
            inside = int(np.dot(_RAMP[: len(part)], part))
            weighted = (self.count + 1) * total + inside
            self.checksum = (self.checksum + weighted) % CHECKSUM_MODULUS
            self.token_sum += total
            low, high = int(part.min()), int(part.max())
            self.min_id = low if self.min_id is None else min(self.min_id, low)
            self.max_id = high if self.max_id is None else max(self.max_id, high)
            self.count += len(part)
