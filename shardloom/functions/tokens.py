"""Column functions over token arrays and packed token payloads."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.functions.arrays import ShardDigest, binary_parts, lists_of, runs, token_run

MAX_TOKEN_ID = (1 << 32) - 1


def unpack(payload: Column, width: int) -> Column:
    """Packed payload -> ``ARRAY<BIGINT>``."""

    @F.arrow_udf("array<bigint>")
    def widen(packed: pa.Array) -> pa.Array:
        bounds, _ = binary_parts(packed)
        values = token_run(packed, 0, len(packed), width).astype(np.int64)
        return lists_of((bounds - bounds[0]) // width, values)

    return widen(payload)


def pack_u32(tokens: Column) -> Column:
    """``ARRAY<BIGINT>`` -> little-endian uint32 bytes, as they appear in a shard file.

    Ids outside ``0 .. 2^32 - 1`` fail the run.
    """

    @F.arrow_udf("binary")
    def narrow(arrays: pa.Array) -> pa.Array:
        values = arrays.flatten().to_numpy(zero_copy_only=False)
        if len(values) and (values.min() < 0 or values.max() > MAX_TOKEN_ID):
            raise ValueError("token id does not fit in 32 unsigned bits")
        data = values.astype("<u4").tobytes()
        ends = np.concatenate([[0], np.cumsum(arrays.value_lengths().to_numpy())]) * 4
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(),
            len(arrays),
            [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)],
        ).cast(pa.binary())

    return narrow(check_ids(tokens))


def check_ids(tokens: Column) -> Column:
    """``tokens`` unchanged, or an error when an id is outside ``0 .. 2^32 - 1``."""
    legal = F.forall(tokens, lambda x: (x >= 0) & (x <= F.lit(MAX_TOKEN_ID)))
    return F.when(legal, tokens).otherwise(
        F.raise_error(F.lit("token id does not fit in 32 unsigned bits"))
    )


def shard_digests(assembled: DataFrame, width: int) -> DataFrame:
    """One row per shard from ordered ``(shard_id, payload)`` rows, a shard per partition.

    ``(shard_id, n_tokens, token_sum, checksum, min_id, max_id)``; see ``ShardDigest``.
    """

    def digest(batches):
        current, state = None, ShardDigest()
        for batch in batches:
            ids = batch.column("shard_id").to_numpy()
            for lo, hi in runs(ids):
                if current is not None and current != int(ids[lo]):
                    yield _digest_row(current, state)
                    state = ShardDigest()
                current = int(ids[lo])
                state.add(token_run(batch.column("payload"), lo, hi, width))
        if current is not None:
            yield _digest_row(current, state)

    return assembled.select("shard_id", "payload").mapInArrow(
        digest,
        "shard_id bigint, n_tokens bigint, token_sum bigint, checksum bigint, "
        "min_id bigint, max_id bigint",
    )


def chunk_digest(tokens: Column, offset: Column) -> Column:
    """``struct<n, token_sum, checksum>`` of a chunk of a shard that begins at ``offset``.

    Chunks add up in any order: sum the fields, the checksum modulo ``CHECKSUM_MODULUS``.
    """

    @F.arrow_udf("struct<n:bigint,token_sum:bigint,checksum:bigint>")
    def digest(arrays: pa.Array, offsets: pa.Array) -> pa.Array:
        rows = []
        for at in range(len(arrays)):
            state = ShardDigest(offsets[at].as_py())
            state.add(arrays[at].values.to_numpy())
            rows.append(
                {"n": len(arrays[at]), "token_sum": state.token_sum, "checksum": state.checksum}
            )
        return pa.array(
            rows,
            pa.struct([(name, pa.int64()) for name in ("n", "token_sum", "checksum")]),
        )

    return digest(tokens, offset)


def _digest_row(shard_id: int, state: ShardDigest) -> pa.RecordBatch:
    columns = {
        "shard_id": shard_id,
        "n_tokens": state.count,
        "token_sum": state.token_sum,
        "checksum": state.checksum,
        "min_id": state.min_id,
        "max_id": state.max_id,
    }
    return pa.RecordBatch.from_arrays(
        [pa.array([value], pa.int64()) for value in columns.values()], names=list(columns)
    )
