"""A sequential packer over Python lists, the yardstick for the distributed one."""

from __future__ import annotations

from shardloom.functions.arrays import CHECKSUM_MODULUS

EOT = 256


def tokens_of(text: str, eot: bool = True) -> list[int]:
    return ([EOT] if eot else []) + list(text.encode())


def pack(documents: list[tuple], size: int, eot: bool = True):
    """``(shards, checkpoints)`` of ordered ``(id, text)`` pairs.

    ``checkpoints`` holds ``(shard, id, documents consumed)`` for every full shard.
    """
    shards, checkpoints, room = [], [], []
    for consumed, (doc_id, text) in enumerate(documents, start=1):
        room += tokens_of(text, eot)
        while len(room) >= size:
            checkpoints.append((len(shards), doc_id, consumed))
            shards.append(room[:size])
            room = room[size:]
    return shards + ([room] if room else []), checkpoints


def checksum(tokens: list[int]) -> int:
    return sum((i + 1) * t for i, t in enumerate(tokens)) % CHECKSUM_MODULUS
