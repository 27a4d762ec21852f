"""The ``tokenshard`` data source: one 1-D little-endian uint32 ``.npy`` file per shard.

Writing takes rows ``(shard_id, file_name, n_tokens, payload)``, each shard's rows together
and in order inside one partition. ``payload`` holds big-endian unsigned integers of
``width`` bytes (option, 2 or 4). Files are staged below a folder named by the option ``job``;
the commit lists them, with their sums, in the job's entry of the journal and moves nothing.
``sources.journal`` puts them in place.

Reading yields ``(file_name, shard_offset, tokens)`` in chunks of ``chunk_tokens``.
"""

from __future__ import annotations

import io
import json
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from shardloom.functions.arrays import ShardDigest, runs, token_run
from shardloom.sources.paths import resolve

STAGING = "_staging"
REPORTS, JOURNAL = "reports", "journal"
STAGED_SCHEMA = (
    "file_name string, staged string, shard_id bigint, n_tokens bigint, token_sum bigint, checksum bigint"
)
REPORT_SCHEMA = (
    "file_name string, shard_id bigint, n_tokens bigint, token_sum bigint, checksum bigint, "
    "status string, error string"
)


def report_path(destination: str, job: str) -> str:
    return f"{destination.rstrip('/')}/{REPORTS}/{job}.json"


def journal_path(destination: str, job: str) -> str:
    return f"{destination.rstrip('/')}/{JOURNAL}/{job}".rstrip("/")


def file_length(n_tokens: int) -> int:
    return n_tokens * 4 + len(npy_header(n_tokens))


class TokenShardSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tokenshard"

    def schema(self) -> str:
        return "file_name string, shard_offset bigint, tokens array<bigint>"

    def reader(self, schema: StructType) -> DataSourceReader:
        return TokenShardReader(
            self.options["path"],
            int(self.options.get("chunk_tokens", 1 << 16)),
            int(self.options.get("partition_bytes", 1 << 27)),
        )

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        job = self.options.get("job")
        if not job:
            raise ValueError("writing needs the option job; plans.build.publish gives it and places the files")
        return TokenShardWriter(self.options["path"], job, int(self.options.get("width", 4)))


@dataclass
class StagedFile:
    file_name: str
    staged: str
    shard_id: int
    n_tokens: int
    token_sum: int
    checksum: int


@dataclass
class StagedFiles(WriterCommitMessage):
    files: list[StagedFile] = field(default_factory=list)


class TokenShardWriter(DataSourceArrowWriter):
    def __init__(self, path: str, job: str, width: int) -> None:
        self.path, self.job, self.width = path, job, width

    def write(self, iterator: Iterator[pa.RecordBatch]) -> StagedFiles:
        fs, root = resolve(self.path)
        # Each attempt stages under its own name, so a lost or duplicate attempt can
        # never touch the files of the one that is committed.
        folder = f"{STAGING}/{self.job}/{uuid.uuid4().hex}"
        fs.create_dir(f"{root}/{folder}", recursive=True)
        message = StagedFiles()
        current: _OpenShard | None = None
        try:
            for batch in iterator:
                shard_ids = batch.column("shard_id").to_numpy()
                for lo, hi in runs(shard_ids):
                    shard_id = int(shard_ids[lo])
                    if current is None or current.shard_id != shard_id:
                        if current is not None:
                            message.files.append(current.close())
                        current = _OpenShard(
                            fs,
                            root,
                            folder,
                            shard_id,
                            batch.column("file_name")[lo].as_py(),
                            batch.column("n_tokens")[lo].as_py(),
                        )
                    current.append(token_run(batch.column("payload"), lo, hi, self.width))
            if current is not None:
                message.files.append(current.close())
                current = None
        finally:
            if current is not None:
                current.stream.close()
        return message

    def commit(self, messages: list[StagedFiles | None]) -> None:
        files = [f for m in messages if m is not None for f in m.files]
        names = {f.file_name for f in files}
        if len(names) != len(files):
            raise ValueError("a shard was written by two partitions; group rows by shard_id")
        fs, folder = resolve(journal_path(self.path, self.job))
        fs.create_dir(folder, recursive=True)
        with fs.open_output_stream(f"{folder}/staged.json") as out:
            for file in files:
                out.write((json.dumps(asdict(file)) + "\n").encode())

    def abort(self, messages: list[StagedFiles | None]) -> None:
        """Drop this job's staging folder."""
        fs, root = resolve(self.path)
        staging = f"{root}/{STAGING}/{self.job}"
        if fs.get_file_info(staging).type != pafs.FileType.NotFound:
            fs.delete_dir(staging)


class _OpenShard:
    """A shard being staged: header first, then token runs as they arrive."""

    def __init__(
        self, fs, root: str, folder: str, shard_id: int, file_name: str, n_tokens: int
    ) -> None:
        self.shard_id, self.n_tokens = shard_id, n_tokens
        self.file_name = file_name if file_name.endswith(".npy") else file_name + ".npy"
        self.staged = f"{folder}/{shard_id}.npy"
        self.digest = ShardDigest()
        self.stream = fs.open_output_stream(f"{root}/{self.staged}")
        self.stream.write(npy_header(n_tokens))

    def append(self, tokens: np.ndarray) -> None:
        self.digest.add(tokens)
        self.stream.write(tokens.astype("<u4", copy=False))

    def close(self) -> StagedFile:
        self.stream.close()
        if self.digest.count != self.n_tokens:
            raise ValueError(
                f"shard {self.shard_id}: planned {self.n_tokens} tokens, got {self.digest.count}"
            )
        return StagedFile(
            self.file_name,
            self.staged,
            self.shard_id,
            self.n_tokens,
            self.digest.token_sum,
            self.digest.checksum,
        )


def npy_header(n_tokens: int) -> bytes:
    header = io.BytesIO()
    np.lib.format.write_array_header_1_0(
        header, {"descr": "<u4", "fortran_order": False, "shape": (n_tokens,)}
    )
    return header.getvalue()


@dataclass(frozen=True)
class FileRange:
    """Part ``part`` of ``parts`` equal token ranges of one file."""

    file_name: str
    part: int
    parts: int


class ShardRanges(InputPartition):
    """Some of one large file, or several small ones."""

    def __init__(self, ranges: list[FileRange]) -> None:
        super().__init__(ranges)


class TokenShardReader(DataSourceReader):
    def __init__(self, path: str, chunk_tokens: int, partition_bytes: int) -> None:
        self.path, self.chunk_tokens, self.partition_bytes = path, chunk_tokens, partition_bytes

    def partitions(self) -> list[InputPartition]:
        fs, root = resolve(self.path)
        packed: list[list[FileRange]] = []
        room = 0
        for info in fs.get_file_info(pafs.FileSelector(root, recursive=True)):
            name = info.path[len(root):].lstrip("/")
            hidden = any(part.startswith("_") for part in name.split("/"))
            if info.type != pafs.FileType.File or not name.endswith(".npy") or hidden:
                continue
            parts = -(-info.size // self.partition_bytes)
            for part in range(parts):
                room -= info.size // parts
                if room < 0:
                    packed.append([])
                    room = self.partition_bytes - info.size // parts
                packed[-1].append(FileRange(name, part, parts))
        return [ShardRanges(ranges) for ranges in packed]

    def read(self, partition: ShardRanges | None) -> Iterator[pa.RecordBatch]:
        for chosen in partition.value if partition is not None else []:
            yield from self._read_range(chosen)

    def _read_range(self, chosen: FileRange) -> Iterator[pa.RecordBatch]:
        fs, root = resolve(self.path)
        path = f"{root}/{chosen.file_name}"
        for offset, values in read_tokens(fs, path, self.chunk_tokens, chosen.part, chosen.parts):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([chosen.file_name]),
                    pa.array([offset], pa.int64()),
                    pa.ListArray.from_arrays(
                        pa.array([0, len(values)], pa.int32()), pa.array(values.astype(np.int64))
                    ),
                ],
                names=["file_name", "shard_offset", "tokens"],
            )


def read_tokens(
    fs: pafs.FileSystem, path: str, chunk_tokens: int = 1 << 16, part: int = 0, parts: int = 1
) -> Iterator[tuple[int, np.ndarray]]:
    """``(offset, tokens)`` of part ``part`` of ``parts`` of a shard file, in chunks."""
    with fs.open_input_file(path) as stream:
        version = np.lib.format.read_magic(stream)
        if version != (1, 0):
            raise ValueError(f"{path}: unsupported .npy version {version}")
        shape, _, dtype = np.lib.format.read_array_header_1_0(stream)
        if len(shape) != 1 or dtype != np.dtype("<u4"):
            raise ValueError(f"{path}: not a 1-D uint32 shard")
        first, last = shape[0] * part // parts, shape[0] * (part + 1) // parts
        stream.seek(stream.tell() + 4 * first)
        for offset in range(first, last, chunk_tokens):
            count = min(chunk_tokens, last - offset)
            values = np.frombuffer(stream.read(4 * count), dtype="<u4")
            if len(values) != count:
                raise ValueError(f"{path}: shorter than its header says")
            yield offset, values
