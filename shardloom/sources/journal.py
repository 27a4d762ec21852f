"""The publish journal: what a job puts in place is written down before it does.

``<dst>/journal/<job>`` holds ``plan``, the manifest rows the job is to add; ``staged.json``,
the staged files with their lengths and sums, written when all of them are complete; and a
lease that is renewed as long as the job lives. The folder goes once the files are recorded.
Whatever a job that died has left there tells the next one which files it did put in place.

Placing is a Spark job, a row per file. A file is created only where none is (a hard link, or
a rename that refuses), so of two writers at once one wins; object stores without either are
looked at first. Every step may run again: what a lost attempt has placed is found as done.
"""

from __future__ import annotations

import json
import os
import socket
import threading
import time
import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.functions.arrays import ShardDigest
from shardloom.sources.npy import (
    REPORT_SCHEMA,
    STAGED_SCHEMA,
    STAGING,
    file_length,
    journal_path,
    read_tokens,
    report_path,
)
from shardloom.sources.paths import exists, resolve

PLAN, FAILED, LEASE = "plan", "failed", "lease.json"

# A lease that was not renewed for so long is that of a dead job, if its host cannot be asked.
LEASE_SECONDS = 120
# Files that one task places, and how many at once: the store's latency, not work, takes the time.
FILES_A_TASK, THREADS = 1000, 16

_held: set[str] = set()


def new_job() -> str:
    """A name that sorts by time."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:12]}"


def started(job: str) -> float:
    """When a job began, in seconds; 0 for a name of another form."""
    stamp = job.split("-")[0]
    return int(stamp) / 1e9 if stamp.isdigit() else 0.0


class Lease:
    """Says that a job lives, from entering to leaving, renewed by a thread of this process."""

    def __init__(self, dst: str, job: str) -> None:
        self.dst, self.job, self.ended = dst, job, threading.Event()

    def __enter__(self) -> Lease:
        _held.add(self.job)
        self._renew()
        threading.Thread(target=self._keep, daemon=True).start()
        return self

    def __exit__(self, *_) -> None:
        self.ended.set()
        _held.discard(self.job)

    def _keep(self) -> None:
        while not self.ended.wait(LEASE_SECONDS / 3):
            try:
                self._renew()
            except OSError:  # the folder is gone with its job, or the store is away: try again
                continue

    def _renew(self) -> None:
        fs, folder = resolve(journal_path(self.dst, self.job))
        fs.create_dir(folder, recursive=True)
        lease = {"host": socket.gethostname(), "pid": os.getpid(), "until": time.time() + LEASE_SECONDS}
        with fs.open_output_stream(f"{folder}/{LEASE}") as out:
            out.write(json.dumps(lease).encode())


def alive(dst: str, job: str) -> bool:
    fs, path = resolve(f"{journal_path(dst, job)}/{LEASE}")
    if fs.get_file_info(path).type == pafs.FileType.NotFound:
        return False
    try:
        with fs.open_input_stream(path) as stream:
            lease = json.loads(stream.read())
    except ValueError:
        return True  # being renewed at this moment
    if lease["until"] < time.time():
        return False
    if lease["host"] != socket.gethostname():
        return True
    if lease["pid"] == os.getpid():
        return job in _held
    try:
        os.kill(lease["pid"], 0)
    except ProcessLookupError:
        return False
    except PermissionError:
        pass
    return True


def jobs(dst: str) -> list[str]:
    """Jobs with an entry, by the time they began."""
    if not exists(journal_path(dst, "")):
        return []
    fs, folder = resolve(journal_path(dst, ""))
    entries = fs.get_file_info(pafs.FileSelector(folder))
    return sorted(e.base_name for e in entries if e.type == pafs.FileType.Directory)


def stranded(dst: str) -> list[str]:
    """Staging folders of dead jobs, whose entry was never written or is gone."""
    fs, root = resolve(dst)
    folder = f"{root}/{STAGING}"
    if fs.get_file_info(folder).type != pafs.FileType.Directory:
        return []
    staged = [e.base_name for e in fs.get_file_info(pafs.FileSelector(folder))]
    known = set(jobs(dst))  # looked at last: a job that begins now has its entry before its staging
    return [job for job in staged if job not in known and job not in _held]


def intend(shards: DataFrame, dst: str, job: str) -> DataFrame:
    """Write down the rows that the job is to add to the manifest; returns them as written."""
    path = f"{journal_path(dst, job)}/{PLAN}"
    shards.write.mode("overwrite").parquet(path)
    return shards.sparkSession.read.schema(shards.schema).parquet(path)


def intended(spark: SparkSession, dst: str, names: Sequence[str]) -> DataFrame | None:
    """``(job, *manifest columns, staged, token_sum, checksum)`` of jobs that staged all files."""
    found = None
    for job in names:
        folder = journal_path(dst, job)
        if not (exists(f"{folder}/{PLAN}/_SUCCESS") and exists(f"{folder}/staged.json")):
            continue
        staged = spark.read.schema(STAGED_SCHEMA).json(f"{folder}/staged.json")
        rows = spark.read.parquet(f"{folder}/{PLAN}").join(
            staged.select("file_name", "staged", "token_sum", "checksum"), "file_name"
        )
        rows = rows.withColumn("job", F.lit(job))
        found = rows if found is None else found.unionByName(rows, allowMissingColumns=True)
    return found


def place(spark: SparkSession, dst: str, job: str, on_exists: str, files: int) -> DataFrame:
    """Put the job's staged files where they belong; returns and keeps each file's outcome."""
    staged = spark.read.schema(STAGED_SCHEMA).json(f"{journal_path(dst, job)}/staged.json")
    parts = max(1, min(files, max(spark.sparkContext.defaultParallelism, -(-files // FILES_A_TASK))))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = resolve(dst)
        schema = pa.schema(
            [(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in REPORT_SCHEMA.split(", ")]
        )
        with ThreadPoolExecutor(THREADS) as pool:
            for batch in batches:
                rows = list(pool.map(lambda row: _placed(fs, root, row, on_exists), batch.to_pylist()))
                yield pa.RecordBatch.from_pylist(rows, schema)

    path = report_path(dst, job)
    staged.repartition(parts, "file_name").mapInArrow(each, REPORT_SCHEMA).write.mode("overwrite").json(path)
    return spark.read.schema(REPORT_SCHEMA).json(path)


def _placed(fs: pafs.FileSystem, root: str, file: dict, on_exists: str) -> dict:
    row = {k: file[k] for k in ("file_name", "shard_id", "n_tokens", "token_sum", "checksum")}
    staged, target = f"{root}/{file['staged']}", f"{root}/{file['file_name']}"
    try:
        status, error = _put(fs, staged, target, file_length(file["n_tokens"]), on_exists)
    except Exception as problem:  # one file's trouble must not hide the others' outcome
        status, error = "failed", str(problem)
    return {**row, "status": status, "error": error}


def _put(fs: pafs.FileSystem, staged: str, target: str, length: int, on_exists: str) -> tuple[str, str | None]:
    for _ in range(2):  # a second look after another writer was first
        waiting, there = fs.get_file_info([staged, target])
        if waiting.type == pafs.FileType.NotFound or _same(fs, staged, target):
            if there.type == pafs.FileType.File and there.size == length:  # by an attempt that was lost
                _discard(fs, staged)
                return "published", None
            return "failed", "the staged copy is gone"
        if there.type == pafs.FileType.NotFound:
            fs.create_dir(target.rpartition("/")[0], recursive=True)
            if _create(fs, staged, target):
                return "published", None
        elif on_exists == "overwrite" or (
            on_exists == "grow" and there.type == pafs.FileType.File and there.size < length
        ):
            fs.move(staged, target)
            return "published", None
        elif there.size == length:
            return "skipped", None  # the copy stays until the job ends: it is not what stands there
        else:
            return "failed", f"a file of {there.size} bytes is in the place of one of {length}"
    return "failed", "another writer is changing the file"


def _same(fs: pafs.FileSystem, staged: str, target: str) -> bool:
    local = fs.type_name == "local"
    return local and os.path.exists(target) and os.path.exists(staged) and os.path.samefile(staged, target)


def _create(fs: pafs.FileSystem, staged: str, target: str) -> bool:
    """Give the staged file its name unless something has it."""
    if fs.type_name == "local":
        try:
            os.link(staged, target)
        except FileExistsError:
            return False
        _discard(fs, staged)
        return True
    try:
        fs.move(staged, target)  # where renaming replaces nothing, this refuses
    except OSError:
        if fs.get_file_info(target).type == pafs.FileType.NotFound:
            raise
        return False
    return True


def _discard(fs: pafs.FileSystem, path: str) -> None:
    try:
        fs.delete_file(path)
    except FileNotFoundError:
        pass


def standing(rows: DataFrame, dst: str) -> DataFrame:
    """Those of the :func:`intended` files that are in place.

    That is so where a file has the intended length, and the staged copy has gone or is the
    same file.
    """
    schema = "file_name string, job string"

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = resolve(dst)
        for batch in batches:
            found = []
            for file in batch.to_pylist():
                staged, target = f"{root}/{file['staged']}", f"{root}/{file['file_name']}"
                waiting, there = fs.get_file_info([staged, target])
                if there.type == pafs.FileType.File and there.size == file_length(file["n_tokens"]):
                    if waiting.type == pafs.FileType.NotFound or _same(fs, staged, target):
                        found.append({"file_name": file["file_name"], "job": file["job"]})
            yield pa.RecordBatch.from_pylist(found, pa.schema([("file_name", pa.string()), ("job", pa.string())]))

    found = rows.select("file_name", "n_tokens", "staged", "job").mapInArrow(each, schema)
    return rows.join(found, ["file_name", "job"]).drop("staged")


def digested(files: DataFrame, dst: str) -> DataFrame:
    """Add ``token_sum`` and ``checksum`` of files ``(file_name, ...)``, read from the files."""
    schema = "file_name string, token_sum bigint, checksum bigint"

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = resolve(dst)
        for batch in batches:
            for name in batch.column("file_name").to_pylist():
                digest = ShardDigest()
                for _, tokens in read_tokens(fs, f"{root}/{name}"):
                    digest.add(tokens)
                columns = [pa.array([name]), pa.array([digest.token_sum]), pa.array([digest.checksum])]
                yield pa.RecordBatch.from_arrays(columns, ["file_name", "token_sum", "checksum"])

    names = files.select("file_name")
    parts = max(files.sparkSession.sparkContext.defaultParallelism, 1)
    return files.join(names.repartition(parts, "file_name").mapInArrow(each, schema), "file_name")


def close(dst: str, job: str, failed: bool = False) -> None:
    """End a recorded job: its staging and its entry go, or both stay for files that failed."""
    fs, folder = resolve(journal_path(dst, job))
    if failed:
        with fs.open_output_stream(f"{folder}/{FAILED}") as out:
            out.write(b"")
        return
    drop_staging(dst, job)
    if fs.get_file_info(folder).type != pafs.FileType.NotFound:
        fs.delete_dir(folder)


def drop_staging(dst: str, job: str) -> None:
    fs, root = resolve(dst)
    staging = f"{root}/{STAGING}/{job}"
    if fs.get_file_info(staging).type != pafs.FileType.NotFound:
        fs.delete_dir(staging)
