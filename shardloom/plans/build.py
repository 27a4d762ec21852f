"""The jobs: corpus to published shards, with resume; and the filter-to-JSON job."""

from __future__ import annotations

import hashlib
import logging
from collections.abc import Callable, Sequence

from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.functions.naming import ThreeWay, TwoWay
from shardloom.functions.vocab import ByteVocab, RankVocab
from shardloom.operators.checkpoints import (
    append_checkpoint,
    checkpoint_log,
    latest_checkpoint,
    read_text_checkpoints,
)
from shardloom.operators.offsets import token_offsets
from shardloom.operators.packing import SHARD_SIZE, observed, shard_manifest, shard_tokens
from shardloom.operators.rows import write_jsonl
from shardloom.session import attach, scratch, written
from shardloom.sources.corpus import SOURCE_ORDER, corpus
from shardloom.sources import journal
from shardloom.sources.npy import file_length
from shardloom.sources.objects import list_objects, outcome, pending
from shardloom.sources.paths import exists, resolve

log = logging.getLogger(__name__)

PLAN, MANIFEST, CHECKPOINTS = "plan", "manifest", "checkpoints"

SKIP_EXISTING, OVERWRITE, GROW = "skip_existing", "overwrite", "grow"
_ON_EXISTS = {SKIP_EXISTING: "skip", OVERWRITE: "overwrite", GROW: "grow"}
# Names given in an error message.
NAMED = 10


def build(
    spark: SparkSession,
    src: str | Sequence[str],
    dst: str,
    vocab: ByteVocab | RankVocab | None = None,
    *,
    id_col: str = "id",
    text_col: str = "text",
    order_by: str | Sequence[str] | None = SOURCE_ORDER,
    glob: str | None = None,
    eot: bool = True,
    shard_size: int = SHARD_SIZE,
    layout: ThreeWay | TwoWay = ThreeWay(),
    mode: str = SKIP_EXISTING,
    resume: bool = False,
    resume_after_id: str | int | None = None,
    resume_from: str | None = None,
    on_progress: Callable[[dict[str, int]], None] | None = None,
) -> DataFrame:
    """Tokenize ``src``, cut it into shards and publish them below ``dst``; returns the manifest.

    ``resume`` continues a stopped run from its saved plan and gives exactly the shards an
    uninterrupted run gives; without a plan it is a fresh start. ``resume_after_id`` names
    the document at whose checkpoint to continue, ``resume_from`` a folder of checkpoint objects
    whose latest says where; without one there it is a fresh start. ``on_progress`` is called with
    the documents and tokens that were planned, counted as the one pass over the corpus went
    by, and with the shards left to write. ``mode`` says what happens to files that
    are already there: ``skip_existing`` leaves them alone and does not compute them again, but
    a file of another length than planned, as a corpus that has grown leaves behind, is an
    error. So is a file that could not be published, once all others are recorded, and a shard
    that no manifest has in the end. What a run that died put in place is recorded first.
    """
    attach(spark)
    vocab = vocab or ByteVocab()
    dst = dst.rstrip("/")
    resume = resume or resume_after_id is not None or resume_from is not None
    report_progress = on_progress or (lambda counts: log.info("%s", counts))
    if resume and order_by is None:
        raise ValueError("arrival order cannot be reproduced, so it cannot be resumed")
    settings = (vocab.fingerprint, eot, shard_size, layout, id_col, text_col, order_by, glob)
    plan_id = fingerprint(spark, src, settings, glob)
    plan_path = f"{dst}/{PLAN}/{plan_id}"
    recover(spark, dst, shard_size)
    resuming = resume and _planned(dst, plan_path)

    staged = None
    if not resuming:
        tokens = vocab.tokenized(corpus(spark, src, id_col, text_col, order_by, glob), eot)
        if vocab.staged:
            # Counting tokens costs a tokenization here: do it once and keep the result.
            staged = scratch(spark, "tokens")
            tokens = written(tokens, "tokens", staged)
        _drop(f"{dst}/{PLAN}")
        passing, counts = observed(tokens.select("pos", "id", "n"))
        offsets = token_offsets(passing)
        report_progress({k: v or 0 for k, v in counts.get.items()})
        shard_manifest(offsets, shard_size, layout).write.parquet(plan_path)
    plan = spark.read.parquet(plan_path)

    wanted = plan
    if resume_after_id is not None:
        done = checkpoint_log(plan, shard_size).filter(F.col("doc_id") == resume_after_id)
        # A long document may have several; the last one replaces those before.
        done = done.agg(F.max("shard_id").alias("shard_id")).first()
        if done.shard_id is None:
            raise ValueError(f"no checkpoint at document {resume_after_id!r}")
        wanted = plan.filter(F.col("shard_id") > done.shard_id)
    if resume_from is not None:
        done = latest_checkpoint(read_text_checkpoints(spark, resume_from)).first().shard_id
        wanted = plan.filter(F.col("shard_id") > done)
    todo = wanted
    if mode == SKIP_EXISTING and _occupied(dst):
        there = present(spark, dst).withColumnRenamed("name", "file_name")
        _same_lengths(todo, there)
        todo = pending(todo, there)
    elif mode == OVERWRITE and resuming:
        # Shards that this very plan has published; others' may be of the same length.
        todo = pending(todo, read_manifest(spark, dst).filter(F.col("plan") == plan_id))
    left, first, last = todo.agg(F.count("*"), F.min("first_pos"), F.max("last_pos")).first()
    report_progress({"shards": left})
    found = todo is not wanted
    if left:
        if resuming:
            rest = corpus(spark, src, id_col, text_col, order_by, glob, span=(first, last))
            tokens = vocab.tokenized(rest, eot)
        report = publish(tokens, todo, vocab.codec(eot), dst, shard_size, layout, mode, plan_id)
        all_published(report)
        found = found or not report.filter(F.col("status") == "skipped").isEmpty()
    if found:
        adopt(wanted, dst, shard_size, plan_id)
    if staged:
        _drop(staged)
    return _covering(read_manifest(spark, dst), wanted, plan)


def _occupied(dst: str) -> bool:
    """Whether anything but this job's own tables is in the destination."""
    fs, path = resolve(dst)
    entries = fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))
    return any(entry.base_name not in (PLAN, journal.STAGING) for entry in entries)


def _covering(manifest: DataFrame, wanted: DataFrame, plan: DataFrame) -> DataFrame:
    """The plan's part of the manifest; raises if a wanted shard is not in it."""
    key = ["file_name", "n_tokens"]
    lost = wanted.join(manifest, key, "left_anti").orderBy("shard_id").select("file_name")
    first = lost.limit(NAMED).collect()
    if first:
        named = ", ".join(row.file_name for row in first)
        raise RuntimeError(f"{lost.count()} shards are not in the manifest, another job may have them: {named}")
    return manifest.join(plan, key, "left_semi")


def publish(
    tokens: DataFrame,
    shards: DataFrame,
    codec,
    dst: str,
    shard_size: int = SHARD_SIZE,
    layout: ThreeWay | TwoWay = ThreeWay(),
    mode: str = SKIP_EXISTING,
    plan_id: str | None = None,
) -> DataFrame:
    """Assemble, write and record ``shards``; returns each file's outcome.

    The journal knows the shards before a file is written, and the files with their sums
    before one is placed: whenever this stops, :func:`recover` finishes what it has begun.
    """
    job = journal.new_job()
    with journal.Lease(dst, job):
        rows, report = put_in_place(tokens, shards, codec, dst, job, layout, mode, plan_id)
        done = report.filter(F.col("status") == "published").select(
            "file_name", "token_sum", "checksum", "status"
        )
        record(rows.join(done, "file_name"), dst, shard_size, journal.started(job))
        failed = not report.filter(F.col("status") == "failed").isEmpty()
        journal.close(dst, job, failed)
    return outcome(shards, report)


def put_in_place(
    tokens: DataFrame,
    shards: DataFrame,
    codec,
    dst: str,
    job: str,
    layout: ThreeWay | TwoWay = ThreeWay(),
    mode: str = SKIP_EXISTING,
    plan_id: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """All of a publish but the recording: the rows noted in the journal, and the outcomes."""
    named = shards.withColumns({"plan": F.lit(plan_id).cast("string"), "job": F.lit(job)})
    rows = journal.intend(named, dst, job)
    (
        shard_tokens(tokens, rows, codec)
        .withColumn("file_name", layout.file_name(F.col("shard_id")))
        .select("shard_id", "file_name", "n_tokens", "payload")
        .write.format("tokenshard")
        .option("width", codec.width)
        .option("job", job)
        .mode("append")
        .save(dst)
    )
    return rows, journal.place(tokens.sparkSession, dst, job, _ON_EXISTS[mode], rows.count())


def recover(spark: SparkSession, dst: str, shard_size: int = SHARD_SIZE) -> None:
    """Record what jobs that died have put in place, and clear what they have left behind.

    A file counts by its name, its length and what became of the staged copy; its sums are
    those noted before it was placed. Jobs that still live are left alone. The staged copies
    of files that could not be placed stay until others stand in their place.
    """
    for job in journal.stranded(dst):
        journal.drop_staging(dst, job)
    dead = [job for job in journal.jobs(dst) if not journal.alive(dst, job)]
    rows = journal.intended(spark, dst, dead) if dead else None
    waiting: set[str] = set()
    if rows is not None:
        rows = written(rows, "intended")
        missing = pending(rows.select("job", "shard_id"), read_manifest(spark, dst, every=True), ["job", "shard_id"])
        placed = journal.standing(rows.join(missing, ["job", "shard_id"], "left_semi"), dst)
        placed = written(placed.withColumn("status", F.lit("published")), "placed")
        for job in sorted(row.job for row in placed.select("job").distinct().collect()):
            record(placed.filter(F.col("job") == job), dst, shard_size, journal.started(job))
        there = present(spark, dst).withColumnRenamed("name", "file_name")
        right = F.col("length") == F.col("n_tokens") * 4 + file_length(0)
        lost = rows.join(there, "file_name", "left").filter(~F.coalesce(right, F.lit(False)))
        waiting = {row.job for row in lost.select("job").distinct().collect()}
    for job in dead:
        if not (job in waiting and exists(f"{journal.journal_path(dst, job)}/{journal.FAILED}")):
            journal.close(dst, job)


def all_published(report: DataFrame) -> DataFrame:
    """The report of a publish; raises if a file failed."""
    failed = report.filter(F.col("status") == "failed").orderBy("shard_id")
    first = failed.select("file_name", "error").limit(NAMED).collect()
    if first:
        named = "; ".join(f"{row.file_name}: {row.error}" for row in first)
        raise RuntimeError(f"{failed.count()} shards could not be published: {named}")
    return report


def _same_lengths(plan: DataFrame, there: DataFrame) -> None:
    """Raises if a planned file is in place with another length."""
    planned = F.col("n_tokens") * 4 + file_length(0)
    other = plan.join(there.select("file_name", "length"), "file_name").filter(F.col("length") != planned)
    first = other.orderBy("shard_id").select("file_name").limit(NAMED).collect()
    if first:
        named = ", ".join(row.file_name for row in first)
        raise ValueError(f"{other.count()} files there have another length than planned: {named}")


def adopt(
    plan: DataFrame, dst: str, shard_size: int = SHARD_SIZE, plan_id: str | None = None
) -> None:
    """Record planned files that are in place, of the right length, but in no manifest.

    No job of ours has put them there, so their sums are read from the files.
    """
    spark = plan.sparkSession
    unrecorded = pending(plan, read_manifest(spark, dst), ["file_name", "n_tokens"])
    if unrecorded.isEmpty():
        return
    right_length = F.col("length") == F.col("n_tokens") * 4 + file_length(0)
    found = present(spark, dst).select(F.col("name").alias("file_name"), "length")
    adopted = unrecorded.join(found, "file_name").filter(right_length).drop("length")
    adopted = journal.digested(written(adopted, "adopted"), dst).withColumns(
        {"status": F.lit("adopted"), "plan": F.lit(plan_id).cast("string"), "job": F.lit(None).cast("string")}
    )
    if not adopted.isEmpty():
        record(adopted, dst, shard_size)


def record(shards: DataFrame, dst: str, shard_size: int, at: float | None = None) -> None:
    """Append the checkpoints of published shards, then the shards to the manifest.

    In this order, as a shard missing from the manifest is found again and recorded. ``at``
    is when their job began, in seconds: of several rows of a shard the latest job's counts.
    """
    append_checkpoint(checkpoint_log(shards, shard_size), f"{dst}/{CHECKPOINTS}")
    when = F.current_timestamp() if at is None else F.timestamp_micros(F.lit(int(at * 1e6)))
    shards.withColumn("recorded", when).write.mode("append").parquet(f"{dst}/{MANIFEST}")


def read_manifest(spark: SparkSession, dst: str, every: bool = False) -> DataFrame:
    """One row per published shard, the latest where one was written again (or ``every`` row)."""
    if not exists(f"{dst}/{MANIFEST}/_SUCCESS"):
        empty = "shard_id bigint, file_name string, n_tokens bigint, plan string, job string"
        return spark.createDataFrame([], empty)
    rows = spark.read.parquet(f"{dst}/{MANIFEST}")
    for name in {"plan", "job"}.difference(rows.columns):  # written before there was a journal
        rows = rows.withColumn(name, F.lit(None).cast("string"))
    if every:
        return rows
    latest = rows.groupBy("shard_id").agg(F.max_by(F.struct("*"), "recorded").alias("row"))
    return latest.select("row.*")


def present(spark: SparkSession, dst: str) -> DataFrame:
    return list_objects(spark, dst, suffix=".npy")


def fingerprint(
    spark: SparkSession, src: str | Sequence[str], settings: tuple, glob: str | None = None
) -> str:
    """Identifies a plan: the settings that shape it and the input files it was made from.

    Files are listed, not read; those that ``glob`` leaves out play no part.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(src if isinstance(src, str) else list(src)).select(
        "path", "length", "modificationTime"
    )
    mix = files.distinct().agg(F.bit_xor(F.xxhash64("*")).alias("mix"), F.count("*").alias("n"))
    return hashlib.sha256(repr((settings, tuple(mix.first()))).encode()).hexdigest()[:32]


def filter_to_jsonl(
    spark: SparkSession,
    src: str | Sequence[str],
    dst: str,
    predicate: Column,
    *,
    id_col: str = "id",
    text_col: str = "text",
    order_by: str | Sequence[str] | None = SOURCE_ORDER,
    glob: str | None = None,
    limit: int | None = None,
) -> None:
    """Read the first ``limit`` documents, keep those matching, write them as JSON lines.

    The cap counts documents read, not documents kept.
    """
    read = corpus(spark, src, id_col, text_col, order_by, glob, limit)
    write_jsonl(read.filter(predicate).select("id", "text"), dst)


def _planned(dst: str, plan_path: str) -> bool:
    """Whether this plan was saved; another plan in its place is an error."""
    if exists(f"{plan_path}/_SUCCESS"):
        return True
    fs, path = resolve(f"{dst}/{PLAN}")
    others = exists(f"{dst}/{PLAN}") and fs.get_file_info(pafs.FileSelector(path))
    if any(exists(f"{dst}/{PLAN}/{other.base_name}/_SUCCESS") for other in others or []):
        raise ValueError("the input or the settings changed since the run to be resumed")
    return False


def _drop(url: str) -> None:
    if exists(url):
        fs, path = resolve(url)
        fs.delete_dir(path)
