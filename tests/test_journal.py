"""Runs that die between staging, placing and recording, and writers that meet."""

import json
import os
import shutil
import socket
import threading
import time
from pathlib import Path

import numpy as np
import pytest
from pyarrow import fs as pafs

from shardloom.plans import build as build_module
from shardloom.plans.build import OVERWRITE, build, put_in_place, read_manifest, recover
from shardloom.sources import journal
from shardloom.sources.npy import file_length, journal_path
from shardloom.streaming.packer import StreamPacker
from tests.packing import checksum, pack
from tests.test_jobs import DOCUMENTS, LAYOUT, SIZE, build_small, shards_on_disk, tokens_and_plan
from tests.test_jobs import source  # noqa: F401


class Died(Exception):
    pass


def die(*_):
    raise Died


def facts(manifest):
    return [(r.n_tokens, r.checksum) for r in manifest.orderBy("shard_id").collect()]


def expected(shards):
    return [(len(s), checksum(s)) for s in shards]


def left_behind(dst):
    return [p for name in ("journal", "_staging") for p in Path(dst, name).glob("*")]


@pytest.mark.parametrize("resume", [False, True])
def test_placed_but_not_recorded(spark, source, folder, monkeypatch, resume):  # noqa: F811
    with monkeypatch.context() as patch:
        patch.setattr(build_module, "record", die)
        with pytest.raises(Died):
            build_small(spark, source, folder)
    shards, checkpoints = pack(DOCUMENTS, SIZE)
    assert shards_on_disk(folder) == shards and not Path(folder, "manifest").exists()
    manifest = build_small(spark, source, folder, resume=resume)
    assert facts(manifest) == expected(shards)
    assert {r.status for r in manifest.collect()} == {"published"}
    log = spark.read.parquet(f"{folder}/checkpoints").orderBy("shard_id").collect()
    assert [(r.shard_id, r.doc_id, r.docs_consumed) for r in log] == checkpoints
    assert not left_behind(folder)


def test_died_while_placing(spark, source, folder, monkeypatch):  # noqa: F811
    whole = journal.place

    def half(spark, dst, job, on_exists, files):
        path = Path(journal_path(dst, job), "staged.json")
        lines = path.read_text().splitlines(keepends=True)
        path.write_text("".join(lines[::2]))
        whole(spark, dst, job, on_exists, files)
        path.write_text("".join(lines))
        raise Died

    with monkeypatch.context() as patch:
        patch.setattr(journal, "place", half)
        with pytest.raises(Died):
            build_small(spark, source, folder)
    shards, _ = pack(DOCUMENTS, SIZE)
    assert 0 < len(shards_on_disk(folder)) < len(shards)
    assert facts(build_small(spark, source, folder, resume=True)) == expected(shards)
    assert shards_on_disk(folder) == shards and not left_behind(folder)


def test_an_overwrite_of_a_grown_corpus_that_died(spark, folder, monkeypatch):
    src, dst = os.path.join(folder, "src"), os.path.join(folder, "dst")
    rows = [(i, "text " * 9) for i in range(18)]
    options = {"order_by": "id", "shard_size": 100, "mode": OVERWRITE}
    spark.createDataFrame(rows[:5], "id bigint, text string").write.parquet(src)
    build(spark, src, dst, **options)
    spark.createDataFrame(rows[5:], "id bigint, text string").write.mode("append").parquet(src)
    with monkeypatch.context() as patch:
        patch.setattr(build_module, "record", die)
        with pytest.raises(Died):
            build(spark, src, dst, **options)
    manifest = build(spark, src, dst, resume=True, **options)
    assert facts(manifest) == expected(pack(rows, 100)[0])
    assert shards_on_disk(dst) == pack(rows, 100)[0]


def test_an_overwrite_that_died_before_it_placed_all(spark, folder, monkeypatch):
    """Old files of the same length do not pass for the new plan's."""
    src, dst = os.path.join(folder, "src"), os.path.join(folder, "dst")
    old, new = ([(i, c * 45) for i in range(6)] for c in "ab")
    options = {"order_by": "id", "shard_size": 100, "mode": OVERWRITE}
    spark.createDataFrame(old, "id bigint, text string").write.parquet(src)
    build(spark, src, dst, **options)
    spark.createDataFrame(new, "id bigint, text string").write.mode("overwrite").parquet(src)
    with monkeypatch.context() as patch:
        patch.setattr(journal, "place", die)
        with pytest.raises(Died):
            build(spark, src, dst, **options)
    manifest = build(spark, src, dst, resume=True, **options)
    assert facts(manifest) == expected(pack(new, 100)[0])
    assert shards_on_disk(dst) == pack(new, 100)[0]


@pytest.mark.parametrize("at", ["record", "place"])
def test_a_stream_that_died_while_a_partial_shard_was_replaced(spark, folder, monkeypatch, at):
    rows = [(i, f"document {i} " * (i % 5 + 1)) for i in range(30)]
    batches = [spark.createDataFrame(rows[k : k + 10], "id bigint, text string") for k in (0, 10, 20)]

    def packer():
        return StreamPacker(spark, folder, order_by="id", shard_size=SIZE, layout=LAYOUT)

    packer()(batches[0], 0)
    packer().finalize()
    with monkeypatch.context() as patch:
        patch.setattr(*((build_module, "record") if at == "record" else (journal, "place")), die)
        with pytest.raises(Died):
            packer()(batches[1], 1)
    packer()(batches[1], 1)
    packer()(batches[2], 2)
    shards, _ = pack(rows, SIZE)
    assert facts(packer().finalize()) == expected(shards)
    assert shards_on_disk(folder) == shards and not left_behind(folder)


def test_a_manifest_that_does_not_cover_the_plan_is_an_error(spark, source, folder, monkeypatch):  # noqa: F811
    def forgetful(shards, dst, shard_size, at=None):
        whole(shards.filter("shard_id != 3"), dst, shard_size, at)

    whole = build_module.record
    monkeypatch.setattr(build_module, "record", forgetful)
    with pytest.raises(RuntimeError, match="not in the manifest.*test_0001"):
        build_small(spark, source, folder)


def test_a_foreign_file_is_adopted_with_the_sums_of_its_content(spark, source, folder):  # noqa: F811
    shards, _ = pack(DOCUMENTS, SIZE)
    Path(folder, "val").mkdir()
    np.save(f"{folder}/val/val_0001.npy", np.full(SIZE, 7, "<u4"))
    row = build_small(spark, source, folder).filter("shard_id = 1").first()
    assert (row.status, row.checksum) == ("adopted", checksum([7] * SIZE))


def lease(dst, job, **changes):
    content = {"host": socket.gethostname(), "pid": os.getppid(), "until": time.time() + 60, **changes}
    folder = Path(journal_path(dst, job))
    folder.mkdir(parents=True)
    Path(folder, journal.LEASE).write_text(json.dumps(content))
    Path(dst, "_staging", job).mkdir(parents=True)


def test_dead_jobs_staging_goes_and_live_jobs_stays(spark, source, folder):  # noqa: F811
    gone = 1 << 22  # beyond the largest process id
    lease(folder, "1-live")
    lease(folder, "2-dead", pid=gone)
    lease(folder, "3-elsewhere", host="another")
    lease(folder, "4-expired", host="another", until=time.time() - 1)
    lease(folder, "5-ours", pid=os.getpid())  # of this process, but no longer held
    Path(folder, "_staging", "6-unknown").mkdir()
    build_small(spark, source, folder)
    for kept in ("_staging", "journal"):
        assert {p.name for p in Path(folder, kept).iterdir()} == {"1-live", "3-elsewhere"}


def test_a_lease_is_renewed(monkeypatch, folder):
    monkeypatch.setattr(journal, "LEASE_SECONDS", 0.3)
    with journal.Lease(folder, "1-job"):
        time.sleep(0.9)
        assert journal.alive(folder, "1-job")
    assert not journal.alive(folder, "1-job")


def test_failed_files_stay_staged_until_others_stand_there(spark, source, folder):  # noqa: F811
    tokens, plan, codec = tokens_and_plan(spark, source)
    Path(folder, "test").write_text("in the way")
    with pytest.raises(RuntimeError, match="could not be published"):
        build_small(spark, source, folder)
    recover(spark, folder)
    assert len(list(Path(folder, "_staging").rglob("*.npy"))) == 2
    os.rename(f"{folder}/test", f"{folder}/aside")
    build_small(spark, source, folder)
    recover(spark, folder)
    assert shards_on_disk(folder) == pack(DOCUMENTS, SIZE)[0] and not left_behind(folder)


def test_of_two_writers_one_publishes_each_file(folder):
    """Both have looked and seen nothing; the file is created once."""
    fs, length = pafs.LocalFileSystem(), file_length(2)
    for attempt in range(40):
        target = f"{folder}/val/{attempt}.npy"
        staged = [f"{folder}/{attempt}-{writer}.npy" for writer in range(4)]
        for number, path in enumerate(staged):
            np.save(path, np.full(2, number, "<u4"))
        start, outcomes = threading.Barrier(4), {}

        def write(path):
            start.wait()
            outcomes[path] = journal._put(fs, path, target, length, "skip")[0]

        threads = [threading.Thread(target=write, args=(path,)) for path in staged]
        [t.start() for t in threads], [t.join() for t in threads]
        assert sorted(outcomes.values()) == ["published", "skipped", "skipped", "skipped"]
        (winner,) = [path for path, outcome in outcomes.items() if outcome == "published"]
        assert np.load(target)[0] == staged.index(winner)


@pytest.mark.parametrize("on_exists", ["skip", "overwrite", "grow"])
def test_placing_again_finds_it_done(folder, on_exists):
    fs, staged, target = pafs.LocalFileSystem(), f"{folder}/s.npy", f"{folder}/val/t.npy"
    np.save(staged, np.zeros(2, "<u4"))
    shutil.copy(staged, f"{staged}.copy")
    assert journal._put(fs, staged, target, file_length(2), on_exists) == ("published", None)
    assert journal._put(fs, staged, target, file_length(2), on_exists) == ("published", None)
    os.link(target, staged)  # the attempt was lost before it removed its copy
    assert journal._put(fs, staged, target, file_length(2), on_exists) == ("published", None)
    assert not os.path.exists(staged)


def test_two_jobs_that_died_are_recorded_in_their_order(spark, source, folder):  # noqa: F811
    """The first placed partial shards, the second whole ones over them."""
    tokens, plan, codec = tokens_and_plan(spark, source)
    first, second = journal.new_job(), journal.new_job()
    assert first < second
    put_in_place(tokens, plan.filter("shard_id < 3"), codec, folder, first, LAYOUT)
    put_in_place(tokens, plan.filter("shard_id < 5"), codec, folder, second, LAYOUT, OVERWRITE)
    recover(spark, folder, SIZE)
    rows = {r.shard_id: r.job for r in read_manifest(spark, folder).collect()}
    assert rows == dict.fromkeys(range(5), second)
    assert facts(read_manifest(spark, folder)) == expected(pack(DOCUMENTS, SIZE)[0][:5])
