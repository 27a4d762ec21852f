import os
from pathlib import Path

import pytest

from shardloom.functions.naming import ThreeWay
from shardloom.sources.corpus import corpus_stream
from shardloom.streaming.packer import StreamPacker, pack_stream
from tests.packing import checksum, pack
from tests.test_jobs import shards_on_disk

SIZE = 300
LAYOUT = ThreeWay(2, 4)
TEXTS = [f"document {i} é {'word ' * (i % 17)}" for i in range(48)] + ["z" * 700, "", "end"]
DOCUMENTS = list(enumerate(TEXTS))
FILES = 4


@pytest.fixture
def inbox(spark, folder):
    """Four files whose modification times follow the documents."""
    per_file = -(-len(DOCUMENTS) // FILES)
    for at in range(FILES):
        rows = DOCUMENTS[at * per_file : (at + 1) * per_file]
        spark.createDataFrame(rows, "id bigint, text string").coalesce(1).write.parquet(
            f"{folder}/raw/{at}"
        )
        (file,) = Path(f"{folder}/raw/{at}").glob("*.parquet")
        os.makedirs(f"{folder}/inbox", exist_ok=True)
        target = f"{folder}/inbox/{at}.parquet"
        os.link(file, target)
        os.utime(target, (1_700_000_000 + at, 1_700_000_000 + at))
    return f"{folder}/inbox"


def packer(spark, folder, **options):
    return StreamPacker(spark, f"{folder}/out", shard_size=SIZE, layout=LAYOUT, **options)


def run(spark, folder, inbox, max_files, **options):
    stream = corpus_stream(spark, inbox, "id bigint, text string", max_files)
    return pack_stream(stream, packer(spark, folder, **options), f"{folder}/query")


@pytest.mark.parametrize("max_files,eot", [(1, True), (3, False)])
def test_stream_equals_batch(spark, folder, inbox, max_files, eot):
    shards, checkpoints = pack(DOCUMENTS, SIZE, eot)
    manifest = run(spark, folder, inbox, max_files, eot=eot).orderBy("shard_id").collect()
    assert shards_on_disk(f"{folder}/out") == shards
    assert [row.checksum for row in manifest] == [checksum(s) for s in shards]
    full = [(r.shard_id, r.last_doc, r.docs_consumed) for r in manifest if r.n_tokens == SIZE]
    assert full == checkpoints


def test_a_replayed_batch_changes_nothing(spark, folder, inbox):
    files = [spark.read.parquet(f"{inbox}/{at}.parquet") for at in range(FILES)]
    pack_batch = packer(spark, folder)
    for batch_id, batch in enumerate(files):
        pack_batch(batch, batch_id)
        if batch_id == 2:  # the state was saved, the engine never heard of it
            pack_batch(batch, batch_id)
        if batch_id == 3:  # shards were published, the state was not saved
            Path(f"{folder}/out/state/batch=3/mark/_SUCCESS").unlink()
            packer(spark, folder)(batch, batch_id)
    manifest = pack_batch.finalize()
    shards, _ = pack(DOCUMENTS, SIZE)
    assert shards_on_disk(f"{folder}/out") == shards
    assert manifest.count() == len(shards)
    assert packer(spark, folder).finalize().count() == len(shards)


def test_nothing_arrived(spark, folder):
    assert packer(spark, folder).finalize().count() == 0


def test_other_settings_are_refused(spark, folder):
    docs = spark.createDataFrame([(i, "text " * 9) for i in range(9)], "id bigint, text string")
    first = StreamPacker(spark, folder, order_by="id", shard_size=64)
    first(docs, 0)
    other = StreamPacker(spark, folder, order_by="id", shard_size=32)
    with pytest.raises(ValueError, match="other settings"):
        other(docs, 1)


def test_a_failed_file_keeps_the_batch(spark, folder):
    docs = spark.createDataFrame([(i, "text " * 9) for i in range(9)], "id bigint, text string")
    packer = StreamPacker(spark, folder, order_by="id", shard_size=64)
    blocked = os.path.join(folder, "val")
    with open(blocked, "w") as out:
        out.write("in the way")
    with pytest.raises(RuntimeError, match="could not be published"):
        packer(docs, 0)
    os.rename(blocked, blocked + ".aside")
    packer(docs, 0)
    total = sum(row.n_tokens for row in packer.finalize().collect())
    assert total == 9 * 46


def test_what_a_batch_writes_does_not_follow_the_fill(spark, folder):
    """Ten batches into one open shard: each is one segment, written once."""
    rows = [(i, f"document {i} " + "word " * 5) for i in range(100)]
    files, shards = {}, None
    pack_batch = StreamPacker(spark, folder, order_by="id", shard_size=1 << 20)
    for k in range(10):
        batch = spark.createDataFrame(rows[k * 10 : k * 10 + 10], "id bigint, text string")
        pack_batch(batch, k)
        segments = {f: f.stat().st_mtime_ns for f in Path(folder, "state", "segments").rglob("*.parquet")}
        assert all(segments[f] == files[f] for f in files)  # nothing that was written is written again
        assert spark.read.parquet(f"{folder}/state/segments/{k}").count() == 10
        files = segments
    assert len(list(Path(folder, "state").glob("batch=*"))) == 2
    manifest = pack_batch.finalize().collect()
    shards, _ = pack(rows, 1 << 20)
    assert [(r.n_tokens, r.checksum) for r in manifest] == [(len(s), checksum(s)) for s in shards]


def test_segments_go_when_their_shard_is_full(spark, folder):
    rows = [(i, "text " * 9) for i in range(40)]
    pack_batch = StreamPacker(spark, folder, order_by="id", shard_size=200)
    for k in range(20):
        pack_batch(spark.createDataFrame(rows[2 * k : 2 * k + 2], "id bigint, text string"), k)
        assert len(list(Path(folder, "state", "segments").iterdir())) <= 6
    shards, checkpoints = pack(rows, 200)
    manifest = pack_batch.finalize().orderBy("shard_id").collect()
    assert [r.checksum for r in manifest] == [checksum(s) for s in shards]
    assert [(r.shard_id, r.last_doc, r.docs_consumed) for r in manifest if r.n_tokens == 200] == checkpoints
