import json
import os
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from shardloom.functions.naming import ThreeWay
from shardloom.functions.vocab import ByteVocab
from shardloom.operators.offsets import token_offsets
from shardloom.operators.packing import shard_manifest
from shardloom.plans import build as build_module
from shardloom.plans.build import OVERWRITE, build, filter_to_jsonl, publish
from shardloom.sources.corpus import corpus
from shardloom.sources.npy import TokenShardWriter
from tests.packing import checksum, pack

SIZE = 200
LAYOUT = ThreeWay(2, 4)
TEXTS = [f"document {i} é {'word ' * (i % 17)}" for i in range(60)]
DOCUMENTS = [(f"<urn:uuid:{i:04d}>", text) for i, text in enumerate(TEXTS)]


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    """Three files in name order, so that file order and row order give document order."""
    path = str(tmp_path_factory.mktemp("corpus"))
    for part in range(3):
        rows = DOCUMENTS[part * 20 : part * 20 + 20]
        spark.createDataFrame(rows, "id string, text string").coalesce(1).write.parquet(
            f"{path}/part={part}"
        )
    return path


def build_small(spark, source, dst, **options):
    return build(
        spark, source, dst, shard_size=options.pop("shard_size", SIZE),
        layout=options.pop("layout", LAYOUT), **options,
    )


def shards_on_disk(dst):
    """Tokens of all shard files, in the order of their splits and numbers."""
    order = {"val": 0, "test": 1, "train": 2}
    files = sorted(Path(dst).glob("*/*_????.npy"), key=lambda f: (order[f.parent.name], f.name))
    return [np.load(file).tolist() for file in files]


def test_build_publishes_what_the_sequential_packer_makes(spark, source, folder):
    shards, checkpoints = pack(DOCUMENTS, SIZE)
    manifest = build_small(spark, source, folder).orderBy("shard_id").collect()
    assert shards_on_disk(folder) == shards
    assert [row.checksum for row in manifest] == [checksum(s) for s in shards]
    log = spark.read.parquet(f"{folder}/checkpoints").orderBy("shard_id")
    got = log.select("shard_id", "doc_id", "docs_consumed").collect()
    assert [tuple(row) for row in got] == checkpoints


def test_build_without_end_of_text(spark, source, folder):
    build_small(spark, source, folder, eot=False)
    assert shards_on_disk(folder) == pack(DOCUMENTS, SIZE, eot=False)[0]


def test_second_build_writes_nothing(spark, source, folder):
    first = build_small(spark, source, folder).count()
    before = {f: f.stat().st_mtime_ns for f in Path(folder).glob("*/*.npy")}
    assert build_small(spark, source, folder).count() == first
    assert {f: f.stat().st_mtime_ns for f in Path(folder).glob("*/*.npy")} == before


@pytest.mark.parametrize("stopped_after", [0, 3])
def test_resume_equals_an_uninterrupted_run(spark, source, folder, monkeypatch, stopped_after):
    whole = publish

    def cut_short(tokens, shards, *rest):
        whole(tokens, shards.filter(F.col("shard_id") <= stopped_after), *rest)
        raise KeyboardInterrupt

    monkeypatch.setattr(build_module, "publish", cut_short)
    with pytest.raises(KeyboardInterrupt):
        build_small(spark, source, folder)
    monkeypatch.setattr(build_module, "publish", whole)
    assert len(shards_on_disk(folder)) == stopped_after + 1
    manifest = build_small(spark, source, folder, resume=True)
    shards, _ = pack(DOCUMENTS, SIZE)
    assert shards_on_disk(folder) == shards
    assert manifest.count() == len(shards)


def test_resume_without_a_checkpoint_is_a_fresh_start(spark, source, folder):
    build_small(spark, source, folder, resume=True)
    assert shards_on_disk(folder) == pack(DOCUMENTS, SIZE)[0]


def test_resume_with_other_settings_is_an_error(spark, source, folder):
    build_small(spark, source, folder)
    with pytest.raises(ValueError, match="changed"):
        build_small(spark, source, folder, resume=True, shard_size=SIZE + 1)


def test_resume_after_an_id(spark, source, folder):
    shards, checkpoints = pack(DOCUMENTS, SIZE)
    build_small(spark, source, folder, resume_after_id=None)
    for file in Path(folder).glob("t*/*.npy"):
        file.rename(f"{folder}/gone-{file.name}")
    shard, doc_id, _ = checkpoints[4]
    build_small(spark, source, folder, resume_after_id=doc_id)
    assert shards_on_disk(folder) == shards[:2] + shards[shard + 1 :]
    with pytest.raises(ValueError, match="no checkpoint"):
        build_small(spark, source, folder, resume_after_id="absent")


def test_files_present_are_left_alone_or_replaced(spark, source, folder):
    shards, _ = pack(DOCUMENTS, SIZE)
    Path(folder, "val").mkdir()
    np.save(f"{folder}/val/val_0001.npy", np.array([7], "<u4"))
    with pytest.raises(ValueError, match="val/val_0001.npy"):  # not of the planned length
        build_small(spark, source, folder)
    assert np.load(f"{folder}/val/val_0001.npy").tolist() == [7]
    build_small(spark, source, folder, mode=OVERWRITE)
    assert shards_on_disk(folder) == shards


def test_a_published_but_unrecorded_file_is_adopted(spark, source, folder):
    shards, _ = pack(DOCUMENTS, SIZE)
    Path(folder, "val").mkdir()
    np.save(f"{folder}/val/val_0001.npy", np.array(shards[1], "<u4"))
    rows = {row.shard_id: row.status for row in build_small(spark, source, folder).collect()}
    assert rows == {k: "adopted" if k == 1 else "published" for k in range(len(shards))}


def tokens_and_plan(spark, source):
    vocab = ByteVocab()
    tokens = vocab.tokenized(corpus(spark, source))
    plan = shard_manifest(token_offsets(tokens.select("pos", "id", "n")), SIZE, LAYOUT).cache()
    return tokens, plan, vocab.codec()


def test_a_failed_run_publishes_nothing(spark, source, folder):
    tokens, plan, codec = tokens_and_plan(spark, source)
    wrong = plan.withColumn("n_tokens", F.when(F.col("shard_id") == 5, 1).otherwise(F.col("n_tokens")))
    with pytest.raises(Exception, match="planned 1 tokens"):
        publish(tokens, wrong, codec, folder, SIZE, LAYOUT)
    assert not list(Path(folder).rglob("*.npy"))


def test_a_file_that_cannot_be_moved_is_reported_and_not_recorded(spark, source, folder):
    tokens, plan, codec = tokens_and_plan(spark, source)
    Path(folder, "test").write_text("in the way of the folder")
    report = publish(tokens, plan, codec, folder, SIZE, LAYOUT)
    failed = {row.shard_id: row.error for row in report.filter("status = 'failed'").collect()}
    assert set(failed) == {2, 3} and all(failed.values())
    recorded = {row.shard_id for row in spark.read.parquet(f"{folder}/manifest").collect()}
    assert recorded == {row.shard_id for row in plan.collect()} - {2, 3}
    # The staged copies of what failed are kept, those of what succeeded are gone.
    assert len(list(Path(folder, "_staging").rglob("*.npy"))) == 2


def test_two_partitions_may_not_write_one_shard(spark, folder):
    from shardloom.sources.npy import StagedFile, StagedFiles

    file = StagedFile("a.npy", "x", 0, 1, 1, 1)
    with pytest.raises(ValueError, match="two partitions"):
        TokenShardWriter(folder, "job", 2).commit([StagedFiles([file]), StagedFiles([file])])


def test_shard_files_read_back_in_parts(spark, source, folder):
    build_small(spark, source, folder)
    reader = spark.read.format("tokenshard").option("chunk_tokens", 30)
    for partition_bytes in (300, 10_000):
        rows = reader.option("partition_bytes", partition_bytes).load(folder).collect()
        files = {}
        for row in sorted(rows, key=lambda row: (row.file_name, row.shard_offset)):
            tokens = files.setdefault(row.file_name, [])
            assert row.shard_offset == len(tokens)
            tokens.extend(row.tokens)
        assert len(files) == len(shards_on_disk(folder))
        assert all(np.load(f"{folder}/{name}").tolist() == t for name, t in files.items())


def test_orders(spark, source, folder):
    shuffled = spark.read.parquet(source).orderBy(F.rand(3)).repartition(3)
    shuffled.write.parquet(f"{folder}/shuffled")
    sorted_ids = corpus(spark, f"{folder}/shuffled", order_by="id").orderBy("pos").collect()
    assert [(row.id, row.text) for row in sorted_ids] == DOCUMENTS
    assert [row.pos for row in sorted_ids] == list(range(len(DOCUMENTS)))
    by_source = corpus(spark, source).orderBy("pos").collect()
    assert [row.id for row in by_source] == [doc_id for doc_id, _ in DOCUMENTS]
    arrival = corpus(spark, source, order_by=None)
    assert sorted(row.id for row in arrival.collect()) == [doc_id for doc_id, _ in DOCUMENTS]
    assert arrival.select("pos").distinct().count() == len(DOCUMENTS)


def test_a_span_in_source_order_opens_only_its_files(spark, source):
    whole = corpus(spark, source).collect()
    low, high = sorted(row.pos for row in whole)[25], sorted(row.pos for row in whole)[35]
    part = corpus(spark, source, span=(low, high))
    assert {row.id for row in part.collect()} == {row.id for row in whole if low <= row.pos <= high}
    scan = part.select("text")._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert "file_path" in scan.toString()


def test_corpus_scans(spark, source):
    assert corpus(spark, f"{source}/part=1").count() == 20
    assert corpus(spark, f"{source}/*/*.parquet").count() == 60
    assert corpus(spark, source, glob="*.parquet").count() == 60
    assert [row.id for row in corpus(spark, source, limit=25).orderBy("pos").collect()] == [
        doc_id for doc_id, _ in DOCUMENTS[:25]
    ]


def test_filter_to_jsonl_caps_before_it_filters(spark, source, folder):
    filter_to_jsonl(spark, source, f"{folder}/out", F.col("text").contains("2 é"), limit=30)
    lines = [
        json.loads(line)
        for file in Path(folder, "out").glob("*.json")
        for line in file.read_text().splitlines()
    ]
    assert sorted(row["id"] for row in lines) == [
        doc_id for doc_id, text in DOCUMENTS[:30] if "2 é" in text
    ]


def test_arrival_order_cannot_be_resumed(spark, source, folder):
    with pytest.raises(ValueError, match="arrival"):
        build_small(spark, source, folder, order_by=None, resume=True)
    total = sum(map(len, build_and_read(spark, source, folder)))
    assert total == sum(map(len, pack(DOCUMENTS, SIZE)[0]))


def build_and_read(spark, source, folder):
    build_small(spark, source, folder, order_by=None)
    return shards_on_disk(folder)


def test_empty_corpus(spark, folder):
    spark.createDataFrame([], "id string, text string").write.parquet(f"{folder}/in")
    assert build_small(spark, f"{folder}/in", f"{folder}/out").count() == 0
    assert not list(Path(folder, "out").rglob("*.npy"))
    assert os.path.isdir(f"{folder}/out/plan")


def test_retried_tasks_leave_no_trace(spark, source, folder):
    """Every assembling task dies once, after it has staged rows."""
    tokens, plan, codec = tokens_and_plan(spark, source)

    @F.arrow_udf("binary")
    def fragile(bodies: pa.Array) -> pa.Array:
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("lost")
        return bodies

    shaky = tokens.withColumn("body", fragile("body"))
    report = publish(shaky, plan, codec, f"file://{folder}", SIZE, LAYOUT)
    assert {row.status for row in report.collect()} == {"published"}
    assert shards_on_disk(folder) == pack(DOCUMENTS, SIZE)[0]
    assert not list(Path(folder, "_staging").rglob("*.npy"))


def test_a_new_plan_does_not_list_what_an_old_one_left(spark, source, folder):
    old = build_small(spark, source, folder).count()
    manifest = build_small(spark, source, folder, shard_size=4 * SIZE, mode=OVERWRITE)
    shards, _ = pack(DOCUMENTS, 4 * SIZE)
    assert old > len(shards)
    rows = manifest.orderBy("shard_id").collect()
    assert [(row.n_tokens, row.checksum) for row in rows] == [(len(s), checksum(s)) for s in shards]


def test_a_grown_corpus_is_an_error_unless_overwritten(spark, folder):
    src, dst = os.path.join(folder, "src"), os.path.join(folder, "dst")
    rows = [(i, "text " * 9) for i in range(12)]
    options = {"order_by": "id", "shard_size": 100}
    spark.createDataFrame(rows[:5], "id bigint, text string").write.parquet(src)
    build(spark, src, dst, **options)
    spark.createDataFrame(rows[5:], "id bigint, text string").write.mode("append").parquet(src)
    with pytest.raises(ValueError, match="another length"):
        build(spark, src, dst, **options)
    manifest = build(spark, src, dst, mode=OVERWRITE, **options).collect()
    assert sum(row.n_tokens for row in manifest) == 12 * 46


def test_files_outside_the_glob_do_not_change_the_plan(spark, folder):
    path = f"{folder}/in"
    spark.createDataFrame(DOCUMENTS, "id string, text string").coalesce(1).write.parquet(path)
    first = build_small(spark, path, f"{folder}/out", glob="*.parquet").count()
    Path(path, "notes.txt").write_text("not a part of the corpus")
    again = build_small(spark, path, f"{folder}/out", glob="*.parquet", resume=True).count()
    assert again == first
    assert len(list(Path(folder, "out", "plan").iterdir())) == 1


def test_resume_from_checkpoint_objects(spark, source, folder):
    from shardloom.operators.checkpoints import read_text_checkpoints, write_text_checkpoints

    shards, checkpoints = pack(DOCUMENTS, SIZE)
    log = spark.createDataFrame(
        [(s, f"doc {s}", n) for s, _, n in checkpoints[:5]], "shard_id bigint, doc_id string, docs_consumed bigint"
    )
    log = log.withColumn("updated", F.timestamp_seconds(F.lit(1_700_000_000) - F.col("shard_id")))
    assert write_text_checkpoints(log, f"{folder}/objects") == 5
    back = read_text_checkpoints(spark, f"{folder}/objects").orderBy("shard_id").collect()
    assert [(r.shard_id, r.doc_id, r.docs_consumed) for r in back] == [tuple(r)[:3] for r in log.collect()]
    # The latest by time, which here is the least shard.
    build_small(spark, source, f"{folder}/out", resume_from=f"{folder}/objects")
    assert shards_on_disk(f"{folder}/out") == shards[1:]
    progress = []
    whole = build_small(spark, source, f"{folder}/all", resume_from=f"{folder}/none", on_progress=progress.append)
    assert shards_on_disk(f"{folder}/all") == shards and whole.count() == len(shards)
    assert progress == [{"documents": len(DOCUMENTS), "tokens": sum(map(len, shards))}, {"shards": len(shards)}]


def test_text_objects_are_whole_and_may_be_written_again(spark, folder):
    from shardloom.sources.objects import list_objects, read_text_objects, write_text_objects

    rows = spark.createDataFrame([("a/x.txt", "é"), ("b.txt", ""), ("c.bin", "1:2")], "name string, value string")
    for _ in range(2):
        assert write_text_objects(rows.repartition(3), folder) == 3
    assert {(r.name, r.value) for r in read_text_objects(spark, folder).collect()} == {("a/x.txt", "é"), ("b.txt", "")}
    assert {r.name for r in list_objects(spark, folder).collect()} == {"a/x.txt", "b.txt", "c.bin"}
    assert not list(Path(folder).glob("_*"))


def test_file_ranks_come_from_the_listing(spark, folder, monkeypatch):
    from shardloom.sources import corpus as corpus_module

    for part in ("a b", "c%20d", "é", "a"):  # names that paths encode
        os.makedirs(f"{folder}/{part}")
        spark.createDataFrame([(part, "text")], "id string, text string").coalesce(1).write.mode("overwrite").parquet(
            f"{folder}/{part}"
        )
    found = corpus(spark, f"{folder}/*").orderBy("pos").collect()
    paths = corpus_module.ranked_files(spark.read.parquet(f"{folder}/*"))
    assert len(found) == len(paths) == 4 and paths == sorted(paths)
    assert [r.pos >> corpus_module.ROW_BITS for r in found] == [0, 1, 2, 3]
    plan = corpus(spark, f"{folder}/*")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == plan.count("BroadcastExchange")  # no text is shuffled
    monkeypatch.setattr(corpus_module, "MAX_FILES", 4)
    with pytest.raises(ValueError, match="merge files"):
        corpus(spark, f"{folder}/*")


def test_paths_that_share_a_fingerprint_get_another(spark, monkeypatch):
    from shardloom.sources import corpus as corpus_module

    whole, seeds = F.xxhash64, []

    def colliding(path, seed):
        seeds.append(seed)
        return F.lit(7).cast("bigint") if len(seeds) < 3 else whole(path, seed)

    monkeypatch.setattr(F, "xxhash64", colliding)
    ranks, seed = corpus_module.file_ranks(spark, ["a", "b", "c"])
    assert seed == 2 and ranks.select("_file").distinct().count() == 3


def test_one_value_of_the_order_column_spreads_over_tasks(spark, folder):
    rows = [(f"{i:05d}", "one", f"text {i}") for i in range(4000)]
    df = spark.createDataFrame(rows, "id string, lang string, text string").orderBy(F.rand(1)).repartition(4)
    df.write.parquet(folder + "/in")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = corpus(spark, folder + "/in", order_by="lang").cache()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert [r.id for r in placed.orderBy("pos").collect()] == [i for i, *_ in rows]
    sizes = [r["count"] for r in placed.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2500


def test_other_dumps_are_not_opened(spark, folder):
    for dump in "ABC":
        spark.createDataFrame([(dump, "text")], "id string, text string").write.parquet(f"{folder}/data/{dump}")
    for path, want in ((f"{folder}/data/B", "B"), (f"{folder}/data/[AC]/*.parquet", "AC")):
        docs = corpus(spark, path)
        assert sorted(r.id for r in docs.collect()) == list(want)
        assert {f.rsplit("/", 2)[1] for f in docs.inputFiles()} == set(want)
