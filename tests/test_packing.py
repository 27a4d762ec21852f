from pathlib import Path

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shardloom.functions.naming import ThreeWay, TwoWay
from shardloom.functions.tokens import shard_digests
from shardloom.functions.vocab import ByteVocab
from shardloom.operators import offsets as offsets_module
from shardloom.operators import packing as packing_module
from shardloom.operators.checkpoints import checkpoint_log, resume_slices
from shardloom.operators.offsets import token_offsets
from shardloom.operators.packing import progress, shard_manifest, shard_slices, shard_tokens
from shardloom.plans.build import publish
from shardloom.sources.corpus import corpus
from tests.packing import checksum, pack

VOCAB = ByteVocab()
TEXTS = st.lists(st.text(max_size=40), max_size=30)


def corpus_of(spark, texts, partitions=3):
    rows = [(i * 7 - 5, f"d{i}", text) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, "pos bigint, id string, text string").repartition(partitions)


def offsets_of(spark, texts, eot=True, partitions=3):
    tokens = VOCAB.tokenized(corpus_of(spark, texts, partitions), eot)
    return tokens, token_offsets(tokens.select("pos", "id", "n"))


def assembled(spark, texts, size, eot=True, partitions=3):
    tokens, offsets = offsets_of(spark, texts, eot, partitions)
    codec = VOCAB.codec(eot)
    rows = shard_tokens(tokens, shard_manifest(offsets, size), codec).collect()
    shards = {}
    for row in sorted(rows, key=lambda row: (row.shard_id, row.pos)):
        shards.setdefault(row.shard_id, []).extend(
            np.frombuffer(bytes(row.payload), f">u{codec.width}").tolist()
        )
    return [shards[k] for k in sorted(shards)]


CASES = {
    "no rows": ([], 8, True),
    "empty text with end-of-text": (["", "ab", ""], 2, True),
    "empty text without end-of-text": (["", "abcd", "", "ef"], 4, False),
    "only empty texts": (["", ""], 4, False),
    "ends exactly on a cut": (["abc", "defg"], 4, True),
    "corpus ends on a cut": (["abc", "def"], 4, True),
    "longer than a shard": (["x" * 21, "y"], 5, True),
    "exactly three shards": (["x" * 14, "y"], 5, True),
    "first document fills a shard": (["x" * 7, "y"], 8, True),
    "shard of one token": (["ab", ""], 1, True),
    "special text is ordinary": (["<|endoftext|>", "a"], 6, True),
    "cut inside a character": (["aé😀b", "ü"], 3, True),
}


@pytest.mark.parametrize("case", CASES)
def test_edge_cases(spark, case):
    texts, size, eot = CASES[case]
    documents = [(f"d{i}", text) for i, text in enumerate(texts)]
    shards, checkpoints = pack(documents, size, eot)
    assert assembled(spark, texts, size, eot) == shards
    _, offsets = offsets_of(spark, texts, eot)
    manifest = shard_manifest(offsets, size).cache()
    log = checkpoint_log(manifest, size).orderBy("shard_id").collect()
    assert [tuple(row) for row in log] == checkpoints
    got = progress(manifest, size).first()
    assert got.tokens == sum(map(len, shards))
    assert got.full_shards == len(checkpoints)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=TEXTS, size=st.integers(1, 60), eot=st.booleans(), partitions=st.integers(1, 5))
def test_concatenated_shards_are_the_concatenated_documents(spark, texts, size, eot, partitions):
    documents = [(f"d{i}", text) for i, text in enumerate(texts)]
    shards, _ = pack(documents, size, eot)
    assert assembled(spark, texts, size, eot, partitions) == shards


def test_digests_are_of_the_tokens_in_order(spark):
    texts = [f"document {i} " * (i % 5) for i in range(40)]
    shards, _ = pack(list(enumerate(texts)), 64)
    tokens, offsets = offsets_of(spark, texts)
    rows = shard_digests(
        shard_tokens(tokens, shard_manifest(offsets, 64), VOCAB.codec()), 2
    ).collect()
    got = {row.shard_id: (row.n_tokens, row.token_sum, row.checksum, row.min_id, row.max_id) for row in rows}
    assert got == {
        k: (len(s), sum(s), checksum(s), min(s), max(s)) for k, s in enumerate(shards)
    }


def test_only_wanted_shards_are_assembled(spark):
    texts = [f"document {i} " * (i % 5) for i in range(40)]
    shards, _ = pack(list(enumerate(texts)), 64)
    tokens, offsets = offsets_of(spark, texts)
    wanted = shard_manifest(offsets, 64).filter(F.col("shard_id").isin(1, 2, 5, len(shards) - 1))
    rows = shard_digests(shard_tokens(tokens, wanted, VOCAB.codec()), 2).collect()
    assert {row.shard_id: row.checksum for row in rows} == {
        k: checksum(shards[k]) for k in (1, 2, 5, len(shards) - 1)
    }


def test_many_cuts_are_placed_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(packing_module, "MAX_BROADCAST_CUTS", 3)
    texts = [f"document {i} " * (i % 5) for i in range(40)]
    assert assembled(spark, texts, 64) == pack(list(enumerate(texts)), 64)[0]


def test_write_tasks_follow_the_tokens(spark, monkeypatch):
    texts = [f"document {i} " * (i % 5) for i in range(40)]
    shards, _ = pack(list(enumerate(texts)), 16)
    before = int(spark.conf.get("spark.sql.shuffle.partitions"))
    used = []
    for bound in (1 << 28, 64, 16):
        monkeypatch.setattr(packing_module, "TASK_TOKENS", bound)
        tokens, offsets = offsets_of(spark, texts)
        rows = shard_tokens(tokens, shard_manifest(offsets, 16), VOCAB.codec())
        used.append(rows.select(F.spark_partition_id().alias("p")).distinct().count())
        assert assembled(spark, texts, 16) == shards
    total = sum(map(len, shards))
    assert used[0] <= max(before, spark.sparkContext.defaultParallelism) < used[1] < used[2]
    assert used[1:] == [-(-total // 64), len(shards)]


@pytest.mark.parametrize("most_runs,parts,ordered", [(1 << 20, 4, False), (0, 1, True), (1 << 20, 1, True)])
def test_offsets_do_not_depend_on_runs(spark, monkeypatch, most_runs, parts, ordered):
    monkeypatch.setattr(offsets_module, "MAX_RUNS", most_runs)
    keys = [-(2**63), -70000, -1, 0, 1, 2, 9, 65535, 65536, 2**40, 2**63 - 1]
    lengths = [3, 0, 5, 1, 1, 0, 2, 7, 4, 9, 6]
    df = spark.createDataFrame(list(zip(keys, lengths)), "pos bigint, n bigint").repartition(parts)
    df = df.sortWithinPartitions("pos") if ordered else df
    rows = token_offsets(df).orderBy("pos").collect()
    starts = np.concatenate([[0], np.cumsum(lengths)])
    assert [(r.pos, r.ordinal, r.start, r.end) for r in rows] == [
        (k, i, starts[i], starts[i + 1]) for i, k in enumerate(keys)
    ]


@pytest.mark.parametrize("rows,message", [
    ([(1, 2), (1, 3)], "repeated pos"),
    ([(None, 2), (1, 3)], "row without pos"),
])
def test_bad_positions_fail(spark, rows, message):
    df = spark.createDataFrame(rows, "pos bigint, n bigint")
    with pytest.raises(Exception, match=message):
        token_offsets(df).collect()


def test_missing_text_names_the_document(spark):
    df = spark.createDataFrame([(1, "d1", "a"), (2, "d2", None)], "pos bigint, id string, text string")
    with pytest.raises(Exception, match="document without text: d2"):
        VOCAB.tokenized(df).select("n").collect()


def test_resume_slices_complete_any_prefix(spark):
    texts = [f"document {i} " * (i % 7) for i in range(30)]
    _, offsets = offsets_of(spark, texts)
    columns = ["id", "shard_id", "doc_from", "doc_to", "shard_offset"]
    everything = {tuple(r) for r in shard_slices(offsets, 50).select(*columns).collect()}
    for k in (-1, 0, 3, 100):
        rest = {tuple(r) for r in resume_slices(offsets, k, 50).select(*columns).collect()}
        assert rest == {row for row in everything if row[1] > k}


def test_names(spark):
    shards = spark.createDataFrame([(k,) for k in (0, 1, 349, 350, 699, 700)], "shard_id bigint")
    three = ThreeWay()
    got = shards.select(three.file_name(F.col("shard_id"))).collect()
    assert [row[0] for row in got] == [
        "val/val_0000.npy", "val/val_0001.npy", "val/val_0349.npy",
        "test/test_0000.npy", "test/test_0349.npy", "train/train_0000.npy",
    ]
    two = shards.limit(2).select(TwoWay().file_name(F.col("shard_id"))).collect()
    assert [row[0] for row in two] == [
        "edufineweb_val_000000.npy", "edufineweb_train_000001.npy",
    ]


def test_shard_files_are_plain_numpy(spark, folder):
    texts = [f"document {i} é " * (i % 5) for i in range(40)]
    shards, _ = pack(list(enumerate(texts)), 64)
    tokens, offsets = offsets_of(spark, texts)
    manifest = shard_manifest(offsets, 64, TwoWay("part"))
    publish(tokens, manifest, VOCAB.codec(), folder, 64, TwoWay("part"))
    files = sorted(Path(folder).glob("*.npy"), key=lambda f: f.name.rsplit("_")[-1])
    arrays = [np.load(file) for file in files]
    assert all(a.dtype == np.dtype("<u4") and a.ndim == 1 for a in arrays)
    assert [a.tolist() for a in arrays] == shards
    assert not (Path(folder) / "_staging").exists() or not any((Path(folder) / "_staging").iterdir())


def physical_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffled_rows(spark, run):
    """What ``run`` gives, and how often rows were sorted into ranges meanwhile."""
    ranged = []
    whole = type(spark.range(1)).repartitionByRange

    def counting(df, *columns):
        ranged.append(columns)
        return whole(df, *columns)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(spark.range(1)), "repartitionByRange", counting)
        return run(), len(ranged)


def test_rows_in_order_are_not_shuffled(spark, folder):
    """Source order and sorted files: no exchange but that of run totals."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs.repartitionByRange(5, "doc_id").sortWithinPartitions("doc_id").write.parquet(folder + "/docs")
    for order in ("source", "doc_id"):
        tokens = VOCAB.tokenized(corpus(spark, folder + "/docs", "doc_id", "text", order))
        lengths = tokens.select("pos", "id", "n")
        assert "Exchange hashpartitioning" not in physical_plan(lengths)
        offsets, sorts = shuffled_rows(spark, lambda: token_offsets(lengths))
        assert sorts == 0
        plan = physical_plan(offsets)
        assert plan.count("Exchange") == plan.count("BroadcastExchange") + plan.count("Exchange SinglePartition")
        rows = offsets.orderBy("pos").collect()
        assert [r.id for r in rows] == list(range(200)) and [r.ordinal for r in rows] == list(range(200))
        assert [r.start for r in rows[1:]] == [r.end for r in rows[:-1]]


def test_rows_out_of_order_are_sorted_once(spark):
    df = spark.range(1000).select(F.xxhash64("id").alias("pos"), "id", (F.col("id") % 7).alias("n")).repartition(4)
    offsets, sorts = shuffled_rows(spark, lambda: token_offsets(df))
    assert sorts == 1
    rows = offsets.orderBy("pos").collect()
    assert [r.ordinal for r in rows] == list(range(1000))
    assert [r.start for r in rows[1:]] == [r.end for r in rows[:-1]]


def test_a_filter_cannot_reach_a_check(spark):
    """A pushed filter must not make a check see other rows than it was meant for."""
    df = spark.createDataFrame([(i, f"d{i}", 3) for i in range(9)], "pos bigint, id string, n bigint")
    offsets = token_offsets(df.repartition(3))
    assert [tuple(r) for r in offsets.filter("pos = 4").collect()] == [(4, "d4", 3, 12, 4, 15)]
    assert offsets.filter("id = 'd2' and start = 6").count() == 1


def test_assembly_shuffles_once_and_pushes_the_span(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    corpus = docs.select(F.col("doc_id").alias("pos"), F.col("doc_id").alias("id"), "text")
    tokens = VOCAB.tokenized(corpus)
    manifest = shard_manifest(token_offsets(tokens.select("pos", "id", "n")), 16384)
    plan = physical_plan(shard_tokens(tokens, manifest.filter("shard_id > 5"), VOCAB.codec()))
    assert plan.count("Exchange") == 1
    assert "GreaterThanOrEqual(doc_id" in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
