import base64
import inspect
import os
from collections import Counter
from datetime import datetime
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import regex
from pyspark.sql import functions as F

import __spark_entry__ as entry
from shardloom.functions.naming import checkpoint_id, checkpoint_name, parse_checkpoint
from shardloom.functions.tokens import check_ids, pack_u32
from shardloom.functions.vocab import (
    GPT4_PATTERN,
    RankVocab,
    piece_dictionary,
    tokenize,
    top_pieces,
)
from shardloom.operators import rows
from shardloom.operators.checkpoints import latest_checkpoint, read_text_checkpoints
from shardloom.plans.build import build
from shardloom.session import BATCH_BYTES, scratch
from shardloom.sources.objects import list_objects, outcome, pending, read_text_objects
from tests.packing import checksum
from tests.test_jobs import shards_on_disk

MERGES = [b"th", b"he", b"the", b" the", b"in", b"ing", b"\xc3\xa9", b"  ", b"an", b"and", b" and"]
RANKS = {bytes([i]): i for i in range(256)} | {piece: 256 + i for i, piece in enumerate(MERGES)}
EOT = 300
TEXTS = [
    "the thing and the hand", "", "  two  spaces\n\nlines", "<|endoftext|> in the text",
    "café <|endoftext|>", "日本 the 日本", "don't 12345 ſ's",
]


@pytest.fixture(scope="module")
def vocab(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("ranks") / "toy.ranks"
    lines = [f"{base64.b64encode(piece).decode()} {rank}" for piece, rank in RANKS.items()]
    path.write_text("\n".join(lines) + "\n")
    return RankVocab.from_ranks(spark, str(path), GPT4_PATTERN, EOT)


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Byte-pair merging as defined: the neighbours of lowest rank first, until none is left."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not pairs:
            return [ranks[part] for part in parts]
        _, i = min(pairs)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def expected(text, eot=True):
    ids = [EOT] if eot else []
    for piece in regex.findall(GPT4_PATTERN, text):
        ids += merged(piece.encode(), RANKS)
    return ids


@pytest.mark.parametrize("eot", [True, False])
def test_rank_vocabulary_encodes_as_its_table_says(spark, vocab, eot):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "pos bigint, text string")
    got = tokenize(df.withColumn("id", F.col("pos")), vocab, eot).orderBy("pos").collect()
    assert [row.tokens for row in got] == [expected(text, eot) for text in TEXTS]


def test_build_with_a_rank_vocabulary(spark, vocab, folder):
    rows_ = [(f"d{i}", text) for i, text in enumerate(TEXTS * 5)]
    spark.createDataFrame(rows_, "id string, text string").write.parquet(f"{folder}/in")
    stream = [t for text in TEXTS * 5 for t in expected(text)]
    build(spark, f"{folder}/in", f"{folder}/out", vocab, order_by="source", shard_size=37)
    got = [t for shard in shards_on_disk(f"{folder}/out") for t in shard]
    ordered = spark.read.parquet(f"{folder}/in").select("text", "_metadata.file_path", "_metadata.row_index")
    in_order = [r.text for r in sorted(ordered.collect(), key=lambda r: (r.file_path, r.row_index))]
    assert got == [t for text in in_order for t in expected(text)]
    assert len(got) == len(stream)


def test_pieces(spark):
    df = spark.createDataFrame([("a b a",), ("b  b",)], "text string")
    counts = {r.piece: r["count"] for r in piece_dictionary(df, r"\w+|\s+").collect()}
    assert counts == {"a": 2, "b": 3, " ": 2, "  ": 1}
    top = top_pieces(piece_dictionary(df, r"\w+|\s+"), 2).collect()
    assert [r.piece for r in top] == ["b", " "]


def test_id_range(spark):
    good = spark.createDataFrame([([0, 2**32 - 1],), ([],)], "t array<bigint>")
    packed = [bytes(r[0]) for r in good.select(pack_u32(F.col("t"))).collect()]
    assert packed == [b"\0\0\0\0\xff\xff\xff\xff", b""]
    for bad in (2**32, -1):
        df = spark.createDataFrame([([1, bad],)], "t array<bigint>")
        with pytest.raises(Exception, match="32 unsigned bits"):
            df.select(check_ids(F.col("t"))).collect()


def test_checkpoint_names_and_values(spark):
    doc = "<urn:uuid:9b0b7a97>"
    df = spark.createDataFrame([(doc, "7:123"), (doc, "9")], "id string, value string")
    shard, docs = parse_checkpoint(F.col("value"))
    name = checkpoint_name(F.col("id"))
    got = df.select(name, checkpoint_id(name), shard, docs).collect()
    assert [tuple(r) for r in got] == [
        (f"checkpoints/{doc}.txt", doc, 7, 123), (f"checkpoints/{doc}.txt", doc, 9, None),
    ]
    for value in ("x", "7:", "1:2:3", ""):
        bad = spark.createDataFrame([(value,)], "value string")
        with pytest.raises(Exception, match="malformed checkpoint"):
            bad.select(*parse_checkpoint(F.col("value"))).collect()


def test_latest_checkpoint(spark):
    at = datetime(2025, 1, 1)
    schema = "shard_id bigint, doc_id string, docs_consumed bigint, updated timestamp"
    rows_ = [(3, "c", 30, at), (4, "d", 41, at), (9, "z", 99, datetime(2024, 1, 1))]
    assert tuple(latest_checkpoint(spark.createDataFrame(rows_, schema)).first()) == (4, "d", 41)
    assert tuple(latest_checkpoint(spark.createDataFrame([], schema)).first()) == (-1, None, 0)


def test_objects(spark, folder):
    Path(folder, "checkpoints").mkdir()
    Path(folder, "checkpoints", "doc a.txt").write_text("7:123")
    Path(folder, "checkpoints", "b.txt").write_text("8:150")
    Path(folder, "checkpoints", "b.log").write_text("é")
    for stamp, name in enumerate(("b.txt", "doc a.txt")):
        os.utime(f"{folder}/checkpoints/{name}", (1_700_000_000 + stamp,) * 2)
    listed = list_objects(spark, folder, prefix="checkpoints/", suffix=".txt").orderBy("name").collect()
    assert [(r.name, r.length) for r in listed] == [("checkpoints/b.txt", 5), ("checkpoints/doc a.txt", 5)]
    plan = list_objects(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan
    assert {r.value for r in read_text_objects(spark, folder, "").collect()} == {"7:123", "8:150", "é"}
    log = read_text_checkpoints(spark, f"{folder}/checkpoints")
    assert tuple(latest_checkpoint(log).first()) == (7, "doc a", 123)
    assert list_objects(spark, f"{folder}/absent").count() == 0


def test_pending_and_outcome(spark):
    plan = spark.createDataFrame([("a", 1), ("b", 2)], "file_name string, shard_id int")
    done = spark.createDataFrame([("a", "published", None)], "file_name string, status string, error string")
    assert [r.file_name for r in pending(plan, done).collect()] == ["b"]
    assert [tuple(r) for r in outcome(plan, done).collect()] == [("a", 1, "published", None)]


def test_rows(spark):
    data = [(10 * i, f"d{i}", f"text {i}") for i in range(20)]
    df = spark.createDataFrame(data, "pos bigint, id string, text string").repartition(3)

    def ids(frame):
        return [r.id for r in frame.orderBy("pos").collect()]

    everything = [f"d{i}" for i in range(20)]
    assert ids(rows.skip(df, 0)) == everything
    assert ids(rows.skip(df, 7)) == everything[7:]
    assert ids(rows.skip(df, 20)) == ids(rows.skip(df, 99)) == []
    assert ids(rows.take(df, 3)) == everything[:3]
    assert ids(rows.seek_after(df, "d4")) == everything[5:]
    assert rows.seek_report(df, "d4").first().skipped == 4
    with pytest.raises(ValueError, match="no document"):
        rows.seek_after(df, "absent")
    assert ids(rows.filter_contains(df, "t 1")) == ["d1"] + everything[10:]
    assert ids(rows.filter_rows(df, F.length("id") == 2)) == everything[:10]
    numbers = rows.numbered(df).orderBy("pos").collect()
    assert [r.ordinal for r in numbers] == list(range(20))
    assert rows.count_items(df).first().items == 20


def test_scratch_is_where_the_session_says(spark):
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base:
        assert scratch(spark, "x").startswith(base)


@pytest.mark.parametrize("bits,keys", [
    (3, range(0, 150, 3)), (16, [-(2**63), -5, 0, 9, 10, 2**40, 2**40 + 1, 2**63 - 1]), (16, [7]),
])
def test_skip_and_take_by_counting_buckets(spark, monkeypatch, bits, keys):
    monkeypatch.setattr(rows, "BUCKET_BITS", bits)
    df = spark.createDataFrame([(k,) for k in keys], "pos bigint").coalesce(2)
    for n in (1, len(keys) - 1, len(keys)):
        assert sorted(r.pos for r in rows.skip(df, n).collect()) == list(keys)[n:]
        assert sorted(r.pos for r in rows.take(df, n).collect()) == list(keys)[:n]
    none = spark.createDataFrame([], "pos bigint")
    assert rows.skip(none, 1).count() == rows.take(none, 1).count() == 0


def test_published_patterns():
    from tiktoken_ext import openai_public

    from shardloom.functions.vocab import GPT2_PATTERN

    assert openai_public.r50k_pat_str == GPT2_PATTERN
    assert f'"""{GPT4_PATTERN}"""' in inspect.getsource(openai_public.cl100k_base)


def test_observed_counts(spark):
    from shardloom.operators.packing import observed

    df = spark.createDataFrame([(1, 5), (2, 7)], "pos bigint, n bigint")
    watched, counts = observed(df)
    watched.collect()
    assert counts.get == {"documents": 2, "tokens": 12}


SF_DIR = "/root/testdata/sf0.001"


def test_rank_vocab_query_equals_brute_force(spark):
    texts = pq.read_table(f"{SF_DIR}/documents.parquet").sort_by("doc_id")["text"].to_pylist()
    pairs = Counter(pair for text in texts for pair in regex.findall("[a-z][a-z]", text))
    best = sorted(pairs.items(), key=lambda item: (-item[1], item[0]))[: entry.PAIRS]
    ranks = {bytes([i]): i for i in range(256)}
    ranks |= {pair.encode(): 256 + i for i, (pair, _) in enumerate(best)}
    known: dict[str, list[int]] = {}
    stream = []
    for text in texts:
        stream.append(entry.GPT2_EOT)
        for piece in regex.findall(entry.PIECES, text):
            if piece not in known:
                known[piece] = merged(piece.encode(), ranks)
            stream += known[piece]
    shards = [stream[i : i + entry.SHARD_SIZE] for i in range(0, len(stream), entry.SHARD_SIZE)]
    rows_ = entry.queries()["rank_vocab_manifest"](spark, SF_DIR).orderBy("shard_id").collect()
    assert [(r.n_tokens, r.token_sum, r.checksum) for r in rows_] == [
        (len(s), sum(s), checksum(s)) for s in shards
    ]


def test_object_listing_query_equals_the_folder(spark):
    rows_ = entry.queries()["object_listing"](spark, SF_DIR).collect()
    assert [(r.name, r.length) for r in rows_] == [
        ("documents.parquet", os.path.getsize(f"{SF_DIR}/documents.parquet"))
    ]


def test_python_gets_batches_of_bounded_bytes(spark):
    @F.arrow_udf("bigint")
    def held(column: pa.Array) -> pa.Array:
        return pa.array([column.nbytes] * len(column), pa.int64())

    texts = spark.range(0, 6000, 1, 1).select(held(F.repeat(F.lit("x"), 4096)).alias("n"))
    assert texts.agg(F.max("n")).first()[0] <= 2 * BATCH_BYTES
