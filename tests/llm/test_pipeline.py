"""The corpus pipeline, stage by stage, against what each stage promises."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from shardloom.llm import near_dedup, quality

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    items = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.collect()
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == columns
        after = Counter(docs.collect())
        assert set(after) <= set(before)
        if name == "quality rules":
            assert quality.ledger(docs).filter(~quality.passes(quality.POLICY)).count() == 0
        if name == "near duplicates":
            assert near_dedup.near_duplicates(docs).filter("not kept").count() == 0
        if name == "benchmark decontamination":
            leaked = {r for r in before if any(t in r.text for t in items)}
            assert leaked and not leaked & set(after)
        if name == "mixing":
            assert max(after.values()) <= 3
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert last.count() == docs.count()
    whole = corpus_pipeline.run(spark, SF_DIR)
    key = ["doc_id", "shard", "slot"]
    assert sorted(map(tuple, whole.select(key).collect())) == sorted(map(tuple, last.select(key).collect()))
