"""``python -m shardloom SRC DST``: publish a corpus as token shards; ``--continue`` resumes."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from shardloom.functions import vocab as vocabularies
from shardloom.functions.naming import ThreeWay, TwoWay
from shardloom.operators.packing import SHARD_SIZE, progress
from shardloom.plans.build import OVERWRITE, SKIP_EXISTING, build
from shardloom.sources.corpus import SOURCE_ORDER

PATTERNS = {
    "gpt2": (vocabularies.GPT2_PATTERN, vocabularies.GPT2_EOT),
    "gpt-4": (vocabularies.GPT4_PATTERN, vocabularies.GPT4_EOT),
}


def main() -> None:
    parser = argparse.ArgumentParser(prog="shardloom", description=__doc__)
    parser.add_argument("src", help="Parquet file, folder or glob")
    parser.add_argument("dst", help="folder or URL the shards go to")
    parser.add_argument("--continue", dest="resume", action="store_true", help="resume a stopped run")
    parser.add_argument("--ranks", help="rank file of the vocabulary; bytes when not given")
    parser.add_argument("--pattern", choices=PATTERNS, default="gpt-4", help="pre-split of --ranks")
    parser.add_argument("--id-col", default="id")
    parser.add_argument("--text-col", default="text")
    parser.add_argument("--order-by", nargs="+", default=SOURCE_ORDER)
    parser.add_argument("--shard-size", type=int, default=SHARD_SIZE)
    parser.add_argument("--two-way", action="store_true", help="first shard val, the rest train")
    parser.add_argument("--no-eot", action="store_true", help="no end-of-text before documents")
    parser.add_argument("--overwrite", action="store_true", help="replace files already there")
    args = parser.parse_args()

    spark = SparkSession.builder.appName("shardloom").getOrCreate()
    vocab = None
    if args.ranks:
        vocab = vocabularies.RankVocab.from_ranks(spark, args.ranks, *PATTERNS[args.pattern])
    manifest = build(
        spark, args.src, args.dst, vocab,
        id_col=args.id_col, text_col=args.text_col, order_by=args.order_by,
        eot=not args.no_eot, shard_size=args.shard_size,
        layout=TwoWay() if args.two_way else ThreeWay(),
        mode=OVERWRITE if args.overwrite else SKIP_EXISTING, resume=args.resume,
    )
    progress(manifest, args.shard_size).show()


if __name__ == "__main__":
    main()
