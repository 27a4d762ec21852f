"""Token shards from text corpora, as Spark jobs."""
