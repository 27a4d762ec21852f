"""The subpackage's registered queries and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from shardloom.llm import (
    chat,
    decontaminate,
    html,
    language,
    mixing,
    near_dedup,
    ngram_join,
    phrases,
    quality,
    repeats,
    sharding,
    sql,
    token_counts,
    vector_codes,
)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    found = repeats.without_repeats(docs)
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept_bytes", 256).alias("kept_sha256"),
    )


def op2_chat_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.swapped_answers(_read(spark, sf_dir, "conversations"))

    def runs(mask: str):
        parts = F.transform(
            mask, lambda r: F.concat(r["trained"].cast("int").cast("string"), F.lit("x"), r["n_chars"].cast("string"))
        )
        return F.array_join(parts, " ").alias(mask)

    return chat.examples(turns).select(
        F.col("pair_id").alias("conv_id"), "prompt_turns", "prompt", "chosen", runs("chosen_mask"),
        "rejected", runs("rejected_mask"),
    )


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_documents(spark, sf_dir), _read(spark, sf_dir, "benchmark"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    counted = token_counts.count_tokens(docs, token_counts.load(spark))
    return counted.select("doc_id", "n_pretokens", "n_tokens")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(_documents(spark, sf_dir).select("doc_id", "text"))
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages")
    return html.extract(pages, html.train(pages)).select("page_id", "url", "text", "n_chars")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    found = language.identify(docs.select("doc_id", "text"), language.train(docs))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_documents(spark, sf_dir).select("doc_id", "text"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_documents(spark, sf_dir).select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    rows = quality.ledger(docs)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality.passes(quality.BASE)).alias("base_failed"),
        quality.passes(quality.POLICY).alias("kept"),
        "fail_bits",
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.best_collocations(_documents(spark, sf_dir).select("doc_id", "text", "lang"))


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(_documents(spark, sf_dir).select("doc_id", "text"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _read(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    coded, books = vector_codes.compress(vectors)
    return coded.select(
        F.col("id").alias("vec_id"), "code", "error", "label_error",
        F.lit(vector_codes.digest(books)).alias("codebooks_sha256"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (
        op1_suffix_dedup, op2_chat_preferences, op3_decontaminate, op4_token_counts, op5_sharding,
        op6_html_text, op7_language, op8_near_dedup, op9_mixing, op10_quality_rules,
        op11_collocations, op12_ngram_join, op13_vector_codes, pipeline,
    )
    return {query.__name__: query for query in named}


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_QUALITY = rf"""
    WITH d AS (
      SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
    numbered AS (SELECT row_number() OVER () AS r, * FROM d),
    windows AS (
      SELECT r, i, list_slice(w, i, i + 7) AS g
      FROM (SELECT r, w, unnest(generate_series(1, len(w) - 7)) AS i FROM numbered WHERE len(w) >= 8)),
    repeated AS (
      SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1),
    covered AS (
      SELECT r, count(DISTINCT p) AS n_repeat_words
      FROM (SELECT r, unnest(generate_series(i, i + 7)) AS p FROM repeated) GROUP BY r),
    lines AS (
      SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines
      FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM numbered)
      WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
    m AS (
      SELECT doc_id, len(w) AS n_words,
             CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             coalesce(n_dup_lines, 0) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words,
             coalesce(n_lines, 0) AS n_lines,
             len(list_filter(w, lambda x: regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]')))
               AS n_upper_words,
             len(list_filter(generate_series(2, len(w)), lambda i: w[i] = w[i - 1])) AS n_echo_words
      FROM numbered LEFT JOIN covered USING (r) LEFT JOIN lines USING (r)),
    f AS (
      SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
             CAST((n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT
               + 4 * (10 * n_symbols > n_words)::INT + 8 * (2 * n_dup_lines > n_lines)::INT
               + 16 * (2 * n_upper_words > n_words)::INT + 32 * (5 * n_echo_words > 2 * n_words)::INT
               + 64 * (word_chars < 2 * n_words OR word_chars > 15 * n_words)::INT AS BIGINT) AS fail_bits
      FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           fail_bits = 0 AS kept, fail_bits FROM f"""

_NEAR = rf"""
    WITH RECURSIVE d AS (
      SELECT doc_id, {_WORDS.replace("coalesce(text, '')", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
      FROM documents),
    s AS (
      SELECT DISTINCT doc_id, g FROM (
        SELECT doc_id, list_slice(w, i, i + 4) AS g
        FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i
              FROM d WHERE len(w) > 0))),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    c AS (
      SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
      FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    e AS (
      SELECT x, y FROM c JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
      WHERE 100 * common >= 75 * (a.n + b.n - common)),
    reach AS (
      SELECT doc_id AS x, doc_id AS y FROM d
      UNION SELECT reach.x, e.y FROM reach JOIN e ON e.x = reach.y)
    SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.component_id, d.doc_id = r.component_id AS kept
    FROM d LEFT JOIN n USING (doc_id)
    JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) r USING (doc_id)"""

_CHAT = """
    WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
    last AS (SELECT conv_id, max({turn: turn, role: role, text: text}) AS l FROM t GROUP BY conv_id),
    sides AS (
      SELECT conv_id, TRUE AS chosen, turn, role, text FROM t
      UNION ALL SELECT t.conv_id, FALSE, t.turn, t.role, t.text
      FROM t JOIN last USING (conv_id) WHERE t.turn < l.turn
      UNION ALL SELECT a.conv_id, FALSE, a.l.turn, a.l.role, b.l.text
      FROM last a JOIN last b ON b.conv_id = a.conv_id + 1),
    laid AS (
      SELECT conv_id, turn, role, text, bool_or(chosen) AS c, bool_or(NOT chosen) AS r
      FROM sides GROUP BY ALL),
    cuts AS (SELECT conv_id, min(turn) AS cut FROM laid WHERE NOT (c AND r) GROUP BY conv_id),
    parts AS (
      SELECT conv_id, turn, role, text, c, r, cut IS NULL OR turn < cut AS p,
             '<|' || role || '|>' || chr(10) AS head, text || '<|end|>' || chr(10) AS body
      FROM laid LEFT JOIN cuts USING (conv_id)),
    lines AS (
      SELECT *, head || body AS line,
             '0x' || length(head) || ' ' || (role = 'assistant')::INT || 'x' || length(body) AS runs
      FROM parts)
    SELECT conv_id, count(*) FILTER (p) AS prompt_turns,
           coalesce(string_agg(line, '' ORDER BY turn, role, text) FILTER (p), '') AS prompt,
           coalesce(string_agg(line, '' ORDER BY turn, role, text) FILTER (NOT p AND c), '') AS chosen,
           coalesce(string_agg(runs, ' ' ORDER BY turn, role, text) FILTER (NOT p AND c), '') AS chosen_mask,
           coalesce(string_agg(line, '' ORDER BY turn, role, text) FILTER (NOT p AND r), '') AS rejected,
           coalesce(string_agg(runs, ' ' ORDER BY turn, role, text) FILTER (NOT p AND r), '') AS rejected_mask
    FROM lines GROUP BY conv_id"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_chat_preferences": _CHAT,
        "op8_near_dedup": _NEAR,
        "op10_quality_rules": _QUALITY,
        "op11_collocations": sql.COLLOCATIONS,
        "op12_ngram_join": sql.NGRAM_JOIN,
        "op13_vector_codes": sql.VECTOR_CODES,
    }
