"""DuckDB oracles of the phrase, similarity-join and vector queries."""

from __future__ import annotations

PARTS, ENTRIES, ROUNDS = 16, 64, 2

COLLOCATIONS = r"""
    WITH pieces AS (
      SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[.,;:!?\x0A-\x0D]')) AS piece
      FROM documents),
    w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
    spans AS (
      SELECT lang, w, i, unnest(generate_series(1, least(5, len(w) - i + 1))) AS size
      FROM (SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM w)),
    f AS (
      SELECT lang, p, len(p) AS size, count(*) AS f
      FROM (SELECT lang, list_slice(w, i, i + size - 1) AS p FROM spans) GROUP BY lang, p),
    n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
    c AS (SELECT lang, p, size, f AS a FROM f WHERE size > 1 AND f >= 100),
    k AS (SELECT *, unnest(generate_series(1, size - 1)) AS k FROM c),
    cuts AS (
      SELECT k.lang, k.p, k.size, a, n, k, l.f AS l, r.f AS r,
             CAST((1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
      FROM k JOIN n USING (lang)
      JOIN f l ON l.lang = k.lang AND l.p = list_slice(k.p, 1, k)
      JOIN f r ON r.lang = k.lang AND r.p = list_slice(k.p, k + 1, k.size)),
    best AS (
      SELECT lang, p, any_value(a) AS a, any_value(n) AS n, min({score: score, k: k, l: l, r: r}) AS b
      FROM cuts GROUP BY lang, p),
    inside AS (
      SELECT DISTINCT s.lang, s.p
      FROM (SELECT lang, a, list_slice(p, i, i + m - 1) AS p
            FROM (SELECT lang, a, p, size, m, unnest(generate_series(1, size - m + 1)) AS i
                  FROM (SELECT *, unnest(generate_series(2, size - 1)) AS m FROM c WHERE size > 2))) s
      JOIN c ON c.lang = s.lang AND c.p = s.p WHERE 100 * s.a >= 100 * c.a),
    ranked AS (
      SELECT lang, array_to_string(p, ' ') AS phrase, a, b.l AS l, b.r AS r, n, b.score AS score
      FROM best ANTI JOIN inside USING (lang, p)),
    numbered AS (
      SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM ranked)
    SELECT lang, rank, phrase, a, l, r, n, score FROM numbered WHERE rank <= 2000"""


def _books(round_: int) -> str:
    """Codebook ``b{round_}(part, entry, value)`` and the assignment ``a{round_}`` by it."""
    start = f"""
    b0 AS (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, value
           FROM points WHERE vec_id IN (SELECT vec_id FROM whole ORDER BY vec_id LIMIT {ENTRIES}))"""
    last = round_ - 1
    mean = f"""
    m{round_} AS (
      SELECT part, entry, list(m ORDER BY i) AS value
      FROM (SELECT part, entry, i, (s - ((s % c) + c) % c) // c AS m
            FROM (SELECT part, entry, i, sum(x) AS s, count(*) AS c
                  FROM (SELECT a.part, a.entry, unnest(generate_series(1, len(a.value))) AS i,
                               unnest(a.value) AS x FROM a{last} a)
                  GROUP BY part, entry, i))
      GROUP BY part, entry),
    b{round_} AS (
      SELECT o.part, o.entry, coalesce(m.value, o.value) AS value
      FROM b{last} o LEFT JOIN m{round_} m ON m.part = o.part AND m.entry = o.entry)"""
    return (mean if round_ else start) + f""",
    a{round_} AS (
      SELECT vec_id, part, value, best.entry AS entry, best.d AS d
      FROM (SELECT vec_id, part, any_value(value) AS value, min({{'d': d, 'entry': entry}}) AS best
            FROM (SELECT p.vec_id, p.part, p.value, b.entry,
                         CAST(list_sum(list_transform(generate_series(1, len(p.value)),
                           lambda i: (p.value[i] - b.value[i]) * (p.value[i] - b.value[i]))) AS BIGINT) AS d
                  FROM points p JOIN b{round_} b ON b.part = p.part)
            GROUP BY vec_id, part))"""


VECTOR_CODES = f"""
    WITH whole AS (
      SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings
      WHERE embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    points AS (
      SELECT vec_id, p AS part, list_slice(v, p * len(v) // {PARTS} + 1, (p + 1) * len(v) // {PARTS}) AS value
      FROM (SELECT vec_id, v, unnest(generate_series(0, {PARTS - 1})) AS p FROM whole)),
    {",".join(_books(k) for k in range(ROUNDS + 1))},
    coded AS (
      SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
      FROM a{ROUNDS} GROUP BY vec_id),
    books AS (
      SELECT sha256(string_agg(x, ',' ORDER BY part, entry, i)) AS codebooks_sha256
      FROM (SELECT part, entry, unnest(generate_series(1, len(value))) AS i,
                   CAST(unnest(value) AS VARCHAR) AS x FROM b{ROUNDS}))
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
           codebooks_sha256
    FROM coded JOIN whole USING (vec_id) CROSS JOIN books"""

NGRAM_JOIN = r"""
    WITH RECURSIVE d AS (
      SELECT doc_id, regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x20\x09-\x0D]+') AS w
      FROM documents),
    s AS (
      SELECT DISTINCT doc_id, list_slice(w, i, i + 3) AS g
      FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 3, 1))) AS i FROM d WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    c AS (
      SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
      FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    e AS (
      SELECT x, y FROM c JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
      WHERE 100 * common >= 85 * (a.n + b.n - common)),
    reach AS (
      SELECT doc_id AS x, doc_id AS y FROM d
      UNION SELECT reach.x, e.y FROM reach JOIN e ON e.x = reach.y)
    SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.component_id
    FROM d LEFT JOIN n USING (doc_id)
    JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) r USING (doc_id)"""
