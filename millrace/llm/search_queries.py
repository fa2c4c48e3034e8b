"""Queries of the operators on vectors, feature weights and token files, with their SQL forms."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from millrace.llm.hard_negatives import hard_negatives
from millrace.llm.importance import draw
from millrace.llm.shared import query
from millrace.llm.token_files import check_sums, read_tokens, write_tokens
from millrace.llm.token_ids import tokenizer_file
from millrace.session import ensure_checkpoint_dir


@query(
    """
    WITH v AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256.0::DOUBLE * x::DOUBLE)::BIGINT) AS c
      FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
      SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
             list_sum(list_transform(range(1, len(a.c) + 1), lambda i: a.c[i] * b.c[i]))::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
    ), p AS (
      SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
    )
    SELECT p.anchor_id, p.positive_id, row_number() OVER w AS rank, s.id AS negative_id, p.positive_score, s.score AS negative_score
    FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
         AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
    WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id)
    QUALIFY row_number() OVER w <= 10
    """
)
def op11_hard_negatives(t) -> DataFrame:
    return hard_negatives(t.embeddings)


def _crc_of_words(table: str, name: str) -> str:
    """CTEs: distinct words of a table's texts with their counts and buckets; the CRC goes byte by byte through a table made by its rule."""
    cleaned = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"{name}_w AS (SELECT *, {cleaned} AS ws FROM {table})"


@query(
    rf"""
    WITH RECURSIVE step AS (
      SELECT b, b AS c, 0 AS k FROM range(0, 256) r(b)
      UNION ALL
      SELECT b, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM step WHERE k < 8
    ), tab AS MATERIALIZED (SELECT list(c ORDER BY b) AS v FROM step WHERE k = 8),
    {_crc_of_words("documents", "d")}, {_crc_of_words("benchmark", "g")},
    vocabulary AS (SELECT DISTINCT w FROM (SELECT unnest(ws) AS w FROM d_w UNION ALL SELECT unnest(ws) FROM g_w)),
    hexed AS (SELECT w, hex(encode(w)) AS x FROM vocabulary),
    bytes AS (
      SELECT w, list_transform(range(0, length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT) AS bs FROM hexed
    ), crc AS MATERIALIZED (
      SELECT w, xor(list_reduce(list_prepend(4294967295, bs), lambda c, b: xor(c >> 8, v[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
      FROM bytes, tab
    ), d AS MATERIALIZED (
      SELECT doc_id, bucket FROM (SELECT doc_id, unnest(ws) AS w FROM d_w) JOIN crc USING (w)
    ), g AS (SELECT bucket, count(*) AS t FROM (SELECT unnest(ws) AS w FROM g_w) JOIN crc USING (w) GROUP BY bucket),
    s AS (SELECT bucket, count(*) AS s FROM d GROUP BY bucket),
    n AS (SELECT (SELECT coalesce(sum(s), 0) FROM s)::DOUBLE AS s_all, (SELECT coalesce(sum(t), 0) FROM g)::DOUBLE AS t_all),
    gain AS (
      SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * (s_all + 10000) / ((s + 1.0::DOUBLE) * (t_all + 10000))))::BIGINT AS gain
      FROM s LEFT JOIN g USING (bucket), n
    ), w AS (SELECT doc_id, sum(gain)::BIGINT AS weight FROM d JOIN gain USING (bucket) GROUP BY doc_id),
    e AS (
      SELECT doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
             coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id::VARCHAR), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
      FROM d_w LEFT JOIN w USING (doc_id)
    ), r AS (
      SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM e WHERE n_features >= 20
      QUALIFY row_number() OVER (ORDER BY score DESC, doc_id) <= (10 * count(*) OVER ()) // 100
    )
    SELECT e.*, r.rank FROM e LEFT JOIN r USING (doc_id)
    """
)
def op12_importance_draw(t) -> DataFrame:
    return draw(t.documents, t.benchmark)


@query()
def op13_token_files(t) -> DataFrame:
    path = f"{ensure_checkpoint_dir(t.spark)}/millrace-tokens-{uuid.uuid4().hex}"
    write_tokens(t.documents, path, tokenizer_file())
    tokens = read_tokens(t.spark, path)
    return check_sums(tokens).select("doc_id", "start", "n_tokens", "ids_crc32")
