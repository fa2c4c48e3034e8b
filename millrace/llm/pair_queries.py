"""Queries of the operators that compare documents in Python on Arrow batches."""

from __future__ import annotations

from pyspark.sql import DataFrame

from millrace.llm.shared import query
from millrace.llm.token_groups import Similarity, jaccard_groups


@query(
    r"""
    WITH RECURSIVE d AS (
      SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
      FROM documents
    ), sh AS (
      SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' '))
                                          WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s
      FROM d
    ), n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
    common AS (
      SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
    ), link AS (
      SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)
    ), edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
    reach AS (
      SELECT doc_id, doc_id AS r FROM d UNION SELECT reach.doc_id, b FROM reach JOIN edge ON reach.r = edge.a
    )
    SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r) AS component_id
    FROM d JOIN reach ON d.doc_id = reach.doc_id LEFT JOIN n ON d.doc_id = n.doc_id GROUP BY d.doc_id
    """
)
def op10_jaccard_join(t) -> DataFrame:
    return jaccard_groups(t.documents, Similarity(n=3, num=90, den=100))
