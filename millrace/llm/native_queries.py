"""Queries of the operators made of DataFrame functions alone, with their SQL forms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.chunk_dedup import duplicates
from millrace.llm.host_rules import host_verdicts, with_counts, with_failures
from millrace.llm.personal_data import find_personal_data, spans_text
from millrace.llm.shared import query
from millrace.llm.source_mix import mix

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"


@query(
    """
    WITH d AS (
      SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
      FROM documents
    )
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
    FROM d WINDOW g AS (PARTITION BY t)
    """
)
def op5_exact_dedup(t) -> DataFrame:
    found = duplicates(t.documents.select("doc_id", "text"), with_text=False)
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query(
    rf"""
    WITH d AS (
      SELECT doc_id, source, len({_WORDS}) AS size,
             ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 12))::BIGINT AS u
      FROM documents
    ), s AS (
      SELECT source, sum(size)::BIGINT AS source_size,
             row_number() OVER (ORDER BY source NULLS LAST) AS place,
             [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1]::DOUBLE AS w
      FROM d GROUP BY source
    ), k AS (
      SELECT *, 3.0::DOUBLE * source_size AS cap,
             coalesce(sum(3.0::DOUBLE * source_size) OVER (ORDER BY 3.0::DOUBLE * source_size / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
             sum(w) OVER (ORDER BY 3.0::DOUBLE * source_size / w, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_w,
             sum(source_size) OVER () AS total
      FROM s
    ), r AS (
      SELECT arg_min((total - capped) / open_w, (cap / w, place)) FILTER (WHERE cap / w >= (total - capped) / open_w) AS rate FROM k
    ),
    t AS (
      SELECT source, source_size, least(cap, rate * w) AS target FROM k, r
    ), l AS (
      SELECT source, CASE WHEN size >= 20 THEN 2.0 ELSE 1.0 END::DOUBLE AS wt, sum(size)::BIGINT AS words FROM d GROUP BY ALL
    ), c AS (
      SELECT l.*, t.source_size, t.target,
             (target - 3.0::DOUBLE * coalesce(sum(words) OVER (PARTITION BY l.source ORDER BY wt DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / nullif(sum(wt * words) OVER (PARTITION BY l.source ORDER BY wt DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS c
      FROM l JOIN t ON l.source IS NOT DISTINCT FROM t.source
    ), f AS (
      SELECT source, max(wt) AS top, arg_max(coalesce(c, 0), wt) AS rate FROM c WHERE coalesce(c, 0) * wt <= 3 GROUP BY source
    ), x AS (
      SELECT c.*, least(CASE WHEN f.top IS NULL OR wt > f.top THEN 3.0::DOUBLE ELSE f.rate * wt END, 3.0::DOUBLE) AS e
      FROM c LEFT JOIN f ON c.source IS NOT DISTINCT FROM f.source
    ), p AS (
      SELECT *, floor(e)::INT AS whole, e - floor(e) AS chance,
             target - sum(floor(e) * words) OVER (PARTITION BY source) AS need
      FROM x
    ), q AS (
      SELECT d.*, p.source_size, p.target, p.whole, p.need,
             CASE WHEN chance > 0 THEN ((u + 0.5::DOUBLE) / 281474976710656.0::DOUBLE) / (1.0::DOUBLE - (u + 0.5::DOUBLE) / 281474976710656.0::DOUBLE)
                                       / (chance / (1.0::DOUBLE - chance)) END AS rank
      FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source AND p.wt = CASE WHEN size >= 20 THEN 2.0 ELSE 1.0 END
    ), o AS (
      SELECT source, need, rank, sum(size) OVER (PARTITION BY source ORDER BY rank RANGE UNBOUNDED PRECEDING) AS upto FROM q WHERE rank IS NOT NULL
    ), b AS (
      SELECT source, arg_min(rank, (abs(need - upto), rank)) AS cut, min(abs(need - upto)) AS miss FROM o GROUP BY source
    )
    SELECT doc_id, size, q.source_size, target,
           (size * (whole + CASE WHEN q.need > 0 AND b.miss < q.need AND rank <= cut THEN 1 ELSE 0 END))::BIGINT AS taken
    FROM q LEFT JOIN b ON q.source IS NOT DISTINCT FROM b.source
    """
)
def op6_source_mix(t) -> DataFrame:
    mixed = mix(t.documents.select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"))


@query(
    rf"""
    WITH d AS (
      SELECT doc_id, source, coalesce(text, '') AS t, {_WORDS} AS ws FROM documents
    ), win AS (
      SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS k
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM d)
    ), dup AS (
      SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1
    ), rep AS (
      SELECT doc_id, count(DISTINCT i + o) AS n FROM dup, range(0, 8) x(o) GROUP BY doc_id
    ), lines AS (
      SELECT doc_id, len(l) - len(list_distinct(l)) AS n
      FROM (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d)
    ), m AS (
      SELECT d.doc_id, source, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')))::BIGINT AS n_symbols,
             lines.n::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
      FROM d JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id)
    ), f AS (
      SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
             n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 100 * n_symbols > 10 * word_chars
             OR 100 * n_dup_lines > 30 * n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words AS rule_failed
      FROM m
    ), h AS (SELECT source, count(*) AS n, count(*) FILTER (rule_failed) AS bad FROM f GROUP BY source),
    p AS (SELECT avg(bad / n) AS m, var_pop(bad / n) AS v FROM h),
    s AS (SELECT m, CASE WHEN v > 0 THEN least(greatest(m * (1 - m) / v - 1, 1), 1000) ELSE 1000 END AS k FROM p),
    g AS (SELECT source, (bad + m * k) / (n + k) > 0.5 AS host_rejected FROM h, s)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND NOT (host_rejected AND rule_failed) AS kept
    FROM f JOIN g ON f.source IS NOT DISTINCT FROM g.source
    """
)
def op7_quality_rules(t) -> DataFrame:
    counted = with_counts(t.documents.select("doc_id", "text", "source")).drop("text")
    kept = host_verdicts(with_failures(counted), "source")
    return kept.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query()
def op8_personal_data(t) -> DataFrame:
    found = find_personal_data(t.documents.select("doc_id", "text")).drop("text")
    base = F.filter("found", lambda s: s["base"])
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in ("email", "ip", "card", "phone")],
        F.sha2(spans_text(base), 256).alias("base_sha256"),
        spans_text(F.col("found")).alias("spans"),
    )
