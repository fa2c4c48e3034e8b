"""Readers and writers applied to the shared tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.catalog.registry import query
from millrace.functions.text import Field, fixed_record, slice_record
from millrace.operators.aggregates import row_count
from millrace.sources.files import corrupt_counts, parse_json, quarantine, split_escaped
from millrace.sources.tables import Tables

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages",
          "conversations", "labels", "benchmark", "embeddings")


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in TABLES))
def source_parquet_tables(t: Tables) -> DataFrame:
    return reduce(
        DataFrame.unionByName,
        [row_count(getattr(t, name)).select(F.lit(name).alias("table_name"), "n") for name in TABLES],
    )


@query("SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def source_json_column(t: Tables) -> DataFrame:
    return parse_json(t.events, "props", "k BIGINT").select("event_id", "event_type", F.col("message.k").alias("k"))


def _broken_props(t: Tables) -> DataFrame:
    cut = F.when(F.col("event_id") % 7 == 0, F.expr("left(props, length(props) - 1)")).otherwise(F.col("props"))
    return parse_json(t.events.select("event_id", "event_type", cut.alias("props")), "props", "k BIGINT")


@query("""
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS corrupt_text
    FROM events WHERE event_id % 7 <> 0
    UNION ALL
    SELECT event_id, NULL, left(props, length(props) - 1) FROM events WHERE event_id % 7 = 0
""")
def source_json_quarantine(t: Tables) -> DataFrame:
    good, bad = quarantine(_broken_props(t))
    return good.select("event_id", F.col("message.k").alias("k"), F.lit(None).cast("string").alias("corrupt_text")).unionByName(
        bad.select("event_id", F.lit(None).cast("bigint").alias("k"), F.col("_corrupt_record").alias("corrupt_text"))
    )


@query("""
    SELECT count(*) AS messages, CAST(count(*) FILTER (event_id % 7 <> 0) AS BIGINT) AS good,
           CAST(count(*) FILTER (event_id % 7 = 0) AS BIGINT) AS corrupt FROM events
""")
def source_corrupt_counts(t: Tables) -> DataFrame:
    return corrupt_counts(_broken_props(t))


@query("""
    SELECT CAST(p_partkey AS VARCHAR) AS f1, p_name || '|' || p_brand AS f2, '\\' || p_type AS f3,
           CAST(p_size AS VARCHAR) AS f4, 4 AS n_fields
    FROM part
""")
def source_escaped_delimiter(t: Tables) -> DataFrame:
    line = F.concat(
        F.col("p_partkey").cast("string"), F.lit("|"), F.col("p_name"), F.lit("\\|"), F.col("p_brand"), F.lit("|"),
        F.lit("\\\\"), F.col("p_type"), F.lit("|"), F.col("p_size").cast("string"),
    )
    f = t.part.select(split_escaped(line).alias("f"))
    return f.select(*[F.get("f", F.lit(i)).alias(f"f{i + 1}") for i in range(4)], F.size("f").alias("n_fields"))


RECORD = [
    Field("c_custkey", 10, "right", "0"),
    Field("c_name", 12, "left", "-"),
    Field("c_mktsegment", 8, "left", " "),
    Field("c_nationkey", 3, "right", " "),
]


@query("""
    SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') || rpad(c_name, 12, '-') || rpad(c_mktsegment, 8, ' ')
           || lpad(CAST(c_nationkey AS VARCHAR), 3, ' ') AS record
    FROM customer
""")
def sink_fixed_record(t: Tables) -> DataFrame:
    return t.customer.select(fixed_record(RECORD).alias("record"))


@query("""
    SELECT c_custkey, rtrim(rpad(c_name, 12, '-'), '-') AS name, rtrim(rpad(c_mktsegment, 8, ' ')) AS segment,
           c_nationkey AS nationkey
    FROM customer
""")
def source_fixed_width_slices(t: Tables) -> DataFrame:
    records = t.customer.select(fixed_record(RECORD).alias("record"))
    cut = records.select(*slice_record("record", [f.width for f in RECORD], ["k", "name", "segment", "n"]))
    return cut.select(
        F.col("k").try_cast("bigint").alias("c_custkey"),
        F.rtrim("name", F.lit("-")).alias("name"),
        F.rtrim("segment").alias("segment"),
        F.trim("n").try_cast("int").alias("nationkey"),
    )


@query("SELECT page_id, url, length(html) AS html_length FROM pages")
def source_pages(t: Tables) -> DataFrame:
    return t.pages.select("page_id", "url", F.length("html").cast("bigint").alias("html_length"))
