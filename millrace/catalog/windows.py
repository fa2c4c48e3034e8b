"""Window reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.catalog.registry import query
from millrace.functions.money import money
from millrace.operators import windows as W
from millrace.sources.tables import Tables


@query("""
    SELECT event_id, event_type, CAST(min(v) OVER w AS DOUBLE) AS amount_min, CAST(max(v) OVER w AS DOUBLE) AS amount_max,
           CAST(sum(v) OVER w AS DOUBLE) AS amount_sum, CAST(sum(v) OVER w AS DOUBLE) / count(v) OVER w AS amount_avg
    FROM (SELECT *, CAST(value AS DECIMAL(18,2)) AS v FROM events)
    WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")
def window_running_stats(t: Tables) -> DataFrame:
    base = t.events.select("event_id", "event_type", "ts", money("value").alias("amount"))
    out = W.running_stats(base, ["event_type"], ["ts", "event_id"], "amount")
    return out.select(
        "event_id", "event_type", *[F.col(f"amount_{k}").cast("double").alias(f"amount_{k}") for k in ("min", "max", "sum", "avg")]
    )


@query("""
    SELECT event_id, event_type, rank() OVER w AS srank, dense_rank() OVER w AS drank, round(percent_rank() OVER w, 2) AS prank,
           row_number() OVER (PARTITION BY event_type ORDER BY user_id, event_id) AS rn
    FROM events WINDOW w AS (PARTITION BY event_type ORDER BY user_id)
""")
def window_ranks(t: Tables) -> DataFrame:
    base = t.events.select("event_id", "event_type", "user_id")
    return W.rank_columns(base, ["event_type"], ["user_id"], ["event_id"]).drop("user_id")


@query("""
    SELECT event_id, user_id, row_number() OVER w AS occurrence, row_number() OVER w = 1 AS is_first
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""")
def window_occurrences(t: Tables) -> DataFrame:
    return W.mark_occurrences(t.events.select("event_id", "user_id", "ts"), ["user_id"], ["ts", "event_id"]).drop("ts")


@query("""
    SELECT l_orderkey, l_linenumber, l_returnflag, l_partkey FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_returnflag, l_partkey, l_suppkey) AS rn FROM lineitem)
    WHERE rn = 1
""")
def window_pick_first(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_partkey", "l_suppkey")
    return W.pick_first(
        lines, ["l_orderkey", "l_linenumber"], ["l_returnflag", "l_partkey", "l_suppkey"], ["l_returnflag", "l_partkey"]
    )


@query("SELECT event_id, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_type FROM events")
def window_lead(t: Tables) -> DataFrame:
    return W.lead_value(
        t.events.select("event_id", "user_id", "ts", "event_type"), ["user_id"], ["ts", "event_id"], "event_type", "next_type"
    ).select("event_id", "next_type")
