"""Counts, totals, event reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.catalog.registry import query
from millrace.functions.dates import audit_label
from millrace.functions.money import money
from millrace.operators import aggregates as A
from millrace.plans import event_reports as R
from millrace.sources.tables import Tables


@query("""
    SELECT strftime(o_orderdate, '%Y%m') AS order_month, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_amount
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderstatus IN ('F', 'O') GROUP BY 1
""")
def report_monthly_amounts(t: Tables) -> DataFrame:
    out = R.monthly_line_amounts(t.orders, t.lineitem)
    return out.withColumn("total_amount", F.col("total_amount").cast("double"))


@query("""
    SELECT strftime(ts, '%Y%m') AS event_month, CAST(round(sum(CAST(value AS DECIMAL(18,2))), 2) AS DOUBLE) AS total_refund
    FROM events JOIN orders ON user_id = o_custkey WHERE event_type IN ('purchase', 'signup') GROUP BY 1
""")
def report_monthly_refunds(t: Tables) -> DataFrame:
    out = R.monthly_refunds(
        t.events, t.orders, key="user_id", export_key="o_custkey", status="event_type",
        finished=("purchase", "signup"), ts="ts", amount="value",
    )
    return out.withColumn("total_refund", F.col("total_refund").cast("double"))


@query("SELECT user_id, count(*) AS n FROM events JOIN orders ON user_id = o_custkey GROUP BY 1")
def report_event_counts(t: Tables) -> DataFrame:
    return R.event_counts(t.events, t.orders, "user_id", "o_custkey", "n")


@query("""
    SELECT event_id, user_id, event_type, c_name FROM events JOIN customer ON user_id = c_custkey
""")
def report_matched_events(t: Tables) -> DataFrame:
    from millrace.operators.reconcile import match_events

    ev = t.events.select("event_id", "user_id", "event_type")
    return match_events(ev, t.customer, "user_id", "c_custkey", ["c_name"])


@query("SELECT count(*) AS n FROM events WHERE event_type = 'view' AND value > 20")
def aggregate_count(t: Tables) -> DataFrame:
    return A.row_count(t.events.filter("event_type = 'view' AND value > 20"))


@query("""
    SELECT count(*) AS total, count(*) FILTER (event_type = 'error') AS errors, count(*) FILTER (value > 50) AS large FROM events
""")
def aggregate_conditional(t: Tables) -> DataFrame:
    return A.conditional_counts(t.events, {"errors": F.col("event_type") == "error", "large": F.col("value") > 50})


@query("""
    SELECT strftime(o_orderdate, '%Y-%m-%d') AS audit_date, count(*) AS total,
           count(*) FILTER (o_orderstatus = 'F') AS finished, count(*) FILTER (o_orderstatus = 'O') AS open
    FROM orders GROUP BY 1
""")
def aggregate_conditional_by_date(t: Tables) -> DataFrame:
    label = audit_label(F.year("o_orderdate"), F.month("o_orderdate"), F.dayofmonth("o_orderdate")).alias("audit_date")
    return A.conditional_counts(
        t.orders, {"finished": F.col("o_orderstatus") == "F", "open": F.col("o_orderstatus") == "O"}, by=[label]
    ).orderBy(F.col("audit_date").desc())


@query("SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL")
def aggregate_count_by(t: Tables) -> DataFrame:
    return A.count_by(t.lineitem, ["l_suppkey", "l_returnflag"])


@query("SELECT event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY 1")
def aggregate_value_counts(t: Tables) -> DataFrame:
    return A.value_counts(t.events, "event_type")


@query("""
    SELECT strftime(l_shipdate, '%Y%m') AS month, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_amount
    FROM lineitem GROUP BY 1
""")
def aggregate_monthly_total(t: Tables) -> DataFrame:
    out = A.monthly_total(t.lineitem, "l_shipdate", "l_extendedprice")
    return out.withColumn("total_amount", F.col("total_amount").cast("double"))


@query("""
    WITH per_value AS (
        SELECT l_orderkey, l_returnflag, count(*) AS n, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS price FROM lineitem GROUP BY ALL)
    SELECT l_orderkey, CAST(sum(price) AS DOUBLE) AS price,
           string_agg(l_returnflag || ':' || n, ',' ORDER BY l_returnflag) AS flags
    FROM per_value GROUP BY 1
""")
def aggregate_rollup_values(t: Tables) -> DataFrame:
    out = A.counted_values(t.lineitem, ["l_orderkey"], "l_returnflag", "flags", {"price": money("l_extendedprice")})
    listed = F.transform("flags", lambda e: F.concat(e["l_returnflag"], F.lit(":"), e["n"].cast("string")))
    return out.select("l_orderkey", F.col("price").cast("double").alias("price"), F.array_join(listed, ",").alias("flags"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def aggregate_duplicate_groups(t: Tables) -> DataFrame:
    return A.duplicate_groups(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("""
    SELECT l_orderkey, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM lineitem GROUP BY 1 HAVING round(sum(CAST(l_quantity AS DECIMAL(18,2))), 0) <> 100
""")
def aggregate_share_not_equal(t: Tables) -> DataFrame:
    out = A.share_violations(t.lineitem, ["l_orderkey"], "l_quantity")
    return out.withColumn("total", F.col("total").cast("double"))


@query("""
    SELECT l_orderkey, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM lineitem GROUP BY 1 HAVING round(sum(CAST(l_quantity AS DECIMAL(18,2))), 0) > 100
""")
def aggregate_share_above(t: Tables) -> DataFrame:
    out = A.share_violations(t.lineitem, ["l_orderkey"], "l_quantity", ">")
    return out.withColumn("total", F.col("total").cast("double"))


@query("SELECT quality, toxic, count(*) AS n FROM labels GROUP BY ALL")
def aggregate_crosstab(t: Tables) -> DataFrame:
    return A.crosstab(t.labels, "quality", "toxic")


@query("""
    SELECT quality, count(*) FILTER (toxic = 0) AS "0", count(*) FILTER (toxic = 1) AS "1" FROM labels GROUP BY 1
""")
def aggregate_crosstab_wide(t: Tables) -> DataFrame:
    return A.crosstab(t.labels, "quality", "toxic", [0, 1])


@query("""
    SELECT o_custkey, left(o_orderpriority, 3) AS source, max(o_orderkey) AS o_orderkey,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS o_totalprice
    FROM orders GROUP BY ALL
""")
def aggregate_attribution(t: Tables) -> DataFrame:
    out = A.attribute_amounts(t.orders, ["o_custkey"], "o_orderpriority", "o_totalprice", "o_orderkey", "source")
    return out.withColumn("o_totalprice", F.col("o_totalprice").cast("double"))
