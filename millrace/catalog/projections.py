"""Projections, filters, set operations, sorting."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.catalog.registry import query
from millrace.functions.dates import stamp
from millrace.operators.project import any_differs, distinct_of, first_match, first_rows, select_as, union_padded, with_columns
from millrace.sources.tables import Tables


@query("SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderpriority AS priority FROM orders")
def project_rename(t: Tables) -> DataFrame:
    return select_as(t.orders, {"order_id": "o_orderkey", "customer_id": "o_custkey", "priority": "o_orderpriority"})


@query("""
    SELECT n_nationkey, n_name, n_regionkey, n_nationkey * 10 + n_regionkey AS code,
           coalesce(nullif(n_regionkey, 0), -1) AS region_or_default
    FROM nation
""")
def project_derived(t: Tables) -> DataFrame:
    return with_columns(
        t.nation,
        code=F.col("n_nationkey") * 10 + F.col("n_regionkey"),
        region_or_default=F.coalesce(F.nullif(F.col("n_regionkey"), F.lit(0)), F.lit(-1)),
    )


@query("""
    SELECT l.* EXCLUDE (l_shipdate), CAST(l_shipdate AS DATE) AS ship_date
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
""")
def project_one_join_side(t: Tables) -> DataFrame:
    lines, orders = t.lineitem, t.orders
    joined = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(lines["*"])
    return joined.withColumn("ship_date", F.col("l_shipdate").cast("date")).drop("l_shipdate")


@query("SELECT DISTINCT event_type, CAST(ts AS DATE) AS event_day FROM events")
def project_distinct(t: Tables) -> DataFrame:
    return distinct_of(t.events, "event_type", F.col("ts").cast("date").alias("event_day"))


@query("SELECT s_suppkey, s_name, TIMESTAMP '2024-02-01 03:04:05' AS dw_load_ts FROM supplier")
def project_stamped(t: Tables) -> DataFrame:
    out = stamp(t.supplier.select("s_suppkey", "s_name"), dt.datetime(2024, 2, 1, 3, 4, 5))
    return out.withColumn("dw_load_ts", F.col("dw_load_ts").cast("timestamp_ntz"))


@query("SELECT event_id, user_id FROM events WHERE event_type = 'purchase' AND props <> '{\"k\": 1}'")
def filter_sql_text(t: Tables) -> DataFrame:
    return t.events.filter("event_type = 'purchase' AND props <> '{\"k\": 1}'").select("event_id", "user_id")


@query("SELECT event_id, user_id FROM events WHERE event_type = 'click' AND user_id = 7")
def filter_columns(t: Tables) -> DataFrame:
    return t.events.filter((F.col("event_type") == "click") & (F.col("user_id") == 7)).select("event_id", "user_id")


@query("SELECT event_id, value FROM events WHERE value > 70")
def filter_threshold(t: Tables) -> DataFrame:
    return t.events.filter(F.col("value") > 70).select("event_id", "value")


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def filter_in_list(t: Tables) -> DataFrame:
    return t.orders.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey", "o_orderpriority")


@query("SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'red%'")
def filter_like_prefix(t: Tables) -> DataFrame:
    return t.part.filter(F.col("p_name").like("red%")).select("p_partkey", "p_name")


@query("""
    SELECT o_orderkey, o_orderstatus FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem) ON o_orderkey = l_orderkey
    WHERE l_orderkey IS NULL
""")
def filter_null(t: Tables) -> DataFrame:
    filled = t.lineitem.select("l_orderkey").distinct()
    joined = t.orders.join(filled, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.filter(F.col("l_orderkey").isNull()).select("o_orderkey", "o_orderstatus")


@query("""
    SELECT p_partkey FROM part
    WHERE nullif(p_size, 11) IS DISTINCT FROM p_size OR nullif(p_type, 'SMALL') IS DISTINCT FROM p_type
""")
def filter_any_differs(t: Tables) -> DataFrame:
    size, kind = F.nullif(F.col("p_size"), F.lit(11)), F.nullif(F.col("p_type"), F.lit("SMALL"))
    return t.part.filter(any_differs([(size, F.col("p_size")), (kind, F.col("p_type"))])).select("p_partkey")


@query("""
    SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 ELSE 9 END AS urgency
    FROM orders
""")
def filter_case(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey", first_match("o_orderpriority", {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3}, 9).alias("urgency")
    )


@query("SELECT s_suppkey, coalesce(nullif(s_nationkey, 3), -1) AS nation FROM supplier")
def filter_default(t: Tables) -> DataFrame:
    return t.supplier.select("s_suppkey", F.coalesce(F.nullif(F.col("s_nationkey"), F.lit(3)), F.lit(-1)).alias("nation"))


@query("SELECT p_partkey, p_brand, p_type FROM part WHERE p_brand = 'Brand#2' AND p_type = 'ECONOMY'")
def filter_two_columns(t: Tables) -> DataFrame:
    return t.part.filter("`p_brand` = 'Brand#2' AND `p_type` = 'ECONOMY'").select("p_partkey", "p_brand", "p_type")


PARTY = {"party_id": "bigint", "party_name": "string", "nation_id": "int", "segment": "string", "kind": "string"}


@query("""
    SELECT c_custkey AS party_id, left(c_name, 12) AS party_name, c_nationkey AS nation_id, c_mktsegment AS segment,
           'customer' AS kind FROM customer
    UNION ALL
    SELECT s_suppkey, s_name, s_nationkey, NULL, 'supplier' FROM supplier WHERE s_nationkey IN (3, 4, 6, 8)
""")
def union_padded_parties(t: Tables) -> DataFrame:
    customers = t.customer.select(
        F.col("c_custkey").alias("party_id"), F.left("c_name", F.lit(12)).alias("party_name"),
        F.col("c_nationkey").alias("nation_id"), F.col("c_mktsegment").alias("segment"), F.lit("customer").alias("kind"),
    )
    suppliers = t.supplier.filter(F.col("s_nationkey").isin(3, 4, 6, 8)).select(
        F.col("s_suppkey").alias("party_id"), F.col("s_name").alias("party_name"),
        F.col("s_nationkey").alias("nation_id"), F.lit("supplier").alias("kind"),
    )
    return union_padded(customers, suppliers, types=PARTY)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 3")
def sort_first_three(t: Tables) -> DataFrame:
    return first_rows(t.orders.select("o_orderkey", "o_totalprice"), 3, F.col("o_totalprice").desc(), "o_orderkey")


@query("SELECT n_name, n_regionkey FROM nation ORDER BY n_regionkey DESC, n_name")
def sort_columns(t: Tables) -> DataFrame:
    return t.nation.select("n_name", "n_regionkey").orderBy(F.col("n_regionkey").desc(), "n_name")


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def sort_distribute_by(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity").repartition(
        "l_orderkey", "l_linenumber"
    )
