"""Dedup, upsert, change logs, flags, audit, reconciliation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.catalog.registry import query
from millrace.operators import maintain as M
from millrace.operators import reconcile as R
from millrace.sources.tables import Tables

TS = dt.datetime(2024, 2, 1, 3, 4, 5)


@query("SELECT DISTINCT text, lang, md5(source) AS source_key FROM documents")
def maintain_dedup_exact(t: Tables) -> DataFrame:
    return M.dedup(t.documents.select("text", "lang", F.md5("source").alias("source_key")))


@query("SELECT text, min(doc_id) AS doc_id FROM documents GROUP BY 1")
def maintain_dedup_by_key(t: Tables) -> DataFrame:
    return M.dedup(t.documents.select("text", "doc_id"), ["text"], ["doc_id"])


@query("""
    SELECT DISTINCT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS BIGINT) AS quantity, l_returnflag, l_linestatus FROM lineitem
""")
def maintain_dedup_lines(t: Tables) -> DataFrame:
    return M.dedup(
        t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_quantity").cast("bigint").alias("quantity"),
                          "l_returnflag", "l_linestatus")
    )


UPSERT_SQL = """
    WITH target AS (SELECT c_custkey, c_mktsegment AS segment, DATE '2023-01-01' AS load_dt FROM customer WHERE c_custkey % 3 <> 0),
    staged AS (SELECT c_custkey, lower(c_mktsegment) AS segment FROM customer WHERE c_custkey % 2 = 0)
    SELECT * FROM target WHERE c_custkey NOT IN (SELECT c_custkey FROM staged)
    UNION ALL SELECT c_custkey, segment, DATE '2024-02-01' FROM staged
"""


@query(UPSERT_SQL)
def maintain_upsert(t: Tables) -> DataFrame:
    target = t.customer.filter("c_custkey % 3 <> 0").select(
        "c_custkey", F.col("c_mktsegment").alias("segment"), F.lit(dt.date(2023, 1, 1)).alias("load_dt")
    )
    staged = t.customer.filter("c_custkey % 2 = 0").select("c_custkey", F.lower("c_mktsegment").alias("segment"))
    return M.upsert(target, staged, ["c_custkey"], TS)


@query("""
    WITH log AS (
        SELECT o_orderkey, o_orderstatus || '9' AS status, CASE WHEN o_orderkey % 5 = 1 THEN 'DELETE' ELSE 'UPDATE' END AS op, '9' AS seq
        FROM orders WHERE o_orderkey % 5 IN (1, 2, 3)
        UNION ALL
        SELECT o_orderkey, o_orderstatus || '10', CASE WHEN o_orderkey % 5 = 2 THEN 'DELETE' ELSE 'INSERT' END, '10'
        FROM orders WHERE o_orderkey % 5 IN (2, 3) OR o_orderkey % 10 = 1
        UNION ALL
        SELECT o_orderkey + 1000000, o_orderstatus, 'INSERT', '1' FROM orders WHERE o_orderkey % 5 = 4
        UNION ALL
        SELECT o_orderkey, o_orderstatus || '11', CASE WHEN o_orderkey % 20 = 0 THEN 'BEFOREIMAGE' END, '11' FROM orders WHERE o_orderkey % 10 = 0),
    entries AS (SELECT o_orderkey, o_orderstatus AS status, 'INSERT' AS op, '0' AS seq FROM orders UNION ALL SELECT * FROM log)
    SELECT o_orderkey, status FROM (
        SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY CAST(seq AS BIGINT) DESC) AS rn FROM entries)
    WHERE rn = 1 AND op IN ('INSERT', 'UPDATE')
""")
def maintain_net_change(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", F.col("o_orderstatus").alias("status"))
    k = F.col("o_orderkey") % 5

    def entry(rows: DataFrame, suffix: str, op, seq: str) -> DataFrame:
        return rows.select(
            "o_orderkey", F.concat("status", F.lit(suffix)).alias("status"), op.alias("header__operation"),
            F.lit(seq).alias("header__change_seq"),
        )

    ninth = entry(o.filter(k.isin(1, 2, 3)), "9", F.when(k == 1, "DELETE").otherwise("UPDATE"), "9")
    tenth = entry(
        o.filter(k.isin(2, 3) | (F.col("o_orderkey") % 10 == 1)), "10", F.when(k == 2, "DELETE").otherwise("INSERT"), "10"
    )
    fresh = entry(o.filter(k == 4).withColumn("o_orderkey", F.col("o_orderkey") + 1000000), "", F.lit("INSERT"), "1")
    # Images of old rows and entries without an operation are no rows of the table.
    image = F.when(F.col("o_orderkey") % 20 == 0, "BEFOREIMAGE")
    other = entry(o.filter(F.col("o_orderkey") % 10 == 0), "11", image, "11")
    return M.net_change(o, ninth.unionByName(tenth).unionByName(fresh).unionByName(other), ["o_orderkey"])


@query("""
    SELECT o_orderkey, o_custkey, o_orderpriority = '1-URGENT' OR o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 48) AS flagged
    FROM orders
""")
def maintain_set_flag(t: Tables) -> DataFrame:
    target = t.orders.select("o_orderkey", "o_custkey", (F.col("o_orderpriority") == "1-URGENT").alias("flagged"))
    hits = t.lineitem.filter("l_quantity > 48").select(F.col("l_orderkey").alias("o_orderkey"))
    return M.set_flag(target, hits, "o_orderkey", "flagged")


def _run_dates(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.col("o_orderstatus").alias("sys_id")).agg(F.max("o_orderdate").cast("date").alias("run_dt"))


@query("SELECT CAST(max(o_orderdate) AS DATE) - 2 AS data_batch_dt FROM orders WHERE o_orderstatus = 'P'")
def maintain_batch_date(t: Tables) -> DataFrame:
    return M.batch_date(_run_dates(t), "P")


@query("""
    SELECT md5(concat_ws('|', 'LINES', strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S'))) AS audit_key,
           CAST(max(l_shipdate) AS TIMESTAMP) AS initial_load_ts, DATE '2024-01-30' AS data_batch_dt, 'LINES' AS table_nm,
           CAST(NULL AS TIMESTAMP) AS min_data_ts, CAST(NULL AS TIMESTAMP) AS max_data_ts, count(*) AS record_amt,
           'LOADER' AS sys_id, TIMESTAMP '2024-02-01 03:04:05' AS dw_load_ts
    FROM lineitem
""")
def maintain_audit_row(t: Tables) -> DataFrame:
    out = M.audit_row(t.lineitem, "LINES", dt.date(2024, 1, 30), "LOADER", TS, load_ts="l_shipdate")
    return out.withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("initial_load_ts", "min_data_ts", "max_data_ts", "dw_load_ts")}
    )


@query("""
    SELECT l_orderkey, l_linenumber, l_suppkey, l_shipmode FROM (
        SELECT l_orderkey, l_linenumber, l_suppkey, CASE l_returnflag WHEN 'A' THEN 'AFF' WHEN 'N' THEN 'NAT' ELSE 'REF' END AS l_shipmode, l_partkey FROM lineitem)
    WHERE l_shipmode IN ('AFF', 'REF') AND l_suppkey % 25 IN (SELECT n_nationkey FROM nation WHERE n_nationkey % 3 <> 0)
      AND l_partkey % 25 IN (SELECT n_nationkey FROM nation WHERE n_nationkey % 3 <> 0)
""")
def maintain_qualify(t: Tables) -> DataFrame:
    source = F.when(F.col("l_returnflag") == "A", "AFF").when(F.col("l_returnflag") == "N", "NAT").otherwise("REF")
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_suppkey", source.alias("l_shipmode"),
        (F.col("l_suppkey") % 25).alias("k1"), (F.col("l_partkey") % 25).alias("k2"),
    )
    return M.qualify(
        rows, t.nation, {"k1": "n_nationkey"}, {"k2": "n_nationkey"}, F.col("n_nationkey") % 3 != 0, "l_shipmode", ["AFF", "REF"]
    ).drop("k1", "k2")


def _versions(t: Tables) -> tuple[DataFrame, DataFrame]:
    a = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    b = t.orders.filter("o_orderkey % 11 <> 0").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 7 == 0, "Z").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(F.col("o_orderkey") % 13 != 0, F.col("o_orderpriority")).alias("o_orderpriority"),
    )
    return a, b


VERSIONS_SQL = """
    a AS (SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders),
    b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'Z' ELSE o_orderstatus END AS o_orderstatus,
                 CASE WHEN o_orderkey % 13 <> 0 THEN o_orderpriority END AS o_orderpriority FROM orders WHERE o_orderkey % 11 <> 0)
"""
BOTH_SQL = """
    SELECT a.o_orderkey AS o_orderkey_a, a.o_orderstatus AS o_orderstatus_a, a.o_orderpriority AS o_orderpriority_a,
           b.o_orderkey AS o_orderkey_b, b.o_orderstatus AS o_orderstatus_b, b.o_orderpriority AS o_orderpriority_b
"""
PAIRS = [("o_orderstatus", "o_orderstatus"), ("o_orderpriority", "o_orderpriority")]


@query(f"""
    WITH {VERSIONS_SQL} {BOTH_SQL} FROM a JOIN b ON a.o_orderkey = b.o_orderkey
    WHERE a.o_orderstatus IS DISTINCT FROM b.o_orderstatus OR a.o_orderpriority IS DISTINCT FROM b.o_orderpriority
""")
def reconcile_diff(t: Tables) -> DataFrame:
    return R.diff_rows(*_versions(t), "o_orderkey", PAIRS)


@query(f"""
    WITH {VERSIONS_SQL} {BOTH_SQL} FROM a JOIN b ON a.o_orderkey = b.o_orderkey
    WHERE a.o_orderstatus <> b.o_orderstatus OR a.o_orderpriority <> b.o_orderpriority
""")
def reconcile_diff_plain(t: Tables) -> DataFrame:
    return R.diff_rows(*_versions(t), "o_orderkey", PAIRS, null_safe=False)


@query(f"WITH {VERSIONS_SQL} {BOTH_SQL} FROM a LEFT JOIN b ON a.o_orderkey = b.o_orderkey")
def reconcile_side_by_side(t: Tables) -> DataFrame:
    return R.side_by_side(*_versions(t), "o_orderkey")
