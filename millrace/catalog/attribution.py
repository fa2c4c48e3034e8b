"""Attribution pipeline on line items (stays), orders (allocations) and nations (agencies)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.catalog.registry import query
from millrace.operators.quality import check_report
from millrace.plans import attribution as P
from millrace.sources.tables import Tables

TS = dt.datetime(2024, 2, 1, 3, 4, 5)


def stays(t: Tables) -> DataFrame:
    key = F.col("l_orderkey")
    return t.lineitem.select(
        F.col("l_returnflag").alias("market_cd"),
        key.alias("confo_num_orig_id"),
        F.col("l_linenumber").cast("bigint").alias("confo_num_curr_id"),
        (F.lit(20240000) + key % 365).alias("date_create_key"),
        F.concat(F.lit("P"), (key % 30).cast("string")).alias("property_cd"),
        F.nullif((F.col("l_suppkey") % 26).cast("string"), F.lit("25")).alias("book_id"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), ((key % 100) + F.col("l_linenumber")).cast("int")).alias("arrival_dt"),
        (F.col("l_partkey") * 100000 + F.col("l_suppkey")).alias("atrb_stay_key"),
    )


def allocations(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")

    def share(k: int, source, amount, agency) -> Column:
        return F.struct(
            (key * 10 + k).alias("atrb_allocation_key"), source.alias("camp_source_drvd_txt"),
            agency.cast("string").alias("atrb_id"), amount.cast("decimal(18,2)").alias("atrb_amt"),
        )

    first, second = F.col("o_custkey") % 25, (F.col("o_custkey") + 1) % 25
    parts = F.array(
        share(1, F.lit("NATU"), F.lit(30), first),
        share(2, F.lit("NATB"), F.lit(20), first),
        share(3, F.when(key % 2 == 0, "PAIU").otherwise("REFX"), F.when(key % 50 == 0, 48).otherwise(50), second),
    )
    return t.orders.select(
        key.alias("confo_num_orig_id"), (F.lit(20240000) + key % 365).alias("date_create_key"), F.inline(parts)
    )


def agencies(t: Tables) -> DataFrame:
    """Every agency is listed twice."""
    one = t.nation.select(
        F.col("n_nationkey").cast("string").alias("agency_id"),
        F.when(F.col("n_nationkey") % 2 == 0, "PAI").otherwise("REF").alias("source_txt"),
        F.when(F.col("n_nationkey") % 3 != 0, "A").otherwise("I").alias("active_ind"),
    )
    return one.unionAll(one)


STAYS_SQL = """
    stays AS (
        SELECT l_returnflag AS market_cd, l_orderkey AS confo_num_orig_id, l_linenumber AS confo_num_curr_id,
               20240000 + l_orderkey % 365 AS date_create_key, 'P' || (l_orderkey % 30) AS property_cd,
               coalesce(nullif(CAST(l_suppkey % 26 AS VARCHAR), '25'), '') AS book_id,
               DATE '2024-01-01' + CAST(l_orderkey % 100 + l_linenumber AS INTEGER) AS arrival_dt,
               l_partkey * 100000 + l_suppkey AS atrb_stay_key
        FROM lineitem),
    collapsed AS (
        SELECT DISTINCT first_value(market_cd) OVER w AS market_cd, confo_num_orig_id, confo_num_curr_id, date_create_key, property_cd,
               first_value(book_id) OVER w AS book_id, arrival_dt, first_value(atrb_stay_key) OVER w AS atrb_stay_key
        FROM stays
        WINDOW w AS (PARTITION BY confo_num_orig_id, confo_num_curr_id, date_create_key, property_cd, arrival_dt
                     ORDER BY market_cd, atrb_stay_key ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
"""
MATCH_SQL = f"""
    {STAYS_SQL},
    alloc AS (
        SELECT o_orderkey * 10 + k AS atrb_allocation_key, o_orderkey AS confo_num_orig_id, 20240000 + o_orderkey % 365 AS date_create_key,
               CASE k WHEN 1 THEN 'NATU' WHEN 2 THEN 'NATB' ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'PAIU' ELSE 'REFX' END END AS source,
               CAST(CASE k WHEN 3 THEN (o_custkey + 1) % 25 ELSE o_custkey % 25 END AS VARCHAR) AS atrb_id,
               CAST(CASE k WHEN 1 THEN 30 WHEN 2 THEN 20 ELSE CASE WHEN o_orderkey % 50 = 0 THEN 48 ELSE 50 END END AS DECIMAL(18,2)) AS amt
        FROM orders, (SELECT unnest([1, 2, 3]) AS k)),
    matched AS (
        SELECT max(atrb_allocation_key) AS atrb_allocation_key, atrb_stay_key, confo_num_orig_id, confo_num_curr_id, date_create_key,
               property_cd, left(source, 3) AS camp_source_abrv_txt, atrb_id, book_id, arrival_dt, market_cd, sum(amt) AS atrb_amt
        FROM collapsed JOIN alloc USING (confo_num_orig_id, date_create_key)
        GROUP BY atrb_stay_key, confo_num_orig_id, confo_num_curr_id, date_create_key, property_cd, left(source, 3), atrb_id, book_id, arrival_dt, market_cd),
    keyed AS (SELECT md5(atrb_allocation_key || '|' || atrb_stay_key) AS atrb_key, * FROM matched)
"""
AGENCY_SQL = """
    agency AS MATERIALIZED (
        SELECT DISTINCT CAST(n_nationkey AS VARCHAR) AS agency_id, CASE WHEN n_nationkey % 2 = 0 THEN 'PAI' ELSE 'REF' END AS source_txt
        FROM nation WHERE n_nationkey % 3 <> 0),
    daily AS (
        SELECT keyed.* FROM keyed
        JOIN (SELECT DISTINCT agency_id FROM agency) b ON keyed.book_id = b.agency_id
        JOIN agency a ON keyed.atrb_id = a.agency_id AND keyed.camp_source_abrv_txt = a.source_txt
        WHERE camp_source_abrv_txt IN ('AFF', 'PAI', 'REF'))
"""
ROW_SQL = """
    atrb_key, atrb_stay_key, confo_num_orig_id, confo_num_curr_id, date_create_key, property_cd, camp_source_abrv_txt,
    atrb_id, book_id, arrival_dt, market_cd, CAST(atrb_amt AS DOUBLE) AS atrb_amt
"""


def shown(df: DataFrame) -> DataFrame:
    return df.withColumn("atrb_amt", F.col("atrb_amt").cast("double")).drop("dw_load_ts")


@query(f"WITH {STAYS_SQL} SELECT * FROM collapsed")
def attribution_collapse(t: Tables) -> DataFrame:
    return P.collapse_stays(stays(t))


@query(f"WITH {MATCH_SQL} SELECT {ROW_SQL}, atrb_allocation_key, false AS flag FROM keyed")
def attribution_match(t: Tables) -> DataFrame:
    return shown(P.match_stays(stays(t), allocations(t), TS))


def _dups(table: str, cols: str) -> str:
    return f"(SELECT count(*) FROM (SELECT 1 FROM {table} GROUP BY {cols} HAVING count(*) > 1))"


def _share(table: str, op: str) -> str:
    return (
        f"(SELECT count(*) FROM (SELECT 1 FROM {table} GROUP BY confo_num_orig_id, confo_num_curr_id, date_create_key, arrival_dt "
        f"HAVING round(sum(atrb_amt), 0) {op} 100))"
    )


RECORD = "confo_num_orig_id, confo_num_curr_id, date_create_key, arrival_dt, market_cd, camp_source_abrv_txt, atrb_id"


def _report_sql(table: str, checks: list[tuple[str, str]]) -> str:
    rows = " UNION ALL ".join(f"SELECT '{code}' AS error_abv, {count} AS row_cnt" for code, count in checks)
    return f"SELECT CAST(row_cnt > 0 AS INTEGER) AS error_code, error_abv, '{table}' AS error_table, row_cnt FROM ({rows})"


MATCH_CHECKS = _report_sql(
    "match",
    [
        ("DUPLICATE_BUSINESS_KEY", _dups("keyed", "atrb_allocation_key, atrb_stay_key")),
        ("DUPLICATE_CCC_KEY", _dups("keyed", RECORD)),
        ("DUPLICATE_PRIMARY_KEY", _dups("keyed", "atrb_key")),
        ("INVALID_ATRB_ALLOCATION_AMT", _share("keyed", "<>")),
    ],
)
DAILY_CHECKS = _report_sql(
    "daily",
    [
        ("DUPLICATE_BUSINESS_KEY", _dups("daily", RECORD)),
        ("DUPLICATE_PRIMARY_KEY", _dups("daily", "atrb_key")),
        ("INVALID_ATRB_ALLOCATION_AMT", _share("daily", ">")),
    ],
)


@query(f"WITH {MATCH_SQL} {MATCH_CHECKS}")
def attribution_match_report(t: Tables) -> DataFrame:
    return check_report(P.match_stays(stays(t), allocations(t), TS), P.match_checks(), "match")


@query(f"WITH {MATCH_SQL}, {AGENCY_SQL} SELECT {ROW_SQL} FROM daily")
def attribution_daily(t: Tables) -> DataFrame:
    return shown(P.qualified_rows(P.match_stays(stays(t), allocations(t), TS), agencies(t)))


@query(f"WITH {MATCH_SQL}, {AGENCY_SQL} {DAILY_CHECKS}")
def attribution_daily_report(t: Tables) -> DataFrame:
    daily = P.qualified_rows(P.match_stays(stays(t), allocations(t), TS), agencies(t))
    return check_report(daily, P.daily_checks(), "daily")


FLAGGED_SQL = f"""
    WITH {MATCH_SQL}, {AGENCY_SQL.split("daily AS (")[0].rstrip().rstrip(",")}
    SELECT {ROW_SQL}, atrb_allocation_key,
           camp_source_abrv_txt IN ('AFF', 'PAI', 'REF') AND b.agency_id IS NOT NULL AND a.agency_id IS NOT NULL AS flag
    FROM keyed
    LEFT JOIN (SELECT DISTINCT agency_id FROM agency) b ON keyed.book_id = b.agency_id
    LEFT JOIN agency a ON keyed.atrb_id = a.agency_id AND keyed.camp_source_abrv_txt = a.source_txt
"""


@query(FLAGGED_SQL)
def attribution_flagged(t: Tables) -> DataFrame:
    return shown(P.attribution(stays(t), allocations(t), agencies(t), TS).flagged)
