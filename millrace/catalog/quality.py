"""Check reports, gates, record and field rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.catalog.registry import query
from millrace.functions.text import blank
from millrace.operators import quality as Q
from millrace.sources.tables import Tables

LINE_CHECKS_SQL = """
    SELECT CAST(count(*) = 0 AS INTEGER) AS error_code, 'NO_RECORDS_LOADED' AS error_abv, 'lineitem' AS error_table, count(*) AS row_cnt FROM lineitem
    UNION ALL
    SELECT CAST(count(*) > 0 AS INTEGER), 'DUPLICATE_RECORDS', 'lineitem', count(*) FROM (
        SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity HAVING count(*) > 1)
    UNION ALL
    SELECT CAST(count(*) > 0 AS INTEGER), 'DUPLICATE_BUSINESS_KEY', 'lineitem', count(*) FROM (
        SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
    UNION ALL
    SELECT CAST(count(*) > 0 AS INTEGER), 'NULL_KEY', 'lineitem', count(*) FROM lineitem WHERE l_orderkey IS NULL OR l_partkey IS NULL
    UNION ALL
    SELECT CAST(count(*) > 0 AS INTEGER), 'SHARE_NOT_100', 'lineitem', count(*) FROM (
        SELECT 1 FROM lineitem GROUP BY l_orderkey HAVING round(sum(CAST(l_quantity AS DECIMAL(18,2))), 0) <> 100)
    UNION ALL
    SELECT CAST(count(*) > 0 AS INTEGER), 'SHARE_ABOVE_300', 'lineitem', count(*) FROM (
        SELECT 1 FROM lineitem GROUP BY l_suppkey, l_orderkey HAVING round(sum(CAST(l_quantity AS DECIMAL(18,2))), 0) > 300)
"""


def line_checks() -> list[Q.Check]:
    return [
        Q.NotEmpty(),
        Q.Unique(("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")),
        Q.Unique(("l_orderkey", "l_linenumber"), "DUPLICATE_BUSINESS_KEY"),
        Q.NoNulls(("l_orderkey", "l_partkey")),
        Q.SumsTo(("l_orderkey",), "l_quantity", 100, "SHARE_NOT_100"),
        Q.SumsAtMost(("l_suppkey", "l_orderkey"), "l_quantity", 300, "SHARE_ABOVE_300"),
    ]


@query(LINE_CHECKS_SQL)
def quality_report(t: Tables) -> DataFrame:
    return Q.check_report(t.lineitem, line_checks(), "lineitem")


@query(f"SELECT * FROM ({LINE_CHECKS_SQL}) WHERE error_code > 0")
def quality_failures(t: Tables) -> DataFrame:
    return Q.failures(Q.check_report(t.lineitem, line_checks(), "lineitem"))


@query("""
    SELECT CAST(count(*) > 0 AS INTEGER) AS error_code, 'KEY_EXISTS' AS error_abv, 'orders' AS error_table, count(*) AS row_cnt
    FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 40)
""")
def quality_not_in_target(t: Tables) -> DataFrame:
    target = t.lineitem.filter("l_quantity > 40").select(F.col("l_orderkey").alias("o_orderkey"))
    return Q.check_report(t.orders, [Q.NotInTarget(target, ("o_orderkey",))], "orders")


@query("""
    SELECT 1 AS error_code, 'NO_RECORDS_LOADED' AS error_abv, 'empty' AS error_table, CAST(0 AS BIGINT) AS row_cnt
    WHERE (SELECT count(*) FROM orders WHERE o_orderstatus = 'X') = 0
    UNION ALL
    SELECT CAST(count(*) > 0 AS INTEGER), 'DUPLICATE_PRIMARY_KEY', 'orders', count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
""")
def quality_union_reports(t: Tables) -> DataFrame:
    return Q.union_reports(
        Q.check_report(t.orders.filter("o_orderstatus = 'X'"), [Q.NotEmpty()], "empty"),
        Q.check_report(t.orders, [Q.Unique(("o_orderkey",), "DUPLICATE_PRIMARY_KEY")], "orders"),
    )


def _customers(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey",
        "c_nationkey",
        F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("segment"),
        F.when(F.col("c_custkey") % 5 != 0, F.col("c_name")).otherwise(" ").alias("name"),
        F.nullif(F.col("c_nationkey"), F.lit(7)).alias("nation"),
    )


CUSTOMERS_SQL = """
    SELECT c_custkey, c_nationkey, nullif(c_mktsegment, 'MACHINERY') AS segment,
           CASE WHEN c_custkey % 5 <> 0 THEN c_name ELSE ' ' END AS name, nullif(c_nationkey, 7) AS nation FROM customer
"""


def _record_rules() -> list[Q.RecordRule]:
    return [
        Q.RecordRule("segment", "Column is NULL", blank("segment")),
        Q.RecordRule("nation", "Nation does not exist", F.col("nation").isNull()),
        Q.RecordRule("name", "Column is NULL", blank("name")),
    ]


def _listed() -> Column:
    return F.array_join(F.transform("errorDescription", lambda e: F.concat_ws(":", e["errorField"], e["errorDesc"])), ";")


@query(f"""
    SELECT c_custkey, concat_ws(';', CASE WHEN segment IS NULL THEN 'segment:Column is NULL' END,
        CASE WHEN nation IS NULL THEN 'nation:Nation does not exist' END,
        CASE WHEN trim(name) = '' THEN 'name:Column is NULL' END) AS errors
    FROM ({CUSTOMERS_SQL})
""")
def quality_row_errors(t: Tables) -> DataFrame:
    return Q.row_errors(_customers(t), _record_rules()).select("c_custkey", _listed().alias("errors"))


@query(f"""
    SELECT c_nationkey, concat_ws(';', CASE WHEN bool_or(segment IS NULL) THEN 'segment:Column is NULL' END,
        CASE WHEN bool_or(nation IS NULL) THEN 'nation:Nation does not exist' END,
        CASE WHEN bool_or(trim(name) = '') THEN 'name:Column is NULL' END) AS errors
    FROM ({CUSTOMERS_SQL}) GROUP BY 1
""")
def quality_collect_errors(t: Tables) -> DataFrame:
    return Q.collect_errors(_customers(t), _record_rules(), ["c_nationkey"]).select("c_nationkey", _listed().alias("errors"))


@query(f"""
    SELECT c_nationkey, coalesce(CASE WHEN bool_or(trim(name) = '') THEN 'name:Column is NULL'
        WHEN bool_or(nation IS NULL) THEN 'nation:Nation does not exist'
        WHEN bool_or(segment IS NULL) THEN 'segment:Column is NULL' END, '') AS errors
    FROM ({CUSTOMERS_SQL}) GROUP BY 1
""")
def quality_first_error(t: Tables) -> DataFrame:
    return Q.first_error(_customers(t), _record_rules(), ["c_nationkey"]).select("c_nationkey", _listed().alias("errors"))


@query(f"""
    SELECT 'custkey' AS "errorField", CAST(c_custkey AS VARCHAR) AS "errorFieldValue", 'does not start with 7, 8 or 9' AS "errorField_description"
    FROM ({CUSTOMERS_SQL}) WHERE left(CAST(c_custkey AS VARCHAR), 1) NOT IN ('7', '8', '9')
    UNION ALL SELECT 'segment', segment, 'segment is NULL' FROM ({CUSTOMERS_SQL}) WHERE segment IS NULL
    UNION ALL SELECT 'name', name, 'name is NULL' FROM ({CUSTOMERS_SQL}) WHERE trim(name) = ''
""")
def quality_field_errors(t: Tables) -> DataFrame:
    return Q.field_errors(
        _customers(t),
        [
            Q.FieldRule("custkey", "c_custkey", "does not start with 7, 8 or 9",
                        ~Q.starts_with_any(F.col("c_custkey").cast("string"), ("7", "8", "9"))),
            Q.FieldRule("segment", "segment", "segment is NULL", blank("segment")),
            Q.FieldRule("name", "name", "name is NULL", blank("name")),
        ],
    )


@query("""
    WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
    f AS (SELECT doc_id, lines[1] AS first_line, lines[len(lines)] AS last_line, CAST(len(lines) AS BIGINT) - 2 AS records FROM l),
    s AS (SELECT *, contains(last_line, 'on') AS has_trailer, TRY_CAST(trim(substring(last_line, 1, 2)) AS BIGINT) AS stated FROM f)
    SELECT CAST(doc_id AS VARCHAR) AS file, records, CASE WHEN has_trailer THEN stated END AS stated_records,
        concat_ws(';', CASE WHEN NOT has_trailer THEN 'Trailer not found' END,
            CASE WHEN has_trailer AND NOT coalesce(stated = records, false) THEN 'Record count is not the same' END,
            CASE WHEN has_trailer AND coalesce(stated = records, false) AND records > 2 THEN 'Record count is above the limit' END,
            CASE WHEN NOT contains(first_line, 'The') THEN 'Header not found' END) AS issues
    FROM s
""")
def quality_file_report(t: Tables) -> DataFrame:
    """Each document read as a framed file, whole text."""
    lines = t.documents.select(
        F.col("doc_id").cast("string").alias("file"), F.posexplode(F.split("text", "\n")).alias("at", "line")
    )
    out = Q.file_report(lines, max_records=2, header="The", trailer="on", count_from=1, count_length=2)
    return out.withColumn("issues", F.array_join("issues", ";"))
