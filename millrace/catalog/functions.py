"""Scalar functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.catalog.registry import query
from millrace.functions import dates, keys, money, text
from millrace.functions.arrays import element_or
from millrace.sources.tables import Tables


@query("""
    SELECT c_custkey, upper(c_mktsegment) AS c_mktsegment_upper, lower(c_mktsegment) AS c_mktsegment_lower,
           upper(left(c_mktsegment, 1)) || lower(substring(c_mktsegment, 2)) AS c_mktsegment_initcap,
           length(c_mktsegment) AS c_mktsegment_length, left(c_mktsegment, 1) AS c_mktsegment_first,
           left(c_mktsegment, 3) AS c_mktsegment_first3
    FROM customer
""")
def text_case_and_length(t: Tables) -> DataFrame:
    out = text.text_profile(t.customer.select("c_custkey", "c_mktsegment"), "c_mktsegment")
    return out.drop("c_mktsegment", "c_mktsegment_last4", "c_mktsegment_from8", "c_mktsegment_word2")


@query("""
    SELECT c_custkey, TRY_CAST(substring(c_name, -4, 4) AS INTEGER) AS c_name_last4,
           TRY_CAST(substring(c_name, 8, 4) AS INTEGER) AS c_name_from8
    FROM customer
""")
def text_numeric_slices(t: Tables) -> DataFrame:
    out = text.text_profile(t.customer.select("c_custkey", "c_name"), "c_name")
    return out.select("c_custkey", "c_name_last4", "c_name_from8")


@query("SELECT p_partkey, string_split(p_name, ' ')[2] AS word2, string_split(p_name, ' ')[4] AS word4 FROM part")
def text_words(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", text.nth_word("p_name", 1).alias("word2"), text.nth_word("p_name", 3).alias("word4"))


@query("""
    SELECT p_partkey, coalesce(string_split(p_name, ' ')[3], string_split(p_name, ' ')[1]) AS word FROM part
""")
def array_element_or(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", element_or(F.split("p_name", " "), 2, 0).alias("word"))


@query("""
    SELECT doc_id, md5(lower(regexp_replace(regexp_replace(text, '[!-/:-@\\[-`{-~]', '', 'g'), '\\p{Nd}', '', 'g'))) AS cleaned
    FROM documents
""")
def text_cleaned(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.md5(text.clean_text("text")).alias("cleaned"))


@query("""
    SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS o_orderdate_ym, CAST(o_orderdate AS DATE) AS o_orderdate_date,
           CAST(date_trunc('month', o_orderdate) AS DATE) AS o_orderdate_month_start,
           CAST(date_trunc('year', o_orderdate) AS DATE) AS o_orderdate_year_start,
           month(o_orderdate) AS o_orderdate_month, dayofmonth(o_orderdate) AS o_orderdate_dom,
           dayofyear(o_orderdate) AS o_orderdate_doy, dayofweek(o_orderdate) + 1 AS o_orderdate_dow,
           CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key, strftime(o_orderdate, '%Y-%m-%d') AS label
    FROM orders
""")
def date_parts(t: Tables) -> DataFrame:
    out = dates.date_parts(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate")
    return out.withColumns(
        {
            "date_key": dates.date_key("o_orderdate"),
            "label": dates.audit_label(F.year("o_orderdate"), F.month("o_orderdate"), F.dayofmonth("o_orderdate")),
        }
    ).drop("o_orderdate")


RUN_DATE = dt.date(2002, 3, 31)


@query("""
    WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS a, DATE '2002-03-31' AS b FROM orders)
    SELECT o_orderkey,
           round(CASE WHEN day(a) = day(b) OR (a = last_day(a) AND b = last_day(b))
                      THEN (year(b) - year(a)) * 12 + month(b) - month(a)
                      ELSE (year(b) - year(a)) * 12 + month(b) - month(a) + (day(b) - day(a)) / 31.0 END, 2) AS a_months,
           datediff('day', a, b) AS a_days, CAST(a + INTERVAL 3 MONTH AS DATE) AS a_plus, a - 2 AS a_minus
    FROM d
""")
def month_math(t: Tables) -> DataFrame:
    base = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("a"))
    return dates.month_math(base, F.lit(RUN_DATE), "a").drop("a")


@query("""
    SELECT o_orderkey, TRY_CAST(CASE WHEN o_orderkey % 4 = 0 THEN 'n/a' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS DATE) AS d
    FROM orders
""")
def date_from_text(t: Tables) -> DataFrame:
    raw = F.when(F.col("o_orderkey") % 4 == 0, "n/a").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return t.orders.select("o_orderkey", dates.text_date(raw).alias("d"))


@query("""
    SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) / pow(10.0, CAST(coalesce(nullif(o_orderkey % 4, 3), 2) AS DOUBLE)) AS amount
    FROM orders
""")
def amount_scaled(t: Tables) -> DataFrame:
    places = F.nullif(F.col("o_orderkey") % 4, F.lit(3).cast("bigint"))
    return t.orders.select(
        "o_orderkey", money.scaled_amount(money.money("o_totalprice"), places, 2).alias("amount")
    )


@query("""
    SELECT p_partkey, CAST(CAST(p_size AS DECIMAL(18,2)) / 100 AS DOUBLE) AS share FROM part
""")
def amount_implied_decimals(t: Tables) -> DataFrame:
    digits = F.lpad(F.col("p_size").cast("string"), 5, "0")
    return t.part.select("p_partkey", money.implied_decimals(digits).cast("double").alias("share"))


@query("SELECT round(sum(CAST(value AS DECIMAL(18,2))), 1)::DOUBLE AS total FROM events")
def amount_rounded_total(t: Tables) -> DataFrame:
    return t.events.agg(money.money_total("value", 1).cast("double").alias("total"))


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey)) AS row_key,
           sha256(concat_ws('|', l_orderkey, l_linenumber)) AS line_key
    FROM lineitem
""")
def key_surrogate(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        keys.surrogate_key("l_orderkey", "l_linenumber", "l_partkey").alias("row_key"),
        keys.surrogate_key("l_orderkey", "l_linenumber", algo="sha2").alias("line_key"),
    )
