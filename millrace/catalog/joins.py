"""Joins and lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.catalog.registry import query
from millrace.functions.dates import calendar_of
from millrace.functions.money import money
from millrace.operators import joins as J
from millrace.operators.aggregates import row_count
from millrace.operators.quality import NotEmpty, Unique, check_report
from millrace.sources.tables import Tables

# Days behind the last order that the calendar still has.
AHEAD = 120
CALENDAR_SQL = f"""
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS date_dt
    FROM (SELECT unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)) + {AHEAD}, INTERVAL 1 DAY)) AS d FROM orders)
"""


def days(t: Tables) -> DataFrame:
    """Date dimension over the days of all orders and the time behind them."""
    o = t.orders.select(F.col("o_orderdate").cast("date").alias("d"))
    return calendar_of(o, "d", AHEAD)


@query("""
    SELECT o_custkey, o_orderkey, l_linenumber, l_quantity FROM orders JOIN lineitem ON o_orderkey = l_orderkey
""")
def join_inner(t: Tables) -> DataFrame:
    o, l = t.orders, t.lineitem
    return o.join(l, o["o_orderkey"] == l["l_orderkey"]).select("o_custkey", "o_orderkey", "l_linenumber", "l_quantity")


@query("SELECT n_regionkey AS region, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def join_using(t: Tables) -> DataFrame:
    return t.nation.withColumnRenamed("n_regionkey", "region").join(
        t.region.withColumnRenamed("r_regionkey", "region"), "region"
    ).select("region", "n_name", "r_name")


@query(f"""
    WITH d AS ({CALENDAR_SQL})
    SELECT o_orderkey, c.date_key AS date_create_key, a.date_key AS date_arrival_key
    FROM orders JOIN d c ON CAST(o_orderdate AS DATE) = c.date_dt
    JOIN d a ON CAST(o_orderdate AS DATE) + 30 = a.date_dt
""")
def join_date_key_roles(t: Tables) -> DataFrame:
    dates = days(t)
    o = t.orders.select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("created"),
        F.date_add(F.col("o_orderdate").cast("date"), 30).alias("arrival"),
    )
    out = J.lookup_date_key(o, dates, "created", "date_create_key")
    return J.lookup_date_key(out, dates, "arrival", "date_arrival_key").select(
        "o_orderkey", "date_create_key", "date_arrival_key"
    )


@query("""
    SELECT c_custkey, n_name FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) ON c_nationkey = n_nationkey
""")
def join_left_lookup(t: Tables) -> DataFrame:
    some = t.nation.filter(F.col("n_nationkey") < 20)
    return J.lookup(t.customer, some, {"c_nationkey": "n_nationkey"}, {"n_name": "n_name"}).select("c_custkey", "n_name")


def currencies(t: Tables) -> DataFrame:
    return t.nation.filter("n_nationkey < 6").select(
        F.concat(F.lit("C"), F.col("n_nationkey").cast("string")).alias("currency_iso_cd"),
        (F.col("n_nationkey") % 3).cast("int").alias("decimal_positions_qty"),
    )


def rates(t: Tables) -> DataFrame:
    """One rate per calendar day and currency number, derived from the day."""
    dates = days(t).select("date_key", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("c"))
    return dates.select(
        F.concat(F.lit("C"), F.col("c").cast("string")).alias("currency_iso_cd"),
        (F.col("date_key") * 10 + F.col("c")).alias("date_currency_key"),
        "date_key",
        (F.lit(1) + (F.col("date_key") % 50 + F.col("c")) / F.lit(100)).cast("decimal(18,8)").alias("exch_per_us_dlr_rte"),
    )


FX_SQL = f"""
    d AS ({CALENDAR_SQL}),
    cur AS (SELECT 'C' || n_nationkey AS currency_iso_cd, n_nationkey % 3 AS places FROM nation WHERE n_nationkey < 6),
    rates AS (SELECT 'C' || c AS currency_iso_cd, date_key, date_key * 10 + c AS date_currency_key,
                     CAST(1 + (date_key % 50 + c) / 100.0 AS DECIMAL(18,8)) AS rate
              FROM d, (SELECT unnest([0, 1, 2, 3, 4, 5, 6]) AS c)),
    fx AS (SELECT d.date_dt, r.currency_iso_cd, r.date_currency_key, r.date_key AS date_create_key, r.rate, cur.places
           FROM rates r JOIN d ON d.date_key = r.date_key JOIN cur USING (currency_iso_cd))
"""


def _priced(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("create_date"),
        F.concat(F.lit("C"), (F.col("o_custkey") % 8).cast("string")).alias("currency_code"),
        money("o_totalprice").alias("amount"),
    )


def _local(df: DataFrame) -> DataFrame:
    local = (
        F.col("amount").cast("double") / F.pow(F.lit(10.0), F.col("decimal_positions_qty").cast("double"))
        * F.col("exch_per_us_dlr_rte").cast("double")
    ).cast("decimal(28,6)").cast("double")
    return df.select("o_orderkey", "date_create_key", local.alias("amount_local"))


@query(f"""
    WITH {FX_SQL}
    SELECT o_orderkey, date_create_key,
           CAST(CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) / pow(10.0, CAST(places AS DOUBLE)) * CAST(rate AS DOUBLE) AS DECIMAL(28,6)) AS DOUBLE) AS amount_local
    FROM orders JOIN fx ON CAST(o_orderdate AS DATE) = date_dt AND 'C' || (o_custkey % 8) = currency_iso_cd
""")
def join_currency_inner(t: Tables) -> DataFrame:
    return _local(J.convert_currency(_priced(t), rates(t), days(t), currencies(t)))


@query(f"""
    WITH {FX_SQL}
    SELECT o_orderkey, date_create_key,
           CAST(CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) / pow(10.0, CAST(places AS DOUBLE)) * CAST(rate AS DOUBLE) AS DECIMAL(28,6)) AS DOUBLE) AS amount_local
    FROM orders LEFT JOIN fx ON CAST(o_orderdate AS DATE) = date_dt AND 'C' || (o_custkey % 8) = currency_iso_cd
""")
def join_currency_left(t: Tables) -> DataFrame:
    return _local(J.convert_currency(_priced(t), rates(t), days(t), currencies(t), "left"))


@query("""
    SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT) AS quantity, CAST(total AS DOUBLE) AS total
    FROM lineitem JOIN (
        SELECT l_orderkey, l_partkey, l_suppkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS total
        FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL) USING (l_orderkey, l_partkey, l_suppkey)
""")
def join_back_natural_key(t: Tables) -> DataFrame:
    keys = ["l_orderkey", "l_partkey", "l_suppkey"]
    child = t.lineitem.filter("l_returnflag = 'R'").groupBy(*keys).agg(F.sum(money("l_extendedprice")).cast("double").alias("total"))
    return J.join_back(t.lineitem.select(*keys, F.col("l_quantity").cast("bigint").alias("quantity")), child, keys)


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, p_brand, s_name, n_name, r_name
    FROM lineitem
    LEFT JOIN part ON l_partkey = p_partkey AND p_type = 'SMALL'
    LEFT JOIN supplier ON l_suppkey = s_suppkey
    LEFT JOIN nation ON s_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey AND r_name <> 'ASIA'
""")
def join_star(t: Tables) -> DataFrame:
    return J.star_join(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
        [
            J.Lookup(t.part, {"l_partkey": "p_partkey"}, {"p_brand": "p_brand"}, F.col("p_type") == "SMALL"),
            J.Lookup(t.supplier, {"l_suppkey": "s_suppkey"}, {"s_name": "s_name", "s_nation": "s_nationkey"}),
            J.Lookup(t.nation, {"s_nation": "n_nationkey"}, {"n_name": "n_name", "n_region": "n_regionkey"}),
            J.Lookup(t.region, {"n_region": "r_regionkey"}, {"r_name": "r_name"}, F.col("r_name") != "ASIA"),
        ],
    ).select("l_orderkey", "l_linenumber", "l_partkey", "p_brand", "s_name", "n_name", "r_name")


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    WHERE l_suppkey % 25 IN (SELECT n_nationkey FROM nation WHERE n_nationkey % 3 <> 0)
      AND (l_partkey % 25, l_linenumber % 5) IN (SELECT (n_nationkey, n_regionkey) FROM nation WHERE n_nationkey % 3 <> 0)
""")
def join_double_lookup(t: Tables) -> DataFrame:
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        (F.col("l_suppkey") % 25).alias("k1"), (F.col("l_partkey") % 25).alias("k2"), (F.col("l_linenumber") % 5).alias("k3"),
    )
    # The dimension lists every key twice; rows must not multiply.
    doubled = t.nation.unionAll(t.nation)
    return J.double_lookup(
        lines, doubled, {"k1": "n_nationkey"}, {"k2": "n_nationkey", "k3": "n_regionkey"}, F.col("n_nationkey") % 3 != 0
    ).drop("k1", "k2", "k3")


@query("SELECT s_suppkey, n_name FROM supplier, nation WHERE s_nationkey = n_nationkey")
def join_comma(t: Tables) -> DataFrame:
    return t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")


@query("""
    SELECT n_nationkey, n_name FROM nation
    WHERE (SELECT count(*) FROM (SELECT n_nationkey FROM nation GROUP BY 1 HAVING count(*) > 1)) = 0
""")
def join_gate(t: Tables) -> DataFrame:
    report = check_report(t.nation, [NotEmpty(), Unique(("n_nationkey",))], "nation")
    return J.gate(t.nation.select("n_nationkey", "n_name"), report)


@query("""
    SELECT count(*) AS n FROM region
    WHERE (SELECT count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1)) = 0
""")
def join_gate_closed(t: Tables) -> DataFrame:
    report = check_report(t.lineitem, [Unique(("l_orderkey", "l_linenumber"))], "lineitem")
    return row_count(J.gate(t.region, report))


@query("""
    SELECT o.n AS orders_n, o.latest AS latest_order, l.n AS lines_n
    FROM (SELECT count(*) AS n, CAST(max(o_orderdate) AS DATE) AS latest FROM orders) o, (SELECT count(*) AS n FROM lineitem) l
""")
def join_one_row_aggregates(t: Tables) -> DataFrame:
    lines = row_count(t.lineitem).scalar()
    return t.orders.agg(
        F.count(F.lit(1)).alias("orders_n"), F.max("o_orderdate").cast("date").alias("latest_order")
    ).withColumn("lines_n", lines)


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def join_not_in(t: Tables) -> DataFrame:
    return J.anti_not_in(t.orders.select("o_orderkey", "o_custkey"), t.lineitem, "o_orderkey", "l_orderkey")


@query("SELECT count(*) AS n FROM orders WHERE o_orderkey NOT IN (SELECT nullif(l_orderkey, 5979) FROM lineitem)")
def join_not_in_with_null(t: Tables) -> DataFrame:
    keys = t.lineitem.select(F.nullif(F.col("l_orderkey"), F.lit(5979).cast("bigint")).alias("k"))
    return row_count(J.anti_not_in(t.orders.select("o_orderkey"), keys, "o_orderkey", "k"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def join_not_exists(t: Tables) -> DataFrame:
    return J.anti_missing(t.orders.select("o_orderkey", "o_custkey"), t.lineitem, {"o_orderkey": "l_orderkey"})


@query("""
    SELECT c_custkey FROM customer c WHERE EXISTS (
        SELECT 1 FROM supplier s WHERE c.c_nationkey = s.s_nationkey
          AND coalesce(nullif(c.c_nationkey % 4, 1), -1) = coalesce(nullif(s.s_suppkey % 4, 1), -1))
""")
def join_exists_null_safe(t: Tables) -> DataFrame:
    one = F.lit(1).cast("bigint")
    c = t.customer.select("c_custkey", F.col("c_nationkey").alias("nation"),
                          F.nullif((F.col("c_nationkey") % 4).cast("bigint"), one).alias("code"))
    s = t.supplier.select(F.col("s_nationkey").alias("nation"), F.nullif(F.col("s_suppkey") % 4, one).alias("code"))
    return J.already_loaded(c, s, ["nation", "code"], {"code": -1}).select("c_custkey")


@query("""
    SELECT o_orderkey, l_linenumber, l_shipmonth FROM orders
    LEFT JOIN (SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y%m') AS l_shipmonth FROM lineitem) ON o_orderkey = l_orderkey
    WHERE l_linenumber IS NOT NULL
""")
def join_matched_rows(t: Tables) -> DataFrame:
    l = t.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", F.date_format("l_shipdate", "yyyyMM").alias("l_shipmonth")
    )
    return J.matched_rows(t.orders.select("o_orderkey"), l, ["o_orderkey"])


@query("""
    SELECT o_orderkey, (SELECT min(l_partkey) FROM lineitem WHERE l_orderkey = o_orderkey AND l_linestatus = 'O') AS open_part,
           (SELECT min(l_partkey) FROM lineitem WHERE l_orderkey = o_orderkey AND l_linestatus = 'F') AS finished_part
    FROM orders
""")
def join_attribute_lookup(t: Tables) -> DataFrame:
    return J.attribute_lookup(
        t.orders.select("o_orderkey"), t.lineitem, "o_orderkey", "l_orderkey", "l_linestatus", "l_partkey",
        {"open_part": "O", "finished_part": "F"},
    )
