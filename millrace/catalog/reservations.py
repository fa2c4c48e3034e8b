"""Reservation messages derived from orders: written as JSON text, parsed, enriched, validated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.catalog.joins import FX_SQL, currencies, days, rates
from millrace.catalog.registry import query
from millrace.functions.dates import calendar
from millrace.functions.money import money
from millrace.operators.nested import explode_errors
from millrace.plans import reservations as R
from millrace.schemas import RESERVATION
from millrace.session import staged
from millrace.sources.files import parse_json, quarantine
from millrace.sources.tables import Tables


def message_text(t: Tables) -> DataFrame:
    """One JSON text per order: 1-2 confirmations, 1-3 segments, 2 room pools, 1 guest."""
    key, cust, day = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate").cast("date")

    def text(c: Column) -> Column:
        return c.cast("string")

    def shifted(i: Column, extra: int) -> Column:
        return text(F.date_add(day, (i * 30 + extra).cast("int")))

    first = F.struct(text(key).alias("reservationCode"), F.lit("1").alias("reservationInstance"))
    second = F.struct(F.concat(F.lit("X"), text(key)).alias("reservationCode"), F.lit("2").alias("reservationInstance"))
    segments = F.transform(
        F.sequence(F.lit(1), F.lit(1) + (key % 3).cast("int")),
        lambda i: F.struct(
            F.when((key % 10 == 0) & (i == 2), " ").otherwise(F.col("o_orderstatus")).alias("segmentStatus"),
            shifted(i, 0).alias("startDate"),
            shifted(i, 3).alias("endDate"),
            F.struct(
                F.col("o_orderpriority").alias("ratePlanCode"),
                F.lit("DAY").alias("baseRateUnit"),
                (money("o_totalprice") * i.cast("decimal(3,0)")).cast("decimal(18,2)").alias("baseAmount"),
                F.concat(F.lit("C"), text(cust % 8)).alias("currencyCode"),
                F.when(key % 5 != 0, F.lit(2)).alias("decimalPlaces"),
            ).alias("rate"),
        ),
    )
    words = F.split("o_orderpriority", "-")
    pools = F.array(
        F.struct(F.get(words, F.lit(0)).alias("roomPoolCode"), F.lit(1).alias("numberOfUnits")),
        F.struct(F.when(key % 11 == 0, "").otherwise(F.get(words, F.lit(1))).alias("roomPoolCode"), F.lit(2).alias("numberOfUnits")),
    )
    name = F.struct(F.when(key % 17 != 0, F.concat(F.lit("N"), text(cust))).alias("givenName"))
    guest = F.array(F.struct(F.struct(F.array(F.struct(F.array(name).alias("name"))).alias("customer")).alias("profiles")))
    message = F.struct(
        text(F.col("o_orderdate")).alias("lastupdatetime"),
        F.struct(
            F.concat(text(day), F.lit("T10:00:00")).alias("creationDateTime"),
            F.concat(F.lit("U"), text(cust)).alias("creatorID"),
            F.when(key % 2 == 0, F.array(first, second)).otherwise(F.array(first)).alias("reservationConfirmations"),
        ).alias("reservation"),
        F.struct(F.concat(F.lit("P"), text(cust % 30)).alias("propertyCode")).alias("property"),
        segments.alias("reservationSegments"),
        pools.alias("roomPools"),
        guest.alias("guest"),
    )
    return t.orders.select(F.to_json(message).alias("value"))


def messages(t: Tables) -> DataFrame:
    good, _ = quarantine(parse_json(message_text(t), "value", RESERVATION))
    return good.select("message.*")


def staged_messages(t: Tables) -> DataFrame:
    """Parsed once: the amounts and the rows that they are joined back to both read the staged messages."""
    return staged(messages(t))


def dimensions(t: Tables) -> R.Dimensions:
    properties = t.nation.select(
        (F.col("n_nationkey") + 100).alias("property_id"),
        F.concat(F.lit("P"), F.col("n_nationkey").cast("string")).alias("property_cd"),
    )
    return R.Dimensions(days(t), properties, currencies(t), rates(t))


def _flat(df: DataFrame) -> DataFrame:
    arrivals = F.transform("date_arrival_key", lambda e: F.concat(e["arrival"].cast("string"), F.lit(":"), e["n"].cast("string")))
    errors = F.transform("errorDescription", lambda e: F.concat_ws(":", e["errorField"], e["errorDesc"]))
    return df.select(
        "create_date", "confo_num_orig", "confo_num_curr", "reservationInstance", "propertyCode", "property_id",
        "date_create_key", F.col("baseAmount").cast("double").alias("base_amount"),
        F.col("baseAmountLocal").cast("double").alias("base_amount_local"),
        F.array_join(arrivals, ",").alias("arrivals"), F.array_join(errors, ";").alias("errors"),
    )


def _parsed_sql(n_segments: str, weight: int, blank: str) -> str:
    return f"""
    WITH {FX_SQL},
    seg AS (
        SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS create_date, i,
               CAST(o_totalprice AS DECIMAL(18,2)) * i AS base,
               CASE WHEN o_orderkey % 5 <> 0 THEN 2 END AS stated
        FROM orders, (SELECT unnest([1, 2, 3]) AS i) WHERE i <= {n_segments}),
    priced AS (
        SELECT o_orderkey, o_custkey, create_date, fx.date_create_key, d.date_key, {weight} AS w, CAST(base AS DECIMAL(18,2)) AS base,
               CAST(CAST(base AS DOUBLE) / pow(10.0, CAST(coalesce(stated, places) AS DOUBLE)) * CAST(rate AS DOUBLE) AS DECIMAL(28,6)) AS loc
        FROM seg JOIN d ON create_date + 30 * i = d.date_dt
        JOIN fx ON create_date = fx.date_dt AND 'C' || (o_custkey % 8) = fx.currency_iso_cd),
    per_day AS (
        SELECT o_orderkey, o_custkey, create_date, date_create_key, date_key, sum(w) AS n, sum(base * w) AS base, sum(loc * w) AS loc
        FROM priced GROUP BY ALL),
    totals AS (
        SELECT o_orderkey, o_custkey, create_date, date_create_key, CAST(sum(base) AS DOUBLE) AS base_amount,
               CAST(sum(loc) AS DOUBLE) AS base_amount_local, string_agg(date_key || ':' || n, ',' ORDER BY date_key) AS arrivals
        FROM per_day GROUP BY ALL)
    SELECT create_date, CAST(o_orderkey AS VARCHAR) AS confo_num_orig,
           CASE WHEN o_orderkey % 2 = 0 THEN 'X' ELSE '' END || o_orderkey AS confo_num_curr, '1' AS "reservationInstance",
           'P' || (o_custkey % 30) AS "propertyCode", n_nationkey + 100 AS property_id, date_create_key,
           base_amount, base_amount_local, arrivals,
           concat_ws(';', CASE WHEN {blank} THEN 'roomPoolCode:Column is NULL' END,
                     CASE WHEN n_nationkey IS NULL THEN 'property_id:Property does not exist' END) AS errors
    FROM totals LEFT JOIN nation ON o_custkey % 30 = n_nationkey
    """


@query(_parsed_sql("least(1 + o_orderkey % 3, 2)", 1, "o_orderkey % 11 = 0 AND o_orderkey % 3 > 0"))
def reservation_by_position(t: Tables) -> DataFrame:
    return _flat(R.parse_reservations(staged_messages(t), dimensions(t)))


@query(_parsed_sql("1 + o_orderkey % 3", 2, "o_orderkey % 11 = 0"))
def reservation_product(t: Tables) -> DataFrame:
    return _flat(R.parse_reservations(staged_messages(t), dimensions(t), align="product"))


@query(f"""
    WITH p AS ({_parsed_sql("1 + o_orderkey % 3", 2, "o_orderkey % 11 = 0")})
    SELECT confo_num_orig, split_part(e, ':', 1) AS error_field, split_part(e, ':', 2) AS error_desc
    FROM (SELECT confo_num_orig, unnest(string_split(errors, ';')) AS e FROM p WHERE errors <> '')
""")
def reservation_errors(t: Tables) -> DataFrame:
    parsed = R.parse_reservations(staged_messages(t), dimensions(t), align="product")
    return explode_errors(parsed.select("confo_num_orig", "errorDescription")).select(
        "confo_num_orig", F.col("errorDesc.errorField").alias("error_field"), F.col("errorDesc.errorDesc").alias("error_desc")
    )


FLAT_SQL = """
    SELECT CAST(o_orderdate AS DATE) AS create_date, CAST(o_orderkey AS VARCHAR) AS confo_num_orig, 'U' || o_custkey AS booking_office,
           'P' || (o_custkey % 30) AS property_code, CASE WHEN o_orderkey % 17 <> 0 THEN 'N' || o_custkey END AS guest_name,
           split_part(o_orderpriority, '-', 1) AS room_pool, 1 AS no_of_rooms, o_orderstatus AS reservation_status,
           strftime(CAST(o_orderdate AS DATE) + 30, '%Y-%m-%d') AS arrival_date, o_orderpriority AS rate_program,
           CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS revenue,
           'C' || (o_custkey % 8) AS currency_code, CASE WHEN o_orderkey % 5 <> 0 THEN 2 END AS decimal_places
    FROM orders
"""


@query(FLAT_SQL)
def reservation_flat(t: Tables) -> DataFrame:
    return R.flatten_reservations(messages(t)).select(
        "create_date", "confo_num_orig", "booking_office", "property_code", "guest_name", "room_pool", "no_of_rooms",
        "reservation_status", "arrival_date", "rate_program", F.col("revenue").cast("double").alias("revenue"),
        "currency_code", "decimal_places",
    )


@query(f"""
    SELECT 'reservationCode' AS "errorField", confo_num_orig AS "errorFieldValue", 'confo_num_orig doesnt start with 7,8 or 9' AS "errorField_description"
    FROM ({FLAT_SQL}) WHERE left(confo_num_orig, 1) NOT IN ('7', '8', '9')
    UNION ALL SELECT 'guest_givenName', NULL, 'Guest name is NULL' FROM ({FLAT_SQL}) WHERE guest_name IS NULL
""")
def reservation_validation(t: Tables) -> DataFrame:
    return R.validate_flat(R.flatten_reservations(messages(t)))
