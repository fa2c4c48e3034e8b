"""Reservation messages to enriched, validated rows. The same code serves a
batch and one micro-batch of a stream."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.arrays import element_or
from millrace.functions.money import RATED, money, scaled_amount
from millrace.functions.text import blank
from millrace.operators.aggregates import counted_values
from millrace.operators.joins import fx_table, join_back, lookup, lookup_date_key
from millrace.operators.nested import explode_aligned, explode_path
from millrace.operators.quality import FieldRule, RecordRule, _errors, field_errors, starts_with_any

NATURAL_KEY = ("create_date", "confo_num_orig", "confo_num_curr")


@dataclass(frozen=True)
class Dimensions:
    """date (date_key, date_dt), property (property_id, property_cd), currency
    (currency_iso_cd, decimal_positions_qty), rates (currency_iso_cd,
    date_currency_key, date_key, exch_per_us_dlr_rte)."""

    dates: DataFrame
    properties: DataFrame
    currencies: DataFrame
    rates: DataFrame


def with_keys(messages: DataFrame, properties: DataFrame) -> DataFrame:
    """Message columns plus creation date, confirmation numbers and property id.

    A second confirmation code is the current one; with a single code it is both.
    """
    codes = F.col("reservation.reservationConfirmations.reservationCode")
    base = messages.withColumns(
        {
            "create_date": F.substring("reservation.creationDateTime", 1, 10).try_cast("date"),
            "confo_num_orig": F.get(codes, F.lit(0)),
            "confo_num_curr": element_or(codes, 1, 0),
            "reservationInstance": F.get(F.col("reservation.reservationConfirmations.reservationInstance"), F.lit(0)),
            "propertyCode": F.col("property.propertyCode"),
        }
    )
    return lookup(base, properties, {"propertyCode": "property_cd"}, {"property_id": "property_id"}, "left")


def _segments(keyed: DataFrame, align: str) -> DataFrame:
    """One row per segment that takes part, with the number of pools it meets.

    ``position`` pairs segment i with room pool i. ``product`` pairs every
    segment with every pool; since the amounts do not depend on the pool, the
    row is weighted by the number of pools instead of being repeated.
    """
    pools, segments = F.col("roomPools"), F.col("reservationSegments")
    n_pools = F.coalesce(F.size(pools), F.lit(0))
    n_segments = F.coalesce(F.size(segments), F.lit(0))
    if align == "position":
        n = F.least(n_pools, n_segments)
        used_segments, used_pools, weight = F.slice(segments, F.lit(1), n), F.slice(pools, F.lit(1), n), F.lit(1)
    elif align == "product":
        used_segments, used_pools, weight = segments, pools, n_pools
    else:
        raise ValueError(f"unknown alignment: {align}")
    # NULL keys never meet their parent again, so they are dropped before the
    # shuffle rather than gathered into one group.
    complete = keyed.filter(
        F.col("create_date").isNotNull()
        & F.col("confo_num_orig").isNotNull()
        & (n_pools > 0)
        & (n_segments > 0)
    )
    return complete.select(
        *NATURAL_KEY,
        "property_id",
        F.exists(used_pools, lambda p: blank(p["roomPoolCode"])).alias("blank_pool"),
        weight.alias("weight"),
        F.explode(used_segments).alias("s"),
    ).select(
        *NATURAL_KEY,
        "property_id",
        "blank_pool",
        "weight",
        F.substring("s.startDate", 1, 10).try_cast("date").alias("start_date"),
        F.col("s.rate.baseAmount").alias("base_amount"),
        F.col("s.rate.currencyCode").alias("currency_code"),
        F.col("s.rate.decimalPlaces").alias("decimal_places"),
    )


def record_rules() -> list[RecordRule]:
    # Field names and texts of the error report.
    return [
        RecordRule("roomPoolCode", "Column is NULL", F.col("blank_pool")),
        RecordRule("property_id", "Property does not exist", F.col("property_id").isNull()),
    ]


def reservation_amounts(keyed: DataFrame, dims: Dimensions, align: str = "position", fx_how: str = "inner",
                        zero_places_as_one: bool = False) -> DataFrame:
    """Per natural key: sums, arrival-date keys with counts, and errors.

    The date and rate lookups are left joins with a flag, so amounts and errors
    come out of one grouped pass. Segments without an arrival date key, and with
    ``fx_how="inner"`` without a rate, add nothing; keys left with no segment drop.
    """
    rows = lookup_date_key(_segments(keyed, align), dims.dates, "start_date", "date_arrival_key", "left")
    fx = fx_table(dims.rates, dims.dates, dims.currencies)
    rows = lookup(
        rows,
        fx,
        {"create_date": "creation_date", "currency_code": "currency_iso_cd"},
        {c: c for c in ("date_create_key", "exch_per_us_dlr_rte", "decimal_positions_qty")},
        "left",
    )
    used: Column = F.col("date_arrival_key").isNotNull()
    if fx_how == "inner":
        used = used & F.col("exch_per_us_dlr_rte").isNotNull()
    local = (
        scaled_amount("base_amount", "decimal_places", F.col("decimal_positions_qty"), zero_places_as_one)
        * F.col("exch_per_us_dlr_rte").cast("double")
    ).cast(RATED)
    weight = F.col("weight").cast("decimal(10,0)")
    rules = record_rules()
    marked = rows.withColumns(
        {
            "used": used,
            "arrival": F.when(used, F.col("date_arrival_key")),
            "local": F.when(used, local * weight).cast(RATED),
            "base": F.when(used, money("base_amount") * weight).cast("decimal(28,2)"),
            "one": F.when(used, F.col("weight")).otherwise(0).cast("long"),
            **{f"r{i}": F.coalesce(r.broken, F.lit(False)).cast("int") for i, r in enumerate(rules)},
        }
    )
    summed = counted_values(
        marked.drop("property_id"),
        [*NATURAL_KEY],
        "arrival",
        "date_arrival_key",
        sums={"baseAmountLocal": F.col("local"), "baseAmount": F.col("base"), "used_rows": F.col("one")},
        maxes={"create_key": F.when(F.col("used"), F.col("date_create_key")),
               **{f"r{i}": F.col(f"r{i}") for i in range(len(rules))}},
        weight=F.col("one"),
    )
    return summed.filter(F.col("used_rows") > 0).select(
        *NATURAL_KEY,
        F.col("create_key").alias("date_create_key"),
        "baseAmountLocal",
        "baseAmount",
        "date_arrival_key",
        _errors([(r, F.col(f"r{i}") > 0) for i, r in enumerate(rules)]).alias("errorDescription"),
    )


def parse_reservations(messages: DataFrame, dims: Dimensions, align: str = "position", fx_how: str = "inner",
                       zero_places_as_one: bool = False) -> DataFrame:
    """Every message with keys, amounts, arrival keys and errors.

    ``date_arrival_key`` is an array of (arrival, n), see
    ``aggregates.counted_values``.
    """
    keyed = with_keys(messages, dims.properties)
    amounts = reservation_amounts(keyed, dims, align, fx_how, zero_places_as_one)
    return join_back(keyed, amounts, NATURAL_KEY)


# --- flat form and field validation -------------------------------------------------


def flatten_reservations(messages: DataFrame) -> DataFrame:
    """One row per position of confirmations, segments and pools, with the guest's first names.

    Guests are matched by position as well; every name of the guest at a
    position gives a row of its own.
    """
    zipped = explode_aligned(
        messages.withColumn("confirmations", F.col("reservation.reservationConfirmations")),
        {"confirmation": "confirmations", "segment": "reservationSegments", "pool": "roomPools", "g": "guest"},
        keep_short=False,
    )
    named = explode_path(zipped.withColumn("g", F.col("g.profiles.customer")), "g.name", "guest_name")
    return named.select(
        F.substring("reservation.creationDateTime", 1, 10).try_cast("date").alias("create_date"),
        F.col("lastupdatetime").alias("transaction_timestamp"),
        F.col("reservation.creatorID").alias("booking_office"),
        F.col("confirmation.reservationCode").alias("confo_num_orig"),
        F.col("confirmation.reservationCode").alias("confo_num_curr"),
        F.col("confirmation.reservationInstance").alias("reservationInstance"),
        F.col("property.propertyCode").alias("property_code"),
        F.col("guest_name.givenName").alias("guest_name"),
        F.col("pool.roomPoolCode").alias("room_pool"),
        F.col("pool.numberOfUnits").alias("no_of_rooms"),
        F.col("segment.segmentStatus").alias("reservation_status"),
        F.col("segment.startDate").alias("arrival_date"),
        F.col("segment.endDate").alias("end_date"),
        F.col("segment.rate.ratePlanCode").alias("rate_program"),
        F.col("segment.rate.baseRateUnit").alias("base_rate_unit"),
        F.col("segment.rate.baseAmount").alias("revenue"),
        F.col("segment.rate.currencyCode").alias("currency_code"),
        F.col("segment.rate.decimalPlaces").alias("decimal_places"),
    )


def validate_flat(flat: DataFrame) -> DataFrame:
    """Wrong values of the flat form, all rules in one pass."""
    # Field names, texts and accepted first digits.
    return field_errors(
        flat,
        [
            FieldRule("reservationCode", "confo_num_orig", "confo_num_orig doesnt start with 7,8 or 9",
                      ~starts_with_any("confo_num_orig", ("7", "8", "9"))),
            FieldRule("currencyCode", "currency_code", "currency_code is NULL", blank("currency_code")),
            FieldRule("reservationStatus", "reservation_status", "reservation_status is NULL",
                      blank("reservation_status")),
            FieldRule("guest_givenName", "guest_name", "Guest name is NULL", F.col("guest_name").isNull()),
        ],
    )
