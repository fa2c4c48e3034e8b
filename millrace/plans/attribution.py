"""Attribution of bookings: stays x allocations -> match -> qualified rows -> flag."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.keys import surrogate_key
from millrace.operators.aggregates import attribute_amounts
from millrace.operators.joins import double_match
from millrace.operators.maintain import qualify, set_flag
from millrace.operators.quality import Check, NotInTarget, SumsAtMost, SumsTo, Unique, check_report
from millrace.operators.windows import pick_first

STAY_KEY = ("confo_num_orig_id", "confo_num_curr_id", "date_create_key", "property_cd", "arrival_dt")
SHARE_KEY = ("confo_num_orig_id", "confo_num_curr_id", "date_create_key", "arrival_dt")
BOOKING = ("confo_num_orig_id", "date_create_key")
RECORD_KEY = (*SHARE_KEY, "market_cd", "camp_source_abrv_txt", "atrb_id")
# Accepted source prefixes.
PREFIXES = ("AFF", "PAI", "REF")
# Rows of one booking that a task takes without harm, and rows that one should have to sort.
BOOKING_ROWS = 500_000
PART_ROWS = 100_000


def collapse_stays(stays: DataFrame) -> DataFrame:
    """One row per booking: the first market code, lowest stay key and booking id on ties."""
    first = pick_first(stays, STAY_KEY, ["market_cd", "atrb_stay_key", "book_id"])
    return first.select(
        "market_cd", *STAY_KEY, F.coalesce("book_id", F.lit("")).alias("book_id"), "atrb_stay_key"
    )


def booking_parts(*frames: DataFrame) -> int | None:
    """Parts to deal the frames by booking; None where a booking may have more than ``BOOKING_ROWS`` rows.

    Runs a job over the booking columns of each frame. Rows are counted by a hash
    of the booking, so a frame of very many rows may be taken for one with large
    bookings.
    """
    most = 0
    for df in frames:
        counted = df.select(*BOOKING).dropna().groupBy(F.pmod(F.xxhash64(*BOOKING), F.lit(16_384))).agg(F.count(F.lit(1)).alias("n"))
        found = counted.agg(F.max("n").alias("largest"), F.sum("n").alias("rows")).first()
        if (found.largest or 0) > BOOKING_ROWS:
            return None
        most = max(most, found.rows or 0)
    return -(-most // PART_ROWS) or 1


def match_stays(stays: DataFrame, allocations: DataFrame, load_ts: dt.datetime | Column, parts: int | None = None) -> DataFrame:
    """Stays with their allocations, shares summed per three-letter source.

    Collapsed stays are unique, so summing allocations per (booking, source, id)
    before the join gives the same rows as grouping the joined rows by all stay
    columns, with one small aggregate instead of one over the join result.

    With ``parts``, see ``booking_parts``, both sides are dealt by booking once,
    where each would be shuffled for its grouping and again for the join. A
    booking is then in one task.
    """
    if parts is not None:
        stays, allocations = stays.repartition(parts, *BOOKING), allocations.repartition(parts, *BOOKING)
    shares = attribute_amounts(
        allocations,
        [*BOOKING, "atrb_id"],
        "camp_source_drvd_txt",
        "atrb_amt",
        "atrb_allocation_key",
        "camp_source_abrv_txt",
    )
    joined = collapse_stays(stays).join(shares, list(BOOKING))
    ts = load_ts if isinstance(load_ts, Column) else F.lit(load_ts)
    return joined.select(
        surrogate_key("atrb_allocation_key", "atrb_stay_key").alias("atrb_key"),
        "atrb_allocation_key",
        "atrb_stay_key",
        "confo_num_orig_id",
        "confo_num_curr_id",
        "date_create_key",
        "property_cd",
        "camp_source_abrv_txt",
        "atrb_id",
        "book_id",
        "arrival_dt",
        "market_cd",
        "atrb_amt",
        F.lit(False).alias("flag"),
        ts.alias("dw_load_ts"),
    )


def match_checks(target: DataFrame | None = None) -> list[Check]:
    """Checks of the match table; with ``target`` also that nothing is loaded twice."""
    checks: list[Check] = [
        Unique(("atrb_allocation_key", "atrb_stay_key"), "DUPLICATE_BUSINESS_KEY"),
        Unique(RECORD_KEY, "DUPLICATE_CCC_KEY"),
        Unique(("atrb_key",), "DUPLICATE_PRIMARY_KEY"),
        SumsTo(SHARE_KEY, "atrb_amt", 100, "INVALID_ATRB_ALLOCATION_AMT"),
    ]
    if target is not None:
        checks += [
            NotInTarget(target, ("atrb_allocation_key", "atrb_stay_key"), "BUSINESS_KEY_EXISTS"),
            NotInTarget(target, RECORD_KEY, "CCC_KEY_EXISTS", (("atrb_id", ""),)),
            NotInTarget(target, ("atrb_key",), "PRIMARY_KEY_EXISTS"),
        ]
    return checks


def qualified_rows(match: DataFrame, agencies: DataFrame, prefixes: Sequence[str] = PREFIXES) -> DataFrame:
    """Match rows whose booking and attributed ids are both active, for the accepted sources.

    ``agencies`` has agency_id, source_txt, active_ind; an id may be listed
    several times without multiplying rows.
    """
    return qualify(
        match,
        agencies,
        {"book_id": "agency_id"},
        {"atrb_id": "agency_id", "camp_source_abrv_txt": "source_txt"},
        F.col("active_ind") == "A",
        "camp_source_abrv_txt",
        prefixes,
    ).drop("atrb_allocation_key", "flag")


def daily_checks(target: DataFrame | None = None) -> list[Check]:
    """Checks of the daily table."""
    checks: list[Check] = [
        Unique(RECORD_KEY, "DUPLICATE_BUSINESS_KEY"),
        Unique(("atrb_key",), "DUPLICATE_PRIMARY_KEY"),
        SumsAtMost(SHARE_KEY, "atrb_amt", 100, "INVALID_ATRB_ALLOCATION_AMT"),
    ]
    if target is not None:
        checks += [
            NotInTarget(target, ("atrb_stay_key",), "BOOKING_STAY_KEY_EXISTS"),
            NotInTarget(target, RECORD_KEY, "BUSINESS_KEY_EXISTS"),
            NotInTarget(target, ("atrb_key",), "PRIMARY_KEY_EXISTS"),
        ]
    return checks


def flag_qualified(match: DataFrame, agencies: DataFrame, prefixes: Sequence[str] = PREFIXES) -> DataFrame:
    """Match table with the flag set on its qualified rows, in one pass.

    Gives what ``flag_daily`` gives when ``atrb_key`` is unique, which is one of
    the checks, without computing the match table a second time.
    """
    marked = double_match(
        match,
        agencies,
        {"book_id": "agency_id"},
        {"atrb_id": "agency_id", "camp_source_abrv_txt": "source_txt"},
        F.col("active_ind") == "A",
        "__qualified",
    )
    hit = F.col("__qualified") & F.substring("camp_source_abrv_txt", 1, 3).isin(*prefixes)
    return marked.withColumn("flag", F.col("flag") | hit).select(*match.columns)


def flag_daily(match: DataFrame, daily: DataFrame, daily_rows: int | None = None) -> DataFrame:
    """Match table with the flag set on rows that went into the daily table; ``daily_rows`` is their number, if known."""
    return set_flag(match, daily, "atrb_key", "flag", daily_rows)


@dataclass(frozen=True)
class Attribution:
    match: DataFrame
    match_report: DataFrame
    daily: DataFrame
    daily_report: DataFrame
    flagged: DataFrame


def attribution(stays: DataFrame, allocations: DataFrame, agencies: DataFrame, load_ts: dt.datetime | Column) -> Attribution:
    """All steps as plans. ``plans.loads.load_attribution`` writes them."""
    match = match_stays(stays, allocations, load_ts)
    daily = qualified_rows(match, agencies)
    return Attribution(
        match,
        check_report(match, match_checks(), "match"),
        daily,
        check_report(daily, daily_checks(), "daily"),
        flag_qualified(match, agencies),
    )
