"""Event reports: two systems compared, monthly refunds, windows over impacts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.dates import audit_label, year_month
from millrace.functions.money import money, money_total
from millrace.operators.reconcile import match_events
from millrace.operators.windows import mark_occurrences, rank_columns, running_stats

FINISHED = ("COMPLETE", "CLOSED")


def monthly_refunds(events: DataFrame, export: DataFrame, key: str = "event_reference_id",
                    status: str = "event_status", finished: Sequence[str] = FINISHED,
                    ts: str = "event_date", amount: str = "event_refund", export_key: str | None = None,
                    month: str = "event_month", total: str = "total_refund") -> DataFrame:
    """Refund per month over finished events that the other system knows too.

    Both sides are reduced to one row per reference before they are joined, so
    a reference with very many events or exports is a single row in the join:
    the export contributes its number of matching rows as a factor.
    """
    export_key = export_key or key
    matches = export.groupBy(F.col(export_key).alias("__ref")).agg(F.count(F.lit(1)).alias("__matches"))
    refunds = (
        events.filter(F.col(status).isin(*finished))
        .groupBy(key, year_month(ts).alias(month))
        .agg(F.sum(money(amount)).alias("__sum"))
    )
    joined = refunds.join(matches, refunds[key] == matches["__ref"])
    return (
        joined.groupBy(month)
        .agg(F.round(F.sum(F.col("__sum") * F.col("__matches").cast("decimal(18,0)")), 2).alias(total))
        .orderBy(month)
    )


def monthly_line_amounts(orders: DataFrame, lines: DataFrame, statuses: Sequence[str] = ("F", "O")) -> DataFrame:
    """Line amount per order month, for orders in the given states.

    Lines are summed per order first: that shuffle is the one the join needs
    anyway, and it leaves one row per order.
    """
    per_order = lines.groupBy("l_orderkey").agg(F.sum(money("l_extendedprice")).alias("amount"))
    return (
        orders.filter(F.col("o_orderstatus").isin(*statuses))
        .join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy(year_month("o_orderdate").alias("order_month"))
        .agg(F.round(F.sum("amount"), 2).alias("total_amount"))
        .orderBy("order_month")
    )


def event_counts(events: DataFrame, export: DataFrame, origin: str = "Origin",
                 reference: str = "event_reference_id", name: str = "Event_count") -> DataFrame:
    """Matched events per origin, most first.

    Each side is counted per key and the counts multiplied, which is what
    counting the joined rows gives.
    """
    left = events.groupBy(origin).agg(F.count(F.lit(1)).alias("__a"))
    right = export.groupBy(F.col(reference).alias("__ref")).agg(F.count(F.lit(1)).alias("__b"))
    return (
        left.join(right, left[origin] == right["__ref"])
        .select(origin, (F.col("__a") * F.col("__b")).alias(name))
        .orderBy(F.col(name).desc())
    )


def matched_events(events: DataFrame, export: DataFrame, origin: str = "Origin",
                   reference: str = "event_reference_id") -> DataFrame:
    """All event columns, once per matching export row."""
    return match_events(events, export, origin, reference)


def impact_base(impacts: DataFrame) -> DataFrame:
    """Active refunded impacts with their audit date and numeric repeat count."""
    return impacts.filter("Event_refunded = 'YES' and Event_status = 'Active'").select(
        "EventMonth",
        audit_label("Year", "Month", "DayOfMonth", sep="").alias("Audit_date"),
        "Origin",
        "LoanId",
        "Event_originator",
        "Impact_date",
        money("Impact_amount").alias("Impact_amount"),
        "Remediation_date",
        "Payment_date",
        F.col("number_of_impacts").try_cast("int").alias("multiple_impacts"),
    )


def impact_running_amounts(impacts: DataFrame, order: Sequence[str] = ("Impact_date", "LoanId")) -> DataFrame:
    return running_stats(impact_base(impacts), ["EventMonth", "Origin"], order, "Impact_amount")


def impact_ranks(impacts: DataFrame, order: Sequence[str] = ("Impact_date",), tie_break: Sequence[str] = ("LoanId",)) -> DataFrame:
    return rank_columns(impact_base(impacts), ["EventMonth", "Origin"], order, tie_break)


def impact_occurrences(impacts: DataFrame, order: Sequence[str] = ("Impact_date", "EventMonth", "Origin")) -> DataFrame:
    """First and repeated impacts of a loan."""
    return mark_occurrences(impact_base(impacts), ["LoanId"], order)


def refund_total(events: DataFrame, amount: str) -> DataFrame:
    return events.agg(money_total(amount).alias("total"))
