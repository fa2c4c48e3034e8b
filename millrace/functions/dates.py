"""Date columns. No function reads the clock; load times are arguments."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def year_month(column: str | Column) -> Column:
    return F.date_format(column, "yyyyMM")


def date_key(column: str | Column) -> Column:
    """Date as the integer yyyymmdd."""
    d = F.col(column) if isinstance(column, str) else column
    d = d.cast("date")
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def audit_label(year: str | Column, month: str | Column, day: str | Column, sep: str = "-") -> Column:
    """Date label from three numbers, month and day padded to two digits."""
    y, m, d = (c if isinstance(c, Column) else F.col(c) for c in (year, month, day))
    return F.concat(
        y.cast("string"), F.lit(sep), F.lpad(m.cast("string"), 2, "0"), F.lit(sep), F.lpad(d.cast("string"), 2, "0")
    )


def text_date(column: str | Column, fmt: str | None = None) -> Column:
    """Text to date; unreadable text becomes NULL instead of failing the job."""
    c = F.col(column) if isinstance(column, str) else column
    return F.try_to_date(c, fmt) if fmt else c.try_cast("date")


def date_parts(df: DataFrame, column: str) -> DataFrame:
    """Add month label, truncations and calendar positions of a date or timestamp."""
    c = F.col(column)
    return df.withColumns(
        {
            f"{column}_ym": year_month(c),
            f"{column}_date": c.cast("date"),
            f"{column}_month_start": F.trunc(c, "MM"),
            f"{column}_year_start": F.trunc(c, "yyyy"),
            f"{column}_month": F.month(c),
            f"{column}_dom": F.dayofmonth(c),
            f"{column}_doy": F.dayofyear(c),
            f"{column}_dow": F.dayofweek(c),
        }
    )


def month_math(df: DataFrame, later: Column, earlier: str, months: int = 3, days: int = 2) -> DataFrame:
    """Add month distance, day distance and shifted dates of ``earlier``.

    ``later`` is an argument (a literal run date, or a column) so that results
    can be reproduced.
    """
    e = F.col(earlier)
    return df.withColumns(
        {
            f"{earlier}_months": F.round(F.months_between(later, e), 2),
            f"{earlier}_days": F.datediff(later, e),
            f"{earlier}_plus": F.add_months(e, months),
            f"{earlier}_minus": F.date_sub(e, days),
        }
    )


def stamp(df: DataFrame, ts: dt.datetime | Column | None = None, name: str = "dw_load_ts") -> DataFrame:
    """Add the load time. ``None`` takes the query's own start time."""
    value = F.current_timestamp() if ts is None else ts if isinstance(ts, Column) else F.lit(ts)
    return df.withColumn(name, value)


def calendar_of(df: DataFrame, column: str, ahead: int = 0) -> DataFrame:
    """Date dimension over all days between the first and the last date of a column, and ``ahead`` more."""
    span = df.agg(F.min(column).alias("a"), F.max(column).alias("z"))
    day = F.explode(F.sequence("a", F.date_add("z", ahead)))
    return span.select(day.alias("date_dt")).select(date_key("date_dt").alias("date_key"), "date_dt")


def calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    """Date dimension (date_key, date_dt, year_acctg), one row per day.

    Built from a row range, so its size is known to the optimizer.
    """
    start = dt.date.fromisoformat(first)
    n_days = (dt.date.fromisoformat(last) - start).days + 1
    d = F.date_add(F.lit(start), F.col("id").cast("int"))
    return spark.range(n_days).select(
        date_key(d).alias("date_key"), d.alias("date_dt"), F.year(d).alias("year_acctg")
    )
