"""Amounts. Sums and rounding are done on decimals, never on binary floats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
RATED = "decimal(28,6)"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(column: str | Column) -> Column:
    return _col(column).cast(MONEY)


def money_total(column: str | Column, places: int = 2) -> Column:
    """Aggregate: exact sum, rounded half up."""
    return F.round(F.sum(money(column)), places)


def scaled_amount(amount: str | Column, places: str | Column, default: str | Column | int = 2,
                  zero_places_as_one: bool = False) -> Column:
    """Minor units to units: amount / 10^places, with a default for missing places.

    ``zero_places_as_one`` treats a stated 0 as 1, as one of the two known
    forms of this rule does.
    """
    p = _col(places)
    if zero_places_as_one:
        p = F.when(p == 0, F.lit(1)).otherwise(p)
    fallback = F.lit(default) if isinstance(default, int) else _col(default)
    return _col(amount).cast("double") / F.pow(F.lit(10.0), F.coalesce(p, fallback).cast("double"))


def implied_decimals(column: str | Column, digits: int = 2) -> Column:
    """Text of digits with an implied decimal point, e.g. '09960' -> 99.60."""
    return (_col(column).try_cast("decimal(18,0)") / F.lit(10**digits).cast("decimal(10,0)")).cast(
        f"decimal(18,{digits})"
    )
