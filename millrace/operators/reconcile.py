"""Comparing two versions of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.project import any_differs


def _suffixed(df: DataFrame, suffix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{c}{suffix}") for c in df.columns])


def side_by_side(a: DataFrame, b: DataFrame, key: str, suffixes: tuple[str, str] = ("_a", "_b"), how: str = "left") -> DataFrame:
    """Both versions of each row of ``a``; columns carry a suffix."""
    left, right = _suffixed(a, suffixes[0]), _suffixed(b, suffixes[1])
    return left.join(right, left[f"{key}{suffixes[0]}"] == right[f"{key}{suffixes[1]}"], how)


def diff_rows(a: DataFrame, b: DataFrame, key: str, pairs: Sequence[tuple[str, str]], null_safe: bool = True,
              suffixes: tuple[str, str] = ("_a", "_b")) -> DataFrame:
    """Rows present in both versions with any differing column.

    ``null_safe=False`` overlooks NULL against a value, as ``<>`` does.
    """
    both = side_by_side(a, b, key, suffixes, "inner")
    return both.filter(
        any_differs([(F.col(x + suffixes[0]), F.col(y + suffixes[1])) for x, y in pairs], null_safe)
    )


def match_events(events: DataFrame, export: DataFrame, left: str, right: str, cols: Sequence[str | Column] = ()) -> DataFrame:
    """Columns of ``events`` for every matching row of another system's export."""
    side = export.select(F.col(right).alias("__ref"), *cols)
    return events.join(side, events[left] == side["__ref"]).drop("__ref")
