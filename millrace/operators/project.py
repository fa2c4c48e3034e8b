"""Projection, padding, union and row filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_as(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Select and rename: ``{new: old}``."""
    return df.select(*[F.col(old).alias(new) for new, old in names.items()])


def with_columns(df: DataFrame, **exprs: Column) -> DataFrame:
    """All columns plus derived ones."""
    return df.withColumns(exprs)


def pad_to(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Give ``df`` exactly these columns and types; missing ones are NULL."""
    have = set(df.columns)
    return df.select(
        *[(F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in types.items()]
    )


def union_padded(*dfs: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """UNION ALL of frames with different columns, padded with NULLs."""
    return reduce(DataFrame.unionByName, [pad_to(d, types) for d in dfs])


def distinct_of(df: DataFrame, *columns: str | Column) -> DataFrame:
    return df.select(*columns).distinct()


def any_differs(pairs: Sequence[tuple[Column, Column]], null_safe: bool = True) -> Column:
    """OR over column pairs. ``null_safe`` also sees NULL against a value."""
    tests = [~a.eqNullSafe(b) if null_safe else a != b for a, b in pairs]
    return reduce(Column.__or__, tests)


def first_match(column: str | Column, mapping: Mapping[str, object], otherwise: object = None) -> Column:
    """CASE over equal values, first match wins."""
    c = F.col(column) if isinstance(column, str) else column
    out = None
    for value, result in mapping.items():
        out = F.when(c == value, F.lit(result)) if out is None else out.when(c == value, F.lit(result))
    return out.otherwise(F.lit(otherwise))


def first_rows(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*order).limit(n)
