"""Counts, totals and roll-ups.

Every aggregate here is one that Spark combines before the shuffle, so a key
that holds a large share of the rows sends one partial row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.dates import year_month
from millrace.functions.money import money, money_total


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def conditional_counts(df: DataFrame, counts: Mapping[str, Column], by: Sequence[str | Column] = (),
                       total: str = "total") -> DataFrame:
    """Row count plus one conditional count per predicate, in one pass."""
    aggs = [F.count(F.lit(1)).alias(total), *[F.count_if(p).alias(n) for n, p in counts.items()]]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def count_by(df: DataFrame, keys: Sequence[str | Column], name: str = "n") -> DataFrame:
    """Grouped count, largest first."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).orderBy(F.col(name).desc())


def value_counts(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Frequency of the non-NULL values of a column, most frequent first."""
    return count_by(df.filter(F.col(column).isNotNull()), [column], name)


def monthly_total(df: DataFrame, ts: str | Column, amount: str | Column, month: str = "month",
                  total: str = "total_amount") -> DataFrame:
    """Sum per calendar month, rounded to 2 places, in month order."""
    return df.groupBy(year_month(ts).alias(month)).agg(money_total(amount).alias(total)).orderBy(month)


def duplicate_groups(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).filter(F.col(name) > 1)


def share_violations(df: DataFrame, keys: Sequence[str], amount: str, op: str = "!=", total: int = 100,
                     name: str = "total") -> DataFrame:
    """Groups whose rounded sum is not (``!=``) or exceeds (``>``) the expected total."""
    rounded = F.col("__rounded")
    wrong = {"!=": rounded != total, ">": rounded > total}[op]
    return (
        df.groupBy(*keys)
        .agg(F.sum(money(amount)).alias(name))
        .withColumn("__rounded", F.round(name, 0))
        .filter(wrong)
        .drop("__rounded")
    )


def counted_values(df: DataFrame, keys: Sequence[str], value: str, into: str, sums: Mapping[str, Column] | None = None,
                   maxes: Mapping[str, Column] | None = None, weight: Column | None = None) -> DataFrame:
    """Sums and maxima per key plus the values seen, as a sorted array of (value, n).

    The array stands for the plain list of values (``arrays.repeat_counted``
    expands it) but grows with the number of different values, not with the
    rows of the key. Rows are first combined per (key, value).
    """
    sums, maxes = sums or {}, maxes or {}
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    per_value = df.groupBy(*keys, value).agg(
        n.cast("long").alias("n"),
        *[F.sum(c).alias(s) for s, c in sums.items()],
        *[F.max(c).alias(m) for m, c in maxes.items()],
    )
    listed = F.collect_list(F.when(F.col(value).isNotNull(), F.struct(F.col(value), F.col("n"))))
    return per_value.groupBy(*keys).agg(
        *[F.sum(s).alias(s) for s in sums], *[F.max(m).alias(m) for m in maxes], F.array_sort(listed).alias(into)
    )


def rollup_amounts(df: DataFrame, keys: Sequence[str], amounts: Sequence[str], value: str, into: str) -> DataFrame:
    """Money sums and the list of distinct values with counts per natural key."""
    return counted_values(df, keys, value, into, {a: money(a) for a in amounts})


def crosstab(df: DataFrame, a: str, b: str, values: Sequence[object] | None = None) -> DataFrame:
    """Counts of ``a`` x ``b``: long form, or one column per value when ``values`` is given."""
    if values is None:
        return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    return df.groupBy(a).pivot(b, list(values)).count().na.fill(0, [str(v) for v in values])


def attribute_amounts(allocations: DataFrame, keys: Sequence[str], source: str, amount: str, key: str,
                      source_as: str, prefix: int = 3) -> DataFrame:
    """Largest key and summed amount per ``keys`` and source prefix."""
    return allocations.groupBy(*keys, F.substring(source, 1, prefix).alias(source_as)).agg(
        F.max(key).alias(key), F.sum(money(amount)).alias(amount)
    )
