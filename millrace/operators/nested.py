"""Arrays and structs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_product(df: DataFrame, cols: Mapping[str, str]) -> DataFrame:
    """Explode arrays one after another: every combination inside a row.

    ``cols`` is {new column: array column}. The product is per row; sums over it
    are cheaper with a weight (see ``plans.reservations``).
    """
    return reduce(lambda d, kv: d.withColumn(kv[0], F.explode(kv[1])), cols.items(), df)


def explode_aligned(df: DataFrame, cols: Mapping[str, str], keep_short: bool = True, position: str | None = None) -> DataFrame:
    """Explode arrays side by side, matched by position.

    ``keep_short`` pads shorter arrays with NULL; otherwise rows stop at the
    shortest array. A missing array is an empty one.
    """
    arrays = [F.coalesce(F.col(a), F.array().cast(df.schema[a].dataType)) for a in cols.values()]
    zipped = F.arrays_zip(*[a.alias(f"v{i}") for i, a in enumerate(arrays)])
    if not keep_short:
        sizes = [F.size(a) for a in arrays]
        zipped = F.slice(zipped, F.lit(1), F.least(*sizes) if len(sizes) > 1 else sizes[0])
    base = df.select("*", F.posexplode(zipped).alias("__pos", "__z"))
    out = base.withColumns({new: F.col(f"__z.v{i}") for i, new in enumerate(cols)})
    if position:
        out = out.withColumn(position, F.col("__pos"))
    return out.drop("__pos", "__z")


def explode_path(df: DataFrame, path: str, into: str) -> DataFrame:
    """Explode every array on a dotted path, e.g. guest.profiles.customer.name.

    Each step that is an array multiplies rows; the last value lands in ``into``.
    """
    head, *rest = path.split(".")
    out = df.withColumn(into, F.col(head))
    for step in [*rest, None]:
        if out.schema[into].dataType.typeName() == "array":
            out = out.withColumn(into, F.explode(into))
        if step is not None:
            out = out.withColumn(into, F.col(into)[step])
    return out


def explode_errors(df: DataFrame, column: str = "errorDescription", into: str = "errorDesc") -> DataFrame:
    """One row per recorded error; clean records give no row."""
    return df.withColumn(into, F.explode(column)).drop(column)


def pairs(**fields: str | Column) -> Column:
    """Named struct."""
    return F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in fields.items()])


def present(items: Sequence[Column]) -> Column:
    """Array of the items that are not NULL."""
    return F.array_compact(F.array(*items))
