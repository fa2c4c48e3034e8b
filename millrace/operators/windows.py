"""Running totals, ranks, first rows.

A window puts all rows of a partition into one task. When a few partitions hold
a large share of the data that task decides the run time, so the running
operators look for oversized groups first (one combined count per key, a job of
its own) and treat them separately:

1. the rows of oversized groups are range-partitioned on (group, order), which
   cuts a group into consecutive blocks, and written to the checkpoint folder
   together with their block number;
2. a window runs inside each block;
3. block totals (at most one row per block and group) are accumulated in block
   order and added to every row of the block.

The result is the same as one window over the whole group, for integers, decimals
and everything that is compared; sums of doubles are added in another order and
can differ in their last digits, so give decimals where that matters. All other
rows take the ordinary window.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import ensure_checkpoint_dir

MAX_GROUP_ROWS = 5_000_000


@dataclass(frozen=True)
class Measure:
    """A running aggregate that can be continued from a carried value."""

    name: str
    kind: str  # sum, min, max
    value: Column

    def local(self) -> Column:
        return {"sum": F.sum, "min": F.min, "max": F.max}[self.kind](self.value)

    def total(self) -> Column:
        return self.local().alias(self.name)

    def merge(self, carried: Column, local: Column) -> Column:
        if self.kind == "sum":
            return F.when(carried.isNull(), local).when(local.isNull(), carried).otherwise(carried + local)
        return (F.least if self.kind == "min" else F.greatest)(carried, local)


def oversized_groups(df: DataFrame, by: Sequence[str], max_rows: int) -> list[tuple]:
    """Groups with more than ``max_rows`` rows, as (key..., rows). Runs a job.

    The list is short by construction: at most all rows / ``max_rows`` entries.
    """
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > max_rows)
    return [tuple(r) for r in sizes.collect()]


def _split(df: DataFrame, by: Sequence[str], hot: list[tuple]) -> tuple[DataFrame, DataFrame]:
    schema = T.StructType([T.StructField(f"__k{i}", df.schema[b].dataType) for i, b in enumerate(by)])
    keys = df.sparkSession.createDataFrame([h[: len(by)] for h in hot], schema)
    cond = reduce(Column.__and__, [df[b].eqNullSafe(keys[f"__k{i}"]) for i, b in enumerate(by)])
    return df.join(keys, cond, "left_semi"), df.join(keys, cond, "left_anti")


def _blocks(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    ranged = df.repartitionByRange(n, *[F.col(b) for b in by], *order)
    # The block number must not change when a lost task is run again or when the
    # frame is read twice, hence the checkpoint.
    return ranged.withColumn("__block", F.spark_partition_id()).checkpoint()


def prefix_scan(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    measures: Sequence[Measure],
    max_group_rows: int = MAX_GROUP_ROWS,
    hot: list[tuple] | None = None,
) -> DataFrame:
    """Add running aggregates, rows from the start of the group to the current row.

    ``order`` must be a total order inside a group.
    """
    if hot is None:
        hot = oversized_groups(df, by, max_group_rows)

    def running(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return frame.withColumns({m.name: m.local().over(w) for m in measures})

    if not hot:
        return running(df, by)

    big, small = _split(df, by, hot)
    n = sum(math.ceil(h[-1] / max_group_rows) for h in hot) * 2
    blocks = _blocks(big, by, order, n)
    totals = blocks.groupBy(*by, "__block").agg(*[m.total() for m in measures])
    before = Window.partitionBy(*by).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    agg = {"sum": F.sum, "min": F.min, "max": F.max}
    carried = totals.select(
        *[F.col(b).alias(f"__k{i}") for i, b in enumerate(by)],
        F.col("__block").alias("__b"),
        *[agg[m.kind](m.name).over(before).alias(f"__{m.name}") for m in measures],
    )
    local = running(blocks, [*by, "__block"])
    cond = (local["__block"] == carried["__b"]) & reduce(
        Column.__and__, [local[b].eqNullSafe(carried[f"__k{i}"]) for i, b in enumerate(by)]
    )
    merged = local.join(carried, cond, "inner").withColumns(
        {
            m.name: m.merge(F.col(f"__{m.name}"), F.col(m.name)).cast(local.schema[m.name].dataType)
            for m in measures
        }
    )
    columns = [*df.columns, *[m.name for m in measures]]
    return merged.select(*columns).unionByName(running(small, by).select(*columns))


def _order(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def running_stats(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str | Column],
    column: str,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Running min, max, sum and average of ``column``.

    ``order`` is required and must be total; without it the result would depend
    on how the rows happen to be stored. Give decimals for exact sums.
    """
    value = F.col(column)
    names = {k: f"{column}_{k}" for k in ("min", "max", "sum", "avg")}
    out = prefix_scan(
        df,
        by,
        _order(order),
        [
            Measure(names["min"], "min", value),
            Measure(names["max"], "max", value),
            Measure(names["sum"], "sum", value),
            Measure("__seen", "sum", value.isNotNull().cast("long")),
        ],
        max_group_rows,
    )
    avg = F.when(F.col("__seen") > 0, F.col(names["sum"]).cast("double") / F.col("__seen"))
    return out.withColumn(names["avg"], avg).drop("__seen")


def rank_columns(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    tie_break: Sequence[str] = (),
    descending: bool = False,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add srank, drank, prank (2 places) and rn.

    Ranks follow ``order``; the row number also uses ``tie_break``, which should
    make the order total.
    """
    keys = [F.col(o).desc() if descending else F.col(o).asc() for o in order]
    ties = [F.col(t).asc() for t in tie_break]
    hot = oversized_groups(df, by, max_group_rows)

    def plain(frame: DataFrame) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(*keys)
        rows = Window.partitionBy(*by).orderBy(*keys, *ties)
        return frame.withColumns(
            {
                "srank": F.rank().over(w).cast("long"),
                "drank": F.dense_rank().over(w).cast("long"),
                "prank": F.round(F.percent_rank().over(w), 2),
                "rn": F.row_number().over(rows).cast("long"),
            }
        )

    if not hot:
        return plain(df)
    big, small = _split(df, by, hot)
    # Tied rows share their ranks, so ranks are computed once per distinct order
    # value: a value that fills a third of a group is a single row here.
    values = big.groupBy(*by, *order).agg(F.count(F.lit(1)).alias("__n"))
    ranked = prefix_scan(
        values,
        by,
        keys,
        [Measure("__upto", "sum", F.col("__n")), Measure("drank", "sum", F.lit(1).cast("long"))],
        max_group_rows,
    )
    sizes = {f"__k{i}": df.schema[b].dataType for i, b in enumerate(by)}
    schema = T.StructType([*[T.StructField(k, t) for k, t in sizes.items()], T.StructField("__total", T.LongType())])
    totals = df.sparkSession.createDataFrame(hot, schema)
    ranked = ranked.join(
        totals,
        reduce(Column.__and__, [ranked[b].eqNullSafe(totals[f"__k{i}"]) for i, b in enumerate(by)]),
    )
    rank = F.col("__upto") - F.col("__n") + 1
    ranked = ranked.select(
        *[F.col(c).alias(f"__j_{c}") for c in [*by, *order]],
        rank.alias("srank"),
        "drank",
        F.round(F.when(F.col("__total") > 1, (rank - 1) / (F.col("__total") - 1)).otherwise(F.lit(0.0)), 2).alias("prank"),
    )
    numbered = prefix_scan(big, by, [*keys, *ties], [Measure("rn", "sum", F.lit(1).cast("long"))], max_group_rows, hot)
    cond = reduce(Column.__and__, [numbered[c].eqNullSafe(ranked[f"__j_{c}"]) for c in [*by, *order]])
    columns = [*df.columns, "srank", "drank", "prank", "rn"]
    return numbered.join(ranked, cond).select(*columns).unionByName(plain(small).select(*columns))


def mark_occurrences(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str | Column],
    name: str = "is_first",
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add the occurrence number and a flag for the first one."""
    out = prefix_scan(
        df, by, _order(order), [Measure("occurrence", "sum", F.lit(1).cast("long"))], max_group_rows
    )
    return out.withColumn(name, F.col("occurrence") == 1)


def lead_value(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str | Column],
    column: str,
    into: str,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Value of the next row of the group; ``order`` must be total.

    Oversized groups are cut into blocks; the last row of a block takes the
    first value of the group's next block.
    """
    keys = _order(order)
    hot = oversized_groups(df, by, max_group_rows)

    def plain(frame: DataFrame, group: Sequence[str]) -> DataFrame:
        return frame.withColumn(into, F.lead(column).over(Window.partitionBy(*group).orderBy(*keys)))

    if not hot:
        return plain(df, by)
    big, small = _split(df, by, hot)
    n = sum(math.ceil(h[-1] / max_group_rows) for h in hot) * 2
    group = [*by, "__block"]
    blocks = _blocks(big, by, keys, n)
    firsts = pick_first(blocks, group, keys).select(*group, F.struct(F.col(column).alias("v")).alias("__first"))
    w = Window.partitionBy(*by).orderBy("__block")
    follow = firsts.select(
        *[F.col(b).alias(f"__k{i}") for i, b in enumerate(by)],
        F.col("__block").alias("__b"),
        F.lead("__first").over(w).alias("__next"),
    )
    local = blocks.withColumns(
        {
            into: F.lead(column).over(Window.partitionBy(*group).orderBy(*keys)),
            "__last": F.lead(F.lit(1)).over(Window.partitionBy(*group).orderBy(*keys)).isNull(),
        }
    )
    cond = (local["__block"] == follow["__b"]) & reduce(
        Column.__and__, [local[b].eqNullSafe(follow[f"__k{i}"]) for i, b in enumerate(by)]
    )
    joined = local.join(follow, cond).withColumn(
        into, F.when(F.col("__last"), F.col("__next.v")).otherwise(F.col(into))
    )
    columns = [*df.columns, into]
    return joined.select(*columns).unionByName(plain(small, by).select(*columns))


def pick_first(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], cols: Sequence[str] | None = None) -> DataFrame:
    """One row per group: the first in ``order``.

    Spark cuts each group to one row per task before the shuffle
    (WindowGroupLimit), so a large group costs no more than a small one there.
    """
    w = Window.partitionBy(*by).orderBy(*_order(order))
    first = df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")
    return first.select(*by, *[c for c in cols if c not in by]) if cols else first
