"""Keyed maintenance: dedup, upsert, change logs, flags, audit rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.keys import surrogate_key
from millrace.operators.joins import double_lookup, join_back, maybe_in
from millrace.operators.windows import pick_first

# The operations of a change log, weakest first. On equal sequence
# numbers the later entry wins.
OPERATIONS = ("INSERT", "UPDATE", "DELETE")


def dedup(df: DataFrame, keys: Sequence[str] | None = None, order: Sequence[str | Column] | None = None) -> DataFrame:
    """Remove exact duplicates, or keep the first row per key in a stated order."""
    if keys is None:
        return df.distinct()
    if order is None:
        raise ValueError("keeping one row per key needs an order")
    return pick_first(df, keys, order)


def upsert(target: DataFrame, staged: DataFrame, keys: Sequence[str], ts: dt.datetime | Column,
           stamp_col: str = "load_dt") -> DataFrame:
    """Target rows whose key is not staged, plus all staged rows stamped ``ts``.

    Staged rows are taken as they are; run ``quality.Unique`` and
    ``quality.NoNulls`` on the keys first to refuse duplicate or missing keys.
    """
    stamp = ts if isinstance(ts, Column) else F.lit(ts)
    kept = join_back(target, staged.select(*keys).distinct(), keys, "left_anti")
    fresh = staged.withColumn(stamp_col, stamp.cast(target.schema[stamp_col].dataType))
    return kept.unionByName(fresh.select(*target.columns))


def net_change(
    base: DataFrame,
    log: DataFrame,
    keys: Sequence[str],
    seq: str = "header__change_seq",
    op: str = "header__operation",
) -> DataFrame:
    """Base table after a change log: latest entry per key, deleted keys gone.

    Sequence numbers are compared as numbers ('10' after '9'); of equal ones the
    operation decides. Base rows count as INSERT with number 0. An entry whose
    operation is none of the known ones, or NULL, is no row of the table: as the
    latest of its key it removes the key like a DELETE.

    The log is reduced to one row per key first. The base is not sorted; its
    rows are kept when the log does not know their key.
    """
    columns = base.columns
    weight = F.coalesce(F.array_position(F.array(*[F.lit(o) for o in OPERATIONS]), F.upper(F.col(op))), F.lit(0))
    last = pick_first(
        log.withColumns({"__seq": F.col(seq).cast("decimal(38,0)"), "__op": weight}).select(*columns, "__seq", "__op"),
        keys, [F.col("__seq").desc(), F.col("__op").desc()],
    )
    kept = join_back(base, last.select(*keys), keys, "left_anti")
    live = last.filter((F.col("__op") > 0) & (F.col("__op") < len(OPERATIONS)))
    return kept.select(*columns).unionByName(live.select(*columns))


def set_flag(target: DataFrame, matched: DataFrame, key: str, flag: str, matched_rows: int | None = None) -> DataFrame:
    """Set ``flag`` on rows whose key is in ``matched``; nothing else changes.

    ``matched_rows``, where their number is known, spares the other rows the
    join: those that ``joins.maybe_in`` rules out are not shuffled and stay in their
    order. Both tables are then read twice.
    """
    def flagged(rows: DataFrame) -> DataFrame:
        hits = matched.select(key).distinct().withColumn("__hit", F.lit(True))
        joined = join_back(rows, hits, [key], "left")
        return joined.withColumn(flag, F.coalesce("__hit", F.col(flag))).select(*target.columns)

    if matched_rows is None:
        return flagged(target)
    seen = maybe_in(target, matched, key, matched_rows, "__seen")
    rest, mine = (seen.filter(c).select(*target.columns) for c in (~F.col("__seen"), F.col("__seen")))
    return rest.unionByName(flagged(mine))


def qualify(
    match: DataFrame,
    dim: DataFrame,
    first: dict[str, str],
    second: dict[str, str],
    active: Column,
    source: str,
    prefixes: Sequence[str],
) -> DataFrame:
    """Rows with an accepted source prefix whose two ids are both active in the dimension."""
    wanted = match.filter(F.substring(source, 1, 3).isin(*prefixes))
    return double_lookup(wanted, dim, first, second, active)


def batch_date(run_dates: DataFrame, sys_id: str, back: int = 2) -> DataFrame:
    """One row: run date of a system minus some days."""
    return run_dates.filter(F.col("sys_id") == sys_id).agg(F.date_sub(F.max("run_dt"), back).alias("data_batch_dt"))


def audit_row(
    df: DataFrame,
    table: str,
    batch_date: Column | dt.date,
    sys_id: str,
    ts: dt.datetime | Column,
    load_ts: str = "dw_load_ts",
    algo: str = "md5",
) -> DataFrame:
    """The audit row of a load: one pass over the loaded rows.

    The key covers the table name too, so two tables loaded at the same time
    get different keys.
    """
    now = (ts if isinstance(ts, Column) else F.lit(ts)).cast("timestamp")
    batch = (batch_date if isinstance(batch_date, Column) else F.lit(batch_date)).cast("date")
    facts = df.agg(F.max(load_ts).cast("timestamp").alias("__max"), F.count(F.lit(1)).alias("__n"))
    first = F.coalesce(F.col("__max"), now)
    return facts.select(
        surrogate_key(F.lit(table), F.date_format(first, "yyyy-MM-dd HH:mm:ss"), algo=algo).alias("audit_key"),
        first.alias("initial_load_ts"),
        batch.alias("data_batch_dt"),
        F.lit(table).alias("table_nm"),
        F.lit(None).cast("timestamp").alias("min_data_ts"),
        F.lit(None).cast("timestamp").alias("max_data_ts"),
        F.col("__n").alias("record_amt"),
        F.lit(sys_id).alias("sys_id"),
        now.alias("dw_load_ts"),
    )
