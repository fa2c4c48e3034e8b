"""Gated loads into metastore tables.

A staged frame is first written to a replica table. The replica is what the
checks read, what is published and what is audited: it is computed once, and a
lost executor costs a re-read of files, not a recomputation.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.dates import text_date
from millrace.functions.money import implied_decimals
from millrace.operators.maintain import audit_row, batch_date, dedup, upsert
from millrace.operators.project import select_as
from millrace.operators.quality import Check, ChecksFailed, NoNulls, Unique, check_report, failed_checks, failures, publish_if_clean
from millrace.plans import attribution as attr
from millrace.session import CLEANUP, setting
from millrace.sinks import tables
from millrace.sources.files import CORRUPT, corrupt_counts, enforce_reject_limit, parse_json, quarantine, read_delimited
from millrace.sources.tables import read_jdbc

# Layout of a rejects record, (column, width).
REJECT_LAYOUT: dict[str, int] = {
    "dtl_rec_type": 3,
    "sequence_num": 10,
    "connect_num": 10,
    "property_cd": 5,
    "confo_num_orig": 8,
    "confo_num_curr": 8,
    "date_create_key": 5,
    "booking_id": 8,
    "attributing_id": 8,
    "traffic_src_cd": 3,
    "arrival_dt": 10,
    "market_cd": 8,
    "percentage": 5,
    **{f"reject_reason_cd_{i:02d}": 4 for i in range(1, 21)},
}


def convert_rejects(raw: DataFrame) -> DataFrame:
    """Typed rejects: arrival date as a date, percentage with its two implied decimals."""
    return raw.withColumns(
        {"arrival_dt": text_date("arrival_dt"), "percentage": implied_decimals("percentage", 2)}
    )


@dataclass(frozen=True)
class LoadResult:
    failed: list = field(default_factory=list)

    @property
    def published(self) -> bool:
        return not self.failed


# Partition column of tables that are loaded day by day.
LOAD_DAY = "load_dt"


@dataclass(frozen=True)
class GatedLoad:
    """Stage -> replica -> checks -> publish -> audit row -> statistics.

    ``mode`` is ``overwrite`` for snapshots, ``append`` for facts that no run
    brings twice, and ``day`` for facts of a load day: the target is partitioned
    by ``load_dt``, and a run replaces the partition of its day. Running a day
    again therefore adds nothing, and the files of other days stay untouched.
    """

    target: str
    replica: str
    audit: str
    sys_id: str
    checks: Sequence[Check]
    mode: str = "overwrite"

    def stage(self, staged: DataFrame, ts: dt.datetime) -> list:
        """Write the replica and return the checks that failed on it.

        The last run's replica makes room first: two of them need not be on disk.
        """
        spark = staged.sparkSession
        tables.recover(spark, self.replica)
        if spark.catalog.tableExists(self.replica) and spark.catalog.getTable(self.replica).tableType == "MANAGED":
            if not {*spark.table(self.replica).inputFiles()} & {*staged.inputFiles()}:
                tables.truncate(spark, self.replica)
        tables.rewrite(staged.withColumn("dw_load_ts", F.lit(ts).cast("timestamp")), self.replica)
        with setting(spark, *CLEANUP):
            return failed_checks(spark.table(self.replica), self.checks, self.replica)

    def publish(self, df: DataFrame, ts: dt.datetime, batch_dt: Column | dt.date, audited: DataFrame | None = None) -> None:
        """Write ``df`` to the target, its audit row, and the target's statistics.

        ``audited`` has the same rows and load times as ``df`` where it is costly to make again.
        """
        if self.mode == "overwrite":
            tables.rewrite(df, self.target)
        elif self.mode == "append":
            tables.append(df, self.target)
        elif self.mode == "day":
            tables.overwrite_partitions(df.withColumn(LOAD_DAY, F.lit(ts.date())), self.target, [LOAD_DAY])
        else:
            raise ValueError(f"unknown mode: {self.mode}")
        row = audit_row(df if audited is None else audited, self.target.upper(), batch_dt, self.sys_id, ts)
        if self.mode == "day" and df.sparkSession.catalog.tableExists(self.audit):
            # The key is made of table and load time: the row of a repeated run is there already.
            row = row.join(df.sparkSession.table(self.audit).select("audit_key"), "audit_key", "left_anti").select(row.columns)
        tables.append(row, self.audit)
        tables.analyze(df.sparkSession, self.target)

    def run(self, staged: DataFrame, ts: dt.datetime, batch_dt: Column | dt.date) -> LoadResult:
        failed = self.stage(staged, ts)
        if not failed:
            self.publish(staged.sparkSession.table(self.replica), ts, batch_dt)
        return LoadResult(failed)


def other_days(spark: SparkSession, table: str, day: dt.date) -> DataFrame | None:
    """Rows of a table loaded day by day, without those of ``day``; None where there is no table yet."""
    tables.recover(spark, table)
    return spark.table(table).filter(F.col(LOAD_DAY) != F.lit(day)) if spark.catalog.tableExists(table) else None


def load_dimension(staged: DataFrame, names: Mapping[str, str], load: GatedLoad, run_dates: DataFrame, ts: dt.datetime) -> LoadResult:
    """Renamed snapshot load. The batch date comes from the run-date table (one row is read)."""
    row = batch_date(run_dates, load.sys_id).first()
    return load.run(select_as(staged, names), ts, row.data_batch_dt)


def load_delimited(spark: SparkSession, path: str, schema: str | T.StructType, table: str, reject_path: str,
                   max_rejects: int = 0, **reader) -> int:
    """Bulk load of a delimited file over ``table``; returns the number of rejected lines.

    Rejected lines are written first; too many of them stop the load before the
    table is touched.
    """
    rows, rejects = read_delimited(spark, path, schema, **reader)
    n = enforce_reject_limit(rejects, max_rejects, reject_path)
    tables.rewrite(rows, table)
    return n


def load_jdbc(spark: SparkSession, url: str, source: str, table: str, **options) -> None:
    """Copy a database table over a staging table."""
    tables.rewrite(read_jdbc(spark, url, source, **options), table)


@dataclass(frozen=True)
class IngestResult:
    messages: int
    good: int
    corrupt: int


def ingest_messages(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    transform: Callable[[DataFrame], DataFrame],
    good_path: str,
    corrupt_path: str,
    staging_path: str,
    run: str,
    fmt: str = "orc",
) -> IngestResult:
    """Batch ingest of JSON lines: parse, set corrupt text aside, transform, append.

    The parsed lines are written to the staging folder of this run and everything
    after reads them from there: a text is parsed once, however often the
    transformation reads its input. Running the same ``run`` again replaces its
    output.
    """
    staged = f"{staging_path}/run={run}"
    parse_json(spark.read.text(path), "value", schema).drop("value").write.mode("overwrite").parquet(staged)
    parsed = spark.read.parquet(staged)
    good, bad = quarantine(parsed)
    bad.select(F.col(CORRUPT).alias("value")).write.mode("overwrite").text(f"{corrupt_path}/run={run}")
    transform(good.select("message.*")).write.mode("overwrite").format(fmt).save(f"{good_path}/run={run}")
    return IngestResult(*corrupt_counts(parsed).first())


def load_keyed(spark: SparkSession, staged: DataFrame, target: str, keys: Sequence[str], ts: dt.datetime,
               stamp_col: str = "load_dt") -> LoadResult:
    """Dedup the staged rows, refuse missing or repeated keys, upsert, swap."""
    stage = f"{target}__stage"
    tables.rewrite(dedup(staged), stage)
    clean = spark.table(stage)
    report = check_report(
        clean, [NoNulls(tuple(keys), "NULL_KEY"), Unique(tuple(keys), "DUPLICATE_KEY")], stage
    )
    failed = publish_if_clean(
        clean, report, lambda df: tables.rewrite(upsert(spark.table(target), df, keys, ts, stamp_col), target)
    )
    tables.drop(spark, stage)
    return LoadResult(failed)


def dedup_table(spark: SparkSession, table: str) -> None:
    """Remove exact duplicates of a table in place."""
    tables.rewrite(dedup(spark.table(table)), table)


def load_attribution(
    spark: SparkSession,
    stays: DataFrame,
    allocations: DataFrame,
    agencies: DataFrame,
    match_table: str,
    daily_table: str,
    audit: str,
    sys_id: str,
    ts: dt.datetime,
) -> tuple[LoadResult, LoadResult]:
    """Match load and daily load of one day, each behind its own check report.

    Both tables are partitioned by load day. The checks look at the new rows and
    at the rows of all other days, whose keys must not come again. The flag of
    the match rows is set before they are written, from the daily rows that
    passed their checks: history is read for the keys alone and never written
    again. Where the daily checks fail, the match rows are loaded without flags.
    A run that was stopped, or a day that is run again, replaces its own
    partitions only.
    """
    day = ts.date()
    match_load = GatedLoad(
        match_table, f"{match_table}__repl", audit, sys_id, attr.match_checks(other_days(spark, match_table, day)), "day"
    )
    with setting(spark, *CLEANUP):
        parts = attr.booking_parts(stays, allocations)
        failed = match_load.stage(attr.match_stays(stays, allocations, F.lit(ts), parts).drop("dw_load_ts"), ts)
        if failed:
            return LoadResult(failed), LoadResult(failed)
        match = spark.table(match_load.replica)
        daily_load = GatedLoad(
            daily_table, f"{daily_table}__repl", audit, sys_id, attr.daily_checks(other_days(spark, daily_table, day)), "day"
        )
        failed = daily_load.stage(attr.qualified_rows(match, agencies).drop("dw_load_ts"), ts)
        daily = spark.table(daily_load.replica)
        match_load.publish(match if failed else attr.flag_daily(match, daily, daily.count()), ts, day, match)
        if not failed:
            daily_load.publish(daily, ts, day)
    return LoadResult(), LoadResult(failed)


def require_clean(df: DataFrame, checks: Sequence[Check], table: str) -> None:
    """Raise when a check fails."""
    failed = failures(check_report(df, checks, table)).collect()
    if failed:
        raise ChecksFailed(failed)
