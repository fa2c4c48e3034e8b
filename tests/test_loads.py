import datetime as dt
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.catalog import attribution as cat
from millrace.operators import quality as Q
from millrace.plans import attribution as P
from millrace.plans import loads as L
from millrace.sinks import tables
from millrace.sources.tables import Tables

TS = dt.datetime(2024, 2, 1, 3, 4, 5)
NAMES = {"error_type": "cc_type", "error_id": "cc_key", "error_desc": "cc_desc"}


@pytest.fixture
def clean(spark):
    for t in ("ld_dim", "ld_repl", "ld_audit", "ld_match", "ld_daily", "ld_match__repl", "ld_daily__repl", "ld_keyed"):
        tables.drop(spark, t)


def dim_load():
    return L.GatedLoad("ld_dim", "ld_repl", "ld_audit", "SYS", [Q.NotEmpty(), Q.Unique(tuple(NAMES))])


def staged(spark, rows):
    return spark.createDataFrame(rows, "cc_type STRING, cc_key STRING, cc_desc STRING")


def test_dimension_load_and_failed_gate(spark, clean):
    runs = spark.createDataFrame([(dt.date(2024, 2, 1), "SYS")], "run_dt DATE, sys_id STRING")
    assert L.load_dimension(staged(spark, [("A", "1", "x"), ("A", "2", "y")]), NAMES, dim_load(), runs, TS).published
    audit = spark.table("ld_audit").collect()
    assert [(a.table_nm, a.record_amt, a.data_batch_dt, a.initial_load_ts) for a in audit] == [
        ("LD_DIM", 2, dt.date(2024, 1, 30), TS)
    ]
    twice = L.load_dimension(staged(spark, [("A", "1", "x")] * 2), NAMES, dim_load(), runs, TS)
    assert [r.error_abv for r in twice.failed] == ["DUPLICATE_RECORDS"] and not twice.published
    empty = L.load_dimension(staged(spark, []), NAMES, dim_load(), runs, TS)
    assert [r.error_abv for r in empty.failed] == ["NO_RECORDS_LOADED"]
    assert spark.table("ld_dim").count() == 2 and spark.table("ld_audit").count() == 1
    with pytest.raises(Q.ChecksFailed):
        L.require_clean(spark.table("ld_repl"), [Q.NotEmpty()], "ld_repl")


def test_keyed_load(spark, clean):
    tables.create_as(spark.createDataFrame([("1", "old", dt.date(2023, 1, 1)), ("2", "keep", dt.date(2023, 1, 1))],
                                           "cd STRING, ds STRING, load_dt DATE"), "ld_keyed")
    s = spark.createDataFrame([("1", "new"), ("1", "new"), ("3", "add")], "cd STRING, ds STRING")
    assert L.load_keyed(spark, s, "ld_keyed", ["cd"], TS).published
    want = [("1", "new", dt.date(2024, 2, 1)), ("2", "keep", dt.date(2023, 1, 1)), ("3", "add", dt.date(2024, 2, 1))]
    assert sorted(map(tuple, spark.table("ld_keyed").collect())) == want
    for bad in ([("1", "a"), ("1", "b")], [(None, "a")]):
        assert not L.load_keyed(spark, spark.createDataFrame(bad, "cd STRING, ds STRING"), "ld_keyed", ["cd"], TS).published
        assert sorted(map(tuple, spark.table("ld_keyed").collect())) == want


def test_dedup_table(spark, clean):
    tables.create_as(spark.range(3).unionAll(spark.range(3)), "ld_keyed")
    L.dedup_table(spark, "ld_keyed")
    assert spark.table("ld_keyed").count() == 3


STAYS = "market_cd STRING, confo_num_orig_id BIGINT, confo_num_curr_id BIGINT, date_create_key BIGINT, property_cd STRING, book_id STRING, arrival_dt DATE, atrb_stay_key BIGINT"
ALLOC = "atrb_allocation_key BIGINT, confo_num_orig_id BIGINT, date_create_key BIGINT, camp_source_drvd_txt STRING, atrb_id STRING, atrb_amt DECIMAL(18,2)"


def attribution_inputs(spark, second_share):
    from decimal import Decimal

    d = dt.date(2024, 3, 1)
    stays = spark.createDataFrame(
        [("M2", 1, 1, 5, "P", "A1", d, 11), ("M1", 1, 1, 5, "P", "A1", d, 12), ("M1", 2, 2, 5, "P", None, d, 13)], STAYS
    )
    alloc = spark.createDataFrame(
        [(101, 1, 5, "PAIU", "A2", Decimal(30)), (102, 1, 5, "PAIB", "A2", Decimal(second_share)), (103, 1, 5, "NATU", "A1", Decimal(20)),
         (104, 2, 5, "REFX", "A1", Decimal(100))], ALLOC
    )
    agencies = spark.createDataFrame(
        [("A1", "REF", "A"), ("A1", "REF", "A"), ("A2", "PAI", "A"), ("A2", "PAI", "I")], "agency_id STRING, source_txt STRING, active_ind STRING"
    )
    return stays, alloc, agencies


def run_attribution(spark, share):
    return L.load_attribution(spark, *attribution_inputs(spark, share), "ld_match", "ld_daily", "ld_audit", "SYS", TS)


def test_attribution_load(spark, clean):
    first, second = run_attribution(spark, 50)
    assert first.published and second.published
    rows = {(r.confo_num_orig_id, r.camp_source_abrv_txt): r for r in spark.table("ld_match").collect()}
    pai = rows[(1, "PAI")]
    assert (pai.atrb_allocation_key, float(pai.atrb_amt), pai.market_cd, pai.atrb_stay_key) == (102, 80.0, "M1", 12)
    assert {k: r.flag for k, r in rows.items()} == {(1, "PAI"): True, (1, "NAT"): False, (2, "REF"): False}
    assert rows[(2, "REF")].book_id == "" and rows[(2, "REF")].dw_load_ts == TS
    assert spark.table("ld_daily").count() == 1 and spark.table("ld_audit").count() == 2


def test_attribution_load_stops_at_failed_check(spark, clean):
    run_attribution(spark, 50)
    before = sorted(map(str, spark.table("ld_match").collect()))
    first, second = run_attribution(spark, 49)
    assert [r.error_abv for r in first.failed] == ["INVALID_ATRB_ALLOCATION_AMT"] and not second.published
    assert sorted(map(str, spark.table("ld_match").collect())) == before


def files_of(spark, table, day):
    rows = spark.table(table).filter(F.col("load_dt") == F.lit(day)).select("_metadata.file_path", "_metadata.file_modification_time").distinct()
    return sorted(map(tuple, rows.collect()))


def test_a_repeated_day_adds_nothing_and_other_days_keep_their_files(spark, clean):
    run_attribution(spark, 50)
    names = ("ld_match", "ld_daily", "ld_audit")
    before = {t: sorted(map(str, spark.table(t).collect())) for t in names}
    first, second = run_attribution(spark, 50)
    assert first.published and second.published
    assert {t: sorted(map(str, spark.table(t).collect())) for t in names} == before
    # The same bookings on the next day are refused by the checks against all other days.
    inputs = attribution_inputs(spark, 50)
    next_day = TS + dt.timedelta(days=1)
    load = lambda stays, alloc: L.load_attribution(spark, stays, alloc, inputs[2], "ld_match", "ld_daily", "ld_audit", "SYS", next_day)
    first, second = load(*inputs[:2])
    assert {r.error_abv for r in first.failed} == {"BUSINESS_KEY_EXISTS", "CCC_KEY_EXISTS", "PRIMARY_KEY_EXISTS"}
    assert {t: sorted(map(str, spark.table(t).collect())) for t in names} == before
    # New bookings go to a partition of their own.
    old = files_of(spark, "ld_match", TS.date()), files_of(spark, "ld_daily", TS.date())
    stays = inputs[0].withColumns({c: F.col(c) + 1000 for c in ("confo_num_orig_id", "atrb_stay_key")})
    alloc = inputs[1].withColumns({c: F.col(c) + 1000 for c in ("confo_num_orig_id", "atrb_allocation_key")})
    first, second = load(stays, alloc)
    assert first.published and second.published
    assert (files_of(spark, "ld_match", TS.date()), files_of(spark, "ld_daily", TS.date())) == old
    assert spark.table("ld_match").count() == 6 and spark.table("ld_daily").count() == 2 and spark.table("ld_audit").count() == 4
    assert spark.table("ld_match").filter("flag").groupBy("load_dt").count().count() == 2


def test_match_rows_load_without_flags_when_the_daily_checks_fail(spark, clean, monkeypatch):
    never = Q.Unique(("property_cd",), "NEVER")
    monkeypatch.setattr(P, "daily_checks", lambda target=None: [Q.NotInTarget(spark.range(1).select(F.lit("P").alias("property_cd")), ("property_cd",), "ALWAYS"), never])
    first, second = run_attribution(spark, 50)
    assert first.published and [r.error_abv for r in second.failed] == ["ALWAYS"]
    assert spark.table("ld_match").count() == 3 and spark.table("ld_match").filter("flag").count() == 0
    assert not spark.catalog.tableExists("ld_daily")


def test_reload_is_seen_by_the_target_checks(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    match = P.match_stays(cat.stays(t), cat.allocations(t), TS)
    got = {r.error_abv: r.row_cnt for r in Q.check_report(match, P.match_checks(match), "m").collect()}
    n = match.count()
    assert got["BUSINESS_KEY_EXISTS"] == got["CCC_KEY_EXISTS"] == got["PRIMARY_KEY_EXISTS"] == n
    daily = P.qualified_rows(match, cat.agencies(t))
    got = {r.error_abv: r.row_cnt for r in Q.check_report(daily, P.daily_checks(daily.filter(F.lit(False))), "d").collect()}
    assert got["BOOKING_STAY_KEY_EXISTS"] == 0


def test_flag_in_one_pass_equals_flag_by_join(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    a = P.attribution(cat.stays(t), cat.allocations(t), cat.agencies(t), TS)
    joined = P.flag_daily(a.match, a.daily)
    assert sorted(map(str, a.flagged.collect())) == sorted(map(str, joined.collect()))
    assert a.flagged.filter("flag").count() == a.daily.count() > 0


def shuffle_files(spark):
    """Shuffle files that are on disk now."""
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {str(f) for d in dirs for f in Path(d).rglob("shuffle_*")}


def test_a_load_leaves_no_shuffle_files(spark, clean):
    before = shuffle_files(spark)
    first, second = run_attribution(spark, 50)
    assert first.published and second.published
    for _ in range(50):  # they are deleted beside the job
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left


def test_the_last_replica_makes_room_unless_the_new_one_is_made_of_it(spark, clean):
    load = L.GatedLoad("ld_dim", "ld_repl", "ld_audit", "SYS", [Q.NotEmpty()])
    assert load.run(staged(spark, [("A", "1", "x"), ("A", "2", "y")]), TS, TS.date()).published
    assert load.run(spark.table("ld_repl").filter("cc_key = '2'"), TS, TS.date()).published
    assert spark.table("ld_dim").count() == spark.table("ld_repl").count() == 1


def test_matching_by_booking_gives_the_same_rows(spark, monkeypatch):
    t = Tables(spark, "/root/testdata/sf0.001")
    both = cat.stays(t), cat.allocations(t)
    found = [sorted(map(str, P.match_stays(*both, TS, parts).collect())) for parts in (None, 1, 5)]
    assert found[0] == found[1] == found[2]
    with L.setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        plans = [P.match_stays(*both, TS, parts)._jdf.queryExecution().executedPlan().toString() for parts in (None, 5)]
    assert [p.count("Exchange hashpartitioning") for p in plans] == [4, 2]
    stays = attribution_inputs(spark, 50)[0]
    missing = stays.unionAll(stays.withColumn("confo_num_orig_id", F.lit(None).cast("bigint")))
    monkeypatch.setattr(P, "BOOKING_ROWS", 2)
    assert P.booking_parts(missing) == P.booking_parts(stays.limit(0)) == 1
    monkeypatch.setattr(P, "PART_ROWS", 2)
    assert P.booking_parts(stays.limit(0), missing) == 2
    monkeypatch.setattr(P, "BOOKING_ROWS", 1)
    assert P.booking_parts(stays) is None


def test_mixed_partitions_are_written_whole(spark, clean):
    """Rows whose partitions alternate within a task, to a new table and to one that is there."""
    rows = spark.range(0, 5, numPartitions=1)
    for i in (1, 2):
        tables.overwrite_partitions(rows.withColumn("d", F.when(F.col("id") < i, F.lit(dt.date(2024, 1, 2))).otherwise(F.lit(dt.date(2024, 1, 1)))), "ld_keyed", ["d"])
    assert {(r.id, r.d.day) for r in spark.table("ld_keyed").collect()} == {(0, 2), (1, 2), (2, 1), (3, 1), (4, 1)}
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_load_delimited(spark, tmp_path):
    from millrace.sources.files import RejectLimitExceeded

    f = tmp_path / "codes.txt"
    f.write_text("CD|DS\nA|one\nB|two|extra\n")
    tables.drop(spark, "ld_codes")
    assert L.load_delimited(spark, str(f), "cd STRING, ds STRING", "ld_codes", str(tmp_path / "rej"), skip=1) == 0
    f.write_text("CD|DS\nC\n")
    with pytest.raises(RejectLimitExceeded):
        L.load_delimited(spark, str(f), "cd STRING, ds STRING", "ld_codes", str(tmp_path / "rej"), skip=1)
    assert sorted(map(tuple, spark.table("ld_codes").collect())) == [("A", "one"), ("B", "two")]
    assert L.load_delimited(spark, str(f), "cd STRING, ds STRING", "ld_codes", str(tmp_path / "rej"), 1, skip=1) == 1
    assert spark.table("ld_codes").count() == 0 and spark.read.parquet(str(tmp_path / "rej")).count() == 2
