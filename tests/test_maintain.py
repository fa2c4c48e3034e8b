import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from millrace.functions.keys import surrogate_key
from millrace.operators import joins as J
from millrace.operators import maintain as M
from millrace.operators import reconcile as R

TS = dt.datetime(2024, 2, 1)
OLD = dt.datetime(2023, 1, 1)
few = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
pairs = st.lists(st.tuples(st.integers(0, 4), st.sampled_from("ab")), max_size=12)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


@few
@given(rows=pairs)
def test_dedup_is_idempotent(spark, rows):
    df = spark.createDataFrame(rows, "k INT, v STRING")
    once = M.dedup(df)
    assert got(once) == got(M.dedup(once)) == sorted(set(rows), key=str)


@few
@given(target=pairs, staged=pairs)
def test_upsert_twice_is_upsert_once(spark, target, staged):
    t = spark.createDataFrame([(*r, OLD) for r in target], "k INT, v STRING, load_dt TIMESTAMP")
    s = spark.createDataFrame(staged, "k INT, v STRING")
    once = M.upsert(t, s, ["k"], TS)
    keys = {k for k, _ in staged}
    assert got(once) == sorted([(*r, OLD) for r in target if r[0] not in keys] + [(*r, TS) for r in staged], key=str)
    assert got(M.upsert(once, s, ["k"], TS)) == got(once)


@few
@given(base=st.dictionaries(st.integers(0, 5), st.sampled_from("xy"), max_size=6),
       log=st.lists(st.tuples(st.integers(0, 6), st.sampled_from(["INSERT", "UPDATE", "DELETE"]), st.sampled_from("pq")), max_size=10))
def test_net_change_replays_the_log(spark, base, log):
    state = dict(base)
    for k, op, v in log:
        if op == "DELETE":
            state.pop(k, None)
        else:
            state[k] = v
    b = spark.createDataFrame(list(base.items()), "k INT, v STRING")
    entries = [(op, str(i + 1), k, v) for i, (k, op, v) in enumerate(log)]
    lg = spark.createDataFrame(entries, "header__operation STRING, header__change_seq STRING, k INT, v STRING")
    assert got(M.net_change(b, lg, ["k"])) == sorted(state.items(), key=str)


def test_trap_11_null_staged_key_loses_nothing(spark):
    t = spark.createDataFrame([(1, "a", OLD), (2, "b", OLD)], "k INT, v STRING, load_dt TIMESTAMP")
    s = spark.createDataFrame([(None, "n"), (2, "new")], "k INT, v STRING")
    assert got(M.upsert(t, s, ["k"], TS)) == sorted([(1, "a", OLD), (None, "n", TS), (2, "new", TS)], key=str)


def test_trap_12_sequence_is_numeric(spark):
    base = spark.createDataFrame([(1, "base"), (2, "base")], "k INT, v STRING")
    log = spark.createDataFrame(
        [("UPDATE", "9", 1, "nine"), ("UPDATE", "10", 1, "ten"), ("DELETE", "3", 2, None), ("INSERT", "1", 3, "new")],
        "header__operation STRING, header__change_seq STRING, k INT, v STRING",
    )
    assert got(M.net_change(base, log, ["k"])) == [(1, "ten"), (3, "new")]


def test_trap_14_flag_update_loses_no_rows(spark):
    t = spark.createDataFrame([(1, False, OLD), (2, True, OLD), (3, False, OLD)], "k INT, flag BOOLEAN, ts TIMESTAMP")
    m = spark.createDataFrame([(1,), (1,), (9,)], "k INT")
    assert got(M.set_flag(t, m, "k", "flag")) == [(1, True, OLD), (2, True, OLD), (3, False, OLD)]


@pytest.mark.parametrize("bits_a_key", [16, 1])
def test_flags_are_the_same_where_the_number_of_rows_is_known(spark, monkeypatch, bits_a_key):
    monkeypatch.setattr(J, "KEY_BITS", bits_a_key)
    target = spark.range(60_000).selectExpr("if(id % 1000 = 0, null, md5(cast(id div 2 as string))) as k", "id % 7 = 0 as flag", "id")
    matched = spark.range(0, 30_000, 10).selectExpr("md5(cast(id as string)) as k").unionAll(spark.sql("select cast(null as string) as k"))
    by_id = lambda df: {r.id: (r.k, r.flag) for r in df.collect()}
    for rows in (matched, matched.limit(0)):
        told = M.set_flag(target, rows, "k", "flag", rows.count())
        assert by_id(told) == by_id(M.set_flag(target, rows, "k", "flag")) and told.count() == 60_000
    passed = J.maybe_in(target, matched, "k", matched.count(), "seen").filter("seen").count()
    assert passed < 60_000 * (0.2 if bits_a_key == 16 else 0.8)


def test_trap_15_key_parts_are_separated(spark):
    df = spark.createDataFrame([(1, 23), (12, 3), (None, 3)], "a INT, b INT")
    for algo in ("md5", "sha2", "xxhash64"):
        assert df.select(surrogate_key("a", "b", algo=algo)).distinct().count() == 3
    with pytest.raises(ValueError):
        surrogate_key("a", algo="crc32")


def test_audit_rows_of_two_tables_differ(spark):
    df = spark.createDataFrame([(1, OLD)], "k INT, dw_load_ts TIMESTAMP")
    a = M.audit_row(df, "A", dt.date(2024, 1, 30), "S", TS).first()
    b = M.audit_row(df, "B", dt.date(2024, 1, 30), "S", TS).first()
    assert a.audit_key != b.audit_key and a.initial_load_ts == OLD and a.record_amt == 1
    none = M.audit_row(df.filter("k > 1"), "A", dt.date(2024, 1, 30), "S", TS).first()
    assert none.initial_load_ts == TS and none.record_amt == 0


def test_batch_date(spark):
    runs = spark.createDataFrame([(dt.date(2024, 3, 1), "S"), (dt.date(2024, 5, 1), "T")], "run_dt DATE, sys_id STRING")
    assert M.batch_date(runs, "S").first()[0] == dt.date(2024, 2, 28)


def test_dedup_by_key_needs_an_order(spark):
    with pytest.raises(ValueError):
        M.dedup(spark.range(3), ["id"])


def test_diff_rows_of_equal_tables_is_empty(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k INT, v STRING")
    assert R.diff_rows(df, df.select("*"), "k", [("v", "v")]).count() == 0
    assert R.side_by_side(df, df.filter("k = 1"), "k").count() == 2


def test_other_operations_are_no_rows(spark):
    """Images of old rows and unknown operations never come out; the base is not sorted."""
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], "k int, v string")
    log = spark.createDataFrame(
        [(1, "x", "BEFOREIMAGE", "2"), (1, "y", "UPDATE", "1"), (2, "z", None, "1"), (3, "u", "update", "1"), (5, "n", "INSERT", "1"), (6, "m", "BEFOREIMAGE", "1")],
        "k int, v string, header__operation string, header__change_seq string",
    )
    out = M.net_change(base, log, ["k"])
    assert sorted((r.k, r.v) for r in out.collect()) == [(3, "u"), (4, "d"), (5, "n")]
