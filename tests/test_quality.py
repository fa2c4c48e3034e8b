import pytest
from pyspark.sql import functions as F

from millrace.functions.text import blank
from millrace.operators import quality as Q

ROWS = [(1, "a", 60.0), (1, "a", 39.6), (2, "b", 100.0), (3, "c", 101.0), (3, None, 0.0)]


@pytest.fixture(scope="module")
def shares(spark):
    return spark.createDataFrame(ROWS, "k INT, s STRING, amt DOUBLE")


def report(df, checks):
    return {r.error_abv: (r.error_code, r.row_cnt) for r in Q.check_report(df, checks, "t").collect()}


def test_checks_in_one_pass(spark, shares):
    got = report(
        shares,
        [
            Q.NotEmpty(),
            Q.Unique(("k", "s"), "DUP_KS"),
            Q.Unique(("k",), "DUP_K"),
            Q.NoNulls(("s",), "NULL_S"),
            Q.SumsTo(("k",), "amt", 100, "SUM"),
            Q.SumsAtMost(("k",), "amt", 100, "MAX"),
            Q.NotInTarget(spark.createDataFrame([(2,), (2,), (9,)], "k INT"), ("k",), "EXISTS"),
        ],
    )
    assert got == {
        "NO_RECORDS_LOADED": (0, 5), "DUP_KS": (1, 1), "DUP_K": (1, 2), "NULL_S": (1, 1), "SUM": (1, 1), "MAX": (1, 1),
        "EXISTS": (1, 1),
    }


def test_one_scan_for_all_checks(shares):
    df = Q.check_report(shares, [Q.NotEmpty(), Q.Unique(("k",), "A"), Q.Unique(("s",), "B"), Q.SumsTo(("k",), "amt")], "t")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_empty_table(shares):
    none = shares.filter("k > 99")
    assert report(none, [Q.NotEmpty(), Q.Unique(("k",), "D"), Q.NoNulls(("k",), "N")]) == {
        "NO_RECORDS_LOADED": (1, 0), "D": (0, 0), "N": (0, 0)
    }
    assert report(none, [Q.NotEmpty(), Q.NoNulls(("k",), "N")]) == {"NO_RECORDS_LOADED": (1, 0), "N": (0, 0)}


def test_null_keys_are_one_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (1, 1)], "k INT, v INT")
    assert report(df, [Q.Unique(("k",), "K"), Q.Unique(("k", "v"), "KV"), Q.Unique(("v",), "V")]) == {
        "K": (1, 1), "KV": (1, 1), "V": (1, 1)
    }


def test_null_safe_target_match(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "k INT, s STRING")
    check = Q.NotInTarget(df, ("k", "s"), "E", (("s", ""),))
    assert report(df, [check]) == {"E": (1, 2)}
    assert report(df, [Q.NotInTarget(df, ("k", "s"), "E")]) == {"E": (1, 1)}


@pytest.mark.parametrize("per_bucket", [16_384, 50])
def test_failed_checks_are_those_of_the_report(spark, monkeypatch, per_bucket):
    """Also where only some buckets of key marks are looked at again."""
    monkeypatch.setattr(Q, "BUCKET_ROWS", per_bucket)
    rows = spark.range(20_000).selectExpr(
        "if(id = 7, 8, id) as k", "if(id % 5000 = 3, null, cast(id % 9000 as string)) as s", "cast(id % 100 as decimal(9,2)) as amt", "cast(id as string) as u"
    )
    target = spark.range(19_990, 20_990).selectExpr("cast(id as int) as k", "if(id = 19990, '', cast(id % 9000 as string)) as s", "cast(null as string) as u")
    checks = [
        Q.NotInTarget(target, ("k",), "K_EXISTS"),
        Q.Unique(("k",), "K"),
        Q.Unique(("s",), "S"),
        Q.NotEmpty(),
        Q.NotInTarget(target, ("s",), "S_EXISTS", (("s", ""),)),
        Q.NotInTarget(target, ("u",), "U_EXISTS"),
        Q.Unique(("u",), "U"),
        Q.Unique(("k", "s"), "KS"),
        Q.NoNulls(("s",), "NULL_S"),
        Q.SumsTo(("k",), "amt", 100, "SUM"),
    ]
    seen = []
    monkeypatch.setattr(Q, "check_report", lambda df, some, table, whole=Q.check_report: seen.append((df, some)) or whole(df, some, table))
    got = {r.error_abv: r.row_cnt for r in Q.failed_checks(rows, checks, "t")}
    want = {r.error_abv: r.row_cnt for r in Q.failures(Q.check_report(rows, checks, "t")).collect()}
    assert got == want and {"K", "S", "K_EXISTS", "S_EXISTS", "SUM", "NULL_S"} == set(got) and got["K_EXISTS"] == 10
    for df, some in seen[:-1]:
        if any(c.code == "K_EXISTS" for c in some):
            assert (df.count() < 10_000) == (per_bucket == 50)
    none = rows.limit(0)
    assert [r.error_abv for r in Q.failed_checks(none, checks, "t")] == ["NO_RECORDS_LOADED"]
    assert [r.error_abv for r in Q.failed_checks(rows, checks[:3], "t")] == ["K_EXISTS", "K", "S"]


def test_trap_10_failed_gate_leaves_target(shares):
    written = []
    failed = Q.publish_if_clean(shares, Q.check_report(shares, [Q.Unique(("k",))], "t"), written.append)
    assert [r.error_abv for r in failed] == ["DUPLICATE_RECORDS"] and not written
    assert Q.publish_if_clean(shares, Q.check_report(shares, [Q.NotEmpty()], "t"), written.append) == []
    assert len(written) == 1
    with pytest.raises(Q.ChecksFailed, match="DUPLICATE_RECORDS"):
        Q.publish_if_clean(shares, Q.check_report(shares, [Q.Unique(("k",))], "t"), written.append, raise_on_failure=True)


def rules():
    return [
        Q.RecordRule("pool", "Column is NULL", blank("pool")),
        Q.RecordRule("prop", "Property does not exist", F.col("prop").isNull()),
    ]


def test_trap_4_clean_records_have_no_errors(spark):
    df = spark.createDataFrame([(1, "p", 1), (1, "p", 1), (2, "", 1), (2, None, None)], "k INT, pool STRING, prop INT")
    got = {r.k: [tuple(e) for e in r.errorDescription] for r in Q.collect_errors(df, rules(), ["k"]).collect()}
    assert got == {1: [], 2: [("pool", "Column is NULL"), ("prop", "Property does not exist")]}
    first = {r.k: [e.errorField for e in r.errorDescription] for r in Q.first_error(df, rules(), ["k"]).collect()}
    assert first == {1: [], 2: ["pool"]}
    assert [len(r.errorDescription) for r in Q.row_errors(df, rules()).collect()] == [0, 0, 1, 2]


def test_trap_21_field_rules(spark):
    df = spark.createDataFrame([("71", "USD"), ("12", " "), (None, None)], "code STRING, cur STRING")
    checks = [
        Q.FieldRule("code", "code", "doesnt start with 7,8 or 9", ~Q.starts_with_any("code", ("7", "8", "9"))),
        Q.FieldRule("cur", "cur", "is NULL", blank("cur")),
    ]
    got = sorted((r.errorField, r.errorFieldValue) for r in Q.field_errors(df, checks).collect() if r.errorFieldValue)
    assert got == [("code", "12"), ("cur", " ")]
    assert Q.field_errors(df, checks).count() == 3


def test_failures_and_union(shares):
    both = Q.union_reports(
        Q.check_report(shares, [Q.NotEmpty()], "a"), Q.check_report(shares, [Q.Unique(("k",))], "b")
    )
    assert [(r.error_table, r.row_cnt) for r in Q.failures(both).collect()] == [("b", 2)]


def test_families_of_key_sets_share_a_row(spark):
    """A row is shuffled once for all key sets that contain a smaller one; counts are those of plain grouping."""
    rows = [(i % 7 if i % 5 else None, i % 3, i % 2, float(i % 11)) for i in range(200)]
    df = spark.createDataFrame(rows, "a INT, b INT, c INT, v DOUBLE")
    sets = [("a", "b", "c"), ("a", "b"), ("b", "a"), ("a",), ("c", "v"), ("c",)]
    checks = [Q.NotEmpty("N"), Q.NoNulls(("a",), "Z"), *[Q.Unique(s, f"U{i}") for i, s in enumerate(sets)], Q.SumsTo(("b", "a"), "v", 40, "S")]
    got = {r.error_abv: r.row_cnt for r in Q.check_report(df, checks, "t").collect()}
    want = {f"U{i}": df.groupBy(*s).count().filter("count > 1").count() for i, s in enumerate(sets)}
    want["S"] = df.groupBy("a", "b").agg({"v": "sum"}).filter("round(`sum(v)`, 0) <> 40").count()
    assert got == {"N": 200, "Z": 40, **want}
    assert list(Q._families(sets)) == [("a",), ("c",)]
    # Two families: two rows are made of one, where every key set had its own.
    plan = Q.check_report(df, checks, "t")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("family") and "RepartitionByExpression [k" in plan
