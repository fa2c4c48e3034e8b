import pytest
from pyspark.sql import functions as F

from millrace.functions.dates import calendar
from millrace.operators import joins as J
from millrace.operators import project as P


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_trap_11_not_in_and_not_exists(spark):
    a = frame(spark, [(1,), (2,), (None,)], "k INT")
    b = frame(spark, [(2,)], "k INT")
    with_null = frame(spark, [(2,), (None,)], "k INT")
    none = b.filter("k > 9")
    assert got(J.anti_missing(a, with_null, {"k": "k"})) == [(1,), (None,)]
    assert got(J.anti_not_in(a, b, "k")) == [(1,)]
    assert got(J.anti_not_in(a, with_null, "k")) == []
    assert got(J.anti_not_in(a, none, "k")) == [(1,), (2,), (None,)]


def test_not_in_is_no_nested_loop_join(spark):
    a, b = spark.range(10), spark.range(5).withColumnRenamed("id", "k")
    plan = J.anti_not_in(a, b, "id", "k")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_trap_13_double_lookup_does_not_multiply(spark):
    rows = frame(spark, [(1, 2), (1, 3), (4, 2)], "a INT, b INT")
    dim = frame(spark, [(1, "A"), (1, "A"), (2, "A"), (2, "I"), (3, "I"), (4, "I")], "id INT, act STRING")
    assert got(J.double_lookup(rows, dim, {"a": "id"}, {"b": "id"}, F.col("act") == "A")) == [(1, 2)]


def test_star_join_keeps_misses(spark):
    fact = frame(spark, [(1,), (2,), (3,)], "k INT")
    typed = frame(spark, [(1, "SLA", "gold"), (2, "OTHER", "x")], "id INT, kind STRING, name STRING")
    out = J.star_join(fact, [J.Lookup(typed, {"k": "id"}, {"sla": "name"}, F.col("kind") == "SLA")])
    assert got(out) == [(1, "gold"), (2, None), (3, None)]


def test_trap_16_attribute_lookup_takes_smallest(spark):
    apps = frame(spark, [(1,), (2,)], "app INT")
    attrs = frame(spark, [(1, "SLA", "z"), (1, "SLA", "b"), (1, "RTO", "4h"), (2, "RTO", "8h")], "no INT, kind STRING, v STRING")
    out = J.attribute_lookup(apps, attrs, "app", "no", "kind", "v", {"sla": "SLA", "rto": "RTO"})
    assert got(out) == [(1, "b", "4h"), (2, None, "8h")]


def test_one_per_key(spark):
    dim = frame(spark, [(1, "b", 1), (1, "a", 2), (2, "c", 3)], "k INT, s STRING, n INT")
    assert got(J.one_per_key(dim, ["k"], ["s", "n"])) == [(1, "a", 2), (2, "c", 3)]
    assert got(J.one_per_key(dim, ["k"])) == [(1,), (2,)]


def test_small_dimensions_are_broadcast_and_large_ones_are_not(spark):
    fact = spark.range(1000).withColumn("d", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 90).cast("int")))
    out = J.lookup_date_key(fact, calendar(spark, "2024-01-01", "2024-02-29"), "d", "k")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert out.count() == fact.filter("d <= '2024-02-29'").count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        plan = J.lookup_date_key(fact, calendar(spark, "2024-01-01", "2024-02-29"), "d", "k")._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_union_padded_and_types(spark):
    a, b = spark.sql("SELECT 1 AS x, 'a' AS y"), spark.sql("SELECT 2 AS x, 3.5 AS z")
    out = P.union_padded(a, b, types={"x": "bigint", "y": "string", "z": "double"})
    assert got(out) == [(1, "a", None), (2, None, 3.5)]


def test_trap_17_null_against_value(spark):
    df = frame(spark, [(1, None), (None, None), (1, 1), (1, 2)], "a INT, b INT")
    pair = [(F.col("a"), F.col("b"))]
    assert df.filter(P.any_differs(pair)).count() == 2
    assert df.filter(P.any_differs(pair, null_safe=False)).count() == 1


def test_first_match_wins(spark):
    df = frame(spark, [("x",), ("y",), (None,)], "v STRING")
    assert [r[0] for r in df.select(P.first_match("v", {"x": 1, "y": 2}, 0)).collect()] == [1, 2, 0]


def test_gate_has_no_cross_join(spark):
    report = frame(spark, [(0, "A", "t", 0)], "error_code INT, error_abv STRING, error_table STRING, row_cnt BIGINT")
    out = J.gate(spark.range(3), report)
    assert out.count() == 3
    assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()
    closed = J.gate(spark.range(3), report.withColumn("error_code", F.lit(1)))
    assert closed.count() == 0


@pytest.mark.parametrize("how,n", [("inner", 1), ("left", 2)])
def test_currency_join(spark, how, n):
    facts = frame(spark, [("2024-01-02", "EUR"), ("2024-01-02", "XXX")], "d STRING, currency_code STRING").select(
        F.col("d").cast("date").alias("create_date"), "currency_code"
    )
    rates = frame(spark, [("EUR", 11, 20240102, 1.25), ("EUR", 12, 20240103, 9.0)],
                  "currency_iso_cd STRING, date_currency_key INT, date_key INT, exch_per_us_dlr_rte DOUBLE")
    cur = frame(spark, [("EUR", 2)], "currency_iso_cd STRING, decimal_positions_qty INT")
    out = J.convert_currency(facts, rates, calendar(spark, "2024-01-01", "2024-01-31"), cur, how)
    assert out.count() == n
    assert out.filter("currency_code = 'EUR'").first().exch_per_us_dlr_rte == 1.25


def test_hot_keys_are_split_when_joined_back(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(600000, numPartitions=16).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("p")
        )
        grouped = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
        for how in ("inner", "left"):
            out = J.join_back(rows, grouped, ["k"], how).agg(F.count(F.lit(1)), F.max("p"), F.sum("n"))
            assert out.collect()[0][0] == 600000
            assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_hot_right_keys_of_semi_and_anti_joins(spark):
    """One row per key reaches the join, whatever the right side repeats."""
    a = spark.range(40).selectExpr("id % 4 as k", "id as p")
    b = spark.range(3000).selectExpr("if(id < 2990, 1, cast(null as bigint)) as k")
    for df in (J.anti_missing(a, b, {"k": "k"}), J.anti_not_in(a, b.dropna(), "k"), J.already_loaded(a, b, ["k"]), J.double_lookup(a, b, {"k": "k"}, {"k": "k"}, F.lit(True))):
        assert "Aggregate" in df._jdf.queryExecution().optimizedPlan().toString()
    assert J.anti_missing(a, b, {"k": "k"}).count() == 30 and J.anti_not_in(a, b, "k").count() == 0
    assert J.already_loaded(a, b, ["k"]).count() == 10 and J.double_lookup(a, b, {"k": "k"}, {"k": "k"}, F.lit(True)).count() == 10
    nulls = spark.createDataFrame([(None, 1), (1, 2)], "k bigint, p int")
    assert J.already_loaded(nulls, b, ["k"], {"k": -1}).count() == 2 and J.already_loaded(nulls, b, ["k"]).count() == 1


def test_double_match_marks_and_keeps(spark):
    rows = frame(spark, [(1, 2), (1, 3), (4, 2)], "a INT, b INT")
    dim = frame(spark, [(1, "A"), (1, "A"), (2, "A")], "id INT, act STRING")
    assert got(J.double_match(rows, dim, {"a": "id"}, {"b": "id"}, F.col("act") == "A", "m")) == [
        (1, 2, True), (1, 3, False), (4, 2, False)
    ]
