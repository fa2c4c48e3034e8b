"""Shape of the physical plans."""

import os

import pytest

from millrace.catalog import QUERIES
from millrace.plans.event_reports import monthly_line_amounts
from millrace.sources.tables import Tables

FOLDER = os.environ.get("PARITY_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(("classify_acc", "classify_conf", "stream"))])
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert ("MapInPandas" in plan) == (name == "html_table_cells")
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    t = Tables(spark, FOLDER)
    plan = plan_of(monthly_line_amounts(t.orders, t.lineitem))
    assert "In(o_orderstatus, [F,O])" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in plan
    assert "StringStartsWith(p_name,red)" in plan_of(QUERIES["filter_like_prefix"](spark, FOLDER))
    assert "GreaterThan(value,70.0)" in plan_of(QUERIES["filter_threshold"](spark, FOLDER))


def test_lines_are_combined_before_the_join(spark):
    t = Tables(spark, FOLDER)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(monthly_line_amounts(t.orders, t.lineitem))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One shuffle per join side, one for the months, one for their order.
    assert plan.count("Exchange hashpartitioning") == 3 and "SortMergeJoin" in plan


def test_json_is_parsed_once_per_branch(spark):
    t = Tables(spark, FOLDER)
    from millrace.catalog.reservations import messages

    assert plan_of(messages(t)).count("from_json(") == 1
    # Amounts are joined back to their messages: both sides read what was staged.
    assert "from_json(" not in plan_of(QUERIES["reservation_by_position"](spark, FOLDER))


def test_attribution_needs_no_aggregate_after_the_join(spark):
    plan = plan_of(QUERIES["attribution_match"](spark, FOLDER))
    join = plan.index("Join")
    assert "Aggregate" not in plan[:join]


def test_nested_path_shuffles_texts_once(spark):
    """Texts are dealt by their id; the words made of them are not shuffled again."""
    plan = plan_of(QUERIES["nested_path"](spark, FOLDER))
    assert plan.count("Exchange hashpartitioning(doc_id") == 1 and plan.count("Exchange") == 1


def test_arrow_batches_are_small(spark):
    """Rows of texts and token ids cross to Python a few megabytes at a time, whatever the session had."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    QUERIES["aggregate_count"](spark, FOLDER)
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "2000"
