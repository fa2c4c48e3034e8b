"""Running operators, with ordinary and with oversized groups."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import windows as W


@pytest.fixture(scope="module")
def events(spark):
    """3,000 rows; group 'a' holds two thirds, NULL is a group too; order values tie heavily."""
    n = F.col("id")
    return (
        spark.range(3000)
        .select(
            n,
            F.when(n % 3 != 0, "a").when(n % 2 == 0, "b").alias("g"),
            F.when(n % 3 == 1, 5).otherwise((n * 7919) % 40).cast("int").alias("o"),
            F.when(n % 10 != 0, ((n * 37) % 101).cast("decimal(10,2)")).alias("v"),
        )
        .repartition(5)
        .cache()
    )


def rows(df):
    return sorted(map(str, df.collect()))


def test_running_stats_same_with_split_groups(events):
    whole = W.running_stats(events, ["g"], ["o", "id"], "v")
    split = W.running_stats(events, ["g"], ["o", "id"], "v", max_group_rows=300)
    assert rows(whole) == rows(split)
    assert whole.dtypes == split.dtypes


def test_ranks_same_with_split_groups(events):
    whole = W.rank_columns(events, ["g"], ["o"], ["id"])
    split = W.rank_columns(events, ["g"], ["o"], ["id"], max_group_rows=300)
    assert rows(whole) == rows(split)
    down = W.rank_columns(events, ["g"], ["o"], ["id"], descending=True)
    assert rows(down) == rows(W.rank_columns(events, ["g"], ["o"], ["id"], descending=True, max_group_rows=100))


def test_occurrences_same_with_split_groups(events):
    whole = W.mark_occurrences(events, ["g"], ["id"])
    assert rows(whole) == rows(W.mark_occurrences(events, ["g"], ["id"], max_group_rows=50))
    assert whole.filter("is_first").count() == 3


def test_split_groups_are_cut(events):
    hot = W.oversized_groups(events, ["g"], 300)
    assert sorted(h[-1] for h in hot) == [500, 500, 2000]
    blocks = W._blocks(events, ["g"], [F.col("o"), F.col("id")], 20)
    assert blocks.groupBy("__block").count().agg(F.max("count")).first()[0] < 500


def test_lead_same_with_split_groups(events):
    whole = W.lead_value(events, ["g"], ["o", "id"], "v", "nxt")
    split = W.lead_value(events, ["g"], ["o", "id"], "v", "nxt", max_group_rows=300)
    assert rows(whole) == rows(split)


def test_trap_9_order_is_required(events):
    with pytest.raises(TypeError):
        W.running_stats(events, ["g"], column="v")


def test_one_row_partition(spark):
    one = spark.createDataFrame([("x", 1, 10)], "g STRING, o INT, v INT")
    got = W.rank_columns(one, ["g"], ["o"]).first()
    assert (got.srank, got.drank, got.prank, got.rn) == (1, 1, 0.0, 1)


def test_trap_5_pick_first_gives_one_row_per_booking(spark):
    stays = spark.createDataFrame([(1, "B", 7), (1, "A", 9), (1, "A", 8)], "k INT, market STRING, stay INT")
    assert [tuple(r) for r in W.pick_first(stays, ["k"], ["market", "stay"]).collect()] == [(1, "A", 8)]


def test_pick_first_is_reduced_before_the_shuffle(events):
    plan = W.pick_first(events, ["g"], ["id"])._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    shuffle = physical.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in physical[:shuffle] and "Partial" in physical[shuffle:]
