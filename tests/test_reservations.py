import json

import pytest

from millrace.functions.dates import calendar
from millrace.operators import nested as N
from millrace.operators.nested import explode_errors
from millrace.plans import reservations as R
from millrace.schemas import RESERVATION
from millrace.sources.files import parse_json, quarantine


def message(codes, segments, pools, prop="P1", created="2024-01-02T10:00:00", guest="Ann"):
    return {
        "lastupdatetime": created,
        "reservation": {
            "creationDateTime": created,
            "creatorID": "U1",
            "reservationConfirmations": [{"reservationCode": c, "reservationInstance": "1"} for c in codes],
        },
        "property": {"propertyCode": prop},
        "reservationSegments": segments,
        "roomPools": None if pools is None else [{"roomPoolCode": p, "numberOfUnits": 1} for p in pools],
        "guest": [{"profiles": {"customer": [{"name": [{"givenName": guest}]}]}}],
    }


def segment(start, amount, cur="EUR", places=2, status="OK"):
    rate = {"ratePlanCode": "R", "baseRateUnit": "DAY", "baseAmount": amount, "currencyCode": cur}
    if places is not None:
        rate["decimalPlaces"] = places
    return {"segmentStatus": status, "startDate": start, "endDate": start, "rate": rate}


TWO = [segment("2024-02-01", 10000), segment("2024-02-02", 5000)]
CASES = [
    message(["71"], TWO, ["K", "Q", "D"]),
    message(["72", "73"], [segment("2024-02-01", 10000, places=None)], [""]),
    message(["74"], [segment("2024-02-01", 10000, places=0)], [None], prop="NOPE"),
    message(["75"], [segment("2030-01-01", 100), segment("2024-02-01", 300)], ["K", "K"]),
    message(["76"], [segment("2024-02-01", 100, cur="XXX")], ["K"]),
    message(["77"], [], ["K"]),
    message(["78"], TWO, None),
    message([], TWO, ["K", "K"]),
    message(["79"], TWO, ["K", "K"], created="soon"),
]


@pytest.fixture(scope="module")
def dims(spark):
    return R.Dimensions(
        calendar(spark, "2024-01-01", "2024-12-31"),
        spark.createDataFrame([(501, "P1")], "property_id INT, property_cd STRING"),
        spark.createDataFrame([("EUR", 3)], "currency_iso_cd STRING, decimal_positions_qty INT"),
        spark.createDataFrame([("EUR", 1, 20240102, "1.25"), ("EUR", 2, 20240103, "9")],
                              "currency_iso_cd STRING, date_currency_key INT, date_key INT, exch_per_us_dlr_rte STRING"),
    )


@pytest.fixture(scope="module")
def messages(spark):
    text = spark.createDataFrame([(json.dumps(m),) for m in CASES] + [('{"broken',)], "value STRING")
    good, bad = quarantine(parse_json(text, "value", RESERVATION))
    assert bad.count() == 1
    return good.select("message.*")


def by_code(df):
    return {r.confo_num_orig: r for r in df.collect()}


def test_by_position(messages, dims):
    got = by_code(R.parse_reservations(messages, dims))
    assert sorted(got) == ["71", "72", "74", "75"]
    a = got["71"]
    assert float(a.baseAmount) == 15000 and float(a.baseAmountLocal) == 187.5 and a.date_create_key == 20240102
    assert [tuple(e) for e in a.date_arrival_key] == [(20240201, 1), (20240202, 1)] and a.errorDescription == []
    b = got["72"]
    assert b.confo_num_curr == "73" and float(b.baseAmountLocal) == 12.5
    assert [e.errorField for e in b.errorDescription] == ["roomPoolCode"]
    c = got["74"]
    assert float(c.baseAmountLocal) == 12500 and c.property_id is None
    assert [e.errorField for e in c.errorDescription] == ["roomPoolCode", "property_id"]
    assert float(got["75"].baseAmount) == 300


def test_trap_6_product_weighs_by_pools(messages, dims):
    got = by_code(R.parse_reservations(messages, dims, align="product"))
    assert float(got["71"].baseAmount) == 45000
    assert [tuple(e) for e in got["71"].date_arrival_key] == [(20240201, 3), (20240202, 3)]
    with pytest.raises(ValueError):
        R.parse_reservations(messages, dims, align="cross")


def test_trap_7_zero_places_and_left_rates(messages, dims):
    got = by_code(R.parse_reservations(messages, dims, fx_how="left", zero_places_as_one=True))
    assert float(got["74"].baseAmountLocal) == 1250
    assert got["76"].baseAmountLocal is None and float(got["76"].baseAmount) == 100


def test_product_weight_equals_exploded_product(messages, dims):
    exploded = N.explode_product(R.with_keys(messages, dims.properties), {"s": "reservationSegments", "p": "roomPools"})
    assert exploded.filter("confo_num_orig = '71'").count() == 6
    total = exploded.filter("confo_num_orig = '71'").selectExpr("sum(s.rate.baseAmount)").first()[0]
    assert total == by_code(R.parse_reservations(messages, dims, align="product"))["71"].baseAmount


def test_same_key_in_two_messages_is_summed_for_both(spark, dims):
    twice = [message(["71"], [segment("2024-02-01", 100)], ["K"])] * 2
    text = spark.createDataFrame([(json.dumps(m),) for m in twice], "value STRING")
    got = R.parse_reservations(parse_json(text, "value", RESERVATION).select("message.*"), dims).collect()
    assert [float(r.baseAmount) for r in got] == [200.0, 200.0] and got[0].date_arrival_key[0].n == 2


def test_trap_26_single_code_is_both(messages, dims):
    keyed = R.with_keys(messages, dims.properties)
    assert {(r.confo_num_orig, r.confo_num_curr) for r in keyed.filter("confo_num_orig in ('71', '72')").collect()} == {
        ("71", "71"), ("72", "73")
    }


def test_errors_explode_to_rows(messages, dims):
    rows = explode_errors(R.parse_reservations(messages, dims)).select("confo_num_orig", "errorDesc.errorField").collect()
    assert sorted(map(tuple, rows)) == [("72", "roomPoolCode"), ("74", "property_id"), ("74", "roomPoolCode")]


def test_struct_field_across_array(messages):
    row = messages.select("reservationSegments.segmentStatus", "roomPools.roomPoolCode").first()
    assert row.segmentStatus == ["OK", "OK"] and row.roomPoolCode == ["K", "Q", "D"]


def test_flat_form_and_validation(spark):
    ms = [message(["71"], [segment("2024-02-01", 1)], ["K"]), message(["12"], [segment("2024-02-01", 1, cur="", status=" ")], ["K"], guest=None)]
    text = spark.createDataFrame([(json.dumps(m),) for m in ms], "value STRING")
    flat = R.flatten_reservations(parse_json(text, "value", RESERVATION).select("message.*"))
    assert [r.guest_name for r in flat.orderBy("confo_num_orig").collect()] == [None, "Ann"]
    errors = sorted(r.errorField for r in R.validate_flat(flat).collect())
    assert errors == ["currencyCode", "guest_givenName", "reservationCode", "reservationStatus"]


def test_explode_aligned_length(spark):
    df = spark.createDataFrame([(1, [1, 2, 3], ["a"]), (2, [], ["b"])], "k INT, a ARRAY<INT>, b ARRAY<STRING>")
    assert N.explode_aligned(df, {"x": "a", "y": "b"}).count() == 4
    assert N.explode_aligned(df, {"x": "a", "y": "b"}, keep_short=False).count() == 1


def test_missing_array_is_empty_when_aligned(spark):
    df = spark.createDataFrame([(1, None, ["a", "b"]), (2, None, None)], "k INT, a ARRAY<INT>, b ARRAY<STRING>")
    assert sorted((r.k, r.x, r.y) for r in N.explode_aligned(df, {"x": "a", "y": "b"}).collect()) == [(1, None, "a"), (1, None, "b")]
    assert N.explode_aligned(df, {"x": "a", "y": "b"}, keep_short=False).count() == 0


def test_hot_reservation_key_is_split(spark):
    """A third of the messages carry one reservation number."""
    from pyspark.sql import functions as F

    from millrace.catalog import reservations as C
    from millrace.sources.tables import Tables

    class Hot(Tables):
        @property
        def orders(self):
            plain = Tables(self.spark, self.folder).orders
            hot = F.col("o_orderkey") % 3 == 0
            return plain.withColumns(
                {
                    "o_orderkey": F.when(hot, 9).otherwise(F.col("o_orderkey")),
                    "o_orderdate": F.when(hot, F.lit("1997-03-04").cast("timestamp_ntz")).otherwise(F.col("o_orderdate")),
                }
            ).repartition(8)

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    t = Hot(spark, "/root/testdata/sf0.01")
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        out = R.parse_reservations(C.messages(t), C.dimensions(t))
        got = out.groupBy("confo_num_orig").agg(
            F.count(F.lit(1)).alias("n"), F.max("baseAmount").alias("a"), F.max(F.to_json("guest")), F.max(F.to_json("reservationSegments"))
        )
        rows = got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in settings:
            spark.conf.unset(k)
    top = max(rows, key=lambda r: r.n)
    assert top.confo_num_orig == "9" and top.n == 5000 and top.a > 0 and len(rows) > 1000
    assert "skew=true" in plan
