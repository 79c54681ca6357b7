import pytest
from pyspark.sql import functions as F

from patronage.functions.money import exact_sum, order_total, round_amount
from patronage.functions.rules import engagement_rate
from patronage.functions.times import ms_to_iso, ms_to_ts, ts_to_ms, with_processing_time
from patronage.operators.segments import materialise_segments, propensity, segment, stage_transitions, with_lifecycle_stage
from patronage.operators.serving import dashboard_view, lookup, recent_customers, to_message

METRICS = "order_count bigint, lifetime_value double, delivered_messages bigint, failed_messages bigint"


@pytest.mark.parametrize("row, stage", [
    ((0, 9999.0, 9, 0), "prospect"),
    ((1, 5000.0, 7, 3), "engaged"),
    ((1, 5000.01, 7, 3), "evangelist"),
    ((1, 5000.01, 6, 4), "high-value"),
    ((1, 10.0, 5, 5), "customer"),
    ((1, 10.0, 0, 0), "customer"),
    ((1, 10.0, 51, 49), "engaged"),
    ((3, 5000.01, 0, 0), "high-value"),
])
def test_lifecycle_stage(spark, row, stage):
    df = with_lifecycle_stage(spark.createDataFrame([row], METRICS))
    assert df.first()["lifecycle_stage"] == stage


@pytest.mark.parametrize("value, orders, stage, label", [
    (200.0, 1, "engaged", "vip"), (199.99, 2, None, "growth"), (199.99, 1, None, "unknown"), (0.0, 1, "engaged", "engaged"),
    (0.0, 1, "", ""),
])
def test_segment_first_match_wins(spark, value, orders, stage, label):
    schema = "customer_id string, lifetime_value double, order_count bigint, lifecycle_stage string"
    assert segment(spark.createDataFrame([("c", value, orders, stage)], schema)).first()["segment"] == label


def test_segment_score_rounds_half_up_at_ties(spark):
    schema = "customer_id string, lifetime_value double, order_count bigint, lifecycle_stage string"
    df = spark.createDataFrame([("a", 1.0, 0, None), ("b", 201.0, 3, None), ("c", 0.0, 0, None)], schema)
    scores = {r["customer_id"]: r["score"] for r in segment(df).collect()}
    assert scores == {"a": 0.01, "b": 1.31, "c": 0.0}
    assert materialise_segments(df, F.lit(5)).first()["materialized_at"] == 5


def test_propensity_limits(spark):
    schema = f"customer_id string, email string, lifecycle_stage string, {METRICS}"
    data = [("zero", None, None, 0, 0.0, 0, 0), ("high", None, None, 0, 750000.0, 0, 0), ("low", None, None, 0, 0.0, 0, 20000),
            ("mixed", None, None, 2, 30.0, 1, 3)]
    found = {r["customer_id"]: r["propensity"] for r in propensity(spark.createDataFrame(data, schema)).collect()}
    assert found == {"zero": 0.5, "high": 1.0, "low": 0.0, "mixed": 0.7685}


def test_engagement_rate_without_messages(spark):
    df = spark.createDataFrame([(0, 0), (3, 1)], "d bigint, f bigint")
    assert [r[0] for r in df.select(engagement_rate(F.col("d"), F.col("f"))).collect()] == [0.0, 0.75]


def test_stage_transitions(spark, rows_of):
    before = spark.createDataFrame([("same", "customer"), ("up", "customer"), ("null", None)], "customer_id string, lifecycle_stage string")
    schema = "customer_id string, email string, first_name string, last_name string, lifecycle_stage string"
    after = spark.createDataFrame(
        [(c, None, None, None, s) for c, s in
         [("same", "customer"), ("up", "engaged"), ("null", "prospect"), ("new", "prospect"), ("new2", "customer")]], schema)
    out = stage_transitions(before, after, now=F.lit(7))
    assert rows_of(out, "customer_id", "lifecycle_stage", "is_active", "created_at") == [
        ("new2", "customer", True, 7), ("null", "prospect", True, 7), ("up", "engaged", True, 7)]


def test_times(spark):
    ms = 1704067200123
    df = spark.createDataFrame([(ms,), (None,), (1704067200000,), (-1,)], "ms bigint")
    got = df.select(ms_to_ts(F.col("ms")).cast("string"), ts_to_ms(ms_to_ts(F.col("ms"))), ms_to_iso(F.col("ms"))).collect()
    assert tuple(got[0]) == ("2024-01-01 00:00:00.123", ms, "2024-01-01T00:00:00.123000+00:00")
    assert tuple(got[1]) == (None, None, None)
    assert got[2][2] == "2024-01-01T00:00:00+00:00"
    assert got[3][1:] == (-1, "1969-12-31T23:59:59.999000+00:00")
    assert with_processing_time(df, "now", F.lit(1)).first()["now"] == 1
    assert with_processing_time(df, "now").schema["now"].dataType.simpleString() == "timestamp"


def test_money(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (None,), (1e9 + 0.01,)], "x double")
    assert df.agg(exact_sum(F.col("x"))).first()[0] == 1000000000.31
    assert spark.range(1).select(round_amount(F.lit(1.005)), round_amount(F.lit(-1.005))).first()[:] == (1.01, -1.01)
    items = spark.createDataFrame([([("a", 3, 79.99), ("b", 1, 25.0)],), ([],)], "items array<struct<sku:string,quantity:int,price:double>>")
    assert [r[0] for r in items.select(order_total(F.col("items"))).collect()] == [264.97, 0.0]


SERVING = ("customer_id string, first_name string, last_name string, email string, lifecycle_stage string, is_active boolean, "
           "order_count bigint, lifetime_value double, last_order_ts bigint, delivered_messages bigint, failed_messages bigint")


def test_recent_customers_ties_nulls_and_limits(spark):
    df = spark.createDataFrame([("a", 5), ("b", None), ("c", 9), ("d", 5), ("e", 0)], "customer_id string, last_order_ts bigint")

    def ids(n):
        return [r["customer_id"] for r in recent_customers(df, n).collect()]

    assert ids(2) == ["c", "d"]
    assert ids(4) == ["a", "c", "d", "e"]
    assert ids(0) == []
    assert ids(100) == ["a", "b", "c", "d", "e"]


def test_dashboard_row(spark):
    data = [("a", "", "Kim", "", None, None, 1, 1234.5, 1704067200000, 2, 1), ("b", None, None, "e@x", "vip", False, 0, None, None, 0, 0),
            ("c", "Jo", "Kim", "e", "s", True, None, 0.0, 1, 29, 71)]
    a, b, c = dashboard_view(spark.createDataFrame(data, SERVING)).orderBy("customer_id").collect()
    assert (a.full_name, a.email, a.lifecycle_stage, a.status, a.lifetime_value) == ("Kim", "—", "—", "—", "1234.50")
    assert (a.last_order_at, a.total_messages, a.delivery_rate_pct) == ("2024-01-01T00:00:00+00:00", 3, 66)
    assert (b.full_name, b.status, b.lifetime_value, b.last_order_at, b.delivery_rate_pct) == ("—", "Inactive", "—", "—", None)
    # the rate is cut after the floating-point product, as in the page it feeds: 29 of 100 is 28.999...
    assert (c.full_name, c.status, c.order_count, c.delivery_rate_pct) == ("Jo Kim", "Active", 0, 28)


def test_lookup_takes_the_id_as_data(spark):
    df = spark.createDataFrame([("a' OR '1'='1", 1), ("b", 2)], "customer_id string, n int")
    assert lookup(df, " b ", ["n"]).collect()[0].n == 2
    assert lookup(df, "a' OR '1'='1").count() == 1
    assert lookup(df, "zzz").count() == 0


def test_message_leaves_nulls_out(spark):
    df = spark.createDataFrame([("k", None, 1)], "customer_id string, email string, n int")
    assert tuple(to_message(df, "customer_id", ["customer_id", "email", "n"]).first()) == ("k", '{"customer_id":"k","n":1}')
