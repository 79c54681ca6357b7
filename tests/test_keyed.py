from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from patronage.operators import keyed as K
from patronage.operators import metrics as M

PROFILE = "customer_id string, source_seq bigint, email string, stage string"
SERVING = ("customer_id string, order_count bigint, lifetime_value double, last_order_ts bigint, first_name string, last_name string, "
           "email string, lifecycle_stage string, is_active boolean, delivered_messages bigint, failed_messages bigint, "
           "last_engagement_ts bigint")
RELAXED = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def test_whole_row_and_per_column_latest_differ_on_nulls(spark):
    df = spark.createDataFrame([("c", 1, "a", "x"), ("c", 2, None, "y")], PROFILE)
    assert K.latest_row(df, ["customer_id"], ["source_seq"]).first().email is None
    row = K.latest_by_offset(df, "customer_id", ["email", "stage"]).first()
    assert (row.email, row.stage) == ("a", "y")


def test_latest_row_keeps_one_row_per_key_before_the_shuffle(spark):
    df = spark.createDataFrame([("c", 1, "a", "x")], PROFILE)
    plan = K.latest_row(df, ["customer_id"], ["source_seq"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Partial") > plan.index("Exchange") > plan.index("Final")


def test_upsert(spark, rows_of):
    current = spark.createDataFrame([("a", 1, "old", "s"), ("b", 1, "old", "s")], PROFILE)
    batch = spark.createDataFrame([("a", 2, "n1", None), ("a", 3, None, "t"), (None, 9, "x", "x"), ("c", 1, "new", "s")], PROFILE)
    merged = K.upsert(current, batch, ["customer_id"], ["source_seq"])
    assert rows_of(merged) == [("a", 3, None, "t"), ("b", 1, "old", "s"), ("c", 1, "new", "s")]
    assert rows_of(K.upsert(merged, batch, ["customer_id"], ["source_seq"])) == rows_of(merged)
    assert rows_of(K.upsert(current, batch.limit(0), ["customer_id"], ["source_seq"])) == rows_of(current)
    assert rows_of(K.upsert(current.limit(0), current, ["customer_id"], ["source_seq"])) == rows_of(current)


def test_upsert_composite_key(spark, rows_of):
    schema = "a int, b int, seq int, v string"
    current = spark.createDataFrame([(1, 1, 0, "x"), (1, 2, 0, "y")], schema)
    batch = spark.createDataFrame([(1, 2, 1, "z"), (2, None, 1, "null key")], schema)
    assert rows_of(K.upsert(current, batch, ["a", "b"], ["seq"]), "a", "b", "v") == [(1, 1, "x"), (1, 2, "z")]


def serving(spark, *rows):
    return spark.createDataFrame(
        [(c, n, v, ts, f, None, e, s, act, d, x, g) for c, n, v, ts, f, e, s, act, d, x, g in rows], SERVING)


def test_monotone_merge(spark, rows_of):
    old = serving(spark, ("a", 3, 10.0, 50, "F", "e", "customer", True, 2, 2, 9), ("only", 1, 1.0, 1, None, None, None, None, 0, 0, None))
    new = serving(spark, ("a", 2, 12.0, 40, None, None, "engaged", False, 3, 1, None), ("fresh", 0, 0.0, None, "N", "", None, None, 0, 0, None))
    got = {r.customer_id: r for r in K.monotone_merge(old, new).collect()}
    a = got["a"]
    assert (a.order_count, a.lifetime_value, a.last_order_ts, a.delivered_messages, a.failed_messages, a.last_engagement_ts) == (3, 12.0, 50, 3, 2, 9)
    assert (a.first_name, a.email, a.lifecycle_stage, a.is_active) == ("F", "e", "engaged", False)
    assert set(got) == {"a", "only", "fresh"} and got["fresh"].last_order_ts is None and got["fresh"].email == ""


def test_tombstones(spark, rows_of):
    current = spark.createDataFrame([("upd-del",), ("del-upd",), ("kept",)], "customer_id string")
    changes = spark.createDataFrame(
        [("upd-del", "v", 1), ("upd-del", None, 2), ("del-upd", None, 1), ("del-upd", "v", 2), ("unknown", None, 1)],
        "key string, value string, source_seq bigint")
    assert rows_of(K.apply_tombstones(current, changes)) == [("del-upd",), ("kept",)]


def test_fill_profile(spark, rows_of):
    schema = "customer_id string, first_name string, email string, lifecycle_stage string, n int"
    rows = spark.createDataFrame([("a", "", None, "s", 1), ("b", "B", None, "s", 2), ("c", None, None, "s", 3), ("d", None, "", None, 4)], schema)
    profiles = spark.createDataFrame([("a", "A", None, "p"), ("b", "X", "x", "p"), ("c", None, "", "p"), ("d", None, "d@x", None)],
                                     "customer_id string, first_name string, email string, lifecycle_stage string")
    assert rows_of(K.fill_profile(rows, profiles)) == [
        ("a", "A", None, "p", 1), ("b", "B", None, "s", 2), ("c", None, None, "s", 3), ("d", None, "d@x", None, 4)]


def test_order_metrics_distinct_and_plain_counts(spark):
    orders = spark.createDataFrame([("c", "o1", 1.1, 5), ("c", "o1", 1.1, 6), ("c", "o2", 2.2, 4)], "customer_id string, order_id string, order_total double, placed_at bigint")
    lake = M.order_metrics(orders).first()
    assert (lake.order_count, lake.lifetime_value, lake.last_order_at) == (2, 4.4, 6)
    live = M.order_summary(orders.withColumnRenamed("placed_at", "order_placed_at")).first()
    assert (live.order_count, live.lifetime_value, live.last_order_ts) == (3, 4.4, 6)


def test_null_status_counts_in_neither(spark):
    df = spark.createDataFrame([("c", "delivered", 5), ("c", None, None), ("c", "failed", None)], "customer_id string, status string, delivered_at bigint")
    assert M.activation_metrics(df).first()[:] == ("c", 1, 1)
    assert M.activation_summary(df).first()[:] == ("c", 1, 1, 5)


def test_folds(spark):
    start = serving(spark, ("a", 1, 4999.99, 10, "F", "e", "customer", False, 7, 3, 1), ("idle", 0, 0.0, None, None, None, "prospect", False, 0, 0, None))
    orders = spark.createDataFrame([("a", 0.02, 9), ("new", 5.0, 3), ("new", 5.5, 2)], "customer_id string, order_total double, placed_at bigint")
    got = {r.customer_id: r for r in M.apply_orders(start, orders).collect()}
    assert (got["a"].order_count, got["a"].lifetime_value, got["a"].last_order_ts, got["a"].is_active, got["a"].lifecycle_stage) == (2, 5000.01, 10, True, "evangelist")
    assert (got["new"].order_count, got["new"].lifetime_value, got["new"].last_order_ts, got["new"].lifecycle_stage) == (2, 10.5, 3, "customer")
    assert (got["idle"].is_active, got["idle"].lifecycle_stage) == (False, "prospect")
    events = spark.createDataFrame([("a", "failed", None), ("a", None, None), ("fresh", "delivered", 8)], "customer_id string, status string, delivered_at bigint")
    got = {r.customer_id: r for r in M.apply_engagements(start, events).collect()}
    assert (got["a"].delivered_messages, got["a"].failed_messages, got["a"].last_engagement_ts, got["a"].lifecycle_stage) == (7, 5, 1, "engaged")
    assert (got["fresh"].delivered_messages, got["fresh"].order_count, got["fresh"].last_engagement_ts, got["fresh"].lifecycle_stage) == (1, 0, 8, "prospect")


events = st.lists(st.tuples(st.sampled_from("abc"), st.one_of(st.none(), st.sampled_from(["x", "y", ""]))), min_size=1, max_size=20)


@RELAXED
@given(events, st.randoms())
def test_latest_does_not_depend_on_arrival(spark, rows_of, values, rng):
    data = [(k, i, v, None) for i, (k, v) in enumerate(values)]
    shuffled = list(data)
    rng.shuffle(shuffled)
    whole, parts = {}, {}
    for k, i, v, _ in data:
        whole[k] = (k, i, v, None)
        parts[k] = v if v is not None else parts.get(k)
    df = spark.createDataFrame(shuffled, PROFILE).repartition(3)
    assert rows_of(K.latest_row(df, ["customer_id"], ["source_seq"])) == sorted(whole.values(), key=str)
    assert rows_of(K.latest_by_offset(df, "customer_id", ["email"])) == sorted(parts.items(), key=str)


counters = st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 9), st.integers(0, 9)), max_size=6, unique_by=lambda t: t[0])


@RELAXED
@given(counters, counters)
def test_monotone_merge_numbers_commute(spark, rows_of, left, right):
    def rows(data):
        return serving(spark, *[(c, n, float(v), n, None, None, None, None, v, n, None) for c, n, v in data])

    numbers = ("customer_id", "order_count", "lifetime_value", "delivered_messages", "last_order_ts")
    one, other = K.monotone_merge(rows(left), rows(right)), K.monotone_merge(rows(right), rows(left))
    assert rows_of(one, *numbers) == rows_of(other, *numbers)
    assert rows_of(K.monotone_merge(one, rows(right)), *numbers) == rows_of(one, *numbers)
