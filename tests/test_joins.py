import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from patronage.contracts import PROFILE_COLUMNS
from patronage.operators import joins as J
from patronage.operators.skew import hot_keys, segment_bounds, segment_of, spread_join
from patronage.plans import batch as B
from patronage.plans import inputs as I

ORDERS = "source_seq bigint, order_id string, customer_id string, order_total double, channel string, placed_at bigint"
PROFILES = "source_seq bigint, customer_id string, email string, lifecycle_stage string"


def asof_by_hand(orders, profiles):
    """Walk all events in order, profiles first at equal sequence."""
    events = [(s, 0, p) for p in profiles for s in [p[0]]] + [(s, 1, o) for o in orders for s in [o[0]]]
    known, out = {}, []
    for seq, kind, row in sorted(events, key=lambda e: (e[0], e[1])):
        if kind == 0:
            email, stage = known.get(row[1], (None, None))
            known[row[1]] = (row[2] if row[2] is not None else email, row[3] if row[3] is not None else stage)
        else:
            out.append((seq, row[1], row[2], *known.get(row[2], (None, None))))
    return sorted(out, key=str)


def enriched(spark, rows_of, orders, profiles, **how):
    df = J.enrich_orders_asof(spark.createDataFrame(orders, ORDERS), spark.createDataFrame(profiles, PROFILES), **how)
    return rows_of(df, "source_seq", "order_id", "customer_id", "customer_email", "lifecycle_stage")


def test_asof_before_after_same_instant_never(spark, rows_of):
    orders = [(5, "before", "a", 1.0, "web", 0), (10, "same", "a", 1.0, "web", 0), (15, "after", "a", 1.0, "web", 0),
              (25, "partial", "a", 1.0, "web", 0), (5, "never", "b", 1.0, "web", 0)]
    profiles = [(10, "a", "e1", "s1"), (20, "a", None, "s2"), (30, "a", "late", "late")]
    got = enriched(spark, rows_of, orders, profiles)
    assert got == asof_by_hand(orders, profiles)
    assert (25, "partial", "a", "e1", "s2") in got and (10, "same", "a", "e1", "s1") in got
    current = spark.createDataFrame([("a", "late", "late")], "customer_id string, email string, lifecycle_stage string")
    plain = J.enrich_orders(spark.createDataFrame(orders, ORDERS), current)
    assert rows_of(plain, "order_id", "customer_email") == sorted(
        [(o[1], "late" if o[2] == "a" else None) for o in orders], key=str)


@pytest.mark.parametrize("segments", [2, 7, 64])
@pytest.mark.parametrize("seed", [1, 2])
def test_asof_is_the_same_when_hot_customers_are_cut_up(spark, rows_of, segments, seed):
    rng = random.Random(seed)

    def customer():
        return rng.choice(["hot", "hot", "hot2", "c1", "c2", "c3", "c4"])

    orders = [(rng.randrange(400), f"o{i}", customer(), 1.0, "web", i) for i in range(500)]
    seqs = rng.sample(range(400), 150)
    profiles = [(s, customer(), rng.choice([None, f"e{s}"]), rng.choice([None, f"s{s}"])) for s in seqs]
    want = asof_by_hand(orders, profiles)
    assert enriched(spark, rows_of, orders, profiles, hot=["hot", "hot2"], segments=segments) == want
    assert enriched(spark, rows_of, orders, profiles, hot=[]) == want
    assert enriched(spark, rows_of, orders, profiles) == want


def test_hot_keys_and_even_segments(spark):
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 1000 == 1, None).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("seq"))
    assert hot_keys(df, "k", parts=10) == ["hot"]
    cuts = segment_bounds(df, "k", "seq", ["hot"], segments=16)
    sizes = [r["n"] for r in df.where("k = 'hot'").groupBy(segment_of(F.col("seq"), cuts)).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) == 16 and max(sizes) < 1.2 * 10000 / 16


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti", "inner"])
def test_spread_join_equals_plain_join(spark, rows_of, how):
    left = spark.createDataFrame([("hot", i) for i in range(50)] + [("a", 1), ("b", 2), (None, 3), ("hot2", 4)], "k string, n int")
    right = spark.createDataFrame([("hot", "H"), ("a", "A"), ("z", "Z")], "k string, v string")
    plain = rows_of(left.join(right, "k", how))
    spread = spread_join(left, right, "k", how, ["hot", "hot2"], spread_on="n", salts=8)
    assert rows_of(spread) == plain
    if how == "left":
        salted = left.where("k = 'hot'").select(F.pmod(F.xxhash64("n"), F.lit(8)).alias("s")).distinct().count()
        assert salted == 8


CUSTOMERS = "customer_id string, email string, first_name string, last_name string, lifecycle_stage string, is_active boolean"


def test_c360_edges(spark):
    customers = spark.createDataFrame([("idle", "e", "f", "l", "s", True), ("a", "e", "f", "l", "s", True)], CUSTOMERS)
    orders = spark.createDataFrame([("a", "o1", 1.5, 9), ("ghost", "o2", 2.0, 8)], "customer_id string, order_id string, order_total double, placed_at bigint")
    acts = spark.createDataFrame([("a", "delivered")], "customer_id string, status string")
    got = {r.customer_id: r for r in J.build_c360(customers, orders, acts).collect()}
    assert set(got) == {"a", "ghost"}
    assert (got["a"].delivered_messages, got["ghost"].delivered_messages, got["ghost"].email) == (1, 0, None)
    without, unique = J.build_c360(customers, orders, None), J.build_c360(customers, orders, acts, unique_orders=True)
    assert dict(without.dtypes) == dict(unique.dtypes) and dict(without.dtypes)["failed_messages"] == "bigint"
    assert {r.customer_id: r for r in unique.collect()} == got
    assert {r.delivered_messages for r in without.collect()} == {0}


def test_unique_orders_need_one_shuffle_less(spark):
    from patronage.operators.metrics import order_metrics

    orders = spark.createDataFrame([("a", "o1", 1.5, 9)], "customer_id string, order_id string, order_total double, placed_at bigint")

    def shuffles(df):
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

    assert shuffles(order_metrics(orders, unique_orders=True)) == 1
    assert shuffles(order_metrics(orders)) == 2


def test_serving_view_adds_customers_without_orders(spark):
    c360 = spark.createDataFrame([("a", "e", "f", "l", None, None, 5.0, 1, 7, 2, 3)],
                                 CUSTOMERS + ", lifetime_value double, order_count bigint, last_order_ts bigint, delivered_messages bigint, failed_messages bigint")
    profiles = spark.createDataFrame([("a", "x", "x", "x", "known", True), ("p", "e2", "f2", None, "prospect", False)], CUSTOMERS)
    got = {r.customer_id: r for r in J.serving_view(c360, profiles).collect()}
    assert (got["p"].order_count, got["p"].lifetime_value, got["p"].last_order_ts, got["p"].lifecycle_stage) == (0, 0.0, None, "prospect")
    assert (got["a"].email, got["a"].lifecycle_stage, got["a"].order_count) == ("e", "known", 1)


def test_merged_streams_give_the_same_c360_as_joins(spark, rows_of):
    cols = ", ".join(f"{c} {'bigint' if c == 'created_at' else 'boolean' if c == 'is_active' else 'string'}" for c in PROFILE_COLUMNS)
    profiles = spark.createDataFrame([("a", 1, "e", "f", None, 1, "s", True), ("a", 2, None, "g", None, 1, "t", False)], f"customer_id string, source_seq bigint, {cols}")
    orders = spark.createDataFrame([("a", 3, "o1", 2.5, 9), ("a", 4, "o2", 1.25, 8)], "customer_id string, source_seq bigint, order_id string, order_total double, placed_at bigint")
    acts = spark.createDataFrame([("a", 5, "delivered", 1), ("a", 6, "failed", None)], "customer_id string, source_seq bigint, status string, delivered_at bigint")
    row = J.conditional_c360(J.merge_streams(profile=profiles, order=orders, activation=acts)).first()
    assert row[:] == ("a", "e", "g", None, "t", False, 3.75, 2, 9, 1, 1)


@pytest.mark.parametrize("limit", [0, 100])
def test_restricting_to_keys(spark, rows_of, limit):
    from patronage.operators.skew import restrict_to_keys

    df = spark.createDataFrame([("hot", i) for i in range(60)] + [("a", 1), ("b", 2), (None, 3)], "k string, n int")
    keys = spark.createDataFrame([("hot",), ("a",), ("z",)], "k string")
    kept = restrict_to_keys(df, keys, "k", 3, ["n"], limit=limit)
    assert rows_of(kept) == rows_of(df.where("k IN ('hot', 'a')"))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert ("_salt" in plan) == (limit < 3)


def test_messages_of_customers_without_orders(spark, tmp_path, rows_of):
    """Customer 1 has a profile and messages only: no row among the folded ones, no messages and no rate elsewhere."""
    sf = str(tmp_path)
    tables = {
        "customer": [(1, "Customer#000000001", 1, 5.0, "MACHINERY"), (2, "Customer#000000002", 1, 5.0, "MACHINERY")],
        "supplier": [(7, "Supplier#000000007", 1, 5.0)],
        "orders": [(3, 2, "O", 100.0, datetime(1998, 2, 6), "5-LOW")],
        "events": [(n, datetime(2024, 1, 1), n % 2 + 1, "view", 1.0, '{"k": 1}') for n in range(4)],
    }
    for name, rows in tables.items():
        spark.createDataFrame(rows, I.SCHEMAS[name]).write.parquet(f"{sf}/{name}.parquet")
    assert rows_of(B.apply_engagements(spark, sf), "customer_id", "order_count", "delivered_messages") == [("2", 1, 2)]
    assert rows_of(B.engagement_rate(spark, sf)) == [("1", 0.0), ("2", 1.0), ("S-7", 0.0)]
    for rows in (B.union_conditional_c360(spark, sf), B.serving_of(spark, sf)):
        got = rows_of(rows, "customer_id", "order_count", "delivered_messages", "failed_messages")
        assert got == [("1", 0, 0, 0), ("2", 1, 2, 0), ("S-7", 0, 0, 0)]
