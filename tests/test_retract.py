"""Gold kept by differences."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from test_streams import ACTIVATION, EVENTS, GOLD, ORDER, ORDERS, PROFILE, WANT_GOLD, drop, feed, pipe  # noqa: F401

from patronage.operators import retract as D
from patronage.operators.keyed import latest_row
from patronage.operators.metrics import activation_metrics, order_metrics

FACT = "order_id string, customer_id string, order_total double, placed_at timestamp, source_seq bigint"
TOTALS = ("customer_id string, order_value decimal(38,6), valued_orders bigint, order_count bigint, last_order_at timestamp, "
          "delivered_messages bigint, failed_messages bigint, applied string")
COLUMNS = ("customer_id", "order_total", "placed_at")


def at(minute):
    return dt.datetime(2024, 1, 1, 0, minute)


def test_images_keep_what_a_changed_row_replaces(spark, rows_of):
    stored = spark.createDataFrame([("o1", "a", 1.0, at(1), 5), ("o2", "a", 2.0, at(2), 6), ("o3", None, None, None, None)], FACT)
    batch = spark.createDataFrame([
        ("o1", "b", 1.5, at(3), 7, 0), ("o1", "c", 1.5, at(3), 7, 1),  # the later batch counts
        ("o2", "z", 9.0, at(9), 4, 2),  # late
        ("o3", None, None, None, None, 2),  # there already
        ("o4", "d", float("nan"), None, 1, 2),
    ], FACT + ", batch bigint")
    got = {r.order_id: r for r in D.with_images(stored, batch, "order_id", COLUMNS).collect()}
    assert set(got) == {"o1", "o4"}
    assert (got["o1"].customer_id, got["o1"].before.customer_id, got["o4"].before) == ("c", "a", None)
    signs = rows_of(D.signed(D.with_images(stored, batch, "order_id", COLUMNS), COLUMNS), "sign", "customer_id")
    assert signs == [(-1, "a"), (1, "c"), (1, "d")]


def test_an_empty_table_has_no_images(spark):
    none = spark.createDataFrame([], FACT)
    batch = none.withColumn("batch", F.lit(0).cast("bigint"))
    images = D.with_images(none, batch, "order_id", COLUMNS)
    assert images.count() == 0 and D.signed(images, COLUMNS).count() == 0


def versions(seed):
    """Versions of a few orders: moves, null customers, null and unusable amounts, times that go back, repeated rows."""
    import random

    draw = random.Random(seed)
    amounts = [1.25, 0.1, 0.2, None, float("nan"), -3.0, 1e6]
    for seq in range(40):
        customer = draw.choice(["a", "a", "a", "b", "c", None])
        yield (f"o{draw.randrange(8)}", customer, draw.choice(amounts), at(draw.randrange(6)) if draw.random() < 0.9 else None, seq)


@pytest.mark.parametrize("seed", range(3))
def test_totals_by_differences_equal_totals_of_the_newest_rows(spark, seed):
    every = list(versions(seed))
    stored = spark.createDataFrame([], FACT)
    totals = spark.createDataFrame([], TOTALS)
    for number in range(4):
        batch = spark.createDataFrame([(*v, number) for v in every[number * 10:number * 10 + 10]], FACT + ", batch bigint")
        images = D.with_images(stored, batch, "order_id", COLUMNS)
        changes = D.differences(D.signed(images, COLUMNS).withColumns({"kind": F.lit("order"), "status": F.lit(None).cast("string")}))
        now = latest_row(spark.createDataFrame(every[:number * 10 + 10], FACT), ["order_id"], ["source_seq"])
        after = D.with_newest_orders(D.apply_differences(totals, changes, f"q-{number}"), now).drop("_lost")
        again = D.apply_differences(after, changes, f"q-{number}").drop("_lost")
        assert sorted(map(tuple, after.collect()), key=str) == sorted(map(tuple, again.collect()), key=str)
        rest = totals.join(after.select("customer_id"), "customer_id", "left_anti")
        totals = spark.createDataFrame(rest.unionByName(after).collect(), TOTALS)
        stored = spark.createDataFrame(now.collect(), FACT)
        known = spark.createDataFrame([], "customer_id string, email string, first_name string, last_name string, lifecycle_stage string, is_active boolean")
        got = D.c360_of_totals(totals, known).select("customer_id", "lifetime_value", "order_count", "last_order_at")
        want = order_metrics(now.where("customer_id IS NOT NULL"), unique_orders=True)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_message_counts_by_differences(spark, rows_of):
    fact = "activation_id string, customer_id string, status string, source_seq bigint"
    first = spark.createDataFrame([("m1", "a", "delivered", 1), ("m2", "a", None, 2), ("m3", "b", "failed", 3)], fact)
    second = spark.createDataFrame([("m1", "b", "failed", 4, 1), ("m2", "a", "delivered", 5, 1)], fact + ", batch bigint")
    columns, totals = ("customer_id", "status"), spark.createDataFrame([], TOTALS)
    empty = {"kind": F.lit("activation"), "order_total": F.lit(None).cast("double"), "placed_at": F.lit(None).cast("timestamp")}
    for name, (stored, batch) in {"q-0": (first.limit(0), first.withColumn("batch", F.lit(0))), "q-1": (first, second)}.items():
        changes = D.differences(D.signed(D.with_images(stored, batch, "activation_id", columns), columns).withColumns(empty))
        totals = spark.createDataFrame(D.apply_differences(totals, changes, name).drop("_lost").collect(), TOTALS)
    now = latest_row(first.unionByName(second.drop("batch")), ["activation_id"], ["source_seq"])
    assert rows_of(totals, "customer_id", "delivered_messages", "failed_messages") == rows_of(activation_metrics(now)) == [("a", 1, 0), ("b", 0, 2)]


def test_changed_rows(spark, rows_of):
    schema = "k string, x double, y string"
    before = spark.createDataFrame([("same", None, "y"), ("gone", 1.0, None), ("other", 1.0, None)], schema)
    after = spark.createDataFrame([("same", None, "y"), ("other", 1.0, "y"), ("new", None, None)], schema)
    got = rows_of(D.changed_rows(before, after, "k"))
    assert got == sorted([("gone", None, None, True), ("other", 1.0, "y", False), ("new", None, None, False)], key=str)


def run_totals(pipe, finished=True):  # noqa: F811
    steps = [
        [lambda s=s: pipe.run_bronze(s) for s in EVENTS],
        [lambda n=n: pipe.run_silver(n) for n in ("customers", "orders", "activations")],
        [lambda n=n: pipe.run_facts(n) for n in ("orders", "activations")],
    ] + ([[pipe.run_gold_totals]] if finished else [])
    for step in steps:
        pipe.finish(*[start() for start in step])


def test_gold_by_differences_follows_moves_and_takes_back_the_newest_order(pipe, rows_of):  # noqa: F811
    for spec in EVENTS:
        feed(pipe, spec)
    run_totals(pipe)
    assert rows_of(pipe.lake.read("gold", "c360"), *GOLD) == WANT_GOLD
    # the order that holds the newest time moves, and the only order of one customer goes to another
    drop(pipe.topics["order"], 50, ORDER, [(20, {**ORDERS[5][1], "customer_id": "b", "placed_at": 40}), (21, {**ORDERS[2][1], "customer_id": "late"})])
    drop(pipe.topics["order"], 51, ORDER, [(1, {**ORDERS[0][1], "customer_id": "b"})])  # older than what is there
    run_totals(pipe)
    got = {r.customer_id: r for r in pipe.lake.read("gold", "c360").collect()}
    assert set(got) == {"a", "b", "late"}
    assert (got["a"].lifetime_value, got["a"].order_count, got["b"].lifetime_value, got["b"].order_count) == (10.6, 2, 7.25, 2)
    whole = {r.customer_id: r[:-1] for r in pipe.gold_rows().collect()}
    assert {c: r[:-1] for c, r in got.items()} == whole
    pipe.finish(pipe.run_publish_c360())
    sent = pipe.spark.read.schema("key string, value string, source_seq bigint").json(pipe.published_path("c360")).collect()
    assert max((r.source_seq, r.value) for r in sent if r.key == "ghost")[1] is None


def test_an_unchanged_customer_emits_nothing(pipe, rows_of):  # noqa: F811
    for spec in EVENTS:
        feed(pipe, spec)
    run_totals(pipe)
    pipe.finish(pipe.run_publish_c360())
    path = pipe.published_path("c360")
    sent = pipe.spark.read.schema("key string, value string").json(path).count()
    drop(pipe.topics["order"], 60, ORDER, [(30, ORDERS[0][1])])  # the same order again
    drop(pipe.topics["activation"], 60, ACTIVATION, [(31, EVENTS[ACTIVATION][3][1])])
    drop(pipe.topics["profile"], 60, PROFILE, [(32, {**EVENTS[PROFILE][4][1], "first_name": "B"})])  # one that does change
    run_totals(pipe)
    pipe.finish(pipe.run_publish_c360())
    rows = pipe.spark.read.schema("key string, value string").json(path)
    assert rows.count() == sent + 1 and rows_of(pipe.lake.read("gold", "c360").where("first_name = 'B'"), "customer_id") == [("b",)]


@pytest.mark.parametrize("step", ["move", "touch"])
@pytest.mark.parametrize("call", [1, 2])
def test_totals_count_once_wherever_their_writer_dies(pipe, rows_of, monkeypatch, step, call):  # noqa: F811
    from patronage.sources import fs

    for spec in EVENTS:
        feed(pipe, spec)
    run_totals(pipe, finished=False)
    real, calls = getattr(fs, step), []

    def dying(*args):
        calls.append(args)
        if len(calls) == call:
            raise OSError("the writer dies here")
        return real(*args)

    monkeypatch.setattr(fs, step, dying)
    with pytest.raises(Exception, match="the writer dies here"):
        pipe.finish(pipe.run_gold_totals())
    monkeypatch.setattr(fs, step, real)
    pipe.finish(pipe.run_gold_totals())
    assert rows_of(pipe.lake.read("gold", "c360"), *GOLD) == WANT_GOLD


def test_no_history_is_read(pipe, monkeypatch):  # noqa: F811
    def history(*_):
        raise AssertionError("the change history is read")

    monkeypatch.setattr(type(pipe.lake), "versions", history)
    read, orders = type(pipe.lake).read_or_empty, []

    def watch(self, layer, name, within=None):
        orders.extend([name] if (layer, name) == ("silver", "orders") else [])
        assert within is not None
        return read(self, layer, name, within)

    monkeypatch.setattr(type(pipe.lake), "read_or_empty", watch)
    for spec in EVENTS:
        feed(pipe, spec, files=1)
    run_totals(pipe)
    assert orders == []
