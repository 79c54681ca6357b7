import glob
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from patronage import Lake
from patronage.sources.layout import TABLES

SCHEMA = "customer_id string, email string, first_name string, last_name string, created_at timestamp, lifecycle_stage string, is_active boolean, ingested_at timestamp, source_seq bigint"


def profiles(spark, *rows):
    return spark.createDataFrame([(c, e, None, None, None, None, None, None, s) for c, e, s in rows], SCHEMA)


def read(lake, rows_of, **how):
    return rows_of(lake.read("silver", "customers", **how), "customer_id", "email", "source_seq")


def test_upsert_read_compact_reset(spark, root, rows_of):
    lake = Lake(spark, root, buckets=4)
    assert not lake.exists("silver", "customers")
    assert lake.read_or_empty("silver", "customers").count() == 0
    assert lake.upsert_batch(profiles(spark, ("a", "a1", 1), ("a", "a2", 2), ("b", "b1", 1), (None, "x", 1)), 0, "silver", "customers")
    assert read(lake, rows_of) == [("a", "a2", 2), ("b", "b1", 1)]
    assert not lake.upsert_batch(profiles(spark, ("a", "again", 9)), 0, "silver", "customers")
    lake.compact("silver", "customers")
    assert read(lake, rows_of) == [("a", "a2", 2), ("b", "b1", 1)]
    lake.upsert_batch(profiles(spark, ("b", None, 5), ("a", "too old", 1), ("c", "c1", 1)), 1, "silver", "customers")
    now = [("a", "a2", 2), ("b", None, 5), ("c", "c1", 1)]
    assert read(lake, rows_of) == now
    lake.compact("silver", "customers")
    lake.compact("silver", "customers")
    lake.upsert_batch(profiles(spark), 2, "silver", "customers")
    assert read(lake, rows_of) == now
    assert rows_of(lake.lookup("silver", "customers", " b "), "customer_id", "source_seq") == [("b", 5)]
    keys = spark.createDataFrame([("c",), ("nobody",)], "customer_id string")
    assert read(lake, rows_of, within=lake.scope(keys)) == [("c", "c1", 1)]
    lake.reset("silver", "customers")
    assert read(lake, rows_of) == []
    lake.upsert_batch(profiles(spark, ("d", "d1", 1)), 3, "silver", "customers")
    assert read(lake, rows_of) == [("d", "d1", 1)]


def test_uncommitted_batch_is_invisible_and_can_be_written_again(spark, root, rows_of):
    lake = Lake(spark, root)
    lake.upsert_batch(profiles(spark, ("a", "a1", 1)), 0, "silver", "customers")
    half = lake.path("silver", "customers", "changes", "batch=1")
    profiles(spark, ("a", "half written", 2)).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(half)
    assert read(lake, rows_of) == [("a", "a1", 1)]
    assert lake.upsert_batch(profiles(spark, ("a", "a2", 2)), 1, "silver", "customers")
    assert read(lake, rows_of) == [("a", "a2", 2)]


def test_point_read_scans_one_bucket(spark, root):
    lake = Lake(spark, root, buckets=8)
    lake.upsert_batch(profiles(spark, *[(f"c{i}", "e", i) for i in range(200)]), 0, "silver", "customers")
    lake.compact("silver", "customers")
    found = lake.lookup("silver", "customers", "c17")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "EqualTo(customer_id,c17)" in plan
    assert found.count() == 1
    few = lake.scope(spark.createDataFrame([("c17",)], "customer_id string"))
    assert len(few.buckets) == 1
    assert lake.scope(spark.range(1000).select(F.col("id").cast("string").alias("customer_id"))).buckets is None


def test_removed_rows(spark, root, rows_of):
    schema = ("customer_id string, order_count bigint, lifetime_value double, last_order_ts bigint, first_name string, last_name string, email string, "
              "lifecycle_stage string, is_active boolean, delivered_messages bigint, failed_messages bigint, last_engagement_ts bigint, applied string, removed boolean")

    def row(c, removed):
        return (c, 1, 1.0, 1, None, None, None, None, None, 0, 0, None, None, removed)

    lake = Lake(spark, root)
    lake.upsert_batch(spark.createDataFrame([row("a", False), row("b", False)], schema), 0, "serving", "customers")
    lake.upsert_batch(spark.createDataFrame([row("a", True)], schema), 1, "serving", "customers")
    assert rows_of(lake.read("serving", "customers"), "customer_id") == [("b",)]
    lake.compact("serving", "customers")
    assert rows_of(lake.read("serving", "customers"), "customer_id") == [("b",)]
    lake.upsert_batch(spark.createDataFrame([row("a", False)], schema), 2, "serving", "customers")
    assert rows_of(lake.read("serving", "customers"), "customer_id") == [("a",), ("b",)]


changes = st.lists(st.tuples(st.sampled_from("abcd"), st.sampled_from(["x", "y", None])), min_size=1, max_size=12)


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(changes, st.integers(1, 4), st.integers(0, 3))
def test_state_does_not_depend_on_the_split_into_batches(spark, tmp_path_factory, rows_of, events, size, compact_at):
    lake = Lake(spark, str(tmp_path_factory.mktemp("lake")), buckets=2)
    numbered = [(k, v, i) for i, (k, v) in enumerate(events)]
    for batch, start in enumerate(range(0, len(numbered), size)):
        lake.upsert_batch(profiles(spark, *numbered[start:start + size]), batch, "silver", "customers")
        if batch == compact_at:
            lake.compact("silver", "customers")
    want = {k: (k, v, i) for k, v, i in numbered}
    assert read(lake, rows_of) == sorted(want.values(), key=str)


def test_a_writer_that_counts_anew_loses_nothing(spark, root, rows_of):
    lake = Lake(spark, root)
    assert lake.upsert_batch(profiles(spark, ("a", "a1", 1)), 0, "silver", "customers", "first query")
    assert lake.upsert_batch(profiles(spark, ("b", "b1", 1)), 0, "silver", "customers", "second query")
    assert not lake.upsert_batch(profiles(spark, ("b", "again", 9)), 0, "silver", "customers", "second query")
    assert read(lake, rows_of) == [("a", "a1", 1), ("b", "b1", 1)]


def test_files_of_a_batch_are_seen_only_when_it_counts(spark, root):
    lake = Lake(spark, root)

    broken = profiles(spark, ("a", "a1", 1)).withColumn("email", F.raise_error(F.lit("in the middle of writing")).cast("string"))
    with pytest.raises(Exception, match="in the middle"):
        lake.upsert_batch(broken, 0, "silver", "customers")
    assert not glob.glob(lake.path("silver", "customers", "changes", "*"))
    assert lake.upsert_batch(profiles(spark, ("a", "a1", 1)), 0, "silver", "customers")
    for batch in glob.glob(lake.path("silver", "customers", "changes", "*")):
        assert os.path.exists(f"{batch}/_SUCCESS")


def test_a_late_row_of_a_moved_order_shows_under_neither_customer_twice(spark, root, rows_of):
    schema = "order_id string, customer_id string, order_total double, source_seq bigint"
    lake = Lake(spark, root, buckets=8)

    def orders(*rows):
        frame = spark.createDataFrame(rows, schema)
        missing = [f for f in TABLES["silver", "orders"].schema.fields if f.name not in frame.columns]
        return frame.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])

    lake.upsert_batch(orders(("o1", "B", 1.0, 10), ("o2", "A", 1.0, 1)), 0, "silver", "orders")
    lake.compact("silver", "orders")
    lake.upsert_batch(orders(("o1", "A", 1.0, 5)), 1, "silver", "orders")
    whole = rows_of(lake.read("silver", "orders"), "order_id", "customer_id")
    assert whole == [("o1", "B"), ("o2", "A")]
    for customer, owned in (("A", ["o2"]), ("B", ["o1"])):
        keys = spark.createDataFrame([(customer,)], "customer_id string")
        assert rows_of(lake.read("silver", "orders", within=lake.scope(keys)), "order_id") == [(o,) for o in owned]
        assert rows_of(lake.lookup("silver", "orders", customer), "order_id") == [(o,) for o in owned]


def test_a_base_with_another_bucket_count_is_read_whole(spark, root, rows_of):
    wide = Lake(spark, root, buckets=16)
    wide.upsert_batch(profiles(spark, *[(f"c{i}", "e", i) for i in range(20)]), 0, "silver", "customers")
    wide.compact("silver", "customers")
    other = Lake(spark, root, buckets=64)
    assert all(other.lookup("silver", "customers", f"c{i}").count() == 1 for i in range(0, 20, 4))


def test_a_scope_too_large_to_broadcast_is_read_whole_unless_it_must_be_exact(spark, root, rows_of, monkeypatch):
    lake = Lake(spark, root, buckets=4)
    lake.upsert_batch(profiles(spark, ("a", "a1", 1), ("b", "b1", 2)), 0, "silver", "customers")
    monkeypatch.setattr("patronage.sources.lake.BROADCAST_KEYS", 0)
    few = lake.scope(spark.createDataFrame([("a",), ("a",), (None,)], "customer_id string"), distinct=True)
    assert few.large and few.count == 2
    for exact, found in ((True, [("a",)]), (False, [("a",), ("b",)])):
        assert rows_of(lake.read_or_empty("silver", "customers", few, exact), "customer_id") == found
    plan = lake.read_or_empty("silver", "orders", few).join(lake.read("silver", "customers"), "customer_id")
    assert "LocalTableScan <empty>" in plan._jdf.queryExecution().executedPlan().toString()
