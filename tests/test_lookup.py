"""Lookups read what holds their key."""

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from patronage.sources.lake import Lake


def served(spark, keys, value):
    return spark.createDataFrame([(k, value) for k in keys], "customer_id string, order_count bigint").withColumns(
        {c: F.lit(None) for c in ("lifetime_value", "last_order_ts", "first_name", "last_name", "email", "lifecycle_stage", "is_active",
                                  "delivered_messages", "failed_messages", "last_engagement_ts", "applied")}
    )


def scans(df):
    plan = df._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0]
    return [line for line in plan.splitlines() if "FileScan" in line]


def test_a_lookup_filters_every_scan_by_its_key_and_reads_one_bucket(spark, root):
    lake = Lake(spark, root, buckets=4)
    lake.upsert_batch(served(spark, [f"c{i}" for i in range(200)], 1), 0, "serving", "customers")
    lake.compact("serving", "customers")
    lake.upsert_batch(served(spark, ["c7", "c9", "new"], 2), 1, "serving", "customers")
    for key, want in {"c7": [2], " c8 ": [1], "new": [2], "none": []}.items():
        found = lake.lookup("serving", "customers", key)
        lines = scans(found)  # as planned: what turns out empty goes from the plan while it runs
        assert [r.order_count for r in found.collect()] == want
        assert lines and all(f"EqualTo(customer_id,{key.strip()})" in line for line in lines)
        pruned = [line.split("PartitionFilters: [")[1].split("]")[0] for line in lines]
        assert sum("bucket" in filters for filters in pruned) == 2  # the base, as it is and where newer rows contest it


def test_files_are_in_order_of_the_key_and_have_small_bloom_filters(spark, root):
    lake = Lake(spark, root, buckets=4)
    lake.upsert_batch(served(spark, [f"c{i * 7919 % 1000}" for i in range(1000)], 1), 0, "serving", "customers")
    lake.compact("serving", "customers")
    files = glob.glob(f"{root}/serving/customers/base/upto=0/bucket=*/*.parquet")
    assert len(files) == 4
    for file in files:
        keys = pq.read_table(file, columns=["customer_id"], partitioning=None).column("customer_id").to_pylist()
        assert keys == sorted(keys)
        with open(file, "rb") as data:
            size = len(data.read())
        assert size < 40_000  # a filter of the default size alone takes a megabyte


def test_row_groups_go_by_bloom_filter(spark, root):
    """Keys around the wanted one in one row group: only the filter can tell that it is not there."""
    lake = Lake(spark, root, buckets=1)
    lake.upsert_batch(served(spark, [f"c{i:05}" for i in range(0, 20000, 2)], 1), 0, "serving", "customers")
    lake.compact("serving", "customers")
    file = glob.glob(f"{root}/serving/customers/base/upto=0/bucket=0/*.parquet")[0]
    column = pq.ParquetFile(file).metadata.row_group(0).column(0)
    assert column.path_in_schema == "customer_id" and column.statistics.min < "c00777" < column.statistics.max
    for key, rows in {"c00778": 10_000, "c00777": 0}.items():
        found = lake.lookup("serving", "customers", key)
        found.collect()
        node = found._jdf.queryExecution().executedPlan()
        read = [int(m) for m in scanned(node)]
        assert sum(read) <= rows and (rows == 0 or sum(read) > 0)


def scanned(node):
    """Rows that came out of the file scans of a plan that has run."""
    if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        yield from scanned(node.executedPlan())
        return
    if node.getClass().getSimpleName().endswith("QueryStageExec"):
        yield from scanned(node.plan())
        return
    if "FileSourceScan" in node.getClass().getSimpleName():
        yield node.metrics().apply("numOutputRows").value()
    children = node.children()
    for i in range(children.size()):
        yield from scanned(children.apply(i))
