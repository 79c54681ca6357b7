"""Benchmark tables as the event relations: every row of a table becomes one event, computed from that row alone.

orders -> order events; events -> activation events and profile updates; customer and supplier -> first profile
events (suppliers place no orders, so they are the customers known by profile only); lineitem -> re-sent order
events and orders with line items.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from patronage.contracts import PROFILE_COLUMNS, columns_of
from patronage.functions.times import ms_to_ts
from patronage.operators.keyed import latest_by_offset

# Declared, so that reading a table starts no schema-inference job. The stored timestamps carry no zone and are read
# as instants of the session zone, which `table` sets to UTC.
SCHEMAS = {
    "customer": columns_of("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
    "supplier": columns_of("s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"),
    "orders": columns_of(
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
        "o_orderpriority string"
    ),
    "lineitem": columns_of(
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": columns_of(
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _amount(price: str, scale: int) -> str:
    """Price divided by a whole number, cut to cents."""
    return f"(bigint(floor({price} * 100.0D + 0.5D)) div {scale}L) / 100.0D"


def _ms(instant: str) -> str:
    return f"unix_millis(timestamp({instant}))"


def order_events(spark: SparkSession, sf_dir: str, scale: int = 1) -> DataFrame:
    total = _amount("o_totalprice", scale)
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey * 2 + 1 AS source_seq",
        "string(o_orderkey) AS order_id",
        "string(o_custkey) AS customer_id",
        f"{total} AS order_total",
        f"array(struct('SKU-' || string(o_orderkey % 6) AS sku, 1 AS quantity, {total} AS price)) AS items",
        "'USD' AS currency",
        "nullif(o_orderpriority, '4-NOT SPECIFIED') AS channel",
        f"{_ms('o_orderdate')} + o_orderkey * 1237 % 86400000 AS placed_at",
    )


def resent_orders(spark: SparkSession, sf_dir: str, scale: int = 1) -> DataFrame:
    """Line items read as order events: order ids repeat, many customers share an order id."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "string(l_orderkey) AS order_id", "string(l_suppkey) AS customer_id",
        f"{_amount('l_extendedprice', scale)} AS order_total", f"{_ms('l_shipdate')} AS placed_at",
    )


def moved_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh order, sent again later under the next customer, dearer and with an earlier time."""
    again = order_events(spark, sf_dir).where("bigint(order_id) % 7 = 0")
    return again.withColumns({
        "source_seq": again["source_seq"] + 10**12, "customer_id": (again["customer_id"].cast("bigint") + 1).cast("string"),
        "order_total": again["order_total"] + 1.0, "placed_at": again["placed_at"] - 864_000_000,
    })


def activation_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    delivered = "event_type IN ('click', 'view', 'purchase')"
    return table(spark, sf_dir, "events").selectExpr(
        "event_id * 3 + 2 AS source_seq",
        "string(event_id) AS activation_id",
        "'ENG-' || string(event_id) AS order_id",
        "string(user_id) AS customer_id",
        "event_type AS channel",
        f"if({delivered}, 'delivered', 'failed') AS status",
        f"if({delivered}, {_ms('ts')}, NULL) AS delivered_at",
        "int(get_json_object(props, '$.k')) % 3 + 1 AS attempts",
    )


def first_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One profile event per customer and per supplier; some stages, e-mails and names are missing or blank."""
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey * 21 + 1 AS source_seq",
        "string(c_custkey) AS customer_id",
        "if(c_custkey % 5 <> 0, lower(c_name) || '@example.com', NULL) AS email",
        "if(c_custkey % 10 = 0, '', 'Customer') AS first_name",
        "substring_index(c_name, '#', -1) AS last_name",
        "1577836800000 + c_custkey * 60001 AS created_at",
        "if(c_custkey % 7 <> 0, lower(c_mktsegment), NULL) AS lifecycle_stage",
        "c_acctbal >= 0 AS is_active",
    )
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey * 21 + 1 AS source_seq",
        "'S-' || string(s_suppkey) AS customer_id",
        "'s' || string(s_suppkey) || '@example.com' AS email",
        "'Supplier' AS first_name",
        "substring_index(s_name, '#', -1) AS last_name",
        "1577836800000 + s_suppkey * 60001 AS created_at",
        "'prospect' AS lifecycle_stage",
        "false AS is_active",
    )
    return customers.unionByName(suppliers)


def profile_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a partial profile update: names always missing, e-mail and stage now and then."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id * 3 AS source_seq",
        "string(user_id) AS customer_id",
        "if(event_id % 3 <> 0, 'u' || string(event_id) || '@mail.example.com', NULL) AS email",
        "string(NULL) AS first_name",
        "string(NULL) AS last_name",
        f"{_ms('ts')} AS created_at",
        "if(event_id % 5 <> 0, event_type, NULL) AS lifecycle_stage",
        "event_type <> 'error' AS is_active",
    )


def profile_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_profiles(spark, sf_dir).unionByName(profile_updates(spark, sf_dir))


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_by_offset(profile_events(spark, sf_dir), "customer_id", PROFILE_COLUMNS)


def silver_form(events: DataFrame, instant: str) -> DataFrame:
    return events.withColumn(instant, ms_to_ts(events[instant]))
