"""Decoding and normalisation queries: raw text built from the tables, in every shape a reader must cope with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.contracts import CONSOLIDATED_COLUMNS, ORDER
from patronage.operators.decode import decode_payload, flatten_payload, split_frame, split_valid
from patronage.operators.normalise import normalise_rows, rows_from_columns
from patronage.plans import inputs as I
from patronage.plans.batch import ISO_SQL, consolidated_of
from patronage.plans.registry import query
from patronage.plans.relations import given
from patronage.sources.events import as_records

_ORDER_FIELDS = "order_id, customer_id, order_total, currency, channel, placed_at"


def order_records(spark: SparkSession, sf: str) -> DataFrame:
    """Order events as records; the default currency is left out of the payload, as a writer may."""
    return as_records(I.order_events(spark, sf).drop("currency"), "order_id")


@query("dec_json_payload", given("order_events") + f"""
SELECT source_seq, {_ORDER_FIELDS}, sku AS first_sku, order_total AS first_price FROM order_events""")
def dec_json_payload(spark: SparkSession, sf: str) -> DataFrame:
    p = F.col("payload")
    return decode_payload(order_records(spark, sf), ORDER).select(
        "source_seq", *[p[c].alias(c) for c in _ORDER_FIELDS.split(", ")],
        p["items"][0]["sku"].alias("first_sku"), p["items"][0]["price"].alias("first_price"),
    )


@query("dec_flatten", given("order_events") + f"""
SELECT order_id AS message_key, {_ORDER_FIELDS}, source_seq, epoch_ms(make_timestamp_ms(source_seq)) AS ingested_ms FROM order_events""")
def dec_flatten(spark: SparkSession, sf: str) -> DataFrame:
    flat = flatten_payload(decode_payload(order_records(spark, sf), ORDER))
    return flat.withColumn("ingested_ms", F.unix_millis("ingested_at")).drop("items", "ingested_at")


@query("dec_key", "SELECT CAST(o_orderkey AS VARCHAR) AS message_key, o_orderkey * 2 + 1 AS source_seq FROM orders")
def dec_key(spark: SparkSession, sf: str) -> DataFrame:
    records = order_records(spark, sf).withColumn("key", F.encode("key", "UTF-8"))
    return decode_payload(records, ORDER).select("message_key", "source_seq")


@query("dec_split_frame", """
SELECT c_custkey, CASE WHEN c_custkey % 13 <> 0 THEN CAST(0 AS INTEGER) END AS magic,
       CASE WHEN c_custkey % 13 <> 0 THEN CAST(c_custkey * 131 AS BIGINT) END AS schema_id,
       CASE WHEN c_custkey % 13 <> 0 THEN c_name END AS body FROM customer""")
def dec_split_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Framed customer names; every thirteenth frame is cut off inside its header."""
    schema_id = F.unhex(F.lpad(F.hex(F.col("c_custkey") * 131), 8, "0"))
    frame = F.concat(F.unhex(F.lit("00")), schema_id, F.encode("c_name", "UTF-8"))
    cut = F.when(F.col("c_custkey") % 13 == 0, F.substring(frame, 1, 3)).otherwise(frame)
    parts = split_frame(F.col("frame"))
    return (
        I.table(spark, sf, "customer").select("c_custkey", cut.alias("frame")).withColumn("p", parts)
        .select("c_custkey", "p.magic", "p.schema_id", F.decode("p.body", "UTF-8").alias("body"))
    )


@query("dec_framed_json", given("order_events") + f"SELECT source_seq, {_ORDER_FIELDS} FROM order_events")
def dec_framed_json(spark: SparkSession, sf: str) -> DataFrame:
    framed = order_records(spark, sf).withColumn(
        "value", F.concat(F.unhex(F.lit("0000000007")), F.encode("value", "UTF-8"))
    )
    rows = decode_payload(framed, ORDER, "framed_json")
    return rows.select("source_seq", *[F.col("payload")[c].alias(c) for c in _ORDER_FIELDS.split(", ")])


def damaged_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as JSON text, five of every seven damaged in different ways."""
    k = F.col("o_orderkey")
    text = k.cast("string")
    customer = F.format_string('"customer_id":"%s",', F.col("o_custkey").cast("string"))
    rest = F.lit('"order_total":5.25,"items":[],"placed_at":1}')
    own = F.concat(F.lit('{"order_id":"'), text, F.lit('",'))
    kind = k % 7
    value = (
        F.when(kind == 0, F.concat(own, customer, rest))
        .when(kind == 1, F.concat(own, customer))
        .when(kind == 2, F.concat(own, customer, F.lit('"order_total":"abc","items":[],"placed_at":1}')))
        .when(kind == 4, F.concat(F.lit("{"), customer, rest))
        .when(kind == 5, F.concat(own, rest))
        .when(kind == 6, F.concat(F.lit("{"), customer, rest))
    )
    return I.table(spark, sf, "orders").select(
        F.when(kind != 4, text).alias("key"), value.alias("value"), F.timestamp_millis(k).alias("timestamp"),
        k.alias("source_seq"),
    )


@query("dec_quarantine", """
SELECT o_orderkey AS source_seq,
       CASE o_orderkey % 7 WHEN 1 THEN 'unreadable' WHEN 2 THEN 'unreadable' WHEN 3 THEN 'null_value' WHEN 4 THEN 'no_key'
                           WHEN 5 THEN 'no_customer_id' ELSE 'good' END AS verdict,
       CASE WHEN o_orderkey % 7 IN (0, 6) THEN CAST(o_custkey AS VARCHAR) END AS customer_id
FROM orders""")
def dec_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    good, bad = split_valid(decode_payload(damaged_orders(spark, sf), ORDER), ORDER)
    kept = good.select("source_seq", F.lit("good").alias("verdict"), F.col("payload.customer_id").alias("customer_id"))
    return kept.unionByName(bad.select("source_seq", F.col("reason").alias("verdict")), allowMissingColumns=True)


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def loose_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every event as a dynamic JSON row: mixed key case, union wrappers, text numbers, and values that are no object."""
    k, u = F.col("event_id"), F.col("user_id")
    kind = k % 8
    value = (
        F.when(kind == 0, _text(
            '{"CUSTOMER_ID":"', u, '","First_Name":"f', k, '","email":{"string":"e', k, '"},"order_count":"7","lifetime_value":',
            F.col("value"), ',"is_active":"YES","last_order_ts":', k * 1000, "}"))
        .when(kind == 1, _text(
            '{"first_name":{"STRING":"f', k, '"},"email":"","order_count":12.7,"lifetime_value":"12.5","is_active":0,',
            '"delivered_messages":"12.7"}'))
        .when(kind == 2, _text(
            '{"customer_id":"","first_name":{"x":"f', k, '"},"email":null,"order_count":" 7 ","lifetime_value":"1f",',
            '"is_active":"maybe","failed_messages":3}'))
        .when(kind == 3, _text(
            '{"customer_id":', u, ',"first_name":{"string":{"string":"f', k, '"}},"is_active":true,"last_order_ts":"', k, '"}'))
        .when(kind == 4, _text(
            '{"customer_id":"', u, '","email":"old', k, '","EMAIL":"new', k, '","is_active":"n","order_count":true}'))
        .when(kind == 5, _text("[", k, ",2]"))
        .when(kind == 6, _text("not json ", k))
        .otherwise(_text(
            '{"customer_id":"', u, '","first_name":{"a":{"b":{"c":{"d":"deep', k, '"}}}},',
            '"last_name":{"a":{"b":{"c":{"d":{"e":"x', k, '"}}}}},"lifetime_value":1e3,"is_active":2,"last_engagement_ts":', k, "}"))
    )
    return I.table(spark, sf, "events").select(k.alias("source_seq"), u.cast("string").alias("key"), value.alias("value"))


_TYPED_SQL = """
WITH loose AS (SELECT event_id AS k, CAST(event_id AS VARCHAR) AS t, CAST(user_id AS VARCHAR) AS u, event_id % 8 AS kind, value FROM events),
typed AS (
  SELECT k AS source_seq, u AS customer_id,
         CAST(CASE kind WHEN 0 THEN 7 WHEN 1 THEN 12 WHEN 2 THEN 7 WHEN 4 THEN 1 ELSE 0 END AS BIGINT) AS order_count,
         CAST(CASE kind WHEN 0 THEN value WHEN 1 THEN 12.5 WHEN 7 THEN 1000 ELSE 0 END AS DOUBLE) AS lifetime_value,
         CASE kind WHEN 0 THEN k * 1000 WHEN 3 THEN k END AS last_order_ts,
         CASE WHEN kind < 4 THEN 'f' || t WHEN kind = 7 THEN 'deep' || t END AS first_name,
         CASE WHEN kind = 7 THEN '{"e":"x' || t || '"}' END AS last_name,
         CASE kind WHEN 0 THEN 'e' || t WHEN 4 THEN 'new' || t END AS email,
         CAST(NULL AS VARCHAR) AS lifecycle_stage,
         CASE WHEN kind IN (0, 3, 7) THEN TRUE WHEN kind IN (1, 4) THEN FALSE END AS is_active,
         CAST(0 AS BIGINT) AS delivered_messages,
         CAST(CASE kind WHEN 2 THEN 3 ELSE 0 END AS BIGINT) AS failed_messages,
         CASE WHEN kind = 7 THEN k END AS last_engagement_ts
  FROM loose WHERE kind NOT IN (5, 6))
"""


def _normalised_sql(columns: str) -> str:
    return f"{_TYPED_SQL} SELECT {columns} FROM typed"


_ALL = f"*, {ISO_SQL.format('last_order_ts')} AS last_order_at"
_TEXTS = ("source_seq", "first_name", "last_name", "email", "lifecycle_stage")
_NUMBERS = ("source_seq", "order_count", "lifetime_value", "last_order_ts", "delivered_messages", "failed_messages")
_BOOLEANS = ("source_seq", "customer_id", "is_active")


@query("normalise_rows", _normalised_sql(_ALL))
def normalised(spark: SparkSession, sf: str) -> DataFrame:
    return normalise_rows(loose_rows(spark, sf))


@query("normalise_union_strings", _normalised_sql(", ".join(_TEXTS)))
def normalise_union_strings(spark: SparkSession, sf: str) -> DataFrame:
    return normalised(spark, sf).select(*_TEXTS)


@query("normalise_numbers", _normalised_sql(", ".join(_NUMBERS)))
def normalise_numbers(spark: SparkSession, sf: str) -> DataFrame:
    return normalised(spark, sf).select(*_NUMBERS)


@query("normalise_booleans", _normalised_sql(", ".join(_BOOLEANS)))
def normalise_booleans(spark: SparkSession, sf: str) -> DataFrame:
    return normalised(spark, sf).select(*_BOOLEANS)


@query("rows_from_columns", given("consolidated") + """
SELECT customer_id, CAST(order_count AS VARCHAR) AS order_count,
       CASE WHEN order_count % 3 > 0 THEN CAST(CAST(lifetime_value AS DECIMAL(18,2)) AS VARCHAR) END AS lifetime_value,
       CASE WHEN order_count % 3 > 0 THEN CAST(last_order_ts AS VARCHAR) END AS last_order_ts,
       CASE WHEN order_count % 3 > 1 THEN first_name END AS first_name, CASE WHEN order_count % 3 > 1 THEN last_name END AS last_name,
       CASE WHEN order_count % 3 > 1 THEN email END AS email,
       CASE WHEN order_count % 3 > 1 THEN lifecycle_stage END AS lifecycle_stage,
       CASE WHEN order_count % 3 > 1 THEN CAST(is_active AS VARCHAR) END AS is_active,
       CAST(NULL AS VARCHAR) AS delivered_messages, CAST(NULL AS VARCHAR) AS failed_messages
FROM consolidated""")
def rows_from_columns_query(spark: SparkSession, sf: str) -> DataFrame:
    """Positional rows of two, four or nine columns; the rest of the names stay empty."""
    rows = consolidated_of(spark, sf).withColumn("lifetime_value", F.col("lifetime_value").cast("decimal(18,2)"))
    width = F.element_at(F.array(F.lit(2), F.lit(4), F.lit(9)), (F.col("order_count") % 3 + 1).cast("int"))
    columns = F.slice(F.array(*[F.col(c).cast("string") for c in CONSOLIDATED_COLUMNS]), F.lit(1), width)
    return rows_from_columns(rows.select(columns.alias("columns")), CONSOLIDATED_COLUMNS)
