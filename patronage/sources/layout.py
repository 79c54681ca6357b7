"""The keyed tables of the lake: layer, name, columns, keys and what orders the versions of a key."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from patronage.contracts import columns_of
from patronage.operators.recency import index_schema


@dataclass(frozen=True)
class KeyedTable:
    """`order_by` ranks rows of a key before the batch number does; `cluster_by` is the column readers restrict on;
    `deleted` names the boolean column that marks a removed key."""

    layer: str
    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    cluster_by: str = "customer_id"
    order_by: tuple[str, ...] = ()
    deleted: str | None = None


def _table(layer: str, name: str, ddl: str, keys: tuple[str, ...], **more) -> KeyedTable:
    return KeyedTable(layer, name, columns_of(ddl), keys, **more)


def _facts(name: str, key: str, ddl: str) -> KeyedTable:
    """What the totals count: the newest row of each id, with the one it replaced."""
    row = columns_of(f"source_seq bigint, {ddl}").fields
    columns = [T.StructField(key, T.StringType()), *row, T.StructField("before", T.StructType(row))]
    return KeyedTable("gold", name, T.StructType(columns), (key,), cluster_by=key)


_ARRIVAL = ", ingested_at timestamp, source_seq bigint"
_METRICS = "lifetime_value double, order_count bigint"
_NAMES = "email string, first_name string, last_name string"

TABLES = {
    (t.layer, t.name): t
    for t in (
        _table(
            "silver", "customers",
            f"customer_id string, {_NAMES}, created_at timestamp, lifecycle_stage string, is_active boolean{_ARRIVAL}",
            ("customer_id",), order_by=("source_seq",),
        ),
        _table(
            "silver", "orders",
            "order_id string, customer_id string, order_total double, items items, "
            f"currency string, channel string, placed_at timestamp{_ARRIVAL}",
            ("order_id",), order_by=("source_seq",),
        ),
        _table(
            "silver", "activations",
            "activation_id string, order_id string, customer_id string, channel string, status string, "
            f"delivered_at timestamp, attempts int{_ARRIVAL}",
            ("activation_id",), order_by=("source_seq",),
        ),
        _table(
            "gold", "c360",
            f"customer_id string, {_NAMES}, lifecycle_stage string, is_active boolean, {_METRICS}, "
            "last_order_at timestamp, delivered_messages bigint, failed_messages bigint, updated_at timestamp, removed boolean",
            ("customer_id",), deleted="removed",
        ),
        _facts("orders_facts", "order_id", "customer_id string, order_total double, placed_at timestamp"),
        _facts("activations_facts", "activation_id", "customer_id string, status string"),
        _table(
            "gold", "totals",
            "customer_id string, order_value amount, valued_orders bigint, order_count bigint, last_order_at timestamp, "
            "delivered_messages bigint, failed_messages bigint, applied string",
            ("customer_id",),
        ),
        _table(
            "live", "profile",
            f"customer_id string, {_NAMES}, created_at bigint, lifecycle_stage string, is_active boolean",
            ("customer_id",),
        ),
        _table(
            "live", "enriched_orders",
            "source_seq bigint, order_id string, customer_id string, order_total double, order_channel string, "
            "order_placed_at bigint, customer_email string, lifecycle_stage string",
            ("source_seq", "order_id"),
        ),
        _table("live", "order_summary", f"customer_id string, {_METRICS}, last_order_ts bigint", ("customer_id",)),
        _table(
            "live", "activation_summary",
            "customer_id string, delivered_messages bigint, failed_messages bigint, last_engagement_ts bigint",
            ("customer_id",),
        ),
        _table(
            "live", "c360",
            f"customer_id string, {_NAMES}, lifecycle_stage string, is_active boolean, {_METRICS}, last_order_ts bigint, "
            "delivered_messages bigint, failed_messages bigint",
            ("customer_id",),
        ),
        _table(
            "live", "stage_events",
            f"customer_id string, {_NAMES}, created_at bigint, lifecycle_stage string, is_active boolean",
            ("customer_id",),
        ),
        _table(
            "live", "segment_source",
            f"customer_id string, {_METRICS}, last_order_ts bigint, lifecycle_stage string", ("customer_id",),
        ),
        _table(
            "live", "segments", "customer_id string, segment string, score double, materialized_at bigint",
            ("customer_id",),
        ),
        _table(
            "serving", "customers",
            "customer_id string, order_count bigint, lifetime_value double, last_order_ts bigint, first_name string, "
            "last_name string, email string, lifecycle_stage string, is_active boolean, delivered_messages bigint, "
            "failed_messages bigint, last_engagement_ts bigint, applied string, removed boolean",
            ("customer_id",), deleted="removed",
        ),
        _table(
            "live", "consolidated",
            "customer_id string, order_count bigint, lifetime_value double, last_order_ts bigint, first_name string, "
            "last_name string, email string, lifecycle_stage string, is_active boolean, delivered_messages bigint, "
            "failed_messages bigint, last_engagement_ts bigint",
            ("customer_id",),
        ),
    )
}

_SERVED = TABLES["serving", "customers"].schema
TABLES["serving", "recent"] = KeyedTable("serving", "recent", index_schema(_SERVED), ("slot",), cluster_by="slot")
