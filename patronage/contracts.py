"""Event contracts: fixed schemas, keys and defaults. Nothing is ever inferred from data."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Contract:
    name: str
    schema: T.StructType
    key: str
    time_col: str
    required: tuple[str, ...]
    defaults: dict[str, object] = field(default_factory=dict, hash=False)


_TYPES = {
    "string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(),
    "boolean": T.BooleanType(), "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(), "binary": T.BinaryType(), "amount": T.DecimalType(38, 6),
}


def columns_of(text: str) -> T.StructType:
    """Schema from "name type, name type"; unlike DDL parsing it needs no running session."""
    pairs = [part.split() for part in text.split(",")]
    return T.StructType([T.StructField(name, ITEMS if kind == "items" else _TYPES[kind]) for name, kind in pairs])


ITEMS = T.ArrayType(
    T.StructType([
        T.StructField("sku", _TYPES["string"]), T.StructField("quantity", _TYPES["int"]),
        T.StructField("price", _TYPES["double"]),
    ])
)


# Field names, types and defaults of the event contracts.
PROFILE = Contract(
    name="profile",
    schema=columns_of(
        "customer_id string, email string, first_name string, last_name string, "
        "created_at bigint, lifecycle_stage string, is_active boolean"
    ),
    key="customer_id",
    time_col="created_at",
    required=("customer_id", "created_at"),
    defaults={"is_active": True},
)
ORDER = Contract(
    name="order",
    schema=columns_of(
        "order_id string, customer_id string, order_total double, "
        "items items, currency string, channel string, placed_at bigint"
    ),
    key="order_id",
    time_col="placed_at",
    required=("order_id", "customer_id", "order_total", "items", "placed_at"),
    defaults={"currency": "USD"},
)
ACTIVATION = Contract(
    name="activation",
    schema=columns_of(
        "activation_id string, order_id string, customer_id string, channel string, "
        "status string, delivered_at bigint, attempts int"
    ),
    key="activation_id",
    time_col="delivered_at",
    required=("activation_id", "order_id", "customer_id", "channel", "status"),
    defaults={"attempts": 0},
)
SEGMENT = Contract(
    name="segment",
    schema=columns_of("customer_id string, segment string, score double, materialized_at bigint"),
    key="customer_id",
    time_col="materialized_at",
    required=("customer_id", "segment", "score", "materialized_at"),
)
CONTRACTS = {c.name: c for c in (PROFILE, ORDER, ACTIVATION, SEGMENT)}

# Column order of a positional consolidated row.
CONSOLIDATED_COLUMNS = (
    "customer_id", "order_count", "lifetime_value", "last_order_ts", "first_name", "last_name",
    "email", "lifecycle_stage", "is_active", "delivered_messages", "failed_messages",
)

PROFILE_COLUMNS = ("email", "first_name", "last_name", "created_at", "lifecycle_stage", "is_active")


def contract(name: str) -> Contract:
    return CONTRACTS[name]


_PRIMITIVES = {
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.DoubleType(),
    "double": T.DoubleType(),
}


def _spark_type(avro: object) -> T.DataType:
    match avro:
        case str() if avro in _PRIMITIVES:
            return _PRIMITIVES[avro]
        case {"type": "record"}:
            return avro_to_struct(avro)
        case {"type": "array", "items": items}:
            return T.ArrayType(_spark_type(items))
        case {"type": "long", "logicalType": "timestamp-millis"}:
            return T.LongType()
        case {"type": str() as inner} if inner in _PRIMITIVES and "logicalType" not in avro:
            return _PRIMITIVES[inner]
        case list() as union:
            branches = [b for b in union if b != "null"]
            if len(branches) == 1:
                return _spark_type(branches[0])
    raise ValueError(f"Avro type has no place in the event model: {avro!r}")


def avro_to_struct(avsc: dict) -> T.StructType:
    """Table schema of an Avro record: optional unions and timestamps unwrapped, every field nullable."""
    return T.StructType([T.StructField(f["name"], _spark_type(f["type"]), True) for f in avsc["fields"]])
