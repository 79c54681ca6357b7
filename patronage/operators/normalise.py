"""Loosely typed JSON rows to the fixed serving schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.functions import variants as V
from patronage.functions.times import ms_to_iso

TEXT_FIELDS = ("first_name", "last_name", "email", "lifecycle_stage")
SERVING_COLUMNS = (
    "customer_id", "order_count", "lifetime_value", "last_order_ts", "first_name", "last_name", "email",
    "lifecycle_stage", "is_active", "delivered_messages", "failed_messages", "last_engagement_ts",
)


def _field(entries: Column, name: str) -> Column:
    """The value stored under a key, null when it is absent. Entries run backwards, so of several spellings of one
    key the last one in the text counts."""
    at = F.nullif(F.array_position(entries["keys"], name), F.lit(0))
    return F.try_element_at(entries["values"], at.cast("int"))


def _parsed(text: Column) -> Column:
    """One row with the object's lower-case keys and its values, or no row at all when the text is no object. As the
    output of a generator they are parsed once, whatever is later computed from them or filtered on them."""
    objects = F.array_compact(F.array(F.from_json(text, "map<string,variant>")))
    return F.explode(F.transform(objects, lambda m: F.struct(
        F.reverse(F.transform(F.map_keys(m), lambda k: F.lower(k))).alias("keys"),
        F.reverse(F.map_values(m)).alias("values"),
    )))


def normalise_rows(df: DataFrame, value_col: str = "value", key_col: str = "key") -> DataFrame:
    """Rows whose value is not a JSON object are left out; other columns are kept in front."""
    keep = [c for c in df.columns if c not in (value_col, key_col)]
    raw = (
        df.withColumn("_entries", _parsed(F.col(value_col).cast("string")))
        .select(
            *keep, F.col(key_col).cast("string").alias("_key"),
            *[_field(F.col("_entries"), n).alias(n) for n in SERVING_COLUMNS],
        )
    )
    own_id = F.col("customer_id")
    use_key = V.is_falsy(own_id) & (F.coalesce(F.col("_key"), F.lit("")) != "")
    typed = raw.select(
        *keep,
        F.when(use_key, F.col("_key")).otherwise(V.as_text(own_id)).alias("customer_id"),
        V.to_bigint(F.col("order_count")).alias("order_count"),
        V.to_double(F.col("lifetime_value")).alias("lifetime_value"),
        V.to_bigint(F.col("last_order_ts"), default=None).alias("last_order_ts"),
        *[V.unwrap_text(F.col(c)).alias(c) for c in TEXT_FIELDS],
        V.to_boolean(F.col("is_active")).alias("is_active"),
        V.to_bigint(F.col("delivered_messages")).alias("delivered_messages"),
        V.to_bigint(F.col("failed_messages")).alias("failed_messages"),
        V.to_bigint(F.col("last_engagement_ts"), default=None).alias("last_engagement_ts"),
    )
    return typed.withColumn("last_order_at", ms_to_iso(F.col("last_order_ts")))


def rows_from_columns(df: DataFrame, names: Sequence[str], array_col: str = "columns") -> DataFrame:
    """Positional array to named columns; arrays that are too short are padded with null."""
    rest = [c for c in df.columns if c != array_col]
    return df.select(*rest, *[F.try_element_at(array_col, F.lit(i)).alias(n) for i, n in enumerate(names, start=1)])
