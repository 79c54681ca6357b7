"""What readers ask for: lookups, the most recent customers, the dashboard row and published messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.functions.profile import activity_label, blank_to_null, full_name
from patronage.functions.times import ms_to_iso, ts_to_ms

DEFAULT_LIMIT = 250


def lookup(df: DataFrame, customer_id: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows of one customer; the id (blanks around it ignored) is a literal, never spliced into SQL text."""
    rows = df.where(F.col("customer_id") == F.lit(customer_id.strip()))
    return rows if columns is None else rows.select(*columns)


def recent_customers(serving: DataFrame, n: int = DEFAULT_LIMIT) -> DataFrame:
    """The n customers with the newest orders (none counts as 0, ties by id descending), listed by id."""
    newest = serving.orderBy(F.desc(F.coalesce("last_order_ts", F.lit(0))), F.desc("customer_id")).limit(n)
    return newest.orderBy(F.col("customer_id").cast("string"))


def dashboard_view(serving: DataFrame) -> DataFrame:
    delivered = F.coalesce("delivered_messages", F.lit(0))
    failed = F.coalesce("failed_messages", F.lit(0))
    total = delivered + failed

    def or_dash(name: str):
        return F.coalesce(blank_to_null(F.col(name)), F.lit("—")).alias(name)

    rate = F.floor(delivered.cast("double") / F.nullif(total, F.lit(0)).cast("double") * 100)
    return serving.select(
        "customer_id",
        full_name(F.col("first_name"), F.col("last_name")).alias("full_name"),
        or_dash("email"),
        or_dash("lifecycle_stage"),
        activity_label(F.col("is_active")).alias("status"),
        F.coalesce("order_count", F.lit(0)).cast("bigint").alias("order_count"),
        F.coalesce(F.col("lifetime_value").cast("decimal(28,2)").cast("string"), F.lit("—")).alias("lifetime_value"),
        F.coalesce(ms_to_iso(F.col("last_order_ts")), F.lit("—")).alias("last_order_at"),
        "last_order_ts",
        total.cast("bigint").alias("total_messages"),
        rate.cast("bigint").alias("delivery_rate_pct"),
        delivered.cast("bigint").alias("delivered_messages"),
        failed.cast("bigint").alias("failed_messages"),
    )


def with_last_order_ts(c360: DataFrame) -> DataFrame:
    """Gold's instant as the epoch milliseconds readers expect."""
    return c360.withColumn("last_order_ts", ts_to_ms(F.col("last_order_at"))).drop("last_order_at")


def to_message(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """(key, value) with the columns as a JSON object; null fields are left out, readers take them as null."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*cols)).alias("value"))


C360_MESSAGE = (
    "customer_id", "email", "first_name", "last_name", "lifecycle_stage", "is_active", "lifetime_value",
    "order_count", "last_order_ts", "delivered_messages", "failed_messages",
)
PROPENSITY_MESSAGE = ("customer_id", "email", "lifecycle_stage", "propensity", "scored_at")
