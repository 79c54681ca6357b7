"""Per-customer aggregates and incremental folds. All combine before the shuffle, so hot customers are safe."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.functions.money import exact_sum, from_cents, to_cents
from patronage.functions.rules import lifecycle_stage


def delivered_count(status: Column) -> Column:
    return F.count_if(status == "delivered")


def failed_count(status: Column) -> Column:
    """A null status is neither delivered nor failed."""
    return F.count_if(status != "delivered")


def order_metrics(orders: DataFrame, unique_orders: bool = False) -> DataFrame:
    """Lake flavour: total, distinct orders, newest order. `unique_orders` says the input already holds one row
    per order id (a silver snapshot), which saves the shuffle a distinct count needs."""
    count = F.count("order_id") if unique_orders else F.count_distinct("order_id")
    return orders.groupBy("customer_id").agg(
        exact_sum(F.col("order_total")).alias("lifetime_value"),
        count.alias("order_count"),
        F.max("placed_at").alias("last_order_at"),
    )


def order_summary(enriched: DataFrame) -> DataFrame:
    """Stream flavour: every event counts, re-sent orders included."""
    return enriched.groupBy("customer_id").agg(
        exact_sum(F.col("order_total")).alias("lifetime_value"),
        F.count(F.lit(1)).alias("order_count"),
        F.max("order_placed_at").alias("last_order_ts"),
    )


def activation_metrics(activations: DataFrame) -> DataFrame:
    return activations.groupBy("customer_id").agg(
        delivered_count(F.col("status")).alias("delivered_messages"), failed_count(F.col("status")).alias("failed_messages")
    )


def activation_summary(events: DataFrame) -> DataFrame:
    return events.groupBy("customer_id").agg(
        delivered_count(F.col("status")).alias("delivered_messages"),
        failed_count(F.col("status")).alias("failed_messages"),
        F.max("delivered_at").alias("last_engagement_ts"),
    )


def _stage_column() -> Column:
    return lifecycle_stage(
        F.col("order_count"), F.col("lifetime_value"), F.col("delivered_messages"), F.col("failed_messages")
    )


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def _gained(serving: DataFrame, gained: DataFrame, done: Column | None) -> DataFrame:
    """The rows with what a batch adds to them; nothing where `done` says that the row holds the batch already."""
    joined = serving.join(gained, "customer_id", "full_outer")
    if done is None:
        return joined
    return joined.withColumns({c: F.when(~F.coalesce(done, F.lit(False)), F.col(c)) for c in gained.columns if c != "customer_id"})


def apply_orders(serving: DataFrame, new_orders: DataFrame, done: Column | None = None) -> DataFrame:
    """Fold a batch of orders into serving rows: counts and value grow, the customer becomes active and the
    stage is worked out again. Customers seen for the first time get a row. Rows for which `done` holds stay."""
    gained = new_orders.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(to_cents(F.col("order_total"))).alias("_cents"),
        F.max("placed_at").alias("_last"),
    )
    touched = F.col("_n").isNotNull()
    updated = (
        _gained(serving, gained, done)
        .withColumn("order_count", _zero("order_count") + _zero("_n"))
        .withColumn(
            "lifetime_value",
            F.when(touched, from_cents(F.coalesce(to_cents(F.col("lifetime_value")), F.lit(0)) + _zero("_cents")))
            .otherwise(F.col("lifetime_value")),
        )
        .withColumn("last_order_ts", F.greatest("last_order_ts", "_last"))
        .withColumn("is_active", F.when(touched, True).otherwise(F.col("is_active")))
        .withColumn("delivered_messages", _zero("delivered_messages"))
        .withColumn("failed_messages", _zero("failed_messages"))
        .withColumn("lifecycle_stage", F.when(touched, _stage_column()).otherwise(F.col("lifecycle_stage")))
    )
    return updated.select(*serving.columns)


def apply_engagements(serving: DataFrame, new_events: DataFrame, done: Column | None = None) -> DataFrame:
    """Fold a batch of message results into serving rows; whatever was not delivered counts as failed. Rows for which
    `done` holds stay."""
    ok = F.coalesce(F.col("status") == "delivered", F.lit(False))
    gained = new_events.groupBy("customer_id").agg(
        F.count_if(ok).alias("_ok"), F.count_if(~ok).alias("_bad"), F.max("delivered_at").alias("_last"),
    )
    touched = F.col("_ok").isNotNull()
    updated = (
        _gained(serving, gained, done)
        .withColumn("order_count", _zero("order_count"))
        .withColumn("lifetime_value", F.coalesce("lifetime_value", F.lit(0.0)))
        .withColumn("delivered_messages", _zero("delivered_messages") + _zero("_ok"))
        .withColumn("failed_messages", _zero("failed_messages") + _zero("_bad"))
        .withColumn("last_engagement_ts", F.greatest("last_engagement_ts", "_last"))
        .withColumn("lifecycle_stage", F.when(touched, _stage_column()).otherwise(F.col("lifecycle_stage")))
    )
    return updated.select(*serving.columns)
