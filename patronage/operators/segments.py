"""Rules applied to whole relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.functions import rules as R


def segment(df: DataFrame) -> DataFrame:
    return df.select(
        "customer_id",
        R.segment_label(F.col("lifetime_value"), F.col("order_count"), F.col("lifecycle_stage")).alias("segment"),
        R.segment_score(F.col("lifetime_value"), F.col("order_count")).alias("score"),
    )


def materialise_segments(changes: DataFrame, now: Column | None = None) -> DataFrame:
    """A segment event for every changed row, stamped in epoch milliseconds."""
    stamp = F.unix_millis(F.current_timestamp()) if now is None else now
    return segment(changes).withColumn("materialized_at", stamp)


def _metrics() -> list[Column]:
    return [F.col(c) for c in ("lifetime_value", "order_count", "delivered_messages", "failed_messages")]


def propensity_column(weights: R.PropensityWeights = R.PropensityWeights()) -> Column:
    return R.propensity_score(*_metrics(), weights)


def propensity(c360: DataFrame, weights: R.PropensityWeights = R.PropensityWeights()) -> DataFrame:
    return c360.select("customer_id", "email", "lifecycle_stage", propensity_column(weights).alias("propensity"))


def with_lifecycle_stage(df: DataFrame) -> DataFrame:
    value, orders, delivered, failed = _metrics()
    return df.withColumn("lifecycle_stage", R.lifecycle_stage(orders, value, delivered, failed))


def stage_transitions(before: DataFrame, after: DataFrame, now: Column | None = None) -> DataFrame:
    """A profile event for every customer whose stage changed; unknown customers start as prospects."""
    old = before.select("customer_id", F.col("lifecycle_stage").alias("_stage"), F.lit(True).alias("_known"))
    started_as = F.when(F.col("_known"), F.col("_stage")).otherwise(F.lit("prospect"))
    changed = after.join(old, "customer_id", "left").where(~started_as.eqNullSafe(F.col("lifecycle_stage")))
    return changed.select(
        "customer_id", "email", "first_name", "last_name",
        (F.unix_millis(F.current_timestamp()) if now is None else now).alias("created_at"),
        "lifecycle_stage", F.lit(True).alias("is_active"),
    )
