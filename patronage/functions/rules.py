"""Business rules: segment, lifecycle stage, engagement and propensity."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from patronage.functions.money import round_amount

# Thresholds of the segment and lifecycle rules.
VIP_VALUE = 200
GROWTH_ORDERS = 2
HIGH_VALUE = 5000
EVANGELIST_RATE = 0.7
ENGAGED_RATE = 0.5


@dataclass(frozen=True)
class PropensityWeights:
    """Weights of the raw propensity score."""

    value_divisor: float = 150.0
    per_order: float = 0.75
    per_net_message: float = 0.25


def segment_label(lifetime_value: Column, order_count: Column, stage: Column) -> Column:
    return (
        F.when(lifetime_value >= VIP_VALUE, "vip")
        .when(order_count >= GROWTH_ORDERS, "growth")
        .otherwise(F.coalesce(stage, F.lit("unknown")))
    )


def segment_score(lifetime_value: Column, order_count: Column) -> Column:
    return round_amount(lifetime_value / F.lit(200.0) + order_count * F.lit(0.1))


def engagement_rate(delivered: Column, failed: Column) -> Column:
    """Delivered share of all messages, 0 when there are none."""
    return F.coalesce(F.try_divide(delivered.cast("double"), (delivered + failed).cast("double")), F.lit(0.0))


def lifecycle_stage(orders: Column, lifetime_value: Column, delivered: Column, failed: Column) -> Column:
    rate = engagement_rate(delivered, failed)
    rich = lifetime_value > HIGH_VALUE
    return (
        F.when(orders == 0, "prospect")
        .when(rich & (rate >= EVANGELIST_RATE), "evangelist")
        .when(rich, "high-value")
        .when(rate > ENGAGED_RATE, "engaged")
        .otherwise("customer")
    )


def propensity_score(
    lifetime_value: Column, orders: Column, delivered: Column, failed: Column,
    weights: PropensityWeights = PropensityWeights(),
) -> Column:
    raw = (
        lifetime_value / F.lit(weights.value_divisor)
        + orders * F.lit(weights.per_order)
        + (delivered - failed) * F.lit(weights.per_net_message)
    )
    return F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-raw)), 4)
