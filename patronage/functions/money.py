"""Amounts are doubles. Sums run over decimals with six places, so they keep small amounts and do not depend on the
order in which partitions are merged. Amounts that are no number (NaN, infinite) count as missing. Rounding to cents is
left to the folds and messages that ask for it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_cents(amount: Column) -> Column:
    """Whole cents, half up; null where the amount is no number or too large."""
    return F.floor(amount.try_cast("decimal(28,6)") * F.lit(100) + F.lit(0.5).cast("decimal(2,1)")).try_cast("bigint")


def from_cents(cents: Column) -> Column:
    return cents.cast("double") / F.lit(100.0)


def exact_sum(amount: Column) -> Column:
    return F.sum(amount.try_cast("decimal(28,6)")).cast("double")


def round_amount(amount: Column, digits: int = 2) -> Column:
    """Round half up on the decimal value, not on its binary approximation."""
    return F.round(amount.try_cast("decimal(38,6)"), digits).cast("double")


def order_total(items: Column) -> Column:
    """Sum of price x quantity over the line items of one order."""
    total = F.aggregate(items, F.lit(0.0), lambda acc, item: acc + item["price"] * item["quantity"])
    return from_cents(to_cents(total))
