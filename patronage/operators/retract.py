"""Totals per customer kept by differences: what a changed row counted before is taken back, what it counts now is added.
Only a newest instant that was taken back needs the customer's rows again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.operators.keyed import latest_row

AMOUNT = "decimal(28,6)"


def with_images(stored: DataFrame, changes: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row per key whose row a batch changes: the row as it stands now and, as `before`, as it stood (null: not there).

    `changes` may hold several versions of a key, ordered by source_seq and batch. A version older than the stored row
    changes nothing, and neither does one that is there already, so a batch that comes again leaves no rows."""
    newest = latest_row(changes, [key], ["source_seq", "batch"])
    new = newest.select(key, F.struct("source_seq", *columns).alias("_new"))
    old = stored.select(key, F.struct("source_seq", *columns).alias("before"))
    was, now = F.col("before.source_seq"), F.col("_new.source_seq")
    late = F.coalesce(was > now, was.isNotNull() & now.isNull())
    changed = new.join(old, key, "left").where(~late & ~F.col("_new").eqNullSafe(F.col("before")))
    return changed.select(key, "_new.*", "before")


def signed(facts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The images as rows that stop counting (sign -1) and rows that start counting (sign 1), under their own customers."""

    def image(sign: int, side: str) -> Column:
        return F.struct(F.lit(sign).cast("bigint").alias("sign"), *[F.col(f"{side}{c}").alias(c) for c in columns])

    sides = F.array(F.when(F.col("before").isNotNull(), image(-1, "before.")), image(1, ""))
    rows = facts.select(F.explode(F.filter(sides, lambda side: side.isNotNull())).alias("_image")).select("_image.*")
    return rows.where(F.col("customer_id").isNotNull())


def differences(batch: DataFrame) -> DataFrame:
    """What a batch of signed rows (kinds order, activation) changes for each customer. Customers of other kinds are listed
    without changes. Combined before the shuffle, so hot customers are safe."""
    sign, amount = F.col("sign"), F.col("order_total").try_cast(AMOUNT)
    return batch.groupBy("customer_id").agg(
        F.sum(F.when(sign > 0, amount).otherwise(-amount)).alias("_value"),
        F.sum(F.when(amount.isNotNull(), sign)).alias("_valued"),
        F.sum(F.when(F.col("kind") == "order", sign)).alias("_orders"),
        F.max(F.when(sign > 0, F.col("placed_at"))).alias("_gained_at"),
        F.max(F.when(sign < 0, F.col("placed_at"))).alias("_lost_at"),
        F.sum(F.when(F.col("status") == "delivered", sign)).alias("_delivered"),
        F.sum(F.when(F.col("status") != "delivered", sign)).alias("_failed"),
    )


def apply_differences(totals: DataFrame, changes: DataFrame, applied: str) -> DataFrame:
    """The totals of the customers of a batch after it, marked with its name. Rows that carry the name already stay as they
    are. `_lost` says that the newest order was taken back, so that `last_order_at` is to be worked out from the orders."""
    joined = changes.join(totals, "customer_id", "left")
    todo = ~F.coalesce(F.col("applied") == applied, F.lit(False))

    def total(name: str, change: str) -> Column:
        old = F.coalesce(F.col(name), F.lit(0))
        return F.when(todo, old + F.coalesce(F.col(change), F.lit(0))).otherwise(old).cast(totals.schema[name].dataType)

    rows = joined.withColumns({
        "order_value": total("order_value", "_value"), "valued_orders": total("valued_orders", "_valued"),
        "order_count": total("order_count", "_orders"), "delivered_messages": total("delivered_messages", "_delivered"),
        "failed_messages": total("failed_messages", "_failed"),
        "last_order_at": F.when(todo, F.greatest("last_order_at", "_gained_at")).otherwise(F.col("last_order_at")),
    })
    some = F.col("order_count") > 0
    # equal instants too: another order may hold it, or none
    lost = F.coalesce(todo & some & (F.col("_lost_at") >= F.col("last_order_at")), F.lit(False))
    rows = rows.withColumns({"_lost": lost, "last_order_at": F.when(some, F.col("last_order_at")), "applied": F.lit(applied)})
    return rows.select(*totals.columns, "_lost")


def with_newest_orders(totals: DataFrame, orders: DataFrame) -> DataFrame:
    """`last_order_at` of the rows marked `_lost` from the orders of their customers."""
    newest = orders.groupBy("customer_id").agg(F.max("placed_at").alias("_newest"))
    value = F.when(F.col("_lost"), F.col("_newest")).otherwise(F.col("last_order_at"))
    return totals.join(newest, "customer_id", "left").withColumn("last_order_at", value).drop("_newest")


def c360_of_totals(totals: DataFrame, customers: DataFrame) -> DataFrame:
    """Gold rows of the customers that have orders; a value is missing where no order has one."""
    rows = totals.where(F.col("order_count") > 0).join(
        customers.select("customer_id", "email", "first_name", "last_name", "lifecycle_stage", "is_active"),
        "customer_id", "left",
    )
    value = F.when(F.col("valued_orders") > 0, F.col("order_value").cast("double")).alias("lifetime_value")
    return rows.select(
        "customer_id", "email", "first_name", "last_name", "lifecycle_stage", "is_active", value,
        "order_count", "last_order_at", "delivered_messages", "failed_messages",
    )


def changed_rows(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Rows of `after` that `before` lacks or holds otherwise (nulls are equal to nulls), and the keys that are gone, with
    `removed` set. Both sides hold one row per key."""
    columns = [c for c in after.columns if c != key]
    new = after.select(key, F.struct(*columns).alias("_new"))
    old = before.select(key, F.struct(*columns).alias("_old"))
    changed = new.join(old, key, "full_outer").where(~F.col("_new").eqNullSafe(F.col("_old")))
    return changed.select(key, "_new.*", F.col("_new").isNull().alias("removed"))
