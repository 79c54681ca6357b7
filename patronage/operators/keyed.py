"""Keyed merge, dedupe and delete."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronage.functions.profile import has_profile

SERVING_MAX = (
    "order_count", "lifetime_value", "delivered_messages", "failed_messages", "last_order_ts", "last_engagement_ts",
)


def latest_row(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """Newest whole row per key; a later null overwrites. Spark keeps one row per key and map task before
    the shuffle (WindowGroupLimit), so a hot key does not reach one task as a whole."""
    newest = [F.desc(c) if isinstance(c, str) else c.desc() for c in order_by]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*newest)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def newest_value(column: str, seq: str) -> Column:
    """Aggregate: the value at the highest `seq` where it is not null."""
    return F.expr(f"max_by(`{column}`, `{seq}`) FILTER (WHERE `{column}` IS NOT NULL)")


def latest_by_offset(df: DataFrame, key: str, cols: Sequence[str], seq: str = "source_seq") -> DataFrame:
    """Newest non-null value of each column per key."""
    return df.groupBy(key).agg(*[newest_value(c, seq).alias(c) for c in cols])


def upsert(current: DataFrame, batch: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """Keys in the batch are replaced by their newest batch row, other keys stay; null keys never match and are dropped.

    Without `order_by` the batch must hold one row per key. Current rows are only filtered, so a batch whose keys are
    small enough to be broadcast leaves them unshuffled.
    """
    newest = batch.dropna(subset=list(keys))
    replaced = newest.select(*keys)
    if order_by:
        # the key set needs no ranking: duplicates fall away in the map-side part of the distinct
        newest, replaced = latest_row(newest, keys, order_by), replaced.distinct()
    return current.join(replaced, list(keys), "left_anti").unionByName(newest.select(*current.columns))


def fold_serving_batch(incoming: DataFrame, key: str = "customer_id", seq: str | None = "source_seq") -> DataFrame:
    """One row per key: numbers keep their maximum, the rest their newest non-null value."""
    columns = [c for c in incoming.columns if c not in (key, seq)]
    return incoming.groupBy(key).agg(
        *[(F.max(c) if c in SERVING_MAX else newest_value(c, seq)).alias(c) for c in columns]
    )


def merge_column(name: str, old: Column, new: Column) -> Column:
    """Counters and instants never go back; anything else takes the new value unless it is null."""
    return (F.greatest(old, new) if name in SERVING_MAX else F.coalesce(new, old)).alias(name)


def monotone_merge(
    current: DataFrame, incoming: DataFrame, key: str = "customer_id", seq: str | None = None
) -> DataFrame:
    """Serving merge of whole relations, column by column.

    `incoming` has one row per key, or several when `seq` names the column that orders them.
    """
    folded = incoming if seq is None else fold_serving_batch(incoming, key, seq)
    old, new = current.alias("old"), folded.alias("new")

    def merged(name: str) -> Column:
        before, after = F.col(f"old.{name}"), F.col(f"new.{name}")
        if name not in folded.columns:
            return before.alias(name)
        return merge_column(name, before, after)

    joined = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")
    return joined.select(*[merged(c) for c in current.columns])


def apply_tombstones(
    current: DataFrame, changes: DataFrame, key: str = "key", value: str = "value", seq: str = "source_seq",
    current_key: str = "customer_id",
) -> DataFrame:
    """Current rows whose last change was a null value (a delete) disappear."""
    last = changes.groupBy(key).agg(F.max_by(F.col(value).isNull(), seq).alias("_gone"))
    gone = last.where("_gone").select(F.col(key).alias(current_key))
    return current.join(gone, current_key, "left_anti")


def fill_profile(rows: DataFrame, profiles: DataFrame, key: str = "customer_id") -> DataFrame:
    """Rows with neither first name nor email take every non-null profile column; others stay as they are."""
    shared = [c for c in profiles.columns if c != key and c in rows.columns]
    usable = profiles.where(has_profile()).select(key, *[F.col(c).alias(f"_p_{c}") for c in shared])
    joined = rows.join(usable, key, "left")
    needs = ~has_profile()
    filled = [
        (F.when(needs, F.coalesce(F.col(f"_p_{c}"), F.col(c))).otherwise(F.col(c)) if c in shared else F.col(c)).alias(c)
        for c in rows.columns
    ]
    return joined.select(*filled)
