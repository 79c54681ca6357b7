"""Spreading keys that hold a large share of the rows.

Aggregates and latest-row windows need none of this: Spark combines them before the shuffle. Joins and
per-key windows over the raw events do, because one hot key would end up in one task. Which keys are hot only
steers how rows are spread; results are the same for any list, so an approximate answer is enough.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 64  # at least; wider shuffles spread hot keys further
MOST_HOT = 50_000  # keys one sketch looks for
BROADCAST_KEYS = 500_000  # key sets up to this many rows (tens of megabytes) go to every executor


def shuffle_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(df: DataFrame, key: str, parts: int | None = None) -> list[str]:
    """Keys holding more than 1/parts of the rows (so at most `parts` of them), found with one
    frequent-items sketch: reads the key column only, and shuffles one sketch per task."""
    parts = min(max(parts or shuffle_width(df), 4), MOST_HOT)
    found = df.select(
        F.expr(f"approx_top_k(`{key}`, {parts}, {min(max(parts * 20, 1000), 1_000_000)})").alias("top"), F.count(F.lit(1)).alias("n")
    ).first()
    return [t["item"] for t in found["top"] if t["item"] is not None and t["count"] * parts > found["n"]]


def spread_join(
    left: DataFrame, right: DataFrame, key: str, how: str, hot: Sequence[str], spread_on: str | Sequence[str],
    salts: int | None = None,
) -> DataFrame:
    """Equi-join that splits the left rows of hot keys over `salts` tasks (two for each shuffle task, if not given) and
    copies the matching right rows.

    `how` is left, left_semi, left_anti or inner. The right side should be unique by key: it grows by at most
    len(hot) x salts rows. The salt is a hash of `spread_on`, so a re-run task sends rows the same way.
    """
    if not hot:
        return left.join(right, key, how)
    salts = salts or max(SALTS, 2 * shuffle_width(left))
    is_hot = F.col(key).isin(list(hot))
    spread_on = [spread_on] if isinstance(spread_on, str) else list(spread_on)
    salted_left = left.withColumn(
        "_salt", F.when(is_hot, F.pmod(F.xxhash64(*spread_on), F.lit(salts)).cast("int")).otherwise(F.lit(0))
    )
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_right = right.withColumn("_salt", F.explode(copies))
    return salted_left.join(salted_right, [key, "_salt"], how).drop("_salt")


def restrict_to_keys(
    df: DataFrame, keys: DataFrame, key: str, key_count: int, spread_on: Sequence[str], limit: int = BROADCAST_KEYS
) -> DataFrame:
    """Rows whose key is among the distinct `keys`. A counted, small key set is broadcast, so the rows stay where they
    are; a larger one is joined by shuffle, with the hot keys of `df` spread."""
    if key_count <= limit:
        return df.join(F.broadcast(keys), key, "left_semi")
    hot = [] if list(spread_on) == [key] else hot_keys(df, key)
    return spread_join(df, keys, key, "left_semi", hot, spread_on)


def segment_bounds(df: DataFrame, key: str, seq: str, hot: Sequence[str], segments: int = 256) -> list[int]:
    """Cut points of `seq` giving each segment about the same number of hot-key rows (at most segments - 1)."""
    shares = [i / segments for i in range(1, segments)]
    row = (
        df.where(F.col(key).isin(list(hot)))
        .agg(F.percentile_approx(seq, shares, 10 * segments).alias("cuts"))
        .first()
    )
    return sorted(set(row["cuts"] or []))


def segment_of(seq: Column, cuts: Sequence[int]) -> Column:
    """Index of the segment a value falls into: a balanced tree of comparisons, so its depth is log2(cuts)."""

    def branch(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(seq <= cuts[middle], branch(low, middle)).otherwise(branch(middle + 1, high))

    return branch(0, len(cuts))
