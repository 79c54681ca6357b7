"""Epoch-millisecond, timestamp and ISO-text conversions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ms_to_ts(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def ts_to_ms(ts: Column) -> Column:
    """Epoch milliseconds; a zone-less timestamp is read in the session zone (UTC)."""
    return F.unix_millis(ts.cast("timestamp"))


def ms_to_iso(ms: Column) -> Column:
    """ISO-8601 with offset; six fraction digits, left out when the fraction is zero."""
    ts = F.timestamp_millis(ms)
    return F.when(F.pmod(ms, F.lit(1000)) == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")).otherwise(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    )


def with_processing_time(df: DataFrame, name: str, now: Column | None = None) -> DataFrame:
    """Stamp rows with the current time; `now` fixes it for tests."""
    return df.withColumn(name, F.current_timestamp() if now is None else now)
