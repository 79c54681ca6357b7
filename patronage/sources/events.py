"""Keyed event streams. A record is (key, value, timestamp, source_seq); `source_seq` orders the records of a key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.contracts import columns_of

RECORD = columns_of("key string, value string, timestamp timestamp, source_seq bigint")
BINARY_RECORD = columns_of("key binary, value binary, timestamp timestamp, source_seq bigint")


def read_events(
    spark: SparkSession, path_or_topic: str, fmt: str = "json", starting: str = "earliest",
    schema: T.StructType = RECORD, options: dict[str, str] | None = None,
) -> DataFrame:
    """Streaming frame over a topic, from its beginning; the position is kept by the sink's checkpoint.

    `kafka` needs the connector on the classpath and its bootstrap servers among the options; records of one key
    share a partition, so the offset orders them. Other formats watch a directory of files.
    """
    options = options or {}
    if fmt == "kafka":
        stream = spark.readStream.format("kafka").options(**options)
        raw = stream.option("subscribe", path_or_topic).option("startingOffsets", starting).load()
        return raw.select("key", "value", "timestamp", F.col("offset").alias("source_seq"))
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path_or_topic)


def as_records(events: DataFrame, key: str) -> DataFrame:
    """Typed event rows (with source_seq) as records with a JSON value."""
    fields = [c for c in events.columns if c != "source_seq"]
    return events.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*fields)).alias("value"),
        F.timestamp_millis(F.col("source_seq")).alias("timestamp"),
        "source_seq",
    )


def append_records(records: DataFrame, path: str, fmt: str = "json") -> None:
    """Parquet row groups stay small, so that a file is read by many tasks; values are JSON in any format. No two records are
    alike, so a dictionary would be built for every row group only to be given up."""
    options = {"parquet.block.size": 2 << 20, "parquet.enable.dictionary": "false"}
    records.write.mode("append").format(fmt).options(**options).save(path)
