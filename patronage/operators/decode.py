"""From raw (key, value) records to typed event rows."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.contracts import Contract

FRAME_HEADER = 5  # one magic byte, four bytes of schema id
_CORRUPT = "_unreadable"


def split_frame(value: Column) -> Column:
    """struct<magic, schema_id, body> of a registry-framed binary value; all null when the header is cut short."""
    whole = F.length(value) >= FRAME_HEADER
    return F.struct(
        F.when(whole, F.conv(F.hex(F.substring(value, 1, 1)), 16, 10).cast("int")).alias("magic"),
        F.when(whole, F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("bigint")).alias("schema_id"),
        F.when(whole, frame_body(value)).alias("body"),
    )


def frame_body(value: Column) -> Column:
    return F.substring(value, F.lit(FRAME_HEADER + 1), F.length(value))


def _avro_reader(spec: Contract, avsc: dict | None) -> str:
    if avsc is None:
        raise ValueError(f"framed_avro needs the writer schema of {spec.name!r}")
    return json.dumps(avsc)


def decode_payload(df: DataFrame, spec: Contract, encoding: str = "json", avsc: dict | None = None) -> DataFrame:
    """Parse `value` into a `payload` struct; a null value stays null. Parsing is native (no Python per row).

    Encodings: `json` (text or bytes), `framed_json` (registry header, then JSON), `framed_avro` (needs spark-avro
    on the classpath and the schema as `avsc`). A value that cannot be read leaves its text in `_unreadable`.
    """
    body = F.col("value") if encoding == "json" else frame_body(F.col("value").cast("binary"))
    if encoding == "framed_avro":
        from pyspark.sql.avro.functions import from_avro

        parsed = from_avro(body, _avro_reader(spec, avsc), {"mode": "PERMISSIVE"})
        # permissive mode gives a struct of nulls for a record it cannot read
        nothing = F.coalesce(*[F.col("_fields")[f.name].cast("string") for f in spec.schema.fields]).isNull()
        unreadable = F.when(F.col("value").isNotNull() & nothing, F.hex(body))
    elif encoding in ("json", "framed_json"):
        schema = T.StructType([*spec.schema.fields, T.StructField(_CORRUPT, T.StringType())])
        parsed = F.from_json(body.cast("string"), schema, {"columnNameOfCorruptRecord": _CORRUPT})
        unreadable = F.col("_fields")[_CORRUPT]
    else:
        raise ValueError(f"unknown encoding {encoding!r}")

    def read(name: str) -> Column:
        value = F.col("_fields")[name]
        return F.coalesce(value, F.lit(spec.defaults[name])) if name in spec.defaults else value

    columns = [read(f.name).cast(f.dataType).alias(f.name) for f in spec.schema.fields]
    # as the output of a generator the value is parsed once; filters on its fields are not pushed below the parser,
    # where each of them would parse it again
    return (
        df.select("*", F.col("key").cast("string").alias("message_key"), F.explode(F.array(parsed)).alias("_fields"))
        .withColumn(_CORRUPT, unreadable)
        .withColumn("payload", F.when(F.col("value").isNotNull(), F.struct(*columns)))
        .drop("_fields", "key")
    )


def split_valid(decoded: DataFrame, spec: Contract) -> tuple[DataFrame, DataFrame]:
    """(good, bad) rows of a decoded frame; bad rows carry the raw value and a reason."""
    missing = [F.col("payload")[c].isNull() for c in spec.required if c != spec.key]
    key = F.coalesce(F.col("payload")[spec.key], F.col("message_key"))
    reason = F.when(F.col("value").isNull(), "null_value").when(F.col(_CORRUPT).isNotNull(), "unreadable")
    reason = reason.when(key.isNull() | (key == ""), "no_key")
    for test, name in zip(missing, [c for c in spec.required if c != spec.key]):
        reason = reason.when(test, f"no_{name}")
    for name in (f.name for f in spec.schema.fields if isinstance(f.dataType, T.DoubleType)):
        amount = F.col("payload")[name]
        reason = reason.when(F.isnan(amount) | (F.abs(amount) == float("inf")), f"bad_{name}")
    tagged = decoded.withColumn("reason", reason)
    good = tagged.where(F.col("reason").isNull()).drop("reason", _CORRUPT, "value")
    bad = tagged.where(F.col("reason").isNotNull()).drop("payload", _CORRUPT)
    return good, bad


def flatten_payload(decoded: DataFrame) -> DataFrame:
    """Bronze layout: message key, the payload's fields, arrival time and the ordering column."""
    return decoded.select("message_key", "payload.*", F.col("timestamp").alias("ingested_at"), "source_seq")
