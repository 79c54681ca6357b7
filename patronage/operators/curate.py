"""Silver projections: typed columns, one id column (payload id first, message key as fallback)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.contracts import ACTIVATION, ORDER, PROFILE, Contract
from patronage.functions.times import ms_to_ts

# columns that are instants in silver and epoch milliseconds before it
_INSTANTS = {"profile": "created_at", "order": "placed_at", "activation": "delivered_at"}


def _curate(bronze: DataFrame, spec: Contract) -> DataFrame:
    def column(name: str) -> Column:
        if name == spec.key:
            return F.coalesce(F.col(name), F.col("message_key")).alias(name)
        if name == _INSTANTS[spec.name]:
            return ms_to_ts(F.col(name)).alias(name)
        return F.col(name)

    return bronze.select(*[column(f.name) for f in spec.schema.fields], "ingested_at", "source_seq")


def curate_customers(bronze: DataFrame) -> DataFrame:
    return _curate(bronze, PROFILE)


def curate_orders(bronze: DataFrame) -> DataFrame:
    return _curate(bronze, ORDER)


def curate_activations(bronze: DataFrame) -> DataFrame:
    return _curate(bronze, ACTIVATION)
