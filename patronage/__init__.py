"""Customer-360 analytics on Spark: DataFrame operators that work in batch and in Structured Streaming."""

from patronage.contracts import ACTIVATION, CONTRACTS, ORDER, PROFILE, SEGMENT, Contract, avro_to_struct, contract
from patronage.session import build_session, workspace
from patronage.sources.lake import Lake
from patronage.streaming.pipeline import Pipeline

__all__ = [
    "ACTIVATION", "CONTRACTS", "Contract", "Lake", "ORDER", "PROFILE", "Pipeline", "SEGMENT",
    "avro_to_struct", "build_session", "contract", "workspace",
]
