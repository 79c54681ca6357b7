"""Token ids in files of length-delimited binary records, with a separate offset index.

A record is: length of the payload (8 bytes), masked CRC-32 of those 8 bytes (4), payload, masked CRC-32 of the payload
(4); all little-endian. Masking rotates the checksum right by 15 bits and adds a constant, so that a checksum stored
among data is not mistaken for one of data. The payload is a header (version, bytes per id, flags, document id) and the
ids. The index is a Parquet table with a row for each record: file, byte position, ids before it in its part.

Every task writes files with names of its own and lists them in the index rows it returns; Spark commits the rows of one
attempt for each task, so files of lost or repeated attempts are never read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronage.llm.common import map_arrow, small_side, written
from patronage.llm.textbytes import pick
from patronage.llm.tokens import encoder
from patronage.session import workspace

VERSION = 1
NO_ID = 1  # flag: the document's id is null
FILE_BYTES = 64 << 20
READ_BYTES = 8 << 20
ENCODE_ROWS = 128
_LENGTH, _CHECK, _HEADER = struct.Struct("<Q"), struct.Struct("<I"), struct.Struct("<BBHq")

INDEX = "part int, record long, doc_id long, file string, at long, bytes int, tokens_before long, n_tokens long"
READ = "part int, record long, doc_id long, tokens_before long, n_tokens long, ids_crc32 long"


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = _LENGTH.pack(len(payload))
    return b"".join((length, _CHECK.pack(masked(length)), payload, _CHECK.pack(masked(payload))))


def unframe(data: memoryview, at: int) -> tuple[memoryview, int]:
    """The payload of the record at this place and the place after it; raises ValueError on any damage."""
    if len(data) < at + 12:
        raise ValueError("record cut off")
    length = bytes(data[at : at + 8])
    if _CHECK.unpack_from(data, at + 8)[0] != masked(length):
        raise ValueError("damaged length")
    end = at + 12 + _LENGTH.unpack(length)[0]
    if len(data) < end + 4:
        raise ValueError("record cut off")
    payload = data[at + 12 : end]
    if _CHECK.unpack_from(data, end)[0] != masked(payload):
        raise ValueError("damaged payload")
    return payload, end + 4


def pack_payload(doc_id: int | None, ids: bytes, width: int) -> bytes:
    return _HEADER.pack(VERSION, width, NO_ID * (doc_id is None), doc_id or 0) + ids


def unpack_payload(payload: memoryview) -> tuple[int | None, np.ndarray]:
    version, width, flags, doc_id = _HEADER.unpack_from(payload)
    if version != VERSION:
        raise ValueError(f"record version {version}")
    return None if flags & NO_ID else doc_id, np.frombuffer(payload, f"<u{width}", offset=_HEADER.size)


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    names, types = zip(*(c.split() for c in schema.split(", ")))
    columns = zip(*rows) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(columns, types)], names)


def write_records(documents: DataFrame, tokenizer: str, style: str, end_id: int, width: int = 2) -> DataFrame:
    """Writes all documents in ascending doc_id order and returns the index, itself a written table.

    Null texts are empty (the end id alone), null ids come first, repeated rows get a record each, an empty table gives
    an empty index; other columns are ignored.
    """
    folder = workspace(documents.sparkSession, "records")
    end = int(end_id).to_bytes(width, "little")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        encode = encoder(tokenizer, style, f"<u{width}")
        part, record, before = TaskContext.get().partitionId(), 0, 0
        out = name = None
        at = 0
        try:
            for batch in batches:
                doc_ids, texts = pick(batch.column(0)).to_pylist(), pick(batch.column(1))
                for first in range(0, len(texts), ENCODE_ROWS):
                    rows = []
                    for doc_id, ids in zip(doc_ids[first:], encode(texts.slice(first, ENCODE_ROWS).to_pylist())):
                        if out is None:
                            name, at = f"part-{part:06d}-{uuid.uuid4().hex}.rec", 0
                            out = store.open_output_stream(f"{path}/{name}")
                        data = frame(pack_payload(doc_id, ids + end, width))
                        out.write(data)
                        n = len(ids) // width + 1
                        rows.append((part, record, doc_id, name, at, len(data), before, n))
                        record, before, at = record + 1, before + n, at + len(data)
                        if at >= FILE_BYTES:
                            out.close()
                            out = None
                    yield _batch(INDEX, rows)
        finally:
            if out is not None:
                out.close()

    ordered = (
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    )
    index = written(map_arrow(ordered, write, INDEX), "records-index")
    return index.withColumn("file", F.concat(F.lit(folder + "/"), "file"))


def read_records(index: DataFrame) -> DataFrame:
    """Every record of the index, read from its file at its place and checked: ids counted and summed up by CRC-32."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, record, doc_id, file, at, size, before, n = (pick(c).to_pylist() for c in batch.columns)
            first = 0
            while first < len(file):
                last = first  # records that follow each other in a file are read together
                while (
                    last + 1 < len(file) and file[last + 1] == file[first] and at[last + 1] == at[last] + size[last]
                    and at[last + 1] + size[last + 1] - at[first] <= READ_BYTES
                ):
                    last += 1
                store, path = fs.FileSystem.from_uri(file[first])
                with store.open_input_file(path) as f:
                    f.seek(at[first])
                    data = memoryview(f.read(at[last] + size[last] - at[first]))
                rows, place = [], 0
                for i in range(first, last + 1):
                    payload, place = unframe(data, place)
                    found, ids = unpack_payload(payload)
                    if (found, len(ids)) != (doc_id[i], n[i]):
                        raise ValueError(f"{file[i]} at {at[i]} holds another record than the index says")
                    rows.append((part[i], record[i], found, before[i], len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                yield _batch(READ, rows)
                first = last + 1

    return map_arrow(index, read, READ)


def with_starts(records: DataFrame, index: DataFrame) -> DataFrame:
    """Adds `start`, the ids of all records before: ids of earlier parts (a row for each part) plus those before in it."""
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = index.groupBy("part").agg(F.sum("n_tokens").alias("_n")).select(
        "part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base")
    )
    parts = written(parts, "records-parts")
    return records.join(small_side(parts), "part").withColumn("start", F.col("_base") + F.col("tokens_before")).drop("_base")


def encode_documents(documents: DataFrame, tokenizer: str, style: str, end_id: int) -> DataFrame:
    """Writes, reads back, and gives doc_id, start, n_tokens, ids_crc32 from what was read."""
    index = write_records(documents, tokenizer, style, end_id)
    return with_starts(read_records(index), index).select("doc_id", "start", "n_tokens", "ids_crc32")
