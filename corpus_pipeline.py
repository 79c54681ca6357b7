"""Corpus pipeline: language ID, line dedup, near-dedup, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir), works on all documents the stage before it kept, and returns the columns of
documents; the last returns the places of the packed pieces. Between stages the documents are a Parquet table in the
shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from patronage.llm import decontaminate, language, linededup, neardup, packing
from patronage.llm.common import read_table, written
from patronage.llm.queries import tokenizer_path

#: Learned profiles, edit joins, similarity classes and token ids are nothing SQL can express.
ORACLE_SQL = None


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.known_language(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.without_repeated_lines(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_overlaps(docs, read_table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"), "word", 1)


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
