"""One query for each operator, over its whole table, with the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.llm import bitsliced, decontaminate, language, linededup, neardup, packing, periodic, personal, quality, records, repetition, sharding, spelling
from patronage.llm.common import held_out, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


@query("op1_quality_pu")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query("op2_best_fit_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), "word", 1)


@query("op3_token_records")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.encode_documents(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), "byte", 0)


@query("op4_near_duplicates")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(read_table(spark, sf_dir, "documents"))


@query("op5_line_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The remaining text stands as its size and checksum."""
    done = linededup.dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return done.select("doc_id", "n_lines", "n_removed", "n_links", F.length(raw).alias("text_bytes"), F.crc32(raw).alias("text_crc32"))


@query("op6_decontamination")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_overlaps(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "item_words", "first_word", "equal_words")


@query("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    marked = language.predict(documents.select("doc_id", "text"), language.learn(documents))
    return marked.select("doc_id", held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


@query("op8_hash_tree_shards")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"), sharding.tree(3, 2, 4))


@query("op9_repetition_rules")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.judge(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "covered_words", "longest_repeat",
    )


@query("op10_personal_data")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.report(read_table(spark, sf_dir, "documents"))


@query("op11_bit_sliced_top_k")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitsliced.top_rows(read_table(spark, sf_dir, "embeddings"), 100, 10)


def with_planted_runs(documents: DataFrame) -> DataFrame:
    """doc_id and text, where the contract makes the words of every tenth document (by crc32 of its id) from some word on
    repeat with some period. Rows without an id or a word stay as they are."""
    code = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(code % 10 == 0, F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    cut = documents.select("doc_id", "text", F.floor(code / 10).alias("g"), words.alias("words"))
    cut = cut.withColumn("n", F.coalesce(F.size("words"), F.lit(-1)))
    cut = cut.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    cut = cut.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    rest = F.col("n") - F.col("a")
    again = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int")))
    made = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(again, F.lit(1), rest)), " ")
    return cut.select("doc_id", F.when(F.col("n") > 0, made).otherwise(F.col("text")).alias("text"))


@query("op12_periodic_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest(periodic.find_runs(with_planted_runs(read_table(spark, sf_dir, "documents"))))


@query("op13_spelling_variants")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read_table(spark, sf_dir, "documents"), spelling.TYPO_EVERY)
