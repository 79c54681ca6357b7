"""Helpers the operators share: written tables, held-out rows, ranks inside groups of any size."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

import patronage
from patronage.session import workspace

ROWS_PER_TASK = 20_000
#: A side of a join is broadcast only after its rows were counted and found to be no more than this.
BROADCAST_ROWS = 200_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(frame: DataFrame, purpose: str, rows: int | None = None) -> DataFrame:
    """The frame as a Parquet table in the shared folder: cuts the lineage, survives lost executors, is worked out once.
    Where it is known to have no more than `rows` rows, a task takes ROWS_PER_TASK of them, so small tables are few files."""
    spark = frame.sparkSession
    if rows is not None:
        frame = frame.coalesce(max(1, -(-rows // ROWS_PER_TASK)))
    path = workspace(spark, f"llm-{purpose}")
    frame.write.option("parquet.block.size", WRITTEN_BYTES).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def small_side(frame: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint for a written table of at most `most` rows; a larger one is left to a shuffle join."""
    return F.broadcast(frame) if frame.count() <= most else frame


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """The fixed test fold: crc32 of the id's text leaves remainder 2 by 4. A null id is never held out."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def unit_hash(*columns: str) -> Column:
    """A number from 0 up to 1 by the columns and the row's number in its task, with all 53 bits of a double."""
    return F.shiftrightunsigned(F.xxhash64(*columns, F.monotonically_increasing_id()), 11) / float(1 << 53)


def dealing(*order: str) -> Column:
    """A number for each row that spreads a key's rows over buckets, rows equal in `order` as well. It counts rows inside
    a task, so it must be written with the rows it is used for."""
    return F.xxhash64(*order, F.monotonically_increasing_id())


def rank_in_groups(
    frame: DataFrame, key: str, order: list[str], into: str, deal: str = "_deal", rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Adds a gapless rank from 0 within each `key`, however many rows one key holds.

    `frame` is a written table with a column `deal` made by `dealing`, which is dropped. A key's rows are dealt to as many
    buckets as their count asks for; ranks by `order` are taken inside (key, bucket) and lifted by the rows of the key's
    earlier buckets, which come from a count table: a row for each `rows_per_task` rows and key.
    """
    sizes = frame.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / rows_per_task).alias("_buckets"))
    sizes = small_side(written(sizes.withColumnRenamed(key, "_key"), "ranked-keys"))
    dealt = frame.join(sizes, F.col(key).eqNullSafe(F.col("_key"))).withColumn("_bucket", F.pmod(F.col(deal), F.col("_buckets")))
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        dealt.groupBy(key, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
        .select(F.col(key).alias("_key"), "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    )
    inside = Window.partitionBy(key, "_bucket").orderBy(*order, deal)
    ranks = dealt.withColumn("_rank", F.row_number().over(inside) - 1).drop("_key", "_buckets").alias("r")
    return (
        ranks.join(base.alias("b"), F.col(f"r.{key}").eqNullSafe(F.col("b._key")) & (F.col("r._bucket") == F.col("b._bucket")))
        .select("r.*", (F.col("_base") + F.col("_rank")).alias(into)).drop("_bucket", "_rank", deal)
    )


_shipped: set[str] = set()
#: Rows and bytes of an Arrow batch, where the session has Spark's default of rows: texts are long, and both sides hold batches.
BATCH_ROWS, BATCH_BYTES = 2_000, "4m"
#: Rows a Parquet scan decodes at a time, where the session has Spark's default: 4,096 texts are arrays of tens of MB a task.
SCANNED_ROWS = 512
#: Bytes of a row group of written tables, which a writing task holds in memory.
WRITTEN_BYTES = 16 << 20


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application, and keeps Arrow and scan batches small."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    if spark.conf.get("spark.sql.parquet.columnarReaderBatchSize", "4096") == "4096":
        spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", SCANNED_ROWS)
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(patronage.__file__).parent
        made = Path(tempfile.mkdtemp(prefix="patronage-code-")) / "patronage.zip"  # served to executors by the driver
        with zipfile.ZipFile(made, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, f"patronage/{source.relative_to(package)}")
        context.addPyFile(str(made))
        _shipped.add(context.applicationId)


def map_arrow(frame: DataFrame, function, schema: str | T.StructType) -> DataFrame:
    """mapInArrow, with this package shipped to the executors."""
    ship(frame.sparkSession)
    return frame.mapInArrow(function, schema)
