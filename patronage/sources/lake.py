"""Keyed lake tables on plain Parquet.

A table is a directory of change batches (`changes/batch=N`, one row per key and batch, append only) and, from
time to time, a compacted base (`base/upto=N`, hash-partitioned into `bucket` directories). The current state is
the newest row per key over the base and the batches after it. A batch is written elsewhere and renamed into the change
directory when it is complete, so that directory is itself the stream of changes. Batches are numbered
by the table; which batch of which writer one holds is recorded beside them, so a batch that is sent again changes
nothing, and a writer that starts to count anew loses nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.operators.keyed import latest_row
from patronage.operators.skew import BROADCAST_KEYS, restrict_to_keys
from patronage.sources import fs
from patronage.sources.layout import TABLES, KeyedTable


@dataclass(frozen=True)
class Scope:
    """Keys a read is restricted to, how many they are at most, and the buckets they fall into (None: most of them)."""

    keys: DataFrame
    count: int
    buckets: tuple[int, ...] | None

    def prune(self) -> Column | None:
        return None if self.buckets is None else F.col("bucket").isin(list(self.buckets))

    @property
    def large(self) -> bool:
        return self.count > BROADCAST_KEYS


class Lake:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    # -- layout ---------------------------------------------------------------------------------------------

    def path(self, layer: str, name: str, *parts: str) -> str:
        return "/".join([self.root, layer, name, *parts])

    def bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _committed(self, layer: str, name: str, pattern: str) -> list[int]:
        done = fs.glob(self.spark, self.path(layer, name, pattern, "_SUCCESS"))
        return sorted(int(p.split("/")[-2].partition("=")[2]) for p in done)

    def batches(self, layer: str, name: str) -> list[int]:
        return self._committed(layer, name, "changes/batch=*")

    def exists(self, layer: str, name: str) -> bool:
        return bool(self.batches(layer, name))

    # -- reading --------------------------------------------------------------------------------------------

    def _no_rows(self, schema: T.StructType) -> DataFrame:
        """Known to be empty when a query is planned, so that joins with it fall away."""
        nothing = self.spark.range(1).where(F.lit(False))
        return nothing.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])

    def _changes(self, table: KeyedTable, after: int, before: int | None = None) -> DataFrame:
        where = self.path(table.layer, table.name, "changes")
        numbers = self.batches(table.layer, table.name)
        paths = [f"{where}/batch={b}" for b in numbers if b > after and (before is None or b < before)]
        full = T.StructType([*table.schema.fields, T.StructField("batch", T.LongType())])
        if not paths:
            return self._no_rows(full)
        return self.spark.read.schema(full).option("basePath", where).parquet(*paths)

    def _base(self, table: KeyedTable, prune: Column | None) -> tuple[DataFrame | None, int]:
        bases = self._committed(table.layer, table.name, "base/upto=*")
        if not bases:
            return None, -1
        full = T.StructType([
            *table.schema.fields, T.StructField("batch", T.LongType()), T.StructField("bucket", T.IntegerType())
        ])
        base = self.spark.read.schema(full).parquet(self.path(table.layer, table.name, "base", f"upto={bases[-1]}"))
        marks = fs.glob(self.spark, self.path(table.layer, table.name, "base", f"upto={bases[-1]}", "_buckets-*"))
        if prune is None or [m.rpartition("-")[2] for m in marks] != [str(self.buckets)]:
            # written with another bucket count: every bucket is read
            return base.drop("bucket"), bases[-1]
        return base.where(prune).drop("bucket"), bases[-1]

    def scope(self, keys: DataFrame, distinct: bool = False) -> Scope:
        """Restriction to the values of a one-column frame; one number per bucket comes to the driver. `distinct` says that
        hardly any value comes twice, which saves a shuffle."""
        wanted = keys.dropna() if distinct else keys.dropna().distinct()
        rows = wanted.groupBy(self.bucket(F.col(keys.columns[0])).alias("bucket")).count().collect()
        found = tuple(sorted(r["bucket"] for r in rows))
        return Scope(wanted, sum(r["count"] for r in rows), None if len(found) > self.buckets // 2 else found)

    def _current(
        self, table: KeyedTable, prune: Column | None = None,
        restrict: Callable[[DataFrame], DataFrame] = lambda df: df,
    ) -> DataFrame:
        keys, rank = list(table.keys), [*table.order_by, "batch"]
        base, upto = self._base(table, prune)
        changes = self._changes(table, upto)
        if base is not None and not any(b > upto for b in self.batches(table.layer, table.name)):
            return restrict(base)
        if base is None:
            rows = latest_row(changes, keys, rank)
        else:
            # only keys with newer batches are ranked again; the rest of the base is passed on without a shuffle
            # as long as the changed keys are few enough for Spark to broadcast
            base, columns = restrict(base), changes.columns
            changed = changes.select(*keys).distinct()
            # a change must beat the key's row in the base wherever that row lies, so ranking comes before restriction;
            # where rows stay in the bucket of their key, the pruned base holds it
            rivals = base if table.cluster_by in keys else self._base(table, None)[0]
            contested = rivals.join(changed, keys, "left_semi").select(*columns).unionByName(changes)
            rows = base.join(changed, keys, "left_anti").select(*columns).unionByName(latest_row(contested, keys, rank))
        return restrict(rows)

    def _live(self, table: KeyedTable, rows: DataFrame) -> DataFrame:
        return rows.where(~F.coalesce(F.col(table.deleted), F.lit(False))) if table.deleted else rows

    @staticmethod
    def _shown(table: KeyedTable) -> list[str]:
        return [c for c in table.schema.fieldNames() if c != table.deleted]

    def read(self, layer: str, name: str, within: Scope | None = None, exact: bool = True) -> DataFrame:
        """Current rows, restricted to the `cluster_by` values in scope when given. Not `exact`: a scope too large to be
        broadcast only prunes buckets, for callers that join with its keys once they have one row per key."""
        table = TABLES[layer, name]
        if within is None or (within.large and not exact):
            rows = self._current(table, within and within.prune())
        else:
            rows = self._current(
                table, within.prune(),
                lambda df: restrict_to_keys(df, within.keys, table.cluster_by, within.count, table.keys),
            )
        return self._live(table, rows).select(*self._shown(table))

    def read_or_empty(self, layer: str, name: str, within: Scope | None = None, exact: bool = True) -> DataFrame:
        """As `read`; a table nobody has written yet has no rows. Both cases have the same schema."""
        if self.exists(layer, name):
            return self.read(layer, name, within, exact)
        table = TABLES[layer, name]
        return self._no_rows(table.schema).select(*self._shown(table))

    def lookup(self, layer: str, name: str, value: str) -> DataFrame:
        """Rows of one `cluster_by` value, blanks around it ignored: the base scan reads a single bucket directory, and every
        scan gets the value as a filter, so that row groups go by their ranges and Bloom filters."""
        table, wanted = TABLES[layer, name], F.lit(value.strip())
        rows = self._current(
            table, F.col("bucket") == self.bucket(wanted), lambda df: df.where(F.col(table.cluster_by) == wanted)
        )
        return self._live(table, rows).select(*self._shown(table))

    def versions(self, layer: str, name: str, before: int | None = None) -> DataFrame:
        """Every version ever written of every key, from the change batches, or from those with a lower number."""
        return self._changes(TABLES[layer, name], -1, before)

    def read_changes(self, layer: str, name: str, **options: str) -> DataFrame:
        """The table as a stream: one row per key and batch. Rows may repeat if a writer died while committing, so
        consumers must be keyed, as all of ours are."""
        table = TABLES[layer, name]
        full = T.StructType([*table.schema.fields, T.StructField("batch", T.LongType())])
        where = fs.make_dir(self.spark, self.path(layer, name, "changes"))
        return self.spark.readStream.schema(full).options(**options).parquet(where)

    # -- writing --------------------------------------------------------------------------------------------

    def upsert_batch(self, df: DataFrame, batch_id: int, layer: str, name: str, writer: str = "") -> bool:
        """Write a batch's newest row per key; False when this writer's batch is already there. Null keys are dropped.

        A run that dies between the rows and their record writes them again as another batch, which changes nothing."""
        table = TABLES[layer, name]
        record = self.path(layer, name, "commits", f"{writer or 'any'}-{batch_id}")
        if fs.exists(self.spark, record):
            return False
        present = fs.glob(self.spark, self.path(layer, name, "changes", "batch=*"))
        number = max((int(p.rpartition("=")[2]) for p in present), default=-1) + 1
        columns = table.schema.fields
        if table.deleted and table.deleted not in df.columns:
            df = df.withColumn(table.deleted, F.lit(False))
        typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in columns])
        rows = typed.dropna(subset=list(table.keys))
        if table.order_by:
            rows = latest_row(rows, table.keys, table.order_by)
        # written elsewhere and moved as a whole: whoever streams the changes sees a batch's files only once the batch counts
        ready = self.path(layer, name, "writing", uuid.uuid4().hex)
        rows.write.options(**self._found_by(table)).parquet(ready)
        fs.move(self.spark, ready, self.path(layer, name, "changes", f"batch={number}"))
        fs.touch(self.spark, record)
        return True

    @staticmethod
    def _found_by(table: KeyedTable) -> dict[str, str]:
        """Writer options: a Bloom filter on the column readers restrict on, as large as the file's keys ask for. A lookup
        then skips the row groups without its key."""
        column = f"#{table.cluster_by}"
        return {
            f"parquet.bloom.filter.enabled{column}": "true", "parquet.bloom.filter.adaptive.enabled": "true",
            f"parquet.bloom.filter.candidates.number{column}": "12",  # sizes from the greatest, 1 MB, down by halves
        }

    def _write_base(self, rows: DataFrame, layer: str, name: str, upto: int) -> None:
        # rebalance keeps buckets together but splits the ones a hot customer makes large
        table = TABLES[layer, name]
        laid_out = rows.withColumn("bucket", self.bucket(F.col(table.cluster_by))).hint("rebalance", "bucket")
        # in order of the key, so that a row group holds a narrow range of it
        laid_out = laid_out.sortWithinPartitions("bucket", table.cluster_by)
        target = self.path(layer, name, "base", f"upto={upto}")
        laid_out.write.mode("overwrite").options(**self._found_by(table)).partitionBy("bucket").parquet(target)
        fs.touch(self.spark, f"{target}/_buckets-{self.buckets}")

    def compact(self, layer: str, name: str) -> None:
        """Fold all batches so far into a new base; older files stay, so running readers are not disturbed."""
        table = TABLES[layer, name]
        batches = self.batches(layer, name)
        bases = self._committed(layer, name, "base/upto=*")
        if not batches or (bases and bases[-1] >= batches[-1]):
            return
        self._write_base(self._live(table, self._current(table)), layer, name, batches[-1])

    def reset(self, layer: str, name: str) -> None:
        """Forget all rows: an empty base hides every batch written so far."""
        batches = self.batches(layer, name)
        if batches:
            self._write_base(self._changes(TABLES[layer, name], batches[-1]), layer, name, batches[-1])
