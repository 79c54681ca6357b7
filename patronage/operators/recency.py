"""A kept list of the newest customers: readers of the most recent ones need not sort the whole serving table.

Customers are dealt to slots by a hash of their id. A slot keeps its newest customers, whole rows, in order of the last
order's instant (none counts as 0), ties by id descending. What a slot cannot keep lies below its floor: a customer that
changes and ranks below the floor is not listed, because others that are not listed may rank higher. A slot without a
floor lists all its customers. Deleted and changed customers leave the list first; a slot with a floor that is left with
fewer customers than readers ask for is filled again from the serving rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.operators.normalise import SERVING_COLUMNS


def slot_of(customer_id: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(customer_id), F.lit(slots)).cast("int")


def index_schema(serving: T.StructType) -> T.StructType:
    row = T.StructType([serving[c] for c in SERVING_COLUMNS])
    floor = T.StructType().add("ts", "long").add("customer_id", "string")
    return T.StructType().add("slot", "integer").add("entries", T.ArrayType(row)).add("floor", floor)


def _rank(row: Column) -> Column:
    return F.struct(F.coalesce(row["last_order_ts"], F.lit(0).cast("bigint")).alias("ts"), row["customer_id"].alias("customer_id"))


def _as_rows(serving: DataFrame, slots: int) -> DataFrame:
    return serving.select(slot_of(F.col("customer_id"), slots).alias("slot"), F.struct(*SERVING_COLUMNS).alias("row"))


def _listed(rows: DataFrame, slots_held: DataFrame, keep: int) -> DataFrame:
    """The first `keep` rows (slot, row) of each slot of (slot, floor), with the new floor. No more than keep + 1 rows of a
    slot are gathered, however many there are."""
    ranked = rows.withColumn("rank", _rank(F.col("row")))
    place = F.row_number().over(Window.partitionBy("slot").orderBy(F.desc("rank")))
    first = ranked.withColumn("place", place).where(F.col("place") <= keep + 1)
    lists = first.groupBy("slot").agg(F.sort_array(F.collect_list(F.struct("rank", "row")), asc=False).alias("found"))
    joined = slots_held.join(lists, "slot", "left")
    cut = F.size("found") > keep
    entries = F.transform(F.slice(F.coalesce("found", F.array().cast(lists.schema["found"].dataType)), 1, keep), lambda e: e["row"])
    floor = F.when(cut, F.element_at("found", F.lit(keep))["rank"]).otherwise(F.col("floor"))
    return joined.select("slot", entries.alias("entries"), floor.alias("floor"))


def merge_recent(index: DataFrame, keys: DataFrame, rows: DataFrame, slots: int, keep: int) -> DataFrame:
    """The slots that a batch touches: `keys` are its customers, `rows` the serving rows of those that still exist."""
    keyed = keys.select("customer_id", slot_of(F.col("customer_id"), slots).alias("slot")).distinct()
    held = keyed.select("slot").distinct().join(index, "slot", "left").select("slot", "floor", "entries")
    listed = held.select("slot", F.explode("entries").alias("row")).withColumn("customer_id", F.col("row")["customer_id"])
    stay = listed.join(keyed, ["slot", "customer_id"], "left_anti").select("slot", "row")
    candidates = stay.unionByName(_as_rows(rows, slots)).join(held.select("slot", "floor"), "slot")
    above = F.col("floor").isNull() | (_rank(F.col("row")) >= F.col("floor"))
    return _listed(candidates.where(above).select("slot", "row"), held.select("slot", "floor"), keep)


def short_slots(merged: DataFrame, least: int) -> list[int]:
    """Slots that list fewer than `least` customers though they have more; a number for each slot at most."""
    short = merged.where(F.col("floor").isNotNull() & (F.size("entries") < least))
    return sorted(r["slot"] for r in short.select("slot").collect())


def refill(merged: DataFrame, serving: DataFrame, short: list[int], slots: int, keep: int) -> DataFrame:
    """The merged slots, the short ones made anew from all serving rows of theirs."""
    own = _as_rows(serving.where(slot_of(F.col("customer_id"), slots).isin(short)), slots)
    empty = merged.where(F.col("slot").isin(short)).select("slot", F.when(F.lit(False), F.col("floor")).alias("floor"))
    return merged.where(~F.col("slot").isin(short)).unionByName(_listed(own, empty, keep))


def recent_from_index(index: DataFrame, n: int) -> DataFrame:
    """The n customers with the newest orders, listed by id, from the index alone. Slots must hold n or be complete."""
    rows = index.select(F.explode("entries").alias("row"))
    newest = rows.orderBy(F.desc(_rank(F.col("row")))).limit(n)
    return newest.select("row.*").orderBy(F.col("customer_id").cast("string"))
