"""Exact top-k inner products over a bit-sliced index.

Vectors are dealt to blocks. In a block every attribute is cut to a few leading bits, and each of these bits is a bitmap
over the block's rows: an attribute slice. A query's weights are rounded too, so its score is a sum of slices times powers
of two, worked out for all rows at once by adders on bitmaps (three bitmaps of one weight give their parity and, of twice
the weight, their majority). The sum is again a number in slices. The place of the k-th largest sum is found from the most
significant slice downward; what rounding can have cost bounds how far below it a row of the true first k may lie. All
rows above that boundary are scored exactly with the whole integers, so results do not depend on slices or bounds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronage.llm.common import map_arrow, ship, small_side, written
from patronage.llm.textbytes import pick

SCALE = 1024
#: Bits kept of an attribute and of a query's weight.
SLICES, WEIGHT_BITS = 7, 6
#: Rows of a block and queries of a group, on average: a task compares one group with one block.
BLOCK_ROWS, GROUP_QUERIES = 16_384, 512
#: Whole numbers beyond this stand as this; scores are exact and stand as the ends of `long` beyond those.
MOST = 1 << 62
BLOCK = "block long, vec_id array<long>, whole binary, sliced binary, shift array<int>, least array<long>, rest double, norm double"
_LONG = 2**63 - 1


def whole_numbers(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x), within +-MOST."""
    with np.errstate(over="ignore"):
        scaled = np.floor(scale * values.astype(np.float64))
    return np.where(np.abs(scaled) < MOST, scaled, 0).astype(np.int64) + np.where(np.abs(scaled) < MOST, 0, np.sign(scaled)).astype(np.int64) * MOST


def packed(bits: np.ndarray) -> np.ndarray:
    """Booleans by row as 64-bit words, along the last axis."""
    n = bits.shape[-1]
    wide = np.zeros((*bits.shape[:-1], -(-n // 64) * 64), bool)
    wide[..., :n] = bits
    return np.packbits(wide, axis=-1, bitorder="little").view(np.uint64)


def unpacked(words: np.ndarray, n: int) -> np.ndarray:
    """The places whose bits are set."""
    return np.flatnonzero(np.unpackbits(words.view(np.uint8), bitorder="little")[:n])


def slice_block(whole: np.ndarray, slices: int = SLICES) -> tuple[np.ndarray, np.ndarray, np.ndarray, float, float]:
    """Bitmaps (attribute, slice, word), each attribute's shift and least value, and the largest norm over rows of what the
    shift cuts off (around its middle) and of the kept values' distance from their mean."""
    least = whole.min(0)
    span = whole.max(0).astype(object) - least.astype(object)
    shift = np.array([max(0, int(s).bit_length() - slices) for s in span], np.int64)
    kept = ((whole.astype(object) - least.astype(object)) >> shift.astype(object)).astype(np.int64) if span.max(initial=0) >= MOST else (whole - least) >> shift
    bits = packed(((kept.T[:, None, :] >> np.arange(slices)[None, :, None]) & 1).astype(bool))
    unit = 2.0**shift
    rest = whole.astype(float) - least - kept * unit - (unit - 1) / 2
    centred = (kept - kept.mean(0)) * unit
    return bits, shift, least, float(np.sqrt((rest**2).sum(1)).max(initial=0.0)), float(np.sqrt((centred**2).sum(1)).max(initial=0.0))


def added(columns: dict[int, list[np.ndarray]], width: int) -> np.ndarray:
    """The sum of bitmaps, columns[j] holding arrays (bitmap, word) of weight 2^j, as slices from the least significant."""
    result, j = [], 0
    while columns:
        held = columns.pop(j, [])
        stack = np.concatenate(held) if held else np.zeros((0, width), np.uint64)
        carried = []
        while len(stack) > 1:
            third = max(1, len(stack) // 3)
            if len(stack) == 2:
                a, b = stack[:1], stack[1:2]
                carried.append(a & b)
                stack = a ^ b
                break
            a, b, c, left = stack[:third], stack[third : 2 * third], stack[2 * third : 3 * third], stack[3 * third :]
            either = a ^ b
            carried.append((a & b) | (either & c))
            stack = np.concatenate([either ^ c, left])
        if carried:
            columns.setdefault(j + 1, []).extend(carried)
        result.append(stack[0] if len(stack) else np.zeros(width, np.uint64))
        j += 1
    return np.stack(result) if result else np.zeros((0, width), np.uint64)


def ranked_value(slices: np.ndarray, rows: np.ndarray, k: int) -> int:
    """The k-th largest number among the bitmap's rows (of which there are k or more), from the highest slice downward."""
    above, equal, value = np.zeros_like(rows), rows, 0
    for j in range(len(slices) - 1, -1, -1):
        upper = equal & slices[j]
        if int(np.bitwise_count(above | upper).sum()) >= k:
            equal, value = upper, value | 1 << j
        else:
            above, equal = above | upper, equal & ~slices[j]
    return value


def at_least(slices: np.ndarray, rows: np.ndarray, bound: int) -> np.ndarray:
    """The bitmap's rows whose number is `bound` or more."""
    if bound <= 0:
        return rows
    if bound >> len(slices):
        return np.zeros_like(rows)
    above, equal = np.zeros_like(rows), rows
    for j in range(len(slices) - 1, -1, -1):
        if bound >> j & 1:
            equal = equal & slices[j]
        else:
            above, equal = above | (equal & slices[j]), equal & ~slices[j]
    return above | equal


def boundary_rows(query: np.ndarray, rows: np.ndarray, k: int, bits: np.ndarray, shift: np.ndarray, rest: float, norm: float, weight_bits: int = WEIGHT_BITS) -> np.ndarray:
    """A bitmap of rows that holds the k best of the given ones: all whose rounded score may reach the k-th."""
    _, slices, width = bits.shape
    if int(np.bitwise_count(rows).sum()) <= k:
        return rows
    exact = query.astype(float) * 2.0**shift  # what one step of an attribute is worth
    step = 2.0 ** max(0, math.frexp(float(np.abs(exact).max(initial=0.0)))[1] - weight_bits)
    weight = np.rint(exact / step).astype(np.int64)
    ones, size = np.uint64(2**64 - 1), np.abs(weight)
    columns: dict[int, list[np.ndarray]] = {}
    for c in range(int(size.max(initial=0)).bit_length()):
        own = np.flatnonzero(size >> c & 1)
        turned = bits[own] ^ np.where(weight[own] < 0, ones, np.uint64(0))[:, None, None]  # -w x is w (most - x) - w most
        for s in range(slices):
            columns.setdefault(c + s, []).append(turned[:, s])
    total = added(columns, width)
    # the k rows with the largest sums score no less than the k-th sum less the error, all others must reach that
    unit = 2.0**shift
    inside = np.linalg.norm(query.astype(float)) * rest
    wrong = np.linalg.norm((exact - weight * step) / unit) * norm
    error = (inside + wrong) / step * (1 + 1e-9) + 1e-3
    return at_least(total, rows, ranked_value(total, rows, k) - math.floor(2 * error) - 1)


def may_overflow(query: np.ndarray, whole: np.ndarray) -> bool:
    return int(np.abs(query).max(initial=0)) * int(np.abs(whole).max(initial=0)) * len(query) >= MOST


def exact_scores(query: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Integer inner products; beyond `long` they stand as its ends."""
    if not len(query):
        return np.zeros(len(whole), np.int64)
    if not may_overflow(query, whole):
        return whole.astype(np.int64) @ query
    return np.array([max(-_LONG - 1, min(_LONG, sum(int(a) * int(b) for a, b in zip(row, query, strict=True)))) for row in whole], np.int64)


def usable(vectors: DataFrame, vector: str) -> DataFrame:
    """vec_id and the components as doubles, without vectors that are null or hold a null, infinite or undefined component."""
    whole = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists("_v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    named = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("_v"))
    return named.where(F.col("_v").isNotNull() & ~bad)


def build_index(vectors: DataFrame, vector: str = "embedding", scale: int = SCALE, slices: int = SLICES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The index as a written table, one row a block: ids, whole components, slices, and the bounds of what slices lose.

    Rows are dealt by a hash of id, vector and partition-local number to as many blocks as their count asks for, so neither
    one id nor one vector, however common, fills a block. Vectors of different lengths are in different blocks. Null vectors
    and those with null or non-finite components are left out; a null id is kept.
    """
    found = usable(vectors, vector)
    counts = found.groupBy(F.size("_v").alias("dims")).agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("blocks"))
    # which block a row falls into may change when a lost task runs again, so the deal is written once
    dealt = found.withColumn("dims", F.size("_v")).join(small_side(written(counts, "index-sizes")), "dims")
    spread = F.xxhash64("vec_id", "_v", F.monotonically_increasing_id())
    dealt = written(dealt.select("dims", F.pmod(spread, F.col("blocks")).alias("part"), "vec_id", "_v"), "index-rows")

    def build(key: tuple, table: pa.Table) -> pa.Table:
        dims, n = key[0].as_py(), table.num_rows
        values = pick(table["_v"]).flatten().to_numpy(zero_copy_only=False).reshape(n, dims)
        whole = whole_numbers(values, scale)
        bits, shift, least, rest, norm = slice_block(whole, slices)
        kind = np.int16 if int(np.abs(whole).max(initial=0)) < 2**15 else np.int64
        block = int(dims) << 40 | int(key[1].as_py())
        columns = [[block], [table["vec_id"].to_pylist()], [whole.astype(kind).tobytes()], [bits.tobytes()], [shift.tolist()], [least.tolist()], [rest], [norm]]
        types = [pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.float64(), pa.float64()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [c.split()[0] for c in BLOCK.split(", ")])

    ship(vectors.sparkSession)
    return written(dealt.groupBy("dims", "part").applyInArrow(build, BLOCK), "bit-sliced-index")


class Block:
    """One row of the index, unpacked."""

    def __init__(self, row: dict):
        n, dims = len(row["vec_id"]), len(row["shift"])
        self.null = np.array([i is None for i in row["vec_id"]], bool)
        self.ids = np.array([_LONG if i is None else i for i in row["vec_id"]], np.int64)
        kind = np.int16 if len(row["whole"]) == 2 * n * dims else np.int64
        self.whole = np.frombuffer(row["whole"], kind).reshape(n, dims)
        width = -(-n // 64)
        self.bits = np.frombuffer(row["sliced"], np.uint64).reshape(dims, -1 if dims else 0, width)
        self.shift = np.array(row["shift"], np.int64)
        self.rest, self.norm = row["rest"], row["norm"]
        self.all = packed(np.ones(n, bool))

    def best(self, query: np.ndarray, own: int | None, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the k best rows but `own`, by score, ties to smaller ids, null ids last."""
        rows = self.all
        if own is not None:
            rows = rows.copy()
            rows[own // 64] &= ~np.uint64(1 << own % 64)
        if len(query) and not may_overflow(query, self.whole):  # scores at the ends of `long` tie: all are compared
            rows = boundary_rows(query, rows, k, self.bits, self.shift, self.rest, self.norm)
        place = unpacked(rows, len(self.ids))
        score = exact_scores(query, self.whole[place])
        order = np.lexsort((self.null[place], self.ids[place], ~score))[:k]
        return place[order], score[order]


def index_queries(index: DataFrame, every: int) -> DataFrame:
    """block, slot, query_id and whole components of the indexed rows whose id is divisible by `every`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                slot = np.flatnonzero((block.ids % every == 0) & ~block.null)
                columns = [pa.array(np.full(len(slot), row["block"])), pa.array(slot), pa.array(block.ids[slot]), pa.array(block.whole[slot].astype(np.int64).tolist(), pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["block", "slot", "query_id", "query"])

    return map_arrow(index, run, "block long, slot long, query_id long, query array<long>")


def search(index: DataFrame, queries: DataFrame, k: int = 10, group_queries: int = GROUP_QUERIES) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of each query's k best rows of the index but itself (all, if fewer).

    `queries` is a table of index_queries, of any size. Groups of queries meet blocks in tasks of their own; a task returns
    a query's k best rows of its block, and the best of these are the result. Queries meet rows of their own length only.
    Rows equal in id and vector are rows of their own: each is a query, and the others are among its candidates. Ties go
    to smaller ids, null ids come last. An empty index or no query gives no rows.
    """
    queries = written(queries, "index-queries")
    dims = F.shiftrightunsigned("block", 40)
    groups = queries.groupBy(dims.alias("dims")).agg(F.ceil(F.count(F.lit(1)) / group_queries).alias("groups"))
    sizes = written(index.select("block", dims.alias("dims")).join(groups, "dims"), "index-groups")
    sides = sizes.select("dims", F.col("block").alias("other"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("group"))
    blocks = index.join(sides.withColumnRenamed("other", "block").drop("dims"), "block")
    dealt = queries.withColumn("dims", dims).join(groups, "dims")
    dealt = dealt.withColumn("group", F.pmod(F.xxhash64("block", "slot"), F.col("groups"))).drop("groups")
    dealt = dealt.join(sides, ["dims", "group"]).select("other", "group", "block", "slot", "query_id", "query")

    def meet(asked: pa.Table, held: pa.Table) -> pa.Table:
        found = []
        for row in held.select([c.split()[0] for c in BLOCK.split(", ")]).to_pylist():
            block = Block(row)
            values = pick(asked["query"])
            flat, cuts = values.flatten().to_numpy(), np.append(0, np.cumsum(pc.list_value_length(values).to_numpy(zero_copy_only=False)))
            origin, slots, ids = (asked[c].to_numpy() for c in ("block", "slot", "query_id"))
            for i in range(asked.num_rows):
                place, score = block.best(flat[cuts[i] : cuts[i + 1]], int(slots[i]) if origin[i] == row["block"] else None, k)
                named = pa.array(block.ids[place], mask=block.null[place])
                found.append(pa.table([pa.array(np.full(len(place), v)) for v in (origin[i], slots[i], ids[i])] + [named, pa.array(score)], names))
        return pa.concat_tables(found) if found else pa.table({c: pa.array([], pa.int64()) for c in names})

    names = ["block", "slot", "query_id", "vec_id", "score"]
    ship(index.sparkSession)
    met = dealt.groupBy("other", "group").cogroup(blocks.groupBy("block", "group"))
    found = met.applyInArrow(meet, ", ".join(f"{c} long" for c in names))
    rank = F.row_number().over(Window.partitionBy("block", "slot").orderBy(F.desc("score"), F.asc_nulls_last("vec_id")))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_rows(vectors: DataFrame, every: int = 100, k: int = 10, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """Of every indexed row whose vec_id is divisible by `every`, the k rows of highest inner product; see `search`."""
    index = build_index(vectors, vector, scale)
    return search(index, index_queries(index, every), k)
