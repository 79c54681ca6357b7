"""Best-fit packing of documents into sequences, planned on the counts of lengths.

Lengths are whole numbers up to the capacity, so a table of how many pieces have each length (at most `capacity` rows)
says all a packing needs. The plan is made on it: a large length that is frequent is a group of its own, the others are
sorted and cut into groups of equal cardinality, each rounded up to its largest; configurations of these few sizes are
optimised by column generation; actual lengths take the places, and what is left over and all small lengths go best-fit,
longest first. Rounding leaves gaps that no piece fills. So the sequences with the largest gaps are taken apart and their
pieces placed best-fit again, a larger share of the sequences each time, until the plan is as good as best fit alone. A
plan is a list of runs: so many sequences with the same content, each place taken by consecutive ranks among the pieces of
its length. Pieces find their places by length and rank, in parallel; neither documents nor ids pass through the driver.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm.common import dealing, map_arrow, rank_in_groups, written
from patronage.llm.textbytes import pick
from patronage.llm.tokens import encoder

CAPACITY = 4096
GROUPS = 32
#: Lengths above this share of the capacity are large: at most 8 of them fit into a sequence.
LARGE_SHARE = 1 / 8
#: Shares of the sequences, those with most room, that are packed anew while best fit alone needs fewer. The last one is all.
MENDED_SHARES = (1 / 64, 1 / 32, 1 / 16, 1 / 8, 1 / 4, 1 / 2, 1)
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
ENCODE_ROWS = 128


@dataclass
class Run:
    """So many equal sequences: room left, the lengths in them, and when numbered the places as (length, first rank)."""

    count: int
    room: int
    sizes: list[int] = field(default_factory=list)
    places: list[tuple[int, int]] = field(default_factory=list)


def best_configuration(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The multiset of sizes that fits and is worth most; every size takes over an eighth of the capacity."""
    most = capacity // int(sizes.min())
    best = np.zeros(capacity + 1)
    choices = []
    for _ in range(most):  # one more item at a time
        options = np.full((len(sizes) + 1, capacity + 1), -1.0)
        options[-1] = best
        for g, (size, value) in enumerate(zip(sizes, values)):
            options[g, size:] = best[: capacity + 1 - size] + value
        choice = options.argmax(0)
        choice[options[choice, np.arange(capacity + 1)] <= best + 1e-12] = len(sizes)
        best = np.maximum(best, options.max(0))
        choices.append(choice)
    taken, room = np.zeros(len(sizes), int), capacity
    for choice in reversed(choices):
        if choice[room] < len(sizes):
            taken[choice[room]] += 1
            room -= sizes[choice[room]]
    return float(values @ taken), taken


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 400) -> list[tuple[np.ndarray, int]]:
    """Configurations and how often each is used, never more than the demand: the covering linear program solved by
    column generation, its solution rounded down."""
    basis = np.diag((capacity // sizes).astype(float))
    used = demand / np.diag(basis)
    for _ in range(rounds):
        worth = np.linalg.solve(basis.T, np.ones(len(sizes)))
        value, column = best_configuration(sizes, worth, capacity)
        if value <= 1 + 1e-9:
            break
        change = np.linalg.solve(basis, column.astype(float))
        with np.errstate(divide="ignore", invalid="ignore"):
            limit = np.where(change > 1e-9, used / change, np.inf)
        leave = int(limit.argmin())
        used = used - limit[leave] * change
        used[leave] = limit[leave]
        basis[:, leave] = column
    left = demand.astype(int).copy()
    found = []
    for k in np.argsort(-used, kind="stable"):
        pattern = np.rint(basis[:, k]).astype(int)
        some = pattern > 0
        n = min(int(used[k] + 1e-6), int((left[some] // pattern[some]).min()))
        if n > 0:
            left -= n * pattern
            found.append((pattern, n))
    return found


def plan(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> list[Run]:
    """Runs that hold every piece, counts[length] of each length, with ranks from 0 in `places`: the linear grouping plan,
    mended until it has no more sequences than best fit alone."""
    if any(not 0 < size <= capacity for size, n in counts.items() if n > 0):
        raise ValueError("a piece is longer than a sequence")
    runs = mended(grouped_plan(counts, capacity, groups), total(best_fit([], counts, capacity)), capacity)
    next_rank: dict[int, int] = defaultdict(int)
    for run in runs:
        for size in run.sizes:
            run.places.append((size, next_rank[size]))
            next_rank[size] += run.count
    return runs


def total(runs: list[Run]) -> int:
    return sum(run.count for run in runs)


def mended(runs: list[Run], most: int, capacity: int) -> list[Run]:
    """The plan with its worst filled sequences packed anew, in growing shares, until there are at most `most`."""
    for share in MENDED_SHARES:
        if total(runs) <= most:
            break
        left, kept, pieces = math.ceil(share * total(runs)), [], defaultdict(int)
        for run in sorted(runs, key=lambda r: (-r.room, -len(r.sizes))):  # full ones with many small pieces fill gaps
            gone = min(run.count, left)
            left -= gone
            for size in run.sizes if gone else ():
                pieces[size] += gone
            if run.count > gone:
                kept.append(Run(run.count - gone, run.room, list(run.sizes)))
        again = best_fit(kept, pieces, capacity)
        runs = min(runs, again, key=total)
    return runs


def best_fit(runs: list[Run], counts: dict[int, int], capacity: int) -> list[Run]:
    """The runs with the pieces added, longest first, each where the least room is left; new runs where it fits nowhere."""
    done: list[Run] = []
    by_room: dict[int, list[Run]] = defaultdict(list)
    rooms: list[int] = []

    def put(run: Run) -> None:
        if run.room == 0 or run.count == 0:
            if run.count:
                done.append(run)
            return
        if not by_room[run.room]:
            insort(rooms, run.room)
        by_room[run.room].append(run)

    for run in runs:
        put(run)
    for size in sorted(counts, reverse=True):
        n = counts[size]
        while n > 0:
            k = bisect_left(rooms, size)
            if k == len(rooms):
                each = min(capacity // size, n)
                run = Run(n // each, capacity)
            else:
                room = rooms[k]
                run = by_room[room].pop()
                if not by_room[room]:
                    rooms.pop(k)
                each = min(room // size, n)
                if run.count > n // each:
                    put(Run(run.count - n // each, run.room, list(run.sizes)))
                    run = Run(n // each, run.room, list(run.sizes))
            run.sizes += [size] * each
            run.room -= each * size
            n -= each * run.count
            put(run)
    return done + [run for room in rooms for run in by_room[room]]


def linear_groups(large: dict[int, int], groups: int) -> dict[int, list[list[int]]]:
    """Groups by the size they are rounded up to, as [length, pieces], longest first: a length that fills a group is one
    by itself, the others are cut into groups of equal cardinality."""
    share = sum(large.values()) / groups
    found = {size: [[size, n]] for size, n in large.items() if n >= share}
    others = sorted((size for size in large if size not in found), reverse=True)
    count, at, group = sum(large[size] for size in others), 0, 0
    cuts = [round(count * i / groups) for i in range(1, groups + 1)]
    for size in others:
        n = large[size]
        while n:
            while cuts[group] <= at:
                group += 1
            take = min(n, cuts[group] - at)
            if at in (0, cuts[group - 1]) or not found:
                top = size
            found.setdefault(top, []).append([size, take])
            at, n = at + take, n - take
    return found


def grouped_plan(counts: dict[int, int], capacity: int, groups: int) -> list[Run]:
    """Linear grouping: configurations of rounded large lengths, taken by actual ones, then best fit for all the rest."""
    left = {size: n for size, n in counts.items() if n > 0}
    large = {size: n for size, n in left.items() if capacity * LARGE_SHARE < size < capacity}
    runs: list[Run] = []
    if large:
        members = linear_groups(large, groups)
        sizes = np.array(sorted(members, reverse=True))
        demand = np.array([sum(n for _, n in members[s]) for s in sizes])
        for pattern, n in configurations(sizes, demand, capacity):
            chosen: list[list[list[int]]] = []  # of each place, the actual lengths that take it in turn
            for stock in [members[int(s)] for s, k in zip(sizes, pattern) for _ in range(k)]:
                parts, need = [], n
                while need:
                    take = min(need, stock[0][1])
                    parts.append([stock[0][0], take])
                    stock[0][1] -= take
                    need -= take
                    if not stock[0][1]:
                        stock.pop(0)
                chosen.append(parts)
            while chosen and chosen[0]:  # as many equal sequences as no place changes its length
                step = min(parts[0][1] for parts in chosen)
                own = [parts[0][0] for parts in chosen]
                runs.append(Run(step, capacity - sum(own), own))
                for parts in chosen:
                    parts[0][1] -= step
                    if not parts[0][1]:
                        parts.pop(0)
    for run in runs:
        for size in run.sizes:
            left[size] -= run.count
    return best_fit(runs, left, capacity)


def places(runs: list[Run]) -> dict[int, np.ndarray]:
    """For each length, rows of (first rank, sequence id of it, offset), sorted by rank."""
    found: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    sequence = 0
    for run in runs:
        offset = 0
        for size, rank in run.places:
            found[size].append((rank, sequence, offset))
            offset += size
        sequence += run.count
    return {size: np.array(sorted(rows), np.int64) for size, rows in found.items()}


def cut_documents(documents: DataFrame, tokenizer: str, style: str, end_id: int, capacity: int = CAPACITY, width: int = 2) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: documents longer than the capacity are cut into pieces of it, others
    are one piece. A null text is empty: one piece with the end id alone. Equal rows and rows without an id are documents
    of their own. Only doc_id and text are read. A text is encoded as a whole, so its ids must fit into a worker's memory."""
    end = int(end_id).to_bytes(width, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, style, f"<u{width}")
        for batch in batches:
            doc_ids, texts = pick(batch.column(0)).to_pylist(), pick(batch.column(1))
            for first in range(0, len(texts), ENCODE_ROWS):
                rows = []
                for doc_id, raw in zip(doc_ids[first:], encode(texts.slice(first, ENCODE_ROWS).to_pylist())):
                    ids = np.frombuffer(raw + end, f"<u{width}").astype("<u4")
                    for piece, start in enumerate(range(0, len(ids), capacity)):
                        own = ids[start : start + capacity]
                        rows.append((doc_id, piece, start, len(own), zlib.crc32(own.tobytes())))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), *[pa.int64()] * 3))]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in PIECES.split(", ")])

    return map_arrow(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), cut, PIECES)


def pack(pieces: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """Adds sequence_id and offset to a written table of pieces with a `length` and a `_deal` (see dealing), which goes.

    Rows equal in doc_id and piece, or with a null doc_id, get places of their own; an empty table gives no rows. The table's
    other columns stay, but none may be named sequence_id, offset or begin with an underscore."""
    lengths = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    found = places(plan(lengths, capacity, groups))
    fields = [f for f in pieces.schema if f.name != "_deal"]
    names = [*[f.name for f in fields], "sequence_id", "offset"]
    ranked = rank_in_groups(pieces, "length", ["doc_id", "piece"], "_place")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = (pick(batch.column(c)).to_numpy(zero_copy_only=False) for c in ("length", "_place"))
            sequence, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            order = np.argsort(size, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(size[order])) + 1) if len(order) else ():
                table = found[int(size[own[0]])]
                row = table[np.searchsorted(table[:, 0], rank[own], "right") - 1]
                sequence[own], offset[own] = row[:, 1] + rank[own] - row[:, 0], row[:, 2]
            columns = [batch.column(c) for c in names[:-2]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", sequence_id long, offset long"
    return map_arrow(ranked, place, schema)


def pack_documents(documents: DataFrame, tokenizer: str, style: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of all documents with their places; see cut_documents and pack."""
    pieces = cut_documents(documents, tokenizer, style, end_id, capacity)
    pieces = written(pieces.withColumn("_deal", dealing("doc_id", "piece")), "pieces")
    return pack(pieces, capacity)
