"""Runs of repeated words, from a dictionary of basic factors.

A basic factor is a stretch of 2^k words; level k of the dictionary names the factors that occur twice or more in their
text, so that equal stretches have equal names. A run of smallest period q, 2^k <= q < 2^(k+1), repeats each factor of
level k inside its first period q words later. Occurrences of a factor less than half its length apart form arithmetic
progressions with its own period, which lower levels have proposed. So each level proposes only the distances, from its
length up to twice that, between the last members of progressions and the other occurrences around them: a number of
pairs in proportion to the words. A proposed pair is extended to both sides by comparing factors from the longest to the
shortest; equal spans are one run, and its period is the least one proposed for the span.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm.common import map_arrow
from patronage.llm.repetition import covered
from patronage.llm.textbytes import Rolling, per_row, pick, slices, words

#: Shortest run, in words. A run also holds its period twice.
LEAST_RUN = 12
RUNS = "array<struct<start: long, length: long, period: long>>"


def _named(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the pairs, and for each in that order the place of its group's first one."""
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order, np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0)) if len(order) else order


def dictionary(names: np.ndarray, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Level by level: places of the factors found twice or more, by name and place; their names; and the names at every
    word (-1 where the factor is alone in its row or reaches beyond it)."""
    n = len(names)
    row_end = np.searchsorted(rows, rows, "right")
    at, first, second, step = np.arange(n), names.view(np.int64), rows, 0
    while len(at):
        order, group = _named(first, second)
        at = at[order]
        several = np.zeros(len(at), bool)
        if len(at) > 1:
            same = group[1:] == group[:-1]
            several[1:] |= same
            several[:-1] |= same
        at, group = at[several], group[several]
        everywhere = np.full(n, -1, np.int32 if n < 2**31 else np.int64)
        everywhere[at] = group
        yield at, group, everywhere
        step = 2 * step or 1
        after = at + step
        ok = after + step <= row_end[at]
        at, after, group = at[ok], after[ok], group[ok]
        second = everywhere[after]
        some = second >= 0
        at, first, second = at[some], group[some], second[some]
        by_place = np.argsort(at, kind="stable")  # lexsort is stable: places stay in order inside a name
        at, first, second = at[by_place], first[by_place], second[by_place]


def _spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, number) for each number in the owner's range low..high."""
    many = np.maximum(high - low, 0)
    owner = np.repeat(np.arange(len(low)), many)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many) + low[owner]


def proposals(at: np.ndarray, group: np.ndarray, size: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) from the occurrences of one level's factors, each match once for a stretch of touching ones."""
    wide = 2 * size + n + 1
    key = group.astype(np.int64) * wide + at
    chained = np.zeros(len(at), bool)  # in one progression with the occurrence before
    chained[1:] = 2 * (key[1:] - key[:-1]) <= size
    last = np.flatnonzero(np.append(~chained[1:], True)) if len(at) else np.zeros(0, np.int64)
    begin = np.maximum.accumulate(np.where(chained, 0, np.arange(len(at))))[last] if len(at) else last
    one, two = _spread(np.maximum(last + 1, np.searchsorted(key, key[last] + size)), np.searchsorted(key, key[last] + 2 * size))
    three, four = _spread(np.searchsorted(key, key[last] - 2 * size, "right"), np.minimum(begin, np.searchsorted(key, key[last] - size, "right")))
    place = np.concatenate([at[last[one]], at[four]])
    period = np.concatenate([at[two], at[last[three]]]) - place
    order = np.lexsort((place, period))
    place, period = place[order], period[order]
    new = np.ones(len(place), bool)
    new[1:] = (period[1:] != period[:-1]) | (place[1:] > place[:-1] + size)
    return place[new], period[new]


def periodic_runs(names: np.ndarray, rows: np.ndarray, least: int = LEAST_RUN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, lengths and periods of all runs in rows of words, by start, then period. Words are given by name; rows
    stand one after the other, and a run never crosses a row's end."""
    n = len(names)
    levels, places, periods = [], [], []
    for k, (at, group, everywhere) in enumerate(dictionary(names, rows)):
        levels.append(everywhere)
        place, period = proposals(at, group, 1 << k, n)
        places.append(place)
        periods.append(period)
    if not levels:
        return (np.zeros(0, np.int64),) * 3
    place, period = np.concatenate(places), np.concatenate(periods)
    low, high = place.copy(), place.copy()
    for k in range(len(levels) - 1, -1, -1):
        level, size = levels[k], 1 << k
        other = np.minimum(high + period, n - 1)
        same = (level[np.minimum(high, n - 1)] == level[other]) & (level[other] >= 0) & (high + period < n)
        high[same] += size
        before = low - size
        left = level[np.maximum(before, 0)]
        same = (before >= 0) & (left >= 0) & (left == level[np.maximum(before, 0) + period])
        low[same] -= size
    length = high - low + period
    fine = (length >= 2 * period) & (length >= least)
    low, length, period = low[fine], length[fine], period[fine]
    order = np.lexsort((period, length, low))
    low, length, period = low[order], length[order], period[order]
    new = np.ones(len(low), bool)
    new[1:] = (low[1:] != low[:-1]) | (length[1:] != length[:-1])
    low, length, period = low[new], length[new], period[new]
    order = np.lexsort((period, low))
    return low[order], length[order], period[order]


def joined_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray, n: int) -> pa.Array:
    """The words of each of n rows, joined by one space."""
    size = ends - starts + 1
    size[np.append(rows[1:] != rows[:-1], True) if len(rows) else slice(0)] -= 1  # none after a row's last word
    begin = np.cumsum(size) - size
    out = np.repeat(starts - begin, size) + np.arange(int(size.sum()))
    text = np.append(data, np.uint8(0x20))[out]
    gap = begin + (ends - starts)
    text[gap[size > ends - starts]] = 0x20
    offsets = np.append(0, np.cumsum(per_row(rows, n, size))).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(text.tobytes())]).cast(pa.string())


def find_runs(documents: DataFrame, least: int = LEAST_RUN) -> DataFrame:
    """doc_id, runs (start, length and period in words, by start, then period) and collapsed: the text's words, joined by
    one space, without those that some run repeats, that is all after the first period of a run.

    One row for each row of the table; rows with a null id or equal rows are worked on alike. A null or empty text has no
    run and collapses to the empty text. Other columns are neither read nor kept. A text is worked on as a whole, however
    long it is, in memory of some 25 bytes a word and level, of which there are log2(longest repeat) + 1.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_id = pick(batch.column(0))
            for first, last, data, offsets in slices(pick(batch.column(1))):
                n = last - first
                starts, ends, rows = words(data, offsets)
                low, length, period = periodic_runs(Rolling(data).spans(starts, ends), rows, least)
                row = rows[low]
                keep = ~covered(low + period, length - period, len(starts))
                fields = [pa.array(x) for x in (low - np.searchsorted(rows, row), length, period)]
                found = pa.ListArray.from_arrays(
                    np.append(0, np.cumsum(per_row(row, n))).astype(np.int32), pa.StructArray.from_arrays(fields, ["start", "length", "period"])
                )
                text = joined_words(data, starts[keep], ends[keep], rows[keep], n)
                yield pa.RecordBatch.from_arrays([doc_id.slice(first, n), found, text], ["doc_id", "runs", "collapsed"])

    return map_arrow(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, f"doc_id long, runs {RUNS}, collapsed string")


def digest(found: DataFrame) -> DataFrame:
    """Of find_runs' rows: n_runs, the longest run (ties: smallest start, then period) and hashes of runs and collapsed text."""
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("shorter"), r["start"].alias("start"), r["period"].alias("period"))))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    length, period = -F.col("best")["shorter"], F.col("best")["period"]
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best")["start"].alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
