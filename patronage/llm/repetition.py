"""Quality rules on repetition, from a suffix array over each document's words.

The words of a slice of documents are ranked by prefix doubling (only suffixes that still share a rank are sorted
again); a document's suffixes never compare equal to another's. Adjacent suffixes' longest common prefixes bound the
intervals of repeated substrings. The longest repeat that starts at a word is the larger prefix shared with its two
neighbours in the array; the union of these spans is the union of all maximal repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm.common import map_arrow
from patronage.llm.textbytes import Rolling, lines, mix, per_row, pick, slices, sums_by_row, words

BASE_WINDOW = 5
#: Repeats shorter than this many words do not count as covered.
LEAST_REPEAT = 4
#: A document goes when more than this share of its words lies in repeats, or a repeat has more words than that.
MOST_COVERED = 0.3
MOST_REPEAT = 100
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, covered_words long, longest_repeat long"


def shared_prefixes(names: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """For each word, how many words from it on are found again elsewhere in its row (its longest repeat)."""
    n = len(names)
    if not n:
        return np.zeros(0, np.int64)
    ends = np.searchsorted(rows, rows, "right")
    order = np.lexsort((names, rows))
    fresh = np.ones(n, bool)
    fresh[1:] = (names[order][1:] != names[order][:-1]) | (rows[order][1:] != rows[order][:-1])
    begin = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = begin  # the rank of a group is the place of its first suffix in the array
    levels, step = [], 1
    open_ = order[~(fresh & np.append(fresh[1:], True))]
    while len(open_):
        levels.append(rank)
        rank = rank.copy()
        after = open_ + step
        old = levels[-1][open_]
        follow = np.where(after < ends[open_], levels[-1][np.minimum(after, n - 1)] + 1, 0)
        by = np.lexsort((follow, old))
        open_, old, follow = open_[by], old[by], follow[by]
        head = np.ones(len(open_), bool)
        head[1:] = old[1:] != old[:-1]
        new = head.copy()
        new[1:] |= follow[1:] != follow[:-1]
        index = np.arange(len(open_))
        block = np.maximum.accumulate(np.where(head, index, 0))
        group = np.maximum.accumulate(np.where(new, index, 0))
        rank[open_] = old + group - block
        open_ = open_[~(new & np.append(new[1:], True))]
        step *= 2
    array = np.empty(n, np.int64)
    array[rank] = np.arange(n)
    left, right = array[:-1].copy(), array[1:].copy()
    common = np.zeros(max(n - 1, 0), np.int64)
    live = np.flatnonzero(rows[left] == rows[right])
    for k in range(len(levels) - 1, -1, -1):  # equal ranks at level k: the next 2^k words are equal
        a, b = left[live] + common[live], right[live] + common[live]
        ok = (a < ends[left[live]]) & (b < ends[right[live]])
        same = ok & (levels[k][np.minimum(a, n - 1)] == levels[k][np.minimum(b, n - 1)])
        # a group's rank covers suffixes that end early; they are alone in it unless all 2^k words are there
        common[live[same]] += 1 << k
    longest = np.zeros(n, np.int64)
    longest[left] = common
    np.maximum.at(longest, right, common)
    return longest


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in any of the spans."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + lengths, -1)
    return np.cumsum(change[:-1]) > 0


def counts(data: np.ndarray, offsets: np.ndarray, least: int = LEAST_REPEAT) -> list[np.ndarray]:
    n = len(offsets) - 1
    rolling = Rolling(data)
    starts, ends, rows = words(data, offsets)
    in_word = np.zeros(len(data) + 1, np.int8)
    in_word[starts] += 1
    in_word[ends] -= 1
    chars = (np.cumsum(in_word[:-1]) > 0) & ((data & 0xC0) != 0x80)
    line_starts, line_ends, line_rows = lines(data, offsets)
    full = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends, line_rows = line_starts[full], line_ends[full], line_rows[full]
    named = mix(rolling.spans(line_starts, line_ends)) ^ mix(line_rows.astype(np.uint64) + np.uint64(1))
    different = np.unique(named, return_index=True)[1]
    longest = shared_prefixes(rolling.spans(starts, ends), rows)
    window = np.flatnonzero(longest >= BASE_WINDOW)
    repeated = covered(window, np.full(len(window), BASE_WINDOW), len(starts))
    found = np.flatnonzero(longest >= least)
    inside = covered(found, longest[found], len(starts))
    most = np.zeros(n, np.int64)
    np.maximum.at(most, rows, longest)
    return [
        per_row(rows, n), sums_by_row(chars, offsets), sums_by_row(SYMBOLS[data], offsets),
        per_row(line_rows, n) - per_row(line_rows[different], n), per_row(rows[repeated], n), per_row(rows[inside], n), most,
    ]


def measure(documents: DataFrame) -> DataFrame:
    """doc_id and the counts of every text. Null texts have no words; repeated rows are measured each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", *[c.split()[0] for c in COUNTS.split(", ")]]
        for batch in batches:
            doc_id = pick(batch.column(0))
            for first, last, data, offsets in slices(pick(batch.column(1))):
                yield pa.RecordBatch.from_arrays([doc_id.slice(first, last - first), *map(pa.array, counts(data, offsets))], names)

    return map_arrow(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, f"doc_id long, {COUNTS}")


def judge(documents: DataFrame, most_covered: float = MOST_COVERED, most_repeat: int = MOST_REPEAT) -> DataFrame:
    """The measured counts with base_failed and kept. Texts without words fail the base rule."""
    n, repeated = F.col("n_words"), F.col("n_repeat_words")
    failed = (n < 10) | (100 * repeated > 20 * n)
    fine = (F.col("covered_words") <= most_covered * n) & (F.col("longest_repeat") <= most_repeat)
    return measure(documents).withColumn("base_failed", failed).withColumn("kept", ~failed & fine)
