"""Words, lines and hashes of many texts at once, as numpy arrays over Arrow's text buffer."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are worked on in slices of about this many bytes; a longer text is a slice of its own.
SLICE_BYTES = 1 << 18
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True

_BASE = 0x9E3779B97F4A7C15 | 1
_tables: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over a 64-bit word (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def seeded(seed: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(seed))


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets of the rows in them); null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the maximal runs of true bytes; a run never crosses a row's end."""
    n = len(inside)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:n]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, "right") - 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of anything but ASCII white space."""
    return runs(~SPACES[data], offsets)


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the newline-split lines, empty ones included; each row has one at least."""
    breaks = np.flatnonzero(data == 0x0A)
    rows = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, breaks, "right") - 1])
    starts = np.concatenate([offsets[:-1], breaks + 1])
    ends = np.concatenate([breaks, offsets[1:]])
    order = np.lexsort((starts, rows))
    starts, rows = starts[order], rows[order]
    ends = ends[np.lexsort((ends, np.concatenate([np.searchsorted(offsets, breaks, "right") - 1, np.arange(len(offsets) - 1)])))]
    return starts, ends, rows


def character_places(data: np.ndarray) -> np.ndarray | None:
    """Where each UTF-8 character begins, and the end; None where every byte is a character."""
    if not (data & 0x80).any():
        return None
    return np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))


def characters(data: np.ndarray, places: np.ndarray | None) -> np.ndarray:
    """The bytes of each character as one number."""
    if places is None:
        return data
    at, size = places[:-1], np.diff(places)
    found = data[at].astype(np.uint32)
    for k in range(1, 4):
        more = np.flatnonzero(size > k)
        found[more] |= data[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return found


class Rolling:
    """Hash of any span of bytes in constant time: sums of random 64-bit values times powers of an odd number."""

    def __init__(self, data: np.ndarray, seed: int = 0):
        self.base = (_BASE * (2 * seed + 1)) | 1
        values = seeded(seed + 1, 256)[data]
        values *= self._powers("up", self.base, len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values, out=self.sums[1:])

    @staticmethod
    def _powers(kind: str, base: int, n: int) -> np.ndarray:
        key = f"{kind}{base}"
        if key not in _tables or len(_tables[key]) < n:
            size = max(n, SLICE_BYTES * 2)
            table = np.full(size, base & (2**64 - 1), np.uint64)
            table[:1] = 1
            _tables[key] = np.cumprod(table)
        return _tables[key][:n]

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        down = self._powers("down", pow(self.base, -1, 2**64), len(self.sums))
        return mix((self.sums[ends] - self.sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def per_row(rows: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    counted = np.bincount(rows, weights, n)
    return counted if weights is not None else counted.astype(np.int64)


def sums_by_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of each row's bytes are flagged."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def pick(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
