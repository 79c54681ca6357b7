"""Near-duplicate lines by a segment-partition edit join.

Lines are compared without white space at their ends, by characters (code points). Equal lines are found for lines of
every length. Lines of `LEAST` characters or more are also compared with others: a line within edit distance `threshold`
of another shares one of the other's threshold + 1 segments unchanged, at a place that the lengths and the segment's number
bound. So every distinct line is indexed by its segments and probes the index of each length up to its own with the
substrings that can match. Keys that two different lines share are found first, by their least and greatest line. The lines
of these keys are dealt to tasks, many small keys or two blocks of a large one at a time. A task verifies its candidates by
bit-parallel edit distance in a diagonal band, each pair under the first segment it shares only, and gives a row a line:
its number of links, and whether one of them occurs earlier. No pairs leave a task.

A line stays where it occurs first; later equal lines go, and a line that is near one with an earlier first occurrence goes
everywhere. Places are ordered by document id, then text hash, then line. A line's work grows with its length, in memory
of some 50 bytes a character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.llm.common import map_arrow, ship, small_side, written
from patronage.llm.textbytes import SLICE_BYTES, SPACES, Rolling, character_places, characters, lines, mix, pick, slices

THRESHOLD = 2
#: Shorter lines are near none: an edit would change more than a twentieth of them. Equal ones are found all the same.
LEAST = 20
#: Lines of one key that a task takes as a whole; larger keys are compared in blocks of so many. Lines of a task with many keys.
KEY_LINES, TASK_LINES = 512, 4_096
#: Characters, and pairs, that are compared at a time.
COMPARED, COMPARED_PAIRS = 1 << 19, 1 << 14
#: Lines whose keys a task has sent lately and does not send again.
REMEMBERED = 1 << 16
#: Letters are counted in so many classes, for a bound on the edit distance.
CLASSES = 32
#: White space at a line's ends that is taken off character by character; beyond it all lines are searched for their words.
MOST_STEPS = 32
_STRIP = " \t\n\x0b\f\r"


def trimmed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Start, end, row and number of each line with a word, without white space at its ends."""
    starts, ends, rows = lines(data, offsets)
    number = np.arange(len(rows)) - np.searchsorted(rows, rows)
    for edge, inside, step in ((starts, 0, 1), (ends, -1, -1)):
        left = np.flatnonzero(starts < ends)
        for _ in range(MOST_STEPS):  # most lines have no space at an end, few have several
            left = left[SPACES[data[edge[left] + inside]]]
            edge[left] += step
            left = left[starts[left] < ends[left]]
            if not len(left):
                break
        else:
            filled = np.flatnonzero(~SPACES[data])
            low, high = np.searchsorted(filled, starts), np.searchsorted(filled, ends) - 1
            some = low <= high
            starts[some], ends[some], ends[~some] = filled[low[some]], filled[high[some]] + 1, starts[~some]
            break
    full = starts < ends
    return starts[full], ends[full], rows[full], number[full]


def line_names(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return np.stack([Rolling(data, seed).spans(starts, ends) for seed in (11, 12)], 1).view(np.int64)


def occurrences(documents: DataFrame) -> DataFrame:
    """u1, u2 (the line), doc_id, text_hash, line_no of every line with a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_id, text_hash = (pick(batch.column(c)) for c in (0, 1))
            for first, last, data, offsets in slices(pick(batch.column(2))):
                starts, ends, rows, number = trimmed(data, offsets)
                name = line_names(data, starts, ends)
                take = pa.array(rows + first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name[:, 0]), pa.array(name[:, 1]), doc_id.take(take), text_hash.take(take), pa.array(number)],
                    ["u1", "u2", "doc_id", "text_hash", "line_no"],
                )

    return map_arrow(documents, run, "u1 long, u2 long, doc_id long, text_hash long, line_no long")


def segment(length: np.ndarray, i: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of segment i (from 0) of a line cut into parts; the last ones are one byte longer if need be."""
    size, longer = length // parts, length % parts
    return i * size + np.maximum(0, i - (parts - longer)), size + (i >= parts - longer)


def alignments(threshold: int) -> list[tuple[int, int, int]]:
    """(segment, lengths' difference, shift) under which a longer line may hold a shorter one's segment: at most i errors
    lie before segment i and threshold - i after it."""
    every = range(threshold + 1)
    return [(i, d, s) for i in every for d in every for s in range(-i, i + 1) if abs(s - d) <= threshold - i]


def own_segments(threshold: int) -> list[tuple[int, int, int]]:
    """The alignments under which a line holds its own segments: their keys are the ones it is indexed by."""
    return [(i, 0, 0) for i in range(threshold + 1)]


def keys(
    rolling: Rolling, starts: np.ndarray, ends: np.ndarray, threshold: int, ways: list[tuple[int, int, int]], places: np.ndarray | None = None
) -> np.ndarray:
    """(line, alignment) keys of the substrings that may be a segment of another line; 0 where there is none. Starts and
    ends count characters, `places` says where they begin in the bytes (None: each is one byte)."""
    length, parts = ends - starts, threshold + 1
    found = np.zeros((len(starts), len(ways)), np.int64)
    for column, (i, shorter, shift) in enumerate(ways):
        other = length - shorter  # the indexed line's length
        at, size = segment(other, i, parts)
        ok = (other >= LEAST) & (at + shift >= 0) & (at + shift + size <= length)
        s, tag = (starts + at + shift)[ok], mix((other[ok] * parts + i).astype(np.uint64))
        e = s + size[ok]
        if places is not None:
            s, e = places[s], places[e]
        found[ok, column] = mix(rolling.spans(s, e) ^ tag).view(np.int64)
    return found


def segment_keys(documents: DataFrame, threshold: int) -> DataFrame:
    """key, u1 and kind (3: a segment of the line, indexed and probed with; 2: probed with only) of the lines that are long
    enough; a line that repeats is sent once by a task as long as it is remembered."""
    own = own_segments(threshold)
    others = [way for way in alignments(threshold) if way not in own]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for _, _, data, offsets in slices(pick(batch.column(2))):
                starts, ends, _, _ = trimmed(data, offsets)
                rolling, places = Rolling(data, 11), character_places(data)
                first, last = (starts, ends) if places is None else (np.searchsorted(places, starts), np.searchsorted(places, ends))
                long = np.flatnonzero(last - first >= LEAST)
                name = rolling.spans(starts[long], ends[long]).view(np.int64)
                new = [k for k, x in enumerate(name.tolist()) if x not in seen and not seen.add(x)]
                if len(seen) > REMEMBERED:
                    seen.clear()
                first, last, name = first[long[new]], last[long[new]], name[new]
                for kind, ways in ((3, own), (2, others)):
                    key = keys(rolling, first, last, threshold, ways, places)
                    line, way = np.nonzero(key)
                    kinds = pa.array(np.full(len(line), kind, np.int8))
                    yield pa.RecordBatch.from_arrays([pa.array(key[line, way]), pa.array(name[line]), kinds], ["key", "u1", "kind"])

    return map_arrow(documents, run, "key long, u1 long, kind byte")


def line_texts(documents: DataFrame) -> DataFrame:
    """u1, u2 and bytes of every line with a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in slices(pick(batch.column(2))):
                starts, ends, _, _ = trimmed(data, offsets)
                name, raw = line_names(data, starts, ends), data.tobytes()
                line = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(name[:, 0]), pa.array(name[:, 1]), pa.array(line, pa.binary())], ["u1", "u2", "line"])

    return map_arrow(documents, run, "u1 long, u2 long, line binary")


def within(a: list, b: list, threshold: int) -> np.ndarray:
    """Whether each pair's edit distance is at most the threshold. Lines are bytes or arrays of characters.

    One machine word per pair holds the vertical differences of the 2 threshold + 1 cells around the diagonal; bit k of
    column j stands for row j + k - threshold. The band moves down by one row a column, so the words shift right. The
    cell on the lower edge is followed along the diagonal, then up the last column to the corner.
    """
    n, width = len(a), 2 * threshold + 1
    la, lb = np.array([len(x) for x in a], np.int64), np.array([len(x) for x in b], np.int64)
    result = np.abs(la - lb) <= threshold
    if not n:
        return result
    # rows outside of a are padding that equals nothing
    rows = np.full((n, int(max(la.max(), lb.max())) + 2 * width + 1), -1, np.int64)
    columns = np.full((n, int(lb.max())), -2, np.int64)
    for k, (x, y) in enumerate(zip(a, b)):
        rows[k, threshold : threshold + len(x)] = np.frombuffer(x, np.uint8) if isinstance(x, bytes) else x
        columns[k, : len(y)] = np.frombuffer(y, np.uint8) if isinstance(y, bytes) else y
    one, all_bits = np.uint64(1), np.uint64((1 << width) - 1)
    plus, minus = np.full(n, np.uint64(((1 << threshold) - 1) << (threshold + 1))), np.zeros(n, np.uint64)
    low = np.full(n, threshold, np.int64)  # value on the band's lowest row, column 0
    final = np.zeros(n, np.int64)
    top = np.uint64(width - 1)
    for j in range(int(lb.max())):
        # bit k: row j + 1 + k - threshold against column j + 1
        equal = np.zeros(n, np.uint64)
        for k in range(width):
            equal |= (rows[:, j + k] == columns[:, j]).astype(np.uint64) << np.uint64(k)
        vp, vn = plus >> one, minus >> one
        # the row that enters the band has no known difference above it: at most one more
        vp |= one << top
        d0 = ((((equal & vp) + vp) ^ vp) | equal | vn) & all_bits
        hp = (vn | ~(d0 | vp)) & all_bits
        hn = d0 & vp
        low += 1 - ((d0 >> top) & one).astype(np.int64)  # along the diagonal
        x = (hp << one) & all_bits
        plus = ((hn << one) | ~(d0 | x)) & all_bits
        minus = d0 & x
        last = lb == j + 1
        if last.any():
            value = low[last].copy()
            for k in range(width - 1, 0, -1):  # from the lowest row up to the corner, row la
                row = j + 1 + k - threshold
                above = row > la[last]
                step = ((plus[last] >> np.uint64(k)) & one).astype(np.int64) - ((minus[last] >> np.uint64(k)) & one).astype(np.int64)
                value -= np.where(above, step, 0)
            final[last] = value
    final[lb == 0] = la[lb == 0]
    return result & (final <= threshold)


class Lines:
    """Lines by number, as characters one after the other, with their keys."""

    def __init__(self, raw: pa.Array, threshold: int):
        offsets = np.append(0, np.cumsum(pc.binary_length(raw).to_numpy(zero_copy_only=False))).astype(np.int64)
        every = np.frombuffer(b"".join(raw.to_pylist()), np.uint8)
        self.threshold, found, first = threshold, [], 0
        while first < len(raw) or not found:  # hashes and counts take many bytes a character, so lines are worked on in slices
            last = min(max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1), len(raw))
            found.append(self._slice(every[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]))
            first = last
        self.letters, self.length, self.index, self.probe, self.classes = map(np.concatenate, zip(*found, strict=True))
        self.ends = np.cumsum(self.length)
        self.starts = self.ends - self.length

    def _slice(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        """Characters, lengths, keys and letter counts of some lines."""
        places = character_places(data)
        letters = characters(data, places)
        edges = offsets if places is None else np.searchsorted(places, offsets)
        starts, ends = edges[:-1], edges[1:]
        rolling = Rolling(data, 11)
        index, probe = (keys(rolling, starts, ends, self.threshold, ways(self.threshold), places) for ways in (own_segments, alignments))
        owner = np.repeat(np.arange(len(starts)), ends - starts)
        kind = (mix(letters.astype(np.uint64)) % np.uint64(CLASSES)).astype(np.int64)
        classes = np.bincount(owner * CLASSES + kind, minlength=len(starts) * CLASSES).reshape(-1, CLASSES).astype(np.int32)
        return letters, ends - starts, index, probe, classes

    def of(self, line: int) -> np.ndarray:
        return self.letters[self.starts[line] : self.ends[line]]

    def first_shared(self, a: np.ndarray, b: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Whether `key` belongs to the first segment of line a that line b holds where an alignment allows it."""
        earlier = np.zeros(len(a), bool)
        mine = np.zeros(len(a), bool)
        for i in range(self.threshold + 1):
            ways = [c for c, (segment_no, _, _) in enumerate(alignments(self.threshold)) if segment_no == i]
            own = self.index[a, i]
            mine |= (own == key) & ~earlier
            earlier |= ((self.probe[b][:, ways] == own[:, None]) & (own != 0)[:, None]).any(1)
        return mine

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the lines of each pair (b's as long or longer) are within the threshold."""
        result = np.zeros(len(a), bool)
        left = np.flatnonzero(np.abs(self.classes[a] - self.classes[b]).sum(1) <= 2 * self.threshold)
        for length in np.unique(self.length[a[left]]):
            same = left[self.length[a[left]] == length]
            step = max(1, COMPARED // int(length))
            for at in range(0, len(same), step):
                part = same[at : at + step]
                x, y = a[part], b[part]
                column = np.arange(length)
                one, two = self.letters[self.starts[x][:, None] + column], self.letters[self.starts[y][:, None] + column]
                head = np.minimum.accumulate(one == two, 1).sum(1)
                tail = np.minimum.accumulate((one == self.letters[(self.ends[y] - length)[:, None] + column])[:, ::-1], 1).sum(1)
                # what lies between the longest common head and tail: nothing, or few replaced characters, or the band decides
                gap = self.length[y] - length
                fine = head + tail >= length
                fine |= (gap == 0) & ((one != two).sum(1) <= self.threshold)
                rest = np.flatnonzero(~fine)
                if len(rest):
                    cut = [(self.of(x[k])[head[k] : length - tail[k]], self.of(y[k])[head[k] : self.length[y[k]] - tail[k]]) for k in rest]
                    fine[rest] = within([c[0] for c in cut], [c[1] for c in cut], self.threshold)
                result[part] = fine
        return result


def pairs_by_key(key: np.ndarray, indexed: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (indexed, probing) of rows with equal keys, a bounded number at a time."""
    index, probe = np.flatnonzero(indexed), np.flatnonzero(~indexed)
    index, probe = index[np.argsort(key[index], kind="stable")], probe[np.argsort(key[probe], kind="stable")]
    low, high = np.searchsorted(key[probe], key[index]), np.searchsorted(key[probe], key[index], "right")
    many = high - low
    bounds = np.cumsum(many)
    first = 0
    while first < len(index):
        last = max(first + 1, int(np.searchsorted(bounds, (bounds[first - 1] if first else 0) + COMPARED_PAIRS, "right")))
        n = many[first:last]
        own = np.repeat(np.arange(first, last), n)
        yield index[own], probe[low[own] + np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)]
        first = last


def linked_lines(documents: DataFrame, firsts: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """u1, u2, links, later of every line with a line near it: how many, and whether one of them first occurs earlier.
    `documents` has doc_id, text_hash, text."""
    every = segment_keys(documents, threshold)
    shared = every.groupBy("key").agg(F.min("u1").alias("low"), F.max("u1").alias("high"), F.bit_or("kind").alias("kinds"))
    shared = written(shared.where("low != high AND kinds = 3").select("key"), "shared-keys")
    roles = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(2)))
    members = every.join(small_side(shared), "key").distinct().select("key", "u1", F.explode(roles).alias("kind"))
    members = written(members.distinct(), "key-lines")
    ids = small_side(written(members.select("u1").distinct(), "line-ids"))
    where = small_side(written(firsts.join(ids, "u1", "left_semi").select(F.col("first.doc_id").alias("_doc")).distinct(), "line-documents"))
    texts = documents.join(where, F.col("doc_id").eqNullSafe(F.col("_doc")), "left_semi")
    texts = line_texts(texts).join(ids, "u1", "left_semi").dropDuplicates(["u1", "u2"])
    texts = written(texts.join(firsts, ["u1", "u2"]), "line-texts")

    # both sides of a large key are cut to blocks; its pairs of blocks are groups of their own, small keys share groups
    counts = members.groupBy("key").agg(F.count_if(F.col("kind") == 1).alias("indexed"), F.count_if(F.col("kind") == 2).alias("probing"))
    counts = counts.select("key", *[F.ceil(F.col(c) / KEY_LINES).cast("int").alias(c) for c in ("indexed", "probing")])
    groups = max(1, members.count() // TASK_LINES)
    dealt = members.join(counts, "key").withColumn("own", F.xxhash64("u1"))
    is_index = F.col("kind") == 1
    own = F.pmod("own", F.when(is_index, F.col("indexed")).otherwise(F.col("probing"))).cast("int")
    other = F.sequence(F.lit(0), F.when(is_index, F.col("probing")).otherwise(F.col("indexed")) - 1)
    dealt = dealt.withColumn("own", own).withColumn("other", F.explode(other))
    dealt = dealt.select(
        "key", "kind", "u1", (F.col("indexed") * F.col("probing") > 1).alias("large"),
        F.when(is_index, F.col("own")).otherwise(F.col("other")).alias("g"), F.when(is_index, F.col("other")).otherwise(F.col("own")).alias("h"),
    )
    dealt = dealt.withColumn("part", F.when(F.col("large"), F.col("key")).otherwise(F.pmod(F.xxhash64("key"), F.lit(groups))))
    dealt = dealt.join(texts, "u1").select("part", "g", "h", "key", "kind", "u1", "u2", "line", "first.*")

    def compare(table: pa.Table) -> pa.Table:
        key, kind, u1, u2 = (table[c].to_numpy() for c in ("key", "kind", "u1", "u2"))
        doc = table["doc_id"]
        unnamed = pc.is_null(doc).to_numpy()
        place = [pc.fill_null(doc, 0).to_numpy(), *(table[c].to_numpy() for c in ("text_hash", "line_no"))]
        when = np.empty(len(key), np.int64)
        when[np.lexsort((place[2], place[1], place[0], ~unnamed))] = np.arange(len(key))
        held = Lines(pick(table["line"]), threshold)
        links, later = np.zeros(len(key), np.int64), np.zeros(len(key), bool)
        for a, b in pairs_by_key(key, kind == 1):
            x, y = held.length[a], held.length[b]
            once = (x < y) | (x == y) & ((u1[a] < u1[b]) | (u1[a] == u1[b]) & (u2[a] < u2[b]))
            a, b = a[once], b[once]
            first = held.first_shared(a, b, key[a])
            a, b = a[first], b[first]
            near = held.near(a, b)
            a, b = a[near], b[near]
            links += np.bincount(np.concatenate([a, b]), minlength=len(key))
            later[np.where(when[a] > when[b], a, b)] = True
        some = np.flatnonzero(links)
        return pa.table({"u1": u1[some], "u2": u2[some], "links": links[some], "later": later[some]})

    ship(documents.sparkSession)
    found = dealt.groupBy("part", "g", "h").applyInArrow(compare, "u1 long, u2 long, links long, later boolean")
    return written(found.groupBy("u1", "u2").agg(F.sum("links").alias("links"), F.max("later").alias("later")), "linked-lines")


def remaining_lines(documents: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """row (all columns as one struct), text (the remaining lines), n_lines, n_removed and n_links; see dedup_lines."""
    keyed = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    firsts = occurrences(keyed).groupBy("u1", "u2").agg(F.min(F.struct("doc_id", "text_hash", "line_no")).alias("first"))
    firsts = written(firsts, "first-lines")
    linked = linked_lines(keyed, firsts, threshold)
    lines_of = firsts.join(small_side(linked), ["u1", "u2"], "left").groupBy(
        F.col("first.doc_id").alias("_doc"), F.col("first.text_hash").alias("_hash")
    ).agg(
        F.collect_list(F.when(~F.coalesce("later", F.lit(False)), F.col("first.line_no"))).alias("kept"),
        F.sum(F.coalesce("links", F.lit(0))).alias("links"),
    )
    # the documents' own columns travel in one struct, so their names meet no others
    whole = documents.select(F.struct("*").alias("row"))
    same = F.col("row")["doc_id"].cast("long").eqNullSafe(F.col("_doc")) & (F.xxhash64(F.col("row")["text"]) == F.col("_hash"))
    joined = whole.join(lines_of.hint("shuffle_hash"), same, "left")
    joined = joined.select("row", F.col("row")["text"].alias("text"), "kept", F.coalesce("links", F.lit(0)).alias("n_links"))

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, gone = [], [], []
            for text, kept in zip(pick(batch.column(1)).to_pylist(), pick(batch.column(2)).to_pylist()):
                if text is None:
                    texts.append(None), counts.append(0), gone.append(0)
                    continue
                have, all_lines = set(kept or ()), text.split("\n")
                left = [x for i, x in enumerate(all_lines) if i in have or not x.strip(_STRIP)]
                texts.append("\n".join(left)), counts.append(len(all_lines)), gone.append(len(all_lines) - len(left))
            columns = [batch.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), batch.column(3)]
            yield pa.RecordBatch.from_arrays(columns, ["row", "text", "n_lines", "n_removed", "n_links"])

    schema = T.StructType(whole.schema.fields).add("text", "string").add("n_lines", "long").add("n_removed", "long").add("n_links", "long")
    return map_arrow(joined, rebuild, schema)


def _columns(documents: DataFrame, text: str = "text") -> list:
    return [F.col(text).alias("text") if c == "text" else F.col("row")[c].alias(c) for c in documents.columns]


def dedup_lines(documents: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """All columns, with the remaining lines as `text` and, added, n_lines, n_removed and n_links.

    n_links counts the links of the near-line graph at lines that first occur in the document. A null text stays null,
    lines without a word stay, a document may be left without any other line. Rows equal in doc_id and text are one
    document: none loses a line to the other. Rows with a null id come first. Of lines that first occur at one place
    (equal texts of one id) none is later. Columns of the documents named like the added ones are replaced; other names
    meet nothing. An empty table gives no rows.
    """
    done = remaining_lines(documents, threshold)
    own = [c for c, n in zip(_columns(documents), documents.columns) if n not in ("n_lines", "n_removed", "n_links")]
    return done.select(*own, "n_lines", "n_removed", "n_links")


def without_repeated_lines(documents: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The documents' own columns, texts without repeated lines and n_chars in step; documents that had a word and are
    left without one are dropped. No column but text and n_chars changes, whatever its name."""
    done = remaining_lines(documents, threshold)
    word = r"[^\x20\x09-\x0D]"
    had = F.coalesce(F.col("row")["text"].rlike(word), F.lit(False))
    done = done.where(~had | F.col("text").rlike(word))
    columns = _columns(documents)
    if "n_chars" in documents.columns:
        size = F.length("text").cast(documents.schema["n_chars"].dataType)
        columns[documents.columns.index("n_chars")] = F.when(F.col("n_removed") > 0, size).otherwise(F.col("row")["n_chars"]).alias("n_chars")
    return done.select(*columns)
