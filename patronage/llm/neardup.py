"""Near-duplicate documents by ProbMinHash, banding and exact verification.

A document's shingles are five lower-case words between ASCII white space; all words where there are fewer. A shingle
that a text holds c times weighs 1 + ln(c). It sends arrivals of a Poisson process with its weight as rate to random
registers; a register keeps the shingle that came first. Two documents agree in a register with the probability Jaccard
similarity of their weighted shingles: the sum over common shingles i of 1 / sum over j of max(x_j / x_i, y_j / y_i). Without
repeated shingles that is the sets' Jaccard similarity. A document's process ends when no later arrival can win: about
`registers` x ln(`registers`) arrivals instead of shingles x registers.

Equal word sequences are one text. Texts that agree in all registers of a band are candidates; a link is a pair whose
weighted shingles have probability Jaccard similarity of `least` or more, worked out exactly, and a class is a connected component of links. Pairs in a band's
bucket are not written out: one pivot is compared with the bucket's other texts first, then four more with the texts that
are still in other classes. Where a bucket still holds several classes, its texts are compared across classes in blocks
inside tasks, by matrices of their shingles, and only links leave a task. So every link between candidates counts, and a
large group of copies costs a star, not a square.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm.common import map_arrow, ship, small_side, written
from patronage.llm.textbytes import Rolling, mix, per_row, pick, slices, words

SHINGLE = 5
LEAST = 0.8
BANDS, ROWS = 32, 5
REGISTERS = BANDS * ROWS
#: Candidates whose registers agree less than this are not verified. Registers agree with the similarity itself, so at 0.8
#: this is six standard deviations below: a pair is lost with probability 2e-9, less than the 3e-6 of missing all bands.
LEAST_ESTIMATE = 0.6
#: Pivots of a mixed bucket, on average; all members of buckets with no more.
PIVOTS = 4
#: Shingles of a group of a mixed bucket, and the tile of the matrices in which two groups are compared.
GROUP_SHINGLES, COMPARED_ROWS, COMPARED_COLUMNS = 1 << 16, 256, 512
_STEP = 0x9E3779B97F4A7C15
_ODD = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)
SIGNED = "doc_id long, text_key long, u1 long, u2 long, bands array<long>, sketch binary"
SHINGLED = "u1 long, u2 long, shingles array<long>, weights array<double>"


def fingerprints(names: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Two 64-bit hashes of each row's word sequence, side by side."""
    first = np.searchsorted(rows, np.arange(n))
    last = np.searchsorted(rows, np.arange(n), "right")
    place = (np.arange(len(names)) - first[rows]).astype(np.int64)
    found = []
    for odd in _ODD:
        powers = np.cumprod(np.full(int(place.max(initial=0)) + 1, odd, np.uint64))
        total = np.zeros(len(names) + 1, np.uint64)
        np.cumsum(mix(names ^ np.uint64(odd)) * powers[place], out=total[1:])
        found.append(mix(total[last] - total[first] + (last - first).astype(np.uint64) * np.full(n, odd, np.uint64)))
    return np.stack(found, 1)


def shingles(names: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and count of each row's distinct shingles, by row."""
    count = per_row(rows, n)
    keys, owners = [], []
    for width in range(1, SHINGLE + 1):
        if len(names) < width:
            continue
        starts = np.flatnonzero(rows[: len(rows) - width + 1] == rows[width - 1 :])
        if width < SHINGLE:
            starts = starts[count[rows[starts]] == width]
        joint = np.full(len(starts), width, np.uint64)
        for k in range(width):
            joint = mix(joint + names[starts + k])
        keys.append(joint)
        owners.append(rows[starts])
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    key, owner = np.concatenate(keys), np.concatenate(owners)
    order = np.lexsort((key, owner))
    key, owner = key[order], owner[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return owner[at], key[at], np.diff(np.append(at, len(key)))


def weights_of(count: np.ndarray) -> np.ndarray:
    return 1 + np.log(count)


def probability_jaccard(a: np.ndarray, x: np.ndarray | None, b: np.ndarray, y: np.ndarray | None) -> float:
    """Of two sorted lists of distinct shingles with weights (None: all 1)."""
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(i):
        return 0.0
    if x is None and y is None:
        return len(i) / (len(a) + len(b) - len(i))
    x, y = np.ones(len(a)) if x is None else x, np.ones(len(b)) if y is None else y
    p, q = x[i], y[j]
    order = np.argsort(q / p, kind="stable")  # where x_j / y_j is larger, x_j / x_i is the larger of the two
    p, q = p[order], q[order]
    by_x, by_y = np.cumsum(p), np.cumsum(q)
    both = by_x / p + (by_y[-1] - by_y) / q
    return float((1 / (both + (x.sum() - by_x[-1]) / p + (y.sum() - by_y[-1]) / q)).sum())


def registers(owner: np.ndarray, key: np.ndarray, weight: np.ndarray, n: int, m: int = REGISTERS) -> np.ndarray:
    """The shingle that arrives first in each of a row's m registers; 0 in rows without shingles."""
    first = np.full(n * m, np.inf)
    winner = np.zeros(n * m, np.uint64)
    limit = np.full(n, np.inf)
    owner, key, clock = owner.copy(), key.copy(), np.zeros(len(key))
    rate = 1 / weight
    turn = 0
    while len(key):
        turn += 1
        bits = mix(key + np.uint64(turn * _STEP & (2**64 - 1)))
        clock = clock - np.log(((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) * rate
        live = clock < limit[owner]
        if not live.all():
            owner, key, clock, rate, bits = owner[live], key[live], clock[live], rate[live], bits[live]
        slot = owner * m + (mix(bits) % np.uint64(m)).astype(np.int64)
        np.minimum.at(first, slot, clock)
        won = clock == first[slot]
        winner[slot[won]] = key[won]
        touched = np.unique(owner) if len(owner) < n else slice(None)
        limit[touched] = first.reshape(n, m)[touched].max(1)
        live = clock < limit[owner]
        owner, key, clock, rate = owner[live], key[live], clock[live], rate[live]
    return winner.reshape(n, m)


def _prepared(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, word hashes, their rows), texts lower-cased; null counts as empty."""
    for first, last, data, offsets in slices(pc.utf8_lower(pc.fill_null(column, ""))):
        starts, ends, rows = words(data, offsets)
        yield first, last, Rolling(data).spans(starts, ends), rows


def signatures(documents: DataFrame) -> DataFrame:
    """doc_id, text_key, fingerprint (null for texts without words), band hashes and register sketch of every text."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_id, text_key = pick(batch.column(0)), pick(batch.column(2))
            for first, last, names, rows in _prepared(pick(batch.column(1))):
                n = last - first
                owner, key, count = shingles(names, rows, n)
                won = registers(owner, key, weights_of(count), n)
                band = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (n, BANDS)).copy()
                for r in range(ROWS):
                    band = mix(band + won.reshape(n, BANDS, ROWS)[:, :, r])
                print_ = fingerprints(names, rows, n).view(np.int64)
                empty = per_row(rows, n) == 0
                sketch = (won & np.uint64(0xFFFF)).astype(np.uint16)
                offsets = np.arange(n + 1, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_id.slice(first, n), text_key.slice(first, n), pa.array(print_[:, 0], mask=empty), pa.array(print_[:, 1], mask=empty),
                        pa.ListArray.from_arrays(offsets * BANDS, pa.array(band.view(np.int64).ravel())),
                        pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets * (2 * REGISTERS)), pa.py_buffer(sketch.tobytes())]),
                    ],
                    ["doc_id", "text_key", "u1", "u2", "bands", "sketch"],
                )

    return map_arrow(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key")), sign, SIGNED)


def shingle_sets(documents: DataFrame) -> DataFrame:
    """Fingerprint, sorted distinct shingle hashes and their weights (null where all are 1) of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, names, rows in _prepared(pick(batch.column(0))):
                n = last - first
                owner, key, count = shingles(names, rows, n)
                print_ = fingerprints(names, rows, n).view(np.int64)
                offsets = np.append(0, np.cumsum(per_row(owner, n))).astype(np.int32)
                sets = pa.ListArray.from_arrays(offsets, pa.array(key.view(np.int64)))
                repeated = np.zeros(n, bool)
                repeated[owner[count > 1]] = True
                some = np.append(0, np.cumsum(per_row(owner, n) * repeated)).astype(np.int32)
                weights = pa.ListArray.from_arrays(some, pa.array(weights_of(count)[repeated[owner]]), mask=pa.array(~repeated))
                yield pa.RecordBatch.from_arrays([pa.array(print_[:, 0]), pa.array(print_[:, 1]), sets, weights], ["u1", "u2", "shingles", "weights"])

    return map_arrow(documents.select("text"), run, SHINGLED)


def likely(pairs: DataFrame, sketches: DataFrame, least: float = LEAST_ESTIMATE) -> DataFrame:
    """Pairs (a, b) whose registers agree in at least this share, and whether neither repeats a shingle (`plain`)."""

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(pick(batch.column(c)).to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in (2, 3))
            mask = (a == b).mean(1) >= least
            kept = [batch.column(c).filter(pa.array(mask)) for c in (0, 1, 4)]
            yield pa.RecordBatch.from_arrays(kept, ["a", "b", "plain"])

    one = sketches.select(F.col("node").alias("a"), F.col("sketch").alias("sa"), F.col("plain").alias("plain_a"))
    two = sketches.select(F.col("node").alias("b"), F.col("sketch").alias("sb"), F.col("plain").alias("plain_b"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "sa", "sb", (F.col("plain_a") & F.col("plain_b")).alias("plain"))
    return map_arrow(both, agree, "a long, b long, plain boolean")


def verified(pairs: DataFrame, sets: DataFrame, least: float = LEAST) -> DataFrame:
    """Pairs (a, b, plain) whose weighted shingles have this similarity or more. Pairs without repeated shingles (plain) are
    compared as sets by SQL expressions, the others in tasks."""
    flagged = written(pairs, "flagged-pairs")
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"), F.col("weights").alias("wa"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"), F.col("weights").alias("wb"))
    shared = F.size(F.array_intersect("sa", "sb"))
    plain = flagged.where("plain").join(one.drop("wa"), "a").join(two.drop("wb"), "b")
    sets_near = plain.where(shared >= least * (F.size("sa") + F.size("sb") - shared) - 1e-9).select("a", "b")
    heavy = flagged.where("NOT plain").join(one, "a").join(two, "b").select("a", "b", "sa", "wa", "sb", "wb")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [
                probability_jaccard(*(None if c[k].as_py() is None else c[k].values.to_numpy() for c in batch.columns[2:])) >= least - 1e-9
                for k in range(batch.num_rows)
            ]
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(near, pa.bool_())) for c in batch.columns[:2]], ["a", "b"])

    return sets_near.union(map_arrow(heavy, compare, "a long, b long"))


def mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members, with labels, of buckets whose texts are not all in one class yet."""
    labelled = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    bands = labelled.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low != high")
    return labelled.join(bands.select("band"), "band")


def overlaps(
    sets: list[np.ndarray], label: np.ndarray, side: np.ndarray, least: float, weights: list[np.ndarray | None] | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Places (a, b) of linked sets with different labels. Sets of side 0 are compared with those of side 1; where there
    is no side 1, with each other. The most frequent label's sets are not compared among themselves.

    A pair's similarity is at most the share of either text's weight that lies on common shingles; where shingles repeat,
    matrices give these shares, and pairs that both allow are worked out one by one."""
    if weights is not None and all(w is None for w in weights):
        weights = None
    known, times = np.unique(label, return_counts=True)
    size = np.array([len(x) for x in sets])
    token = np.concatenate(sets)
    holder = np.repeat(np.arange(len(sets)), size)
    part_of = None if weights is None else np.concatenate([np.full(len(x), 1 / max(len(x), 1)) if w is None else w / w.sum() for x, w in zip(sets, weights, strict=True)])
    names, column, held = np.unique(token, return_inverse=True, return_counts=True)
    often = held > 1  # a shingle that one set holds is in no overlap
    place = np.cumsum(often) - 1
    keep = often[column]
    holder, column, width = holder[keep], place[column[keep]], int(often.sum())
    order = np.argsort(column, kind="stable")
    holder, column = holder[order], column[order]
    if part_of is not None:
        part_of = part_of[keep][order]
    one, two = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if side.any() else (np.arange(len(sets)),) * 2
    most = label == known[times.argmax()]
    found = []
    for rows, cols in ((one[~most[one]], two), (one[most[one]], two[~most[two]])) if side.any() else ((one[~most[one]], two),):
        for at in range(0, len(rows), COMPARED_ROWS):
            part = rows[at : at + COMPARED_ROWS]
            row_of, col_of = np.full(len(sets), -1), np.full(len(sets), -1)
            row_of[part], col_of[cols] = np.arange(len(part)), np.arange(len(cols))
            shared = np.zeros((len(part), len(cols)), np.float32)
            shares = [np.zeros_like(shared) for _ in range(2 * (part_of is not None))]
            for low in range(0, width, COMPARED_COLUMNS):
                cut = slice(*np.searchsorted(column, (low, low + COMPARED_COLUMNS)))
                h, c = holder[cut], column[cut] - low
                left = np.zeros((len(part), COMPARED_COLUMNS), np.float32)
                right = np.zeros((len(cols), COMPARED_COLUMNS), np.float32)
                left[row_of[h][row_of[h] >= 0], c[row_of[h] >= 0]] = 1
                right[col_of[h][col_of[h] >= 0], c[col_of[h] >= 0]] = 1
                shared += left @ right.T
                if part_of is not None:
                    heavy_left, heavy_right, own = np.zeros_like(left), np.zeros_like(right), part_of[cut]
                    heavy_left[row_of[h][row_of[h] >= 0], c[row_of[h] >= 0]] = own[row_of[h] >= 0]
                    heavy_right[col_of[h][col_of[h] >= 0], c[col_of[h] >= 0]] = own[col_of[h] >= 0]
                    shares[0] += heavy_left @ right.T
                    shares[1] += left @ heavy_right.T
            if part_of is None:
                near = shared >= least * (size[part][:, None] + size[cols][None, :] - shared) - 1e-9
            else:
                near = np.minimum(*shares) >= least - 1e-3
            near &= label[part][:, None] != label[cols][None, :]
            a, b = np.nonzero(near)
            a, b = part[a], cols[b]
            if weights is not None:
                exact = [probability_jaccard(sets[x], weights[x], sets[y], weights[y]) >= least - 1e-9 for x, y in zip(a, b, strict=True)]
                a, b = a[np.array(exact, bool)], b[np.array(exact, bool)]
            found.append((a, b))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def compared(members: DataFrame, sets: DataFrame, least: float = LEAST) -> DataFrame:
    """All links between members of a bucket that have different labels.

    A bucket's members are dealt to groups of about GROUP_SHINGLES shingles, and a task compares two groups at a time by
    their shingles; only links leave it.
    """
    members = written(members.join(sets, "node").select("band", "node", "label", "shingles", "weights"), "mixed-shingles")
    groups = members.groupBy("band").agg(F.ceil(F.sum(F.size("shingles")) / GROUP_SHINGLES).cast("int").alias("groups"))
    dealt = members.join(groups, "band").withColumn("own", F.pmod(F.xxhash64("node"), F.col("groups")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
    dealt = dealt.select("band", F.least("own", "other").alias("g"), F.greatest("own", "other").alias("h"), "own", "node", "label", "shingles", "weights")

    def link(table: pa.Table) -> pa.Table:
        node, label = (table[c].to_numpy() for c in ("node", "label"))
        side = (table["own"].to_numpy() != table["g"].to_numpy()).astype(np.int8)
        a = b = np.zeros(0, np.int64)
        g, h = table["g"][0].as_py(), table["h"][0].as_py()
        if (g == h or 0 < side.sum() < len(side)) and (label != label[0]).any():
            lists = table["shingles"].combine_chunks()
            values, cuts = lists.values.to_numpy(), lists.offsets.to_numpy()
            weights = [None if w is None else np.array(w) for w in table["weights"].to_pylist()]
            a, b = overlaps([values[x:y] for x, y in zip(cuts[:-1], cuts[1:], strict=True)], label, side, least, weights)
        return pa.table({"a": node[a].astype(np.int64), "b": node[b].astype(np.int64)})

    ship(members.sparkSession)
    found = dealt.groupBy("band", "g", "h").applyInArrow(link, "a long, b long")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, label: the least node each linked node is connected to. Labels spread along links and jump to their own
    label's label, so rounds grow with the logarithm of a component's diameter; each round is a written table."""
    most = 2 * links.count()  # of a written table, so no links are worked out for it
    both = written(links.select("a", "b").union(links.select("b", "a")).distinct(), "links", most)
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("label")), "labels", most)
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("low"))
        to = labels.select(F.col("node").alias("low"), F.col("label").alias("lower"))
        step = step.join(to, "low").select("node", F.least("low", "lower").alias("label"), (F.least("low", "lower") < F.col("label")).alias("moved"))
        step = written(step, "labels", most)
        labels = step.select("node", "label")
        if step.where("moved").isEmpty():
            return labels


def classes(documents: DataFrame, least: float = LEAST) -> DataFrame:
    """doc_id and class_id, the least doc_id of the document's class, for every row.

    A link is probability Jaccard similarity `least` of the weighted shingles (see above): texts of the same shingles, one of
    them with a passage many times over, can lie below it. Null texts and texts without words are classes of their own.
    Texts are worked on whole, case and white space aside; their shingles must fit into a task's memory. Only doc_id and
    text are read. Repeated rows share a class. Rows with a null id are
    classed by their text; a class of such rows only has the id null. An empty table gives no rows.
    """
    return text_classes(documents, least).select("doc_id", "class_id")


def text_classes(documents: DataFrame, least: float) -> DataFrame:
    """As classes, with text_key (xxhash64 of the text, which tells texts of one id apart) and the class itself, (g1, g2,
    alone), g1 null for texts without words: two classes have one class_id where their texts share the id."""
    signed = written(signatures(documents), "signatures")
    single = signed.where(F.col("u1").isNotNull()).dropDuplicates(["u1", "u2"])
    exploded = single.select("u1", "u2", F.explode("bands").alias("band"))
    shared = exploded.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = written(exploded.join(shared, "band"), "bucket-members")
    nodes = members.select("u1", "u2").distinct().withColumn("node", F.monotonically_increasing_id())
    nodes = written(nodes, "nodes")
    members = written(members.join(nodes, ["u1", "u2"]).select("band", "n", "node"), "bucket-nodes")
    own = written(single.join(nodes, ["u1", "u2"]).select("node", "doc_id", "sketch"), "node-sketches")
    ids = small_side(written(own.select(F.col("doc_id").alias("_doc")).distinct(), "node-documents"))
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, F.col("doc_id").eqNullSafe(F.col("_doc")), "left_semi")
    sets = shingle_sets(texts).dropDuplicates(["u1", "u2"]).join(nodes, ["u1", "u2"]).select("node", "shingles", "weights")
    sets = written(sets, "node-shingles")
    own = written(own.join(sets.select("node", F.col("weights").isNull().alias("plain")), "node"), "node-registers")

    pivots = members.groupBy("band").agg(F.min("node").alias("pivot"))
    star = members.join(pivots, "band").where("node != pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    star = written(star, "pairs")
    links = written(verified(likely(star, own), sets, least), "links")
    labels = components(links)
    # by the node alone: texts that share several buckets meet the same pivots there, and a pair is one however many they are
    spread = F.pmod(F.xxhash64("node"), F.lit(1 << 30)) / float(1 << 30)
    left = written(mixed(members, labels).withColumn("spread", spread), "mixed-buckets")
    pivots = left.where(F.col("spread") < PIVOTS / F.col("n")).select("band", F.col("node").alias("pivot"), F.col("label").alias("pivot_label"))
    pairs = left.join(pivots, "band").where("label != pivot_label").select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))
    pairs = written(pairs.distinct().join(star, ["a", "b"], "left_anti"), "pairs")
    links = written(links.union(verified(likely(pairs, own), sets, least)), "links")
    labels = components(links)
    found = written(compared(mixed(members.where(F.col("n") > PIVOTS), labels), sets, least), "links")
    if not found.isEmpty():
        labels = components(links.union(found))

    class_of = labels.join(nodes, "node").select("u1", "u2", "label")
    classed = signed.select("doc_id", "text_key", "u1", "u2").join(class_of, ["u1", "u2"], "left")
    classed = classed.select("doc_id", "text_key", F.coalesce("label", "u1").alias("g1"), F.when(F.col("label").isNull(), F.col("u2")).alias("g2"), F.col("label").isNull().alias("alone"))
    classed = written(classed, "classed")
    lowest = classed.where(F.col("g1").isNotNull()).groupBy("g1", "g2", "alone").agg(F.min("doc_id").alias("class_id"))
    same = (F.col("g1") == F.col("h1")) & F.col("g2").eqNullSafe(F.col("h2")) & (F.col("alone") == F.col("single"))
    lowest = lowest.select(F.col("g1").alias("h1"), F.col("g2").alias("h2"), F.col("alone").alias("single"), "class_id")
    joined = classed.join(lowest, same, "left")
    class_id = F.when(F.col("g1").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id")
    return joined.select("doc_id", "text_key", "g1", "g2", "alone", class_id)


def one_of_each(documents: DataFrame, least: float = LEAST) -> DataFrame:
    """The documents with the least id of their class, each once; all columns, whatever their names, stay. Rows without an
    id all stay.

    Different texts may share an id: each is judged by its own class, and one text of a class stays.
    """
    found = written(text_classes(documents, least), "classes")
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    keyed = documents.select(F.struct("*").alias("row"), doc_id, F.xxhash64("text").alias("text_key"))
    own = [F.col("row")[c].alias(c) for c in documents.columns]
    name = lambda frame: frame.select("doc_id", "text_key")
    losers = small_side(written(name(found.where("doc_id != class_id")).distinct(), "losers"))
    kept = keyed.join(losers, ["doc_id", "text_key"], "left_anti")
    best = found.where("doc_id = class_id")
    repeated = written(best.groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    if repeated.isEmpty():
        return kept.select(*own)
    repeated = small_side(repeated)
    wordless = F.when(F.col("g1").isNull(), F.col("text_key"))
    first = best.join(repeated, "doc_id", "left_semi").groupBy("doc_id", "g1", "g2", "alone", wordless).agg(F.min("text_key").alias("text_key"))
    first = small_side(written(name(first), "repeated-first"))
    once = kept.join(first, ["doc_id", "text_key"], "left_semi").dropDuplicates(["doc_id", "text_key"])
    return kept.join(repeated, "doc_id", "left_anti").select(*own).unionByName(once.select(*own))
