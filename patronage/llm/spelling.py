"""Groups of spelling variants: words one edit apart, found by blocked Gram matrices of letter counts.

A word is a vector of letter counts. One inserted, deleted or replaced letter changes two words' counts by a squared
distance of at most 2 and their lengths by at most 1, and the same holds for counts of whole groups of letters. So words
are dealt to blocks by length and by the counts of a few letter groups, and only blocks whose counts can lie that near are
compared. Two blocks' squared distances are one matrix product in NumPy; pairs at most 2 apart are verified letter by
letter. A block is cut to chunks of bounded size, a task holds two chunks at a time, and per word only the number of its
near words and the best of them leave it.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.llm.common import map_arrow, written
from patronage.llm.textbytes import pick

#: Words have this many code points and occurrences at least.
LEAST_LENGTH, LEAST_COUNT = 6, 5
#: A form occurs this many times as often as the word it stands for, at least.
TIMES = 5
#: A run of letters whose checksum with its document's id this divides loses one code point.
TYPO_EVERY = 199
#: Letter groups of the block keys; all other letters are one more group.
LETTER_GROUPS = ("aeé", "iouy", "tnh", "srl")
#: Words and letters of a chunk, on average. A longer word is a chunk of its own.
CHUNK_WORDS, CHUNK_LETTERS = 2_048, 1 << 18
#: Words a task counts before it sends them on; pairs verified at a time.
COUNTED, VERIFIED_LETTERS = 200_000, 1 << 23
_RUN = re.compile(rf"[a-zÀ-ÿ]{{{LEAST_LENGTH},}}")


def word_counts(documents: DataFrame, typo_every: int | None = None) -> DataFrame:
    """word and n: maximal runs of letters A-Z, a-z and U+00C0 to U+00FF of whole texts, A-Z in lower case.

    With `typo_every`, a run loses one code point where the crc32 of `<doc_id>:<run>` is divisible by it, the one at that
    crc32 modulo the run's length; runs of rows without an id stay. Shorter words and rarer ones are left out. Rows equal
    in all columns count each; null and empty texts have no words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sent() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

        total: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), pick(batch.column(1)).to_pylist(), strict=True):
                own = Counter(_RUN.findall((text or "").encode().lower().decode()))
                if typo_every is None or doc_id is None:
                    total.update(own)
                else:
                    prefix = zlib.crc32(b"%d:" % doc_id)
                    for word, n in own.items():
                        h = zlib.crc32(word.encode(), prefix)
                        if h % typo_every == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < LEAST_LENGTH:
                                continue
                        total[word] += n
                if len(total) > COUNTED:
                    yield sent()
                    total.clear()
        if total:
            yield sent()

    counted = map_arrow(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _group_count(letters: str) -> Column:
    return F.length("word") - F.length(F.translate("word", letters, ""))


def chunks(words: DataFrame) -> DataFrame:
    """The words by block (length and counts of letter groups) in chunks, as a written table with a number for each chunk."""
    groups = [f"c{i}" for i in range(len(LETTER_GROUPS))]
    keyed = words.select("word", "n", F.length("word").alias("length"), *[_group_count(g).alias(c) for g, c in zip(LETTER_GROUPS, groups, strict=True)])
    per_chunk = F.least(F.lit(CHUNK_WORDS), F.greatest(F.lit(1), F.lit(CHUNK_LETTERS) / F.col("length")))
    sizes = keyed.groupBy("length", *groups).agg(F.ceil(F.count(F.lit(1)) / F.first(per_chunk)).alias("chunks"))
    dealt = keyed.join(sizes, ["length", *groups]).withColumn("chunk", F.pmod(F.xxhash64("word"), F.col("chunks")))
    packed = dealt.groupBy("length", *groups, "chunk").agg(F.collect_list("word").alias("words"), F.collect_list("n").alias("counts"))
    return written(packed.withColumn("id", F.monotonically_increasing_id()), "word-chunks")


def neighbours() -> list[tuple[int, ...]]:
    """Differences (length, letter groups) between two blocks that may hold words one edit apart, each pair of blocks
    once: the same length, where one group may lose a letter to another, and one letter more in some group. The group of
    all other letters follows from the rest."""
    same = []
    for change in product((-1, 0, 1), repeat=len(LETTER_GROUPS)):
        other = -sum(change)
        moved = [*change, other]
        if abs(other) <= 1 and moved.count(1) <= 1 and moved.count(-1) <= 1 and change >= (0,) * len(change):
            same.append((0, *change))
    one = [tuple(int(i == g) for i in range(len(LETTER_GROUPS))) for g in range(len(LETTER_GROUPS) + 1)]
    return same + [(1, *change) for change in one]


def chunk_pairs(held: DataFrame) -> DataFrame:
    """a, b: numbers of all pairs of chunks that are to be compared, each once."""
    names = ["length", *[f"c{i}" for i in range(len(LETTER_GROUPS))]]
    keys = held.select("id", *names)
    steps = F.array(*[F.struct(*[F.lit(x).alias(f"d{i}") for i, x in enumerate(step)]) for step in neighbours()])
    moved = keys.select(F.col("id").alias("a"), *names, F.explode(steps).alias("d"))
    moved = moved.select("a", *[(F.col(c) + F.col("d")[f"d{i}"]).alias(c) for i, c in enumerate(names)], (F.aggregate(F.array(*[F.abs(F.col("d")[f"d{i}"]) for i in range(len(names))]), F.lit(0), lambda x, y: x + y) == 0).alias("same"))
    met = moved.join(keys.withColumnRenamed("id", "b"), names)
    return met.where(~F.col("same") | (F.col("a") <= F.col("b"))).select("a", "b")


def letter_counts(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(word, letter) counts and the words' letters by row, 0 after the end. Words are Latin-1 bytes of one length."""
    letters = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)
    used = np.unique(letters)
    place = np.zeros(256, np.int64)
    place[used] = np.arange(len(used))
    flat = np.arange(len(words))[:, None] * len(used) + place[letters]
    counts = np.zeros((len(words), 256), np.float64 if letters.shape[1] > 1000 else np.float32)
    counts[:, used] = np.bincount(flat.ravel(), minlength=len(words) * len(used)).reshape(len(words), len(used))
    return counts, letters


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of letters are exactly one edit apart; b's are as long as a's or longer by one."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(1) == 1
    size = a.shape[1]
    head = np.minimum.accumulate(a == b[:, :size], 1).sum(1)
    tail = np.minimum.accumulate((a == b[:, 1:])[:, ::-1], 1).sum(1)
    return head + tail >= size


def near_pairs(a: list[bytes], b: list[bytes], same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places (in a, in b) of words one edit apart, from the Gram matrix of their letter counts; with `same`, a is b and
    each pair is given once."""
    one, left = letter_counts(a)
    two, right = (one, left) if same else letter_counts(b)
    used = np.flatnonzero(one.any(0) | two.any(0))
    one, two = one[:, used], two[:, used]
    squares = ((one * one).sum(1), (two * two).sum(1))
    unit = [np.ones((len(x), 1), x.dtype) for x in (one, two)]
    # the norms ride along as two more columns, so the product is the squared distance itself
    distance = np.hstack([-2 * one, squares[0][:, None], unit[0]]) @ np.hstack([two, unit[1], squares[1][:, None]]).T
    near = distance <= 2
    if same:
        near &= np.triu(np.ones(near.shape, bool), 1)
    i, j = np.nonzero(near)
    step = max(1, VERIFIED_LETTERS // max(1, right.shape[1]))
    fine = [one_edit(left[i[at : at + step]], right[j[at : at + step]]) for at in range(0, len(i), step)]
    fine = np.concatenate(fine) if fine else np.zeros(0, bool)
    return i[fine], j[fine]


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, best_n and best: of every word (of one row each) with a near word, how many it has, and the most
    frequent of them, ties to the smallest in code-point order."""
    held = chunks(words)
    pairs = written(chunk_pairs(held), "chunk-pairs")
    side = lambda n: held.select(F.col("id").alias(n), F.col("words").alias(f"{n}_words"), F.col("counts").alias(f"{n}_counts"))
    met = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "a_words", "a_counts", "b_words", "b_counts")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                a, b = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                one, two = (batch.column(c)[row].as_py() for c in (2, 4))
                n, m = (batch.column(c)[row].values.to_numpy() for c in (3, 5))
                i, j = near_pairs([w.encode("latin-1") for w in one], [w.encode("latin-1") for w in two], a == b)
                if not len(i):
                    continue
                place, other = np.concatenate([i, j + len(one)]), np.concatenate([j + len(one), i])
                names, n = one + two, np.concatenate([n, m])
                rank = np.empty(len(names), np.int64)
                rank[sorted(range(len(names)), key=names.__getitem__)] = np.arange(len(names))
                order = np.lexsort((rank[other], -n[other], place))
                place, other = place[order], other[order]
                first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
                of, best = place[first], other[first]
                columns = [pa.array([names[k] for k in of]), pa.array(np.diff(np.append(first, len(place)))), pa.array(n[best]), pa.array([names[k] for k in best])]
                yield pa.RecordBatch.from_arrays(columns, ["word", "n_near", "best_n", "best"])

    found = map_arrow(met, compare, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("down"), "best")).alias("best")
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return found.select("word", "n_near", (-F.col("best.down")).alias("best_n"), F.col("best.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root: where the forms (word, form) lead. Counts grow along them, so they end; each round goes twice as far."""
    far = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = far.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        step = far.join(onward, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved"))
        step = written(step, "roots")
        far = step.select("word", "root")
        if step.where("moved").isEmpty():
            return far


def variant_groups(words: DataFrame, times: int = TIMES) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of a table (word, n) with one row a word.

    A word's form is its most frequent near word (one edit apart; ties to the smallest in code-point order) if that occurs
    `times` as often as the word or more, else null with form_n. The root follows forms to the last one; a word without a
    form is its own. An empty table gives no rows. Words are made of letters up to U+00FF, of any length.
    """
    words = written(words.select("word", "n"), "words")
    near = words.join(near_words(words), "word", "left")
    formed = F.col("best_n") >= times * F.col("n")
    near = near.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n"))
    near = written(near, "near-words")
    ends = roots(near.where(F.col("form").isNotNull()))
    found = near.join(ends, "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(documents: DataFrame, typo_every: int | None = None) -> DataFrame:
    """The groups of the documents' words; see word_counts and variant_groups. Only doc_id and text are read."""
    return variant_groups(word_counts(documents, typo_every))
