"""Benchmark decontamination by spaced-seed hashing.

A mask keeps some of the positions of a short window of words and ignores the others, so that two windows that differ
only in ignored words hash alike. Windows of the benchmark items are hashed under every mask, those of the documents are
joined to them, and around each hit the item is laid over the document: the pair is an overlap if some `window` aligned
words differ in `substitutions` at most. The two masks together leave no such overlap without a hit, wherever two words
of thirteen were replaced. All of it is SQL expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.llm.common import small_side, written

MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 3, 6, 7, 8))
SPAN = max(map(max, MASKS)) + 1
WINDOW = 13
SUBSTITUTIONS = 2
#: Items of fewer words say too little to be looked for, unless `least_words` asks for them; items shorter than the masks
#: are looked for whole.
LEAST_WORDS = 5
_SPACE = " \t\n\x0b\f\r"


def word_array(text: Column) -> Column:
    """Lower-case words between ASCII white space."""
    return F.split(F.lower(F.btrim(F.coalesce(text, F.lit("")), F.lit(_SPACE))), r"[\x20\x09-\x0D]+", -1)


def seeds(hashes: Column, number: int, mask: tuple[int, ...]) -> Column:
    """The hash of every window under a mask, by first word."""
    last = F.size(hashes) - (max(mask) + 1)
    keys = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.lit(number), *[F.get(hashes, i + o) for o in mask]))
    return F.when(last >= 0, keys).otherwise(F.array().cast("array<bigint>"))


def allowed(window: Column) -> Column:
    """Substitutions that the masks are sure to bridge: two in thirteen words, one in ten to twelve, none in fewer."""
    return F.when(window >= WINDOW, SUBSTITUTIONS).when(window >= 10, 1).otherwise(0)


def find_overlaps(documents: DataFrame, benchmark: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, text_hash, item_id, item_words, first_word, equal_words: one row for each document and item with an
    overlap, at its best place.

    Items of fewer than `least_words` words are left out: two or three common words would take most documents with them.
    With 1, every item is looked for. Items of ten words or more may differ in one word, those of thirteen in two of any
    thirteen; shorter ones must be found as they are. Null and wordless texts and items have none. Rows equal in doc_id and text give one row, as do repeated items; null ids
    are found as well. Other columns are ignored. `text_hash` tells rows of one doc_id with different texts apart.
    """
    items = benchmark.where(F.col("text").isNotNull()).select("item_id", word_array(F.col("text")).alias("item"))
    items = written(items.where((F.size("item") >= least_words) & (F.get("item", F.lit(0)) != "")).distinct(), "benchmark-items")
    short = [r[0] for r in items.where(F.size("item") < SPAN).select(F.size("item")).distinct().collect()]  # at most SPAN - 1
    masks = [(i, m, None) for i, m in enumerate(MASKS)] + [(100 + n, tuple(range(n)), n) for n in sorted(short)]
    hashes = F.transform("item", lambda w: F.xxhash64(w))
    wanted = lambda n: F.size("item") >= SPAN if n is None else F.size("item") == n
    index = None
    for number, mask, n in masks:
        part = items.where(wanted(n)).select("item_id", F.posexplode_outer(seeds(hashes, number, mask)).alias("item_at", "key"))
        index = part if index is None else index.union(part)
    index = written(index.where("key IS NOT NULL"), "benchmark-seeds")

    hashed = documents.select("doc_id", F.transform(word_array(F.col("text")), lambda w: F.xxhash64(w)).alias("h"))
    # outer: a plain generator adds a filter on its array, which is pushed down and works out the hashes for each window.
    # The words of a window stand side by side in a row, so that its keys are compiled: a function of arrays boxes each value.
    apart = sorted({o for _, m, _ in masks for o in m})
    beside = F.arrays_zip(*[F.slice("h", o + 1, F.size("h")).alias(f"h{o}") for o in apart])
    windows = hashed.select("doc_id", F.size("h").alias("n"), F.posexplode_outer(beside).alias("at", "w"))
    keys = [F.when(F.col("at") + max(m) < F.col("n"), F.xxhash64(F.lit(i), *[F.col("w")[f"h{o}"] for o in m])) for i, m, _ in masks]
    rows = windows.select("doc_id", "at", F.explode_outer(F.array(*keys)).alias("key"))
    hits = rows.join(small_side(index), "key").select("doc_id", "item_id", (F.col("at") - F.col("item_at")).alias("first_word")).distinct()
    hits = written(hits, "benchmark-hits")

    hits = small_side(hits).withColumnRenamed("doc_id", "_doc")
    texts = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").join(hits, F.col("doc_id").eqNullSafe(F.col("_doc")))
    texts = texts.select("doc_id", "text_hash", "item_id", "first_word", word_array(F.col("text")).alias("doc"))
    laid = texts.join(small_side(items), "item_id").select(
        "doc_id", "text_hash", "item_id", "first_word", F.size("item").alias("item_words"),
        F.transform("item", lambda w, i: F.coalesce(F.get("doc", F.col("first_word") + i) == w, F.lit(False))).alias("same"),
    )
    size = F.least(F.lit(WINDOW), F.col("item_words"))
    equal_from = lambda i: F.size(F.filter(F.slice("same", i + 1, size), lambda s: s))
    overlaps = F.exists(F.sequence(F.lit(0), F.col("item_words") - size), lambda i: equal_from(i) >= size - allowed(size))
    found = laid.where(overlaps).withColumn("equal_words", F.size(F.filter("same", lambda s: s)))
    best = F.max(F.struct("equal_words", (-F.col("first_word")).alias("m"))).alias("b")
    return found.groupBy("doc_id", "text_hash", "item_id", "item_words").agg(best).select(
        "doc_id", "text_hash", "item_id", "item_words", (-F.col("b.m")).alias("first_word"), F.col("b.equal_words").alias("equal_words")
    )


def without_overlaps(documents: DataFrame, benchmark: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """The documents that overlap no benchmark item; all columns, whatever their names, and repeated rows stay."""
    found = written(find_overlaps(documents, benchmark, least_words).select("doc_id", "text_hash").distinct(), "contaminated")
    row = documents.select(F.struct("*").alias("row"))
    same = F.col("row")["doc_id"].eqNullSafe(F.col("doc_id")) & (F.xxhash64(F.col("row")["text"]) == F.col("text_hash"))
    return row.join(small_side(found), same, "left_anti").select(*[F.col("row")[c].alias(c) for c in documents.columns])
