"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, fixed by its code point. An n-gram binds its letters: each letter's vector
is permuted (rotated) by its distance from the n-gram's end, and the permuted vectors are multiplied. A document bundles
(adds up) the vectors of its n-grams; a language's prototype bundles its documents, each at unit length. A document has
the language whose prototype is closest by cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.llm.common import held_out, map_arrow, unit_hash
from patronage.llm.textbytes import pick

DIMENSIONS = 1024
#: Documents that profiles are learned from, at most (a bounded, hash-chosen sample of the labelled rows).
TRAINING_DOCUMENTS = 20_000
#: The least cosine to the best prototype at which the pipeline takes a document to be in a known language. A text of
#: unknown trigrams has cosines of 0 with a deviation of 1 / sqrt(DIMENSIONS) = 0.03, whatever its length.
LEAST_COSINE = 0.12
#: Texts of fewer different trigrams can have a lower cosine in their own language too (it grows with their square root),
#: so the cosine does not reject them: they stay where half of their letters or more are letters of the learned texts.
FEW_GRAMS = 64
UNKNOWN = "und"
SLICE_CHARS = 1 << 18
#: n-grams bound at a time: a bounded part of a slice's.
GRAMS = 2048

_letters: dict[str, np.ndarray] = {}


def letter_table() -> np.ndarray:
    """For each code point whether it is a letter."""
    if "table" not in _letters:
        _letters["table"] = np.array([chr(c).isalpha() for c in range(0x110000)])
    return _letters["table"]


def letter_vector(code: int, dimensions: int) -> np.ndarray:
    key = f"{code}/{dimensions}"
    if key not in _letters:
        _letters[key] = np.random.default_rng(code).integers(0, 2, dimensions).astype(np.float32) * 2 - 1
    return _letters[key]


def text_vectors(texts: list[str], dimensions: int = DIMENSIONS) -> tuple[np.ndarray, np.ndarray]:
    """Bundled trigram vectors of the texts, lower-cased, any run of non-letters one boundary; and their letters."""
    vectors, letters, _ = bundled(texts, dimensions)
    return vectors, letters


def bundled(texts: list[str], dimensions: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors and letters as in text_vectors, and how many trigrams each text has."""
    texts = [f" {t} " for t in texts]
    joined = "".join(texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t) for t in texts])
    rows = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    is_letter = letter_table()[codes]
    letters = np.bincount(rows[is_letter], minlength=len(texts))
    # keep letters and the first non-letter of each run; every text starts and ends with a boundary
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    keep[:1] = True
    starts = np.append(0, ends[:-1])[np.diff(np.append(0, ends)) > 0]
    keep[starts] = True
    symbols = np.where(is_letter, codes, 0)[keep]
    owner = rows[keep]
    present, symbol = np.unique(symbols, return_inverse=True)
    if len(symbols) < 3:
        return np.zeros((len(texts), dimensions), np.float32), letters, np.zeros(len(texts), np.int64)
    size = len(present)
    gram = (symbol[:-2] * size + symbol[1:-1]) * size + symbol[2:]
    inside = (owner[:-2] == owner[2:]) & ~((symbols[:-2] == 0) & (symbols[1:-1] == 0) | (symbols[1:-1] == 0) & (symbols[2:] == 0))
    gram, owner = gram[inside], owner[:-2][inside]
    times = np.bincount(owner, minlength=len(texts))
    if size**3 <= 1 << 22:
        seen = np.zeros(size**3, bool)
        seen[gram] = True
        grams = np.flatnonzero(seen)
        place = np.zeros(size**3, np.int32)
        place[grams] = np.arange(len(grams))
        column = place[gram]
    else:
        grams, column = np.unique(gram, return_inverse=True)
    vectors = np.zeros((len(texts), dimensions), np.float32)
    letter = np.stack([letter_vector(int(c), dimensions) for c in present])
    second, third = np.roll(letter, 1, axis=1), np.roll(letter, 2, axis=1)
    for first in range(0, len(grams), GRAMS):
        part = grams[first : first + GRAMS]
        own = (column >= first) & (column < first + len(part)) if len(grams) > GRAMS else slice(None)
        bound = third[part // size // size] * second[part // size % size] * letter[part % size]
        counts = np.bincount(owner[own].astype(np.int64) * len(part) + column[own] - first, minlength=len(texts) * len(part))
        vectors += counts.reshape(len(texts), len(part)).astype(np.float32) @ bound
    return vectors, letters, times


def slices(column: pa.Array, most: int = SLICE_CHARS) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) in slices of bounded length; null counts as empty."""
    lowered = pc.utf8_lower(pc.fill_null(column, ""))
    first, chars, part = 0, 0, []
    for text in lowered.to_pylist():
        part.append(text)
        chars += len(text)
        if chars >= most or len(part) >= 1024:
            yield first, part
            first, chars, part = first + len(part), 0, []
    if part:
        yield first, part


def unit(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(norms > 0, norms, 1)


@dataclass(frozen=True)
class Profiles:
    languages: tuple[str, ...]
    prototypes: np.ndarray  # a unit vector for each language
    dimensions: int
    letters: frozenset[str] = frozenset()  # of the learned texts

    def predict(self, texts: list[str], least: float = LEAST_COSINE) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language and score of each text, and whether it is taken to be in a known language."""
        vectors, letters, times = bundled(texts, self.dimensions)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        cosines = unit(vectors) @ self.prototypes.T
        best = cosines.argmax(1)
        score = np.clip(cosines[np.arange(len(texts)), best], 0, 1)
        known = letters > 0
        score = np.where(known, score, 0.0)
        kept = known & (score >= least)
        # different trigrams, by how far their vectors add up; a text that repeats a few has a few
        different = times.astype(np.float64) ** 2 * self.dimensions / np.maximum(np.square(vectors, dtype=np.float64).sum(1), 1)
        for k in np.flatnonzero(known & ~kept & (different < FEW_GRAMS)):
            own = [c for c in texts[k] if c.isalpha()]
            kept[k] = 2 * sum(c in self.letters for c in own) >= len(own)
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best, known)], score, kept


def learn(documents: DataFrame, dimensions: int = DIMENSIONS, most: int = TRAINING_DOCUMENTS) -> Profiles:
    """Profiles of the languages of documents that are not held out and have a text and a language.

    Of n such documents about `most` are used, chosen by a hash of id, text and the row's number in its task, so that rows
    equal in all columns are chosen one by one; the share is compared with the whole hash and is never rounded away. Tasks send one summed vector for each
    language and the letters they met, so the driver gets languages x tasks vectors at most, added up by Spark first, and
    each letter once.
    """
    training = documents.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    n = documents.where(~held_out() & F.col("lang").isNotNull()).count()
    share = min(1.0, most / max(n, 1))
    training = training.where(unit_hash("doc_id", "text") < share)

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        letters: set[str] = set()
        for batch in batches:
            langs = np.array(pick(batch.column(0)).to_pylist(), object)
            for first, texts in slices(pick(batch.column(1))):
                vectors = unit(text_vectors(texts, dimensions)[0]).astype(np.float64)
                letters.update(c for c in set().union(*texts) if c.isalpha())
                own = langs[first : first + len(texts)]
                for lang in set(own):
                    sums[lang] = sums.get(lang, 0) + vectors[own == lang].sum(0)
        for lang, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * dimensions), pa.array(np.arange(dimensions, dtype=np.int32)), pa.array(total)], ["lang", "k", "v"]
            )
        codes = pa.array(sorted(map(ord, letters)), pa.int32())  # letters in rows without a language
        yield pa.RecordBatch.from_arrays([pa.nulls(len(codes), pa.string()), codes, pa.array(np.zeros(len(codes)))], ["lang", "k", "v"])

    summed = map_arrow(training.select("lang", "text"), bundle, "lang string, k int, v double").groupBy("lang", "k").agg(F.sum("v").alias("v"))
    prototypes: dict[str, np.ndarray] = {}
    letters: set[str] = set()
    for lang, k, v in summed.collect():  # languages x dimensions numbers, and letters
        if lang is None:
            letters.add(chr(k))
            continue
        prototypes.setdefault(lang, np.zeros(dimensions))[k] = round(v, 6)
    languages = tuple(sorted(prototypes))
    table = unit(np.array([prototypes[x] for x in languages])) if languages else np.zeros((0, dimensions))
    return Profiles(languages, table.astype(np.float32), dimensions, frozenset(letters))


def predict(documents: DataFrame, profiles: Profiles) -> DataFrame:
    """The documents with lang_pred and lang_score in place of columns of these names.

    Null texts and texts without a letter are `und` with score 0; with no profile all are. All rows and other columns stay,
    repeated rows each; ties between languages go to the first by name. An empty table gives no rows. A text is read whole.
    """
    own = [F.col("row")[c].alias(c) for c in documents.columns if c not in ("lang_pred", "lang_score")]
    return marked(documents, profiles, LEAST_COSINE).select(*own, "lang_pred", "lang_score")


def marked(documents: DataFrame, profiles: Profiles, least: float) -> DataFrame:
    """row (all columns as one struct), lang_pred, lang_score, known: whether the document is taken to be in a known language."""
    shared = documents.sparkSession.sparkContext.broadcast(profiles)  # languages x dimensions floats
    nested = documents.select(F.struct("*").alias("row"), "text")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores, known = [], [], []
            for _, texts in slices(pick(batch.column(1))):
                lang, score, kept = shared.value.predict(texts, least)
                langs += lang
                scores.append(score)
                known += kept.tolist()
            score = np.concatenate(scores) if scores else np.zeros(0)
            columns = [batch.column(0), pa.array(langs, pa.string()), pa.array(score.astype(np.float64)), pa.array(known, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["row", "lang_pred", "lang_score", "known"])

    schema = T.StructType([nested.schema["row"]]).add("lang_pred", "string").add("lang_score", "double").add("known", "boolean")
    return map_arrow(nested, mark, schema)


def known_language(documents: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """Drops documents without a letter and those that are close to no learned language; all columns stay as they are,
    whatever their names.

    A short text's cosine does not tell whether it is; such texts stay if they are in known letters (FEW_GRAMS).
    """
    kept = marked(documents, learn(documents), least).where("known")
    return kept.select(*[F.col("row")[c].alias(c) for c in documents.columns])
