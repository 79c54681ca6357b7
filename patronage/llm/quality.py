"""Quality classifier by positive-unlabelled learning.

Trusted positives are documents labelled 1; all other documents are unlabelled web text (their labels, 0 included, are
not looked at). With class prior p, logistic loss and risks R_p+ (positives as positive), R_p- and R_u- (positives and
unlabelled as negative), a small network minimises the non-negative unbiased risk

    p R_p+ + max(0, R_u- - p R_p-)

where a step in which the bracket is negative goes back up its gradient. The prior is the smallest ratio, over score
thresholds, of the unlabelled share above it to the positive share above it, under a classifier of positives against
unlabelled (best bin estimation). Features are shares and lengths counted from the whole text; labels, lang, source and
doc_id are none of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm.common import held_out, map_arrow, unit_hash, written
from patronage.llm.textbytes import Rolling, lines, mix, per_row, pick, slices, sums_by_row, words

#: Training rows, at most (hash-chosen): positives, and unlabelled documents.
TRAINING_POSITIVES = 20_000
TRAINING_UNLABELLED = 40_000
THRESHOLD = 0.7
HIDDEN = 16
EPOCHS = 30
BATCH = 2048
RATE = 0.01
PULL_BACK = 0.5
LEAST_BIN = 0.1  # share of positives above a threshold, below which its ratio is too noisy to use

FEATURES = (
    "log_chars letters upper digits symbols exclaims stops pipes other mean_word longest_word distinct same_as_before "
    "distinct_pairs distinct_fives odd_ends capitals lines dup_lines log_words"
).split()


def _class(*spans: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for a, b in spans:
        table[a : b + 1] = True
    return table


_UPPER, _LETTER, _DIGIT = _class((65, 90)), _class((65, 90), (97, 122)), _class((48, 57))
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&<>@^~_=+\\/{}[]"))
_STOP = np.isin(np.arange(256), list(b".,;:?"))


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of FEATURES for each text."""
    n = len(offsets) - 1
    starts_char = (data & 0xC0) != 0x80
    before = np.concatenate([[0], data[:-1]]) if len(data) else data
    wide_upper = (before == 0xC3) & (data >= 0x80) & (data <= 0x9E)
    chars = sums_by_row(starts_char, offsets)
    safe = np.maximum(chars, 1)
    letter = _LETTER[data] | (data >= 0xC3)
    letters = sums_by_row(letter, offsets)
    rolling = Rolling(data)
    starts, ends, rows = words(data, offsets)
    n_words = per_row(rows, n)
    some = np.maximum(n_words, 1)
    names = rolling.spans(starts, ends)
    own = mix(rows.astype(np.uint64) + np.uint64(7))

    def distinct(width: int) -> np.ndarray:
        """Share of distinct windows of so many words among a row's windows; 1 where there is none."""
        if len(names) < width:
            return np.ones(n)
        inside = rows[: len(rows) - width + 1] == rows[width - 1 :]
        joint = own[: len(inside)].copy()
        for k in range(width):
            joint = mix(joint + names[k : k + len(inside)])
        joint, owner = joint[inside], rows[: len(inside)][inside]
        first = np.unique(joint, return_index=True)[1]
        total = per_row(owner, n)
        return np.where(total > 0, per_row(owner[first], n) / np.maximum(total, 1), 1.0)

    same = np.zeros(len(names), bool)
    same[1:] = (names[1:] == names[:-1]) & (rows[1:] == rows[:-1])
    last = data[ends - 1] if len(ends) else data
    odd = _SYMBOL[last] | (last == ord("!")) | (last == ord("|"))
    capital = _UPPER[data[starts]] if len(starts) else np.zeros(0, bool)
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, rows, ends - starts)
    line_starts, line_ends, line_rows = lines(data, offsets)
    line_names = mix(rolling.spans(line_starts, line_ends)) ^ mix(line_rows.astype(np.uint64) + np.uint64(1))
    n_lines = per_row(line_rows, n)
    fresh = per_row(line_rows[np.unique(line_names, return_index=True)[1]], n)
    part = lambda flags: sums_by_row(flags, offsets) / safe
    columns = [
        np.log1p(chars), letters / safe, sums_by_row(_UPPER[data] | wide_upper, offsets) / np.maximum(letters, 1), part(_DIGIT[data]),
        part(_SYMBOL[data]), part(data == ord("!")), part(_STOP[data]), part(data == ord("|")), part(starts_char & (data >= 0xC4)),
        per_row(rows, n, (ends - starts).astype(float)) / some, np.log1p(longest), distinct(1), per_row(rows[same], n) / some,
        distinct(2), distinct(5), per_row(rows[odd], n) / some, per_row(rows[capital], n) / some, n_lines / some,
        1 - fresh / np.maximum(n_lines, 1), np.log1p(n_words),
    ]
    return np.stack(columns, 1).astype(np.float32)


@dataclass
class Network:
    """Standardised features, one hidden layer, a logit."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]

    @classmethod
    def fresh(cls, x: np.ndarray, seed: int) -> "Network":
        draw = np.random.default_rng(seed)
        width = x.shape[1]
        weights = [draw.normal(0, width**-0.5, (width, HIDDEN)), np.zeros(HIDDEN), draw.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
        return cls(x.mean(0), x.std(0) + 1e-3, weights)

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        hidden = np.tanh(z @ self.weights[0] + self.weights[1])
        return hidden @ self.weights[2] + self.weights[3][0], hidden, z

    def gradient(self, x: np.ndarray, by_logit: np.ndarray, passed: tuple) -> list[np.ndarray]:
        _, hidden, z = passed
        back = by_logit[:, None] * self.weights[2] * (1 - hidden**2)
        return [z.T @ back, back.sum(0), hidden.T @ by_logit, by_logit.sum(keepdims=True)]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.forward(x)[0], -30, 30)))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, x)


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, seed: int = 1) -> Network:
    """Minimises the non-negative risk; without a prior, the plain risk of positives against unlabelled."""
    net = Network.fresh(np.concatenate([positive, unlabelled]), seed)
    draw = np.random.default_rng(seed)
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in net.weights]
    steps = max(1, -(-len(unlabelled) // BATCH))
    t = 0
    for _ in range(EPOCHS):
        p_order, u_order = draw.permutation(len(positive)), draw.permutation(len(unlabelled))
        for p_part, u_part in zip(np.array_split(p_order, steps), np.array_split(u_order, steps)):
            if not len(p_part) or not len(u_part):
                continue
            xp, xu = positive[p_part], unlabelled[u_part]
            fp, fu = net.forward(xp), net.forward(xu)
            sp, su = sigmoid(fp[0]), sigmoid(fu[0])
            if prior is None:
                grads = [a + b for a, b in zip(net.gradient(xp, (sp - 1) / len(xp), fp), net.gradient(xu, su / len(xu), fu))]
            else:
                bracket = softplus(fu[0]).mean() - prior * softplus(fp[0]).mean()
                minus = [a - b for a, b in zip(net.gradient(xu, su / len(xu), fu), net.gradient(xp, prior * sp / len(xp), fp))]
                if bracket >= 0:
                    grads = [a + b for a, b in zip(net.gradient(xp, prior * (sp - 1) / len(xp), fp), minus)]
                else:
                    grads = [-PULL_BACK * g for g in minus]
            t += 1
            for k, (w, g) in enumerate(zip(net.weights, grads)):
                g = g + 1e-4 * w
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return net


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, seed: int = 2) -> float:
    """Share of positives among the unlabelled, estimated on halves that the classifier has not seen."""
    net = fit(positive[::2], unlabelled[::2], None, seed)
    p, u = np.sort(net.score(positive[1::2])), np.sort(net.score(unlabelled[1::2]))
    if not len(p) or not len(u):
        return 0.5
    cuts = np.quantile(p, np.linspace(0, 1 - LEAST_BIN, 91))
    above_p = 1 - np.searchsorted(p, cuts) / len(p)
    above_u = 1 - np.searchsorted(u, cuts) / len(u)
    slack = np.sqrt(np.log(20) / 2 / len(u)) + np.sqrt(np.log(20) / 2 / len(p))
    k = int(((above_u + slack) / above_p).argmin())
    return float(np.clip(above_u[k] / above_p[k], 0.05, 0.95))


def feature_table(documents: DataFrame) -> DataFrame:
    """doc_id and the features of every text, as a written table; null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_id = pick(batch.column(0))
            for first, last, data, offsets in slices(pick(batch.column(1))):
                rows = features(data, offsets)
                column = pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * len(FEATURES), pa.array(rows.ravel()))
                yield pa.RecordBatch.from_arrays([doc_id.slice(first, last - first), column], ["doc_id", "features"])

    table = map_arrow(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, features array<float>")
    return written(table, "quality-features")


def train(table: DataFrame, labels: DataFrame, most_positive: int = TRAINING_POSITIVES, most_unlabelled: int = TRAINING_UNLABELLED) -> Network | None:
    """A network from rows that are not held out, or None without a positive or an unlabelled row.

    At most the given numbers of rows come to the driver, as features only: those with the least hash of id, features and
    the row's number in its task, so many rows of one id, or without one, are chosen from like all others.
    """
    positives = labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    rows = table.where(~held_out()).join(positives.withColumn("_p", F.lit(True)), "doc_id", "left")
    rows = written(rows.select("doc_id", "features", F.coalesce("_p", F.lit(False)).alias("_p")), "quality-training")
    sizes = {r["_p"]: r["n"] for r in rows.groupBy("_p").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return None
    rows = rows.withColumn("_u", unit_hash("doc_id", "features"))
    parts = []
    for is_positive, most in ((True, most_positive), (False, most_unlabelled)):
        share = 1.1 * most / sizes[is_positive] + 1000 / sizes[is_positive]  # some more than needed, then the first of them
        parts.append(rows.where((F.col("_p") == is_positive) & (F.col("_u") < share)).orderBy("_u").limit(most))
    chosen = parts[0].unionByName(parts[1]).toArrow()
    order = np.argsort(chosen["doc_id"].fill_null(-1).to_numpy(), kind="stable")
    x = chosen["features"].combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES)).astype(np.float64)[order]
    is_positive = chosen["_p"].to_numpy()[order]
    positive, unlabelled = x[is_positive], x[~is_positive]
    if not len(positive) or not len(unlabelled):
        return None
    return fit(positive, unlabelled, class_prior(positive, unlabelled))


def score_documents(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row.

    Empty and null texts are scored by their (zero) features, repeated rows alike; labels with nulls are not looked at;
    with nothing to learn from every score is 0.5. Only doc_id and text are read, so other columns cannot clash.
    """
    table = feature_table(documents)
    net = train(table, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pick(batch.column(1)).flatten().to_numpy().reshape(-1, len(FEATURES)).astype(np.float64)
            score = net.score(x) if net else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], ["doc_id", "score"])

    scored = map_arrow(table, run, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
