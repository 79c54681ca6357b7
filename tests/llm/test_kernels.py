"""Numeric kernels against plain Python versions of the same definitions; no Spark."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from patronage.llm import language, linededup, neardup, packing, quality, records, repetition, textbytes
from patronage.llm.queries import tokenizer_path
from patronage.llm.tokens import Encoder

TEXTS = [
    None, "", " \n ", "a", "a a a a a a a", "a b c d e f a b c d e g\na b c\na b c\n\n\n", "é ü # é ü # é ü\n| |",
    "  a  b\n\n c\t d ", "It's we'll 'S x²³ 12345 a1b2", "İstanbul ΣΑΣ ß", "日本語 text", "a b \x1c c",
    "<|endoftext|> hi <|startoftext|>", "éa", "\n", "  ", "don't!!  \r\n--", " 's", "A­b\u0085", "x" * 5000,
]


def random_texts(n, seed=3):
    draw = random.Random(seed)
    parts = ["a", "b", "c ", "d ", " ", "\n", "é", "ab cd ef gh ij kl ", "Word, ", "THE!! "]
    return ["".join(draw.choice(parts) for _ in range(draw.randint(0, 60))) for _ in range(n)]


def distance(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
        before = row
    return before[-1]


def edited(draw, line, most, letters=b"abc"):
    out = list(line)
    for _ in range(draw.randint(0, most)):
        kind, at = draw.randint(0, 2), draw.randint(0, len(out))
        if kind == 0:
            out.insert(at, draw.choice(letters))
        elif out and kind == 1:
            out.pop(at % len(out))
        elif out:
            out[at % len(out)] = draw.choice(letters)
    return bytes(out)


@pytest.mark.parametrize("threshold", [0, 1, 2, 3])
def test_banded_edit_distance(threshold):
    draw = random.Random(threshold)
    a = [bytes(draw.choice(b"abc") for _ in range(draw.randint(0, 30))) for _ in range(800)]
    b = [edited(draw, x, 4) for x in a]
    assert linededup.within(a, b, threshold).tolist() == [distance(x, y) <= threshold for x, y in zip(a, b)]
    assert linededup.within([], [], threshold).tolist() == []


def test_segments_meet_for_every_pair_within_the_threshold():
    draw = random.Random(1)
    for _ in range(400):
        a = bytes(draw.choice(b"ab") for _ in range(draw.randint(22, 40)))
        b = edited(draw, a, 2, b"ab")
        a, b = sorted((a, b), key=len)
        if a == b or len(a) < linededup.LEAST or distance(a, b) > 2:
            continue
        rolling = textbytes.Rolling(np.frombuffer(a + b, np.uint8), 11)
        keys = lambda s, e, probe: set(linededup.keys(rolling, np.array([s]), np.array([e]), 2, linededup.alignments(2) if probe else linededup.own_segments(2))[0].tolist()) - {0}
        assert keys(0, len(a), False) & keys(len(a), len(a) + len(b), True)


@pytest.mark.parametrize("most", [1, 3, 32])
def test_lines_without_white_space_at_their_ends(monkeypatch, most):
    monkeypatch.setattr(linededup, "MOST_STEPS", most)
    draw = random.Random(3)
    texts = ["".join(draw.choice(" \t\r\n\nab é") * draw.choice([1, 1, 5]) for _ in range(draw.randint(0, 40))) for _ in range(200)]
    data = "".join(texts).encode()
    offsets = np.append(0, np.cumsum([len(t.encode()) for t in texts]))
    got = [(data[a:b].decode(), r, n) for a, b, r, n in zip(*linededup.trimmed(np.frombuffer(data, np.uint8), offsets), strict=True)]
    strip = " \t\n\x0b\f\r"
    assert got == [(x.strip(strip), r, n) for r, t in enumerate(texts) for n, x in enumerate(t.split("\n")) if x.strip(strip)]


def repetition_by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0d]+", text)
    windows = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i : i + 5]), []).append(i)
    repeated = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    seen, twice = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0d]", line):
            twice += line in seen
            seen.add(line)
    best = [0] * len(words)
    for i in range(len(words)):
        for j in range(len(words)):
            k = 0
            while i != j and max(i, j) + k < len(words) and words[i + k] == words[j + k]:
                k += 1
            best[i] = max(best[i], k)
    inside = {j for i, b in enumerate(best) if b >= repetition.LEAST_REPEAT for j in range(i, i + b)}
    return [
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), twice, len(repeated), len(inside),
        max(best, default=0),
    ]


def test_repetition_counts():
    texts = [t for t in TEXTS if t is None or len(t) < 1000] + random_texts(150)
    got = []
    for _, _, data, offsets in textbytes.slices(pa.array(texts), 400):
        got += np.array(repetition.counts(data, offsets)).T.tolist()
    assert got == [repetition_by_hand(t) for t in texts]


@pytest.mark.parametrize(("file", "style"), [("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word"), ("word_bpe_49k.json", "plain")])
def test_encoder_equals_the_library(file, style):
    encode = Encoder(tokenizer_path(file), style, remembered=50)
    for text in TEXTS + random_texts(100):
        expected = encode.library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(encode([text])[0], "<u2").tolist() == expected, text


@pytest.mark.parametrize(("file", "style"), [("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word"), ("word_bpe_49k.json", "plain")])
def test_encoder_equals_a_fresh_library_on_added_tokens(file, style):
    from tokenizers import Tokenizer

    library, encode = Tokenizer.from_file(tokenizer_path(file)), Encoder(tokenizer_path(file), style)
    texts = ["abc <|endoftext|> def", "<|startoftext|><|endoftext|>", "a<|ENDOFTEXT|>b", "é日<|endoftext|>語", "<|endof", "text|>"] + TEXTS
    expected = [library.encode(text or "", add_special_tokens=False).ids for text in texts]
    assert [np.frombuffer(x, "<u2").tolist() for x in encode(texts)] == expected
    assert [np.frombuffer(encode([x])[0], "<u2").tolist() for x in texts] == expected


def test_lines_of_a_group_take_memory_by_slices(monkeypatch):
    sizes = []
    rolling = linededup.Rolling
    monkeypatch.setattr(linededup, "Rolling", lambda data, seed: sizes.append(len(data)) or rolling(data, seed))
    texts = ["a" * 30, "é日" * 40, "b" * 700, "", "aé" * 25] * 3
    raw = pa.array([x.encode() for x in texts], pa.binary())
    whole = linededup.Lines(raw, 2)
    monkeypatch.setattr(linededup, "SLICE_BYTES", 100)
    sliced = linededup.Lines(raw, 2)
    assert max(sizes[1:]) == 700 and len(sizes) > 6
    for name in ("letters", "starts", "ends", "length", "index", "probe", "classes"):
        assert np.array_equal(getattr(whole, name), getattr(sliced, name)), name
    assert [len(sliced.of(k)) for k in range(len(texts))] == [len(x) for x in texts]
    assert len(linededup.Lines(raw[:0], 2).length) == 0


def test_encoder_keeps_pieces_it_meets_again():
    encode = Encoder(tokenizer_path("byte_bpe_50k.json"), "byte", remembered=20)
    encoded = []
    encode._piece = lambda piece, found=encode._piece: encoded.append(piece) or found(piece)
    encode.known.find = encode._piece
    for k in range(40):
        text = "The same words come again " + " ".join(chr(97 + k % 26) * (j + k // 26 + 1) for j in range(4))
        ids = encode.library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encode([text])[0], "<u2").tolist() == ids
        assert len(encode.known) <= 10 + 9
    assert [encoded.count(x) for x in ("The", " same", " words", " come", " again")] == [1] * 5


def test_encoder_refuses_ids_that_do_not_fit():
    with pytest.raises(ValueError):
        Encoder(tokenizer_path("byte_bpe_50k.json"), "byte", "<u1")


def test_records_round_trip_and_damage():
    ids = np.arange(7, dtype="<u2").tobytes()
    data = records.frame(records.pack_payload(5, ids, 2)) + records.frame(records.pack_payload(None, b"", 2))
    payload, at = records.unframe(memoryview(data), 0)
    assert records.unpack_payload(payload)[0] == 5 and records.unpack_payload(payload)[1].tolist() == list(range(7))
    payload, end = records.unframe(memoryview(data), at)
    assert records.unpack_payload(payload)[0] is None and end == len(data)
    for k in range(at):
        broken = bytearray(data[:at])
        broken[k] ^= 1
        with pytest.raises(ValueError):
            records.unframe(memoryview(bytes(broken)), 0)
    with pytest.raises(ValueError):
        records.unframe(memoryview(data[: at - 1]), 0)


@pytest.mark.parametrize("lengths", [
    [], [1], [4096] * 10, [3000] * 50 + [1500] * 60, np.random.default_rng(1).integers(1, 4097, 3000).tolist(),
    np.minimum(4096, np.random.default_rng(2).lognormal(6.3, 1, 20000).astype(int) + 1).tolist(),
])
def test_packing_plan_places_every_piece_once(lengths):
    counts = Counter(lengths)
    runs = packing.plan(dict(counts))
    placed, ranks = Counter(), {}
    for run in runs:
        assert sum(size for size, _ in run.places) + run.room == packing.CAPACITY and run.room >= 0
        for size, rank in run.places:
            placed[size] += run.count
            ranks.setdefault(size, []).append((rank, run.count))
    assert placed == counts
    for own in ranks.values():  # ranks are covered without gap or overlap
        at = 0
        for rank, n in sorted(own):
            assert rank == at
            at += n
    bins = []  # first fit, longest first
    for size in sorted(lengths, reverse=True)[:3000]:
        fit = next((k for k, room in enumerate(bins) if room >= size), None)
        if fit is None:
            bins.append(packing.CAPACITY - size)
        else:
            bins[fit] -= size
    if len(lengths) <= 3000:
        assert sum(run.count for run in runs) <= 1.02 * len(bins) + 1
    else:
        assert sum(run.count for run in runs) <= 1.01 * sum(lengths) / packing.CAPACITY + 1


def test_registers_estimate_the_weighted_similarity():
    n = 40
    key = textbytes.seeded(5, 60)
    a, b = key[:50], key[10:]
    owner = np.repeat(np.arange(2 * n), 50)
    keys = np.concatenate([np.concatenate([a, b]) + np.uint64(1000 * i) for i in range(n)])
    won = neardup.registers(owner, keys, np.ones(len(keys)), 2 * n)
    agree = np.mean([(won[2 * i] == won[2 * i + 1]).mean() for i in range(n)])
    assert abs(agree - 40 / 60) < 0.03
    heavy = neardup.registers(np.array([0, 0]), key[:2], np.array([3.0, 1.0]), 1, 20_000)
    assert abs((heavy[0] == key[0]).mean() - 0.75) < 0.02


def test_probability_jaccard_equals_its_sum():
    draw = np.random.default_rng(8)
    for _ in range(200):
        a, b = (np.unique(draw.integers(0, 30, draw.integers(1, 25))) for _ in range(2))
        x, y = (None if draw.random() < 0.2 else 1 + np.log(draw.integers(1, 5, len(s))) for s in (a, b))
        p, q = ({k: float(w) for k, w in zip(s.tolist(), np.ones(len(s)) if v is None else v, strict=True)} for s, v in ((a, x), (b, y)))
        want = sum(1 / sum(max(p.get(j, 0) / p[i], q.get(j, 0) / q[i]) for j in p.keys() | q.keys()) for i in p.keys() & q.keys())
        assert abs(neardup.probability_jaccard(a, x, b, y) - want) < 1e-9


def test_shingles_of_short_and_empty_rows():
    names, rows = textbytes.seeded(1, 9), np.array([0, 0, 0, 0, 0, 0, 2, 2, 3])
    owner, _, times = neardup.shingles(names, rows, 4)
    assert owner.tolist() == [0, 0, 2, 3] and times.tolist() == [1, 1, 1, 1]
    assert neardup.shingles(names[:0], rows[:0], 3)[0].tolist() == []



@pytest.mark.parametrize("two_sides", [False, True])
def test_overlaps_of_blocks(two_sides):
    draw = np.random.default_rng(5)
    base = draw.integers(-(2**62), 2**62, 700)
    sets = []
    for k in range(600):  # more rows than a tile has; some with a few members only
        own = base[draw.random(700) < (0.95 if k % 3 else 0.8)] if k % 7 else base[: k % 5 + 1]
        sets.append(np.unique(np.append(own, draw.integers(-(2**62), 2**62, k % 11))))
    label, side = draw.integers(0, 6, 600) // 3 * 3, np.arange(600) % 2 * int(two_sides)
    a, b = neardup.overlaps(sets, label, side, 0.8)
    got = {(min(x), max(x)) for x in zip(a.tolist(), b.tolist())}
    want = set()
    for i in range(600):
        for j in range(i):
            if label[i] != label[j] and (not two_sides or side[i] != side[j]):
                shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if shared >= 0.8 * (len(sets[i]) + len(sets[j]) - shared) - 1e-9:
                    want.add((j, i))
    assert got == want and want
    weights = [None if k % 3 else 1 + np.log(draw.integers(1, 9, len(x))) for k, x in enumerate(sets)]
    a, b = neardup.overlaps(sets, label, side, 0.8, weights)
    got = {(min(x), max(x)) for x in zip(a.tolist(), b.tolist())}
    want = {(j, i) for i in range(600) for j in range(i) if label[i] != label[j] and (not two_sides or side[i] != side[j])
            and neardup.probability_jaccard(sets[i], weights[i], sets[j], weights[j]) >= 0.8}
    assert got == want and want


def test_language_vectors_tell_languages_apart():
    first, second = ["the cat sat on the mat and the dog"] * 3, ["der hund und die katze in dem haus"] * 3
    vectors, letters = language.text_vectors(first + second + ["", "123 !!"])
    assert letters[-2:].tolist() == [0, 0] and not vectors[-1].any()
    unit = language.unit(vectors)
    assert unit[0] @ unit[1] > 0.99 and unit[0] @ unit[3] < 0.5


def test_positive_unlabelled_learning_on_a_known_mixture():
    draw = np.random.default_rng(0)
    good, bad = draw.normal(0, 1, (6000, 3)), draw.normal(3, 1, (2000, 3))
    positive, unlabelled = good[:2000], np.concatenate([good[2000:], bad])
    prior = quality.class_prior(positive, unlabelled)
    assert abs(prior - 4 / 6) < 0.1
    score = quality.fit(positive, unlabelled, prior).score(np.concatenate([draw.normal(0, 1, (500, 3)), draw.normal(3, 1, (500, 3))]))
    assert (score[:500] >= 0.5).mean() > 0.95 and (score[500:] < 0.5).mean() > 0.95


def test_features_of_empty_texts_are_finite():
    for _, _, data, offsets in textbytes.slices(pa.array(["", None, "a", "É è"])):
        assert np.isfinite(quality.features(data, offsets)).all()
