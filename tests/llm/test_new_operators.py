"""Periodic runs, exact top-k search and spelling variants against plain Python, with odd rows and whole small tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from patronage.llm import bitsliced, periodic, spelling
from patronage.llm.queries import QUERIES, with_planted_runs

SCHEMA = "doc_id long, text string, runs string, start string, n string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def given(spark, tmp_path_factory):
    """A folder with a documents table: runs, near words, nulls, empty and long texts, repeated rows and ids."""
    draw = random.Random(7)
    stock = ["".join(draw.choice("abcdeé") for _ in range(draw.randrange(3, 9))) for _ in range(40)]
    rows = [(i, " ".join(draw.choice(stock) for _ in range(draw.randrange(200)))) for i in range(400)]
    rows += [(None, None), (None, "no id " * 20), (1000, None), (1001, ""), (1002, " \t\n "), (1003, "Long " * 40_000), (7, rows[7][1]), (7, rows[8][1])]
    rows += [(2000 + i, "seven words that are all the same") for i in range(30)]
    path = str(tmp_path_factory.mktemp("tables"))
    table(spark, rows).repartition(5).write.parquet(f"{path}/documents.parquet")
    return path, rows


def plain_runs(words, least):
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if length >= max(least, 2 * q):
                found.setdefault((start, length), q)
    return sorted(((s, m, q) for (s, m), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_digest(doc_id, words):
    runs = plain_runs(words, 12)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    text = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    milli = 1000 * length // period if runs else None
    return doc_id, len(runs), start, length, period, milli, hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest()


def planted(doc_id, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_run_kernel_equals_brute_force():
    draw = random.Random(5)
    for _ in range(400):
        least, rows = draw.choice([2, 4, 12]), []
        for _ in range(draw.randrange(1, 4)):
            letters = draw.randrange(1, 5)
            root = [draw.randrange(letters) for _ in range(draw.randrange(1, 20))]
            words = [draw.randrange(letters) for _ in range(draw.randrange(40))] + (root * 9)[: draw.randrange(1, 9 * len(root))]
            for _ in range(draw.randrange(3)):
                words[draw.randrange(len(words))] = draw.randrange(letters)
            rows.append(words * draw.choice([1, 1, 2]))
        names = np.array([w for words in rows for w in words], np.uint64)
        got = list(zip(*[x.tolist() for x in periodic.periodic_runs(names, np.repeat(np.arange(len(rows)), [len(w) for w in rows]), least)], strict=True))
        want, at = [], 0
        for words in rows:
            want += [(s + at, m, q) for s, m, q in plain_runs(words, least)]
            at += len(words)
        assert got == want


def test_runs_on_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b " * 10 + "c"), (4, "a b " * 10 + "c"), (None, "x " * 12), (5, "long " * 50_000), (6, "é 日 " * 9)]
    found = {(r.doc_id, r.collapsed): [tuple(x) for x in r.runs] for r in periodic.find_runs(table(spark, rows)).collect()}
    assert found == {
        (1, ""): [], (2, ""): [], (3, ""): [], (4, "a b c"): [(0, 20, 2)], (None, "x"): [(0, 12, 1)], (5, "long"): [(0, 50_000, 1)], (6, "é 日"): [(0, 18, 2)],
    }
    assert periodic.find_runs(table(spark, rows)).count() == len(rows)
    assert periodic.find_runs(table(spark, [])).count() == 0 and periodic.find_runs(table(spark, [])).columns == ["doc_id", "runs", "collapsed"]


def test_periodic_query_equals_brute_force(spark, given):
    path, rows = given
    names = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    got = [tuple(r[c] for c in names) for r in QUERIES["op12_periodic_runs"](spark, path).collect()]
    small = [(i, t) for i, t in rows if len(t or "") < 100_000]
    want = [plain_digest(i, planted(i, t)) for i, t in small]
    assert sorted((g for g in got if g[0] != 1003), key=str) == sorted(want, key=str)
    texts = with_planted_runs(spark.read.parquet(f"{path}/documents.parquet")).collect()
    assert sum(r.text != t for r, t in zip(sorted(texts, key=str), sorted((tuple(x) for x in rows), key=str), strict=True)) > 20
    assert sorted(" ".join(WORD.findall(r.text or "")) for r in texts) == sorted(" ".join(planted(i, t)) for i, t in rows)


def plain_top(rows, every, k):
    """rows of (vec_id, whole components); the same rows as the search, by row number."""
    found = []
    for i, (name, q) in enumerate(rows):
        if name is None or name % every:
            continue
        others = [(-sum(a * b for a, b in zip(q, v, strict=True)), j_name is None, j_name or 0, j_name) for j, (j_name, v) in enumerate(rows) if j != i and len(v) == len(q)]
        found += [(name, rank, o[3], -o[0]) for rank, o in enumerate(sorted(others, key=lambda o: o[:3])[:k], 1)]
    return sorted(found, key=str)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string, block string")


def test_search_equals_brute_force_on_odd_rows(spark):
    draw = random.Random(3)
    rows = [(i, [draw.gauss(0, 0.125) for _ in range(24)]) for i in range(900)]
    rows += [(1000 + i, rows[200][1]) for i in range(150)]  # one common vector: ties go by id
    rows += [(300, rows[5][1]), (300, rows[300][1]), (None, rows[400][1]), (None, [0.5] * 24), (2000, [0.0] * 24)]  # repeated and null ids
    rows += [(2100, [1.0, 2.0]), (2101, [3.0, -1.0]), (2200, []), (2201, [])]  # other lengths
    bad = [(2300, None), (2400, [None] * 24), (2500, [float("nan")] * 24), (2600, [float("inf")] + [0.0] * 23), (2700, [0.1] * 23 + [None])]
    frame = vectors(spark, [(i, v, "x", "y") for i, v in rows + bad]).repartition(3)
    index = bitsliced.build_index(frame, block_rows=300)
    got = bitsliced.search(index, bitsliced.index_queries(index, 100), 10, group_queries=4)
    want = plain_top([(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows], 100, 10)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert bitsliced.top_rows(vectors(spark, [])).count() == 0


def test_large_components_are_exact_and_end_with_long(spark):
    rows = [(0, [1e13, -3.0]), (1, [1e13, 2.0]), (2, [-1e13, 0.1]), (3, [1e300, 0.0]), (100, [2.0**40, 1.0])]
    got = {(r.query_id, r.vec_id): r.score for r in bitsliced.top_rows(vectors(spark, [(*r, "x", "y") for r in rows])).collect()}
    assert got[0, 1] == got[0, 3] == got[100, 1] == 2**63 - 1 and got[0, 2] == -(2**63)
    small = {(r.query_id, r.vec_id): r.score for r in bitsliced.top_rows(vectors(spark, [(0, [2.0**20, 1.5], "x", "y"), (1, [2.0**20, -1.5], "x", "y")])).collect()}
    assert small == {(0, 1): 2**60 - 1536 * 1536}


@pytest.mark.parametrize("bits", [(2, 2), (6, 5), (11, 11)])
def test_boundary_rows_hold_the_best(bits):
    draw = np.random.default_rng(bits[0])
    for dims, spread in ((1, 5), (7, 300), (64, 128), (64, 2**24)):
        whole = np.rint(draw.normal(0, spread, (500, dims))).astype(np.int64)
        block = bitsliced.slice_block(whole, bits[0])
        for query in whole[:20]:
            rows = bitsliced.packed(draw.random(500) < 0.9)
            place = bitsliced.unpacked(rows, 500)
            score = bitsliced.exact_scores(query, whole)[place]
            best = place[np.lexsort((place, -score.astype(float)))[:10]]
            held = bitsliced.unpacked(bitsliced.boundary_rows(query, rows, 10, block[0], block[1], block[3], block[4], bits[1]), 500)
            least = np.sort(score)[-10]
            assert set(place[score >= least]) <= set(held) <= set(place) and set(best) <= set(held)


def test_slice_sums_equal_plain_sums():
    draw = np.random.default_rng(1)
    numbers = draw.integers(0, 1 << 9, (37, 200))
    columns = {j: [bitsliced.packed((numbers >> j & 1).astype(bool))] for j in range(9)}
    total = bitsliced.added(columns, 4)
    plain = sum(np.unpackbits(s.view(np.uint8), bitorder="little")[:200].astype(int) << j for j, s in enumerate(total))
    assert (plain == numbers.sum(0)).all()


def test_top_k_query_equals_brute_force(spark):
    import pyarrow.dataset as ds

    held = ds.dataset("/root/testdata/sf0.001/embeddings.parquet").to_table().to_pylist()
    rows = [(r["vec_id"], [int(np.floor(1024 * float(x))) for x in r["embedding"]]) for r in held]
    got = QUERIES["op11_bit_sliced_top_k"](spark, "/root/testdata/sf0.001").collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_top(rows, 100, 10)


def one_edit_apart(a, b):
    """Word a is made of b, or b of a, by exactly one inserted, deleted or replaced letter."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_variants(counts):
    found, forms = {}, {}
    for w, n in counts.items():
        near = [(-m, v) for v, m in counts.items() if abs(len(v) - len(w)) <= 1 and one_edit_apart(v, w)]
        best = min(near, default=None)
        if best and -best[0] >= 5 * n:
            forms[w] = best[1]
        found[w] = (n, len(near))
    rows = []
    for w, (n, near) in found.items():
        root = w
        while root in forms:
            root = forms[root]
        rows.append((w, forms.get(w), root, n, near, counts.get(forms.get(w))))
    return sorted(rows, key=str)


VARIANT = ("word", "form", "root", "n", "n_near", "form_n")


def variants_of(frame):
    return sorted((tuple(r[c] for c in VARIANT) for r in frame.collect()), key=str)


def test_variants_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(spelling, "CHUNK_WORDS", 16)
    draw = random.Random(11)
    words = {}
    for _ in range(60):
        word = "".join(draw.choice("aeiéstnrxÿ÷") for _ in range(draw.randrange(6, 10)))
        for _ in range(draw.randrange(12)):
            words[word] = draw.choice([5, 6, 7, 30, 30, 180, 1000, 40_000])
            at, kind = draw.randrange(len(word)), draw.randrange(3)
            word = word[:at] + draw.choice("aeiéstnrxÿ÷") * (kind > 0) + word[at + (kind < 2) :]
            if len(word) < 6:
                break
    words |= {"long" * 3000: 5, "long" * 3000 + "a": 25, "long" * 2999 + "lang": 125, "anagram": 9, "anagarm": 99}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    want = plain_variants(words)
    assert variants_of(spelling.variant_groups(frame)) == want and sum(r[1] is not None and r[1] != r[2] for r in want) > 3
    assert spelling.variant_groups(frame.limit(0)).count() == 0


def test_neighbour_blocks_cover_every_edit():
    draw = random.Random(2)
    steps = set(spelling.neighbours())
    key = lambda w: (len(w), *[sum(c in g for c in w) for g in spelling.LETTER_GROUPS])
    for _ in range(2000):
        a = "".join(draw.choice("aeiouytnhsrlbcdé") for _ in range(7))
        at, kind = draw.randrange(7), draw.randrange(2)
        b = a[:at] + draw.choice("aeiouytnhsrlbcdé") + a[at + kind :]
        step = tuple(y - x for x, y in zip(key(a), key(b), strict=True))
        assert (step in steps) + (tuple(-x for x in step) in steps) == (2 if not any(step) else 1)


def test_spelling_query_equals_brute_force(spark, tmp_path):
    draw = random.Random(9)
    stock = ["".join(draw.choice("abdeéilmnorstÀ") for _ in range(draw.randrange(4, 11))) for _ in range(60)]
    rows = [(i, " ".join(draw.choice(stock[: 1 + draw.randrange(60)]).capitalize() for _ in range(60)) + draw.choice([" ", "-", "9"])) for i in range(700)]
    rows += [(None, " ".join(stock)), (None, None), (1, None), (2, ""), (3, " ".join(stock) * 30), (4, "x" * 30_000), (5, rows[5][1]), (5, rows[5][1])]
    table(spark, rows).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    counts = {}
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] = counts.get(run, 0) + 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    want = plain_variants(counts)
    assert variants_of(QUERIES["op13_spelling_variants"](spark, str(tmp_path))) == want and sum(r[1] is not None for r in want) > 10
