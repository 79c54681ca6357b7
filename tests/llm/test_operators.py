"""Operators on small tables against plain Python; nulls, empty and long texts, repeated rows, clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from patronage.llm import decontaminate, language, linededup, neardup, packing, personal, quality, records, repetition, sharding
from patronage.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, score string, text_hash string, n_lines string"


def table(spark, rows):
    """Rows of (doc_id, text) with a language and columns that clash with operators' own names."""
    return spark.createDataFrame([(i, t, "en", "x", "y", "z") for i, t in rows], SCHEMA)


def prose(draw, n, stock=400):
    return " ".join(f"w{draw.randrange(stock)}" for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    draw = random.Random(1)
    return table(spark, [
        (1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, prose(draw, 50)), (5, prose(random.Random(1), 50)), (None, "no id here at all"),
        (6, "long " * 50_000), (7, "é日本語 😀 4111 1111 1111 1111"), (8, "a@b.co"), (None, None),
    ])


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, [])


def test_sharding(spark, odd, empty):
    root = sharding.tree(3, 2, 4)
    rows = sharding.shard_documents(odd, root).collect()
    assert len(rows) == odd.count() and sharding.shard_documents(empty, root).count() == 0
    many = sharding.shard_documents(table(spark, [(i, "x" * (i % 7)) for i in range(6000)]), root).collect()
    slots = {}
    for r in many:
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.size == r.doc_id % 7 + 8 and r.text_crc32 == zlib.crc32(b"x" * (r.doc_id % 7))
        assert r.grown_shard in (r.shard, 24)
    assert set(slots) == set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(150 < len(s) < 350 for s in slots.values())
    assert 100 < sum(r.grown_shard == 24 for r in many) < 400


def test_sharding_descends_like_plain_code(spark):
    import math

    def draw(doc_id, node):
        u = (int(hashlib.md5(f"{node.name}/{doc_id}".encode()).hexdigest()[:13], 16) + 0.5) / 16**13
        return math.log(u) / node.weight

    def descend(doc_id, node):
        while node.children:
            node = max(node.children, key=lambda c: draw(doc_id, c)) if len(node.children) > 1 else node.children[0]
        return node.shard

    root = sharding.tree(2, 2, 3)
    for r in sharding.shard_documents(table(spark, [(i, "") for i in range(300)]), root).collect():
        assert (r.shard, r.grown_shard) == (descend(r.doc_id, root), descend(r.doc_id, sharding.grow(root)))


def test_weight_changes_move_documents_only_to_and_from_their_subtree(spark):
    light = sharding.inner("root", [sharding.inner(f"r{k}", [sharding.Node(f"s{2 * k + j}", 1.0, 2 * k + j) for j in (0, 1)]) for k in range(3)])
    heavy = sharding.inner("root", [*light.children[:2], sharding.inner("r2", [sharding.Node("s4", 3.0, 4), light.children[2].children[1]])])
    from pyspark.sql import functions as F

    moved = spark.range(4000).select(sharding.shard_of(F.col("id"), light).alias("a"), sharding.shard_of(F.col("id"), heavy).alias("b")).where("a != b")
    assert moved.count() and all(r.b in (4, 5) for r in moved.collect())


def test_packing(spark, odd, empty):
    path = tokenizer_path("word_bpe_49k.json")
    rows = packing.pack_documents(odd, path, "word", 1).collect()
    assert packing.pack_documents(empty, path, "word", 1).count() == 0
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    expected = []
    for r in odd.collect():
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            expected.append((r.doc_id, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got, key=str) == sorted(expected, key=str)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(sequences) == -(-sum(r.length for r in rows) // 4096)


def test_records(spark, odd, empty):
    path = tokenizer_path("byte_bpe_50k.json")
    rows = records.encode_documents(odd.repartition(3), path, "byte", 0).collect()
    assert records.encode_documents(empty, path, "byte", 0).count() == 0
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    ids = lambda t: [*library.encode(t or "", add_special_tokens=False).ids, 0]
    given = [(r.doc_id, r.text) for r in odd.collect()]
    expected = sorted((str(i), len(ids(t)), zlib.crc32(np.array(ids(t), "<u4").tobytes())) for i, t in given)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in rows) == expected
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    with_id = [r.doc_id for r in sorted(rows, key=lambda r: r.start) if r.doc_id is not None]
    assert with_id == sorted(with_id)


def probability_jaccard(x, y):
    """Of two Counters of shingles, with weights 1 + ln(count)."""
    x, y = ({k: 1 + math.log(n) for k, n in c.items()} for c in (x, y))
    return sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in x.keys() | y.keys()) for i in x.keys() & y.keys())


def jaccard_classes(rows):
    def shingles(text):
        words = re.findall(r"[^\x20\x09-\x0d]+", (text or "").lower())
        return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else Counter({tuple(words)} - {()})

    sets = [(i, shingles(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for x in range(len(sets)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a and b and len(a.keys() & b.keys()) > len(a) / 9 and probability_jaccard(a, b) >= 0.8 - 1e-9:
                parent[max(root(x), root(y))] = min(root(x), root(y))
    groups = {}
    for k, (i, _) in enumerate(sets):
        groups.setdefault(root(k), []).append(i)
    return {i: min(g) for g in groups.values() for i in g}


def test_near_duplicates(spark, odd, empty):
    draw = random.Random(4)
    rows, i = [], 0
    for _ in range(25):
        words = prose(draw, draw.randint(60, 200)).split()
        for _ in range(draw.randint(1, 6)):
            copy = list(words)
            for _ in range(draw.randint(0, 6)):
                copy[draw.randrange(len(copy))] = "changed"
            rows.append((i, " ".join(copy)))
            i += 1
    chain = prose(draw, 300).split()  # near its neighbours only: classes join over many links
    for _ in range(30):
        rows.append((i, " ".join(chain)))
        at = draw.randrange(280)
        chain[at : at + 8] = prose(draw, 8).split()
        i += 1
    rows += [(i, rows[0][1]), (i + 1, "one two"), (i + 2, "One  two\n"), (i + 3, "")]
    draw.shuffle(rows)
    got = {r.doc_id: r.class_id for r in neardup.classes(table(spark, rows)).collect()}
    assert got == jaccard_classes(rows)
    assert neardup.classes(odd).count() == odd.count() and neardup.classes(empty).count() == 0
    kept = neardup.one_of_each(table(spark, [*rows, rows[3]]))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(got.values())) and kept.columns == table(spark, []).columns
    assert neardup.one_of_each(odd).count() == odd.count() - 1


def test_near_duplicates_with_repeated_passages(spark):
    """Equal or nearly equal shingles, some of them repeated: what is repeated alike is near, a fifth 300 times is not."""
    draw, rows = random.Random(12), []
    for k in range(60):
        passage, rest = prose(draw, 20, 10**6), prose(draw, 80, 10**6).split()
        other = list(rest)
        if k % 2:
            other[40] = "changed"
        rows += [(2 * k, " ".join([passage] * 2 + rest)), (2 * k + 1, " ".join([passage] * (3, 5, 300)[k % 3] + other))]
    want = jaccard_classes(rows)
    linked = [sum(want[2 * k + 1] == 2 * k for k in range(c, 60, 3)) for c in range(3)]
    assert linked[0] == 20 and 0 < linked[1] and linked[2] == 0
    assert {r.doc_id: r.class_id for r in neardup.classes(table(spark, rows)).collect()} == want


def test_different_texts_of_one_id_are_judged_each(spark):
    draw = random.Random(13)
    a, b, c, d = (prose(draw, 40, 10**6) for _ in range(4))
    rows = [(1, a), (5, a), (5, b), (6, c), (6, d), (6, d), (6, d + "\n"), (7, c), (8, ""), (8, " "), (8, b)]
    kept = sorted((r.doc_id, r.text.strip()) for r in neardup.one_of_each(table(spark, rows)).collect())
    assert kept == sorted([(1, a), (5, b), (6, c), (6, d), (8, ""), (8, "")])


def line_dedup_by_hand(rows):
    from tests.llm.test_kernels import distance

    strip = " \t\n\x0b\f\r"
    first = {}
    for i, text in sorted(rows):
        for n, line in enumerate(text.split("\n")):
            key = line.strip(strip)
            if key:
                first[key] = min(first.get(key, (i, n)), (i, n))
    near = lambda a, b: a != b and min(len(a), len(b)) >= linededup.LEAST and abs(len(a) - len(b)) <= 2 and distance(a, b) <= 2
    gone, links = set(), {}
    for a in first:
        for b in first:
            if near(a, b):
                links[first[a][0]] = links.get(first[a][0], 0) + 1
                if first[b] < first[a]:
                    gone.add(a)
    keep = lambda i, n, key: not key or first[key] == (i, n) and key not in gone
    return {i: ("\n".join(x for n, x in enumerate(t.split("\n")) if keep(i, n, x.strip(strip))), links.get(i, 0)) for i, t in rows}


def test_line_dedup(spark, odd, empty):
    from tests.llm.test_kernels import edited

    draw = random.Random(6)
    stock = [bytes(draw.choice(b"abc ") for _ in range(draw.randint(5, 40))) for _ in range(60)]
    rows = []
    for i in range(60):
        rows.append((i, "\n".join(edited(draw, draw.choice(stock), 3).decode() for _ in range(draw.randint(0, 6)))))
    done = linededup.dedup_lines(table(spark, rows).repartition(3))
    assert {r.doc_id: (r.text, r.n_links) for r in done.collect()} == line_dedup_by_hand(rows)
    assert sorted(done.columns) == sorted([*table(spark, []).columns, "n_removed", "n_links"])
    assert linededup.dedup_lines(odd).count() == odd.count() and linededup.dedup_lines(empty).count() == 0
    kept = linededup.without_repeated_lines(table(spark, [(1, "the very same line of text"), (2, "the very same line of text"), (3, None), (4, "")]))
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.text) == [(1, "the very same line of text")] and kept.count() == 3


def test_line_dedup_of_short_lines_and_other_scripts(spark):
    draw = random.Random(4)
    stock = ["".join(draw.choice("日本語の文字列aé") for _ in range(draw.choice([3, 6, 19, 20, 21, 22, 30]))) for _ in range(30)]
    rows = []
    for i in range(80):
        made = []
        for _ in range(draw.randint(0, 5)):
            line = list(draw.choice(stock))
            for _ in range(draw.randint(0, 3)):
                line[draw.randrange(len(line))] = draw.choice("日本xy")
            made.append(" " * draw.randint(0, 1) + "".join(line) + draw.choice(["", "\t"]))
        rows.append((i, "\n".join([*made, ""])))
    done = linededup.dedup_lines(table(spark, rows).repartition(3))
    assert {r.doc_id: (r.text, r.n_links) for r in done.collect()} == line_dedup_by_hand(rows)


def test_line_dedup_of_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(linededup, "KEY_LINES", 64)
    monkeypatch.setattr(linededup, "COMPARED_PAIRS", 1000)
    base = "a line that stands in very many documents with small changes"
    rows = [(i, base[:k] + x + base[k:]) for i, (k, x) in enumerate((k, x) for k in range(len(base)) for x in "ABCDEFGHI")][:500]
    done = linededup.dedup_lines(table(spark, rows))
    # one letter put in each: any two are two edits apart at most
    assert {r.doc_id: (r.text, r.n_links) for r in done.collect()} == {i: ("" if i else rows[0][1], 499) for i in range(500)}


def test_line_dedup_keeps_columns_of_any_name(spark):
    names = "_doc string, _kept string, _had string, n_lines string, n_removed string, n_links string, row string, kept string, `a.b` string"
    rows = [(i, t, 10, *[f"{c}{i}" for c in "abcdefghi"]) for i, t in enumerate(["one line\ntwo", "two\nthree", None, "two"])]
    frame = spark.createDataFrame(rows, f"doc_id long, text string, n_chars int, {names}")
    kept = linededup.without_repeated_lines(frame)
    assert kept.schema.simpleString() == frame.schema.simpleString()
    texts = {0: ("one line\ntwo", 10), 1: ("three", 5), 2: (None, 10)}
    assert sorted(tuple(r) for r in kept.collect()) == [(i, *texts[i], *rows[i][3:]) for i in range(3)]
    assert linededup.dedup_lines(frame).count() == 4


def overlaps_by_hand(text, item):
    doc, words = (text or "").lower().split(), item.lower().split()
    m = len(words)
    if m < 5:
        return False
    size = min(13, m)
    allowed = 2 if size >= 13 else 1 if size >= 10 else 0
    for at in range(-m, len(doc) + 1):
        same = [0 <= at + j < len(doc) and doc[at + j] == words[j] for j in range(m)]
        if any(sum(same[a : a + size]) >= size - allowed for a in range(m - size + 1)):
            return True
    return False


def test_decontamination(spark, odd, empty):
    draw = random.Random(5)
    items = [prose(draw, n) for n in (30, 20, 13, 12, 10, 9, 8, 6, 5, 4, 40, 15)]
    docs = []
    for d in range(250):
        words = prose(draw, draw.randint(0, 60)).split()
        if d % 2:
            part = draw.choice(items).split()
            n = min(13, len(part))
            at = draw.randint(0, len(part) - n)
            part = part[at : at + n]
            for j in draw.sample(range(n), min(n, draw.randint(0, 4))):
                part[j] = "other"
            k = draw.randint(0, len(words))
            words = words[:k] + part + words[k:]
        docs.append((d, " ".join(words)))
    benchmark = spark.createDataFrame([*enumerate(items), (99, None), (98, "")], "item_id long, text string")
    rows = decontaminate.find_overlaps(table(spark, docs), benchmark).collect()
    expected = {(d, k) for d, t in docs for k, it in enumerate(items) if overlaps_by_hand(t, it)}
    assert {(r.doc_id, r.item_id) for r in rows} == expected and len(rows) == len(expected)
    kept = decontaminate.without_overlaps(table(spark, docs), benchmark)
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in docs} - {d for d, _ in expected}
    for left, right in ((odd, benchmark), (empty, benchmark), (odd, benchmark.limit(0))):
        assert decontaminate.without_overlaps(left, right).count() == left.count()
    hidden = table(spark, [(None, items[0]), (3, items[0]), (3, "clean text")])
    assert [r.text for r in decontaminate.without_overlaps(hidden, benchmark).collect()] == ["clean text"]


def test_windows_are_hashed_in_compiled_code(spark, monkeypatch):
    frames = {}
    monkeypatch.setattr(decontaminate, "written", lambda frame, purpose: frames.setdefault(purpose, frame))
    item = "one two three four five six seven eight nine ten"
    documents = spark.createDataFrame([(1, f"zero {item.upper()} eleven"), (2, "one two three"), (3, None)], "doc_id long, text string")
    found = decontaminate.find_overlaps(documents, spark.createDataFrame([(7, item)], "item_id long, text string"))
    assert [tuple(r)[:1] + tuple(r)[2:] for r in found.collect()] == [(1, 7, 10, 1, 10)]
    plan = frames["benchmark-hits"]._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode(arrays_zip" in plan


def test_small_written_tables_are_few_files(spark):
    from patronage.llm.common import written

    frame = spark.range(30_000).repartition(50)
    assert len(written(frame, "few", 30_000).inputFiles()) == 2
    assert written(frame.where("id < 0"), "none", 0).isEmpty()
    links = written(spark.range(1, 1000).selectExpr("id AS a", "id + 1 AS b").repartition(40), "test-links")
    labels = neardup.components(links)
    assert len(labels.inputFiles()) == 1
    assert labels.count() == 1000 and labels.select("label").distinct().collect() == [(1,)]


def test_masks_bridge_every_allowed_substitution():
    from itertools import combinations

    for size, most in ((13, 2), (12, 1), (11, 1), (10, 1), (9, 0)):
        for gone in combinations(range(size), most):
            assert any(all(o + p not in gone for p in m) for m in decontaminate.MASKS for o in range(size - max(m)))


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text):
    number = lambda v: re.sub(r"\D", "", v)
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(x) <= 255 for x in v.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda v: 12 <= len(number(v)) <= 19 and luhn(number(v))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 9 <= len(number(v)) <= 15),
    ]
    found = [(m.start(), k, m.end(), n) for k, (n, p, ok) in enumerate(kinds) for m in re.finditer(p, text or "") if ok(m.group())]
    return ",".join(f"{n}:{a}:{b}" for a, _, b, n in sorted(found))


def test_personal_data(spark, odd, empty):
    draw = random.Random(5)
    parts = [
        "a", "b.", "@", "x@y.com", "1", "12", " ", "-", "+", "(", ")", "4111111111111111", "1.2.3.4", "255.1.1.1", "999.1.1.1",
        "\n", "_", "é", "😀", "+1 (886) 555-9674", "4111-1111 1111-1111", "..", "0",
    ]
    texts = [None, "", "a@b.c_d@e.ff", "1.2.3.4.5.6.7.8", "1" * 3000, "a" * 50_000, "1 " * 20_000]
    texts += ["".join(draw.choice(parts) for _ in range(draw.randint(1, 25))) for _ in range(700)]
    got = {r.doc_id: r for r in personal.report(table(spark, list(enumerate(texts))).repartition(4)).collect()}
    for i, text in enumerate(texts):
        expected = base_spans(text)
        assert got[i].base_sha256 == hashlib.sha256(expected.encode()).hexdigest(), (text, expected, got[i].spans)
        assert got[i].n_email == expected.count("email:") and got[i].n_card == expected.count("card:")
    assert personal.report(odd).count() == odd.count() and personal.report(empty).count() == 0


def test_addresses_with_zero_parts(spark):
    texts = ["10.0.0.1", "at 127.0.0.1, 192.168.0.12", "0.0.0.0 000.00.0.000", "0256.0.0.1", "0.0.0.0255", f"{'0' * 4000}.0.0.{'0' * 4000}256"]
    got = {r.doc_id: r for r in personal.report(table(spark, list(enumerate(texts)))).collect()}
    assert [got[i].n_ip for i in range(6)] == [1, 2, 2, 0, 1, 0]
    assert all(got[i].spans == base_spans(t) for i, t in enumerate(texts))


def test_checksums_and_context_decide_on_the_added_kinds(spark):
    texts = [
        "iban DE89 3704 0044 0532 0130 00", "DE89370400440532013001", "social security 123-45-6789", "part 123-45-6789", "GB82 WEST 1234 5698 7654 32.",
    ]
    rows = {r.doc_id: r.spans for r in personal.report(table(spark, list(enumerate(texts)))).collect()}
    assert rows == {0: "iban:5:32", 1: "", 2: "ssn:16:27", 3: "", 4: "iban:0:27"}


def test_language(spark, odd, empty):
    rows = [(i, "the cat sat on the mat and the other thing", "en") for i in range(40)] + [(100 + i, "der hund und die katze in dem haus ist", "de") for i in range(40)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    profiles = language.learn(labelled)
    assert profiles.languages == ("de", "en")
    marked = language.predict(labelled, profiles)
    assert marked.where("lang != lang_pred or lang_score < 0 or lang_score > 1").count() == 0
    seen = {r.doc_id: r.lang_pred for r in language.predict(odd, profiles).where("doc_id is not null").collect()}
    assert [seen[k] for k in (1, 2, 3)] == ["und"] * 3 and seen[4] != "und"
    assert language.predict(empty, profiles).count() == 0
    assert language.predict(odd, language.learn(empty)).where("lang_pred != 'und'").count() == 0
    clash = language.predict(marked, profiles)
    assert clash.columns == marked.columns
    extra = labelled.union(spark.createDataFrame([(900, "123", "en"), (901, None, None), (902, "これは日本語です", None)], labelled.schema))
    assert language.known_language(extra).count() == 80


def test_short_texts_in_known_letters_stay(spark):
    rows = [(i, "the cat sat on the mat and the other thing", "en") for i in range(40)]
    rows += [(100, "a", "en"), (101, "to", "en"), (102, "Moth.", "en"), (103, "Moth. " * 500, "en"), (104, "日本", None), (105, "日本語 " * 500, None)]
    kept = language.known_language(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert sorted(r.doc_id for r in kept.where("doc_id >= 100").collect()) == [100, 101, 102, 103] and kept.where("doc_id < 100").count() == 40


def test_repetition(spark, odd, empty):
    draw = random.Random(8)
    once = prose(draw, 60)
    rows = {r.doc_id: r for r in repetition.judge(table(spark, [(1, once), (2, once + " " + once), (3, "few words"), (4, None)])).collect()}
    assert [(rows[k].base_failed, rows[k].kept) for k in (1, 2, 3, 4)] == [(False, True), (True, False), (True, False), (True, False)]
    assert repetition.judge(odd).count() == odd.count() and repetition.judge(empty).count() == 0


def test_quality(spark, odd, empty):
    draw = random.Random(9)
    good = [(i, prose(draw, 80)) for i in range(300)]
    bad = [(1000 + i, " ".join(w + "###" for w in prose(draw, 80).split())) for i in range(150)]
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good[:150]] + [(i, 0, 0) for i, _ in bad[:50]] + [(None, 1, None), (1, None, None)], "doc_id long, quality int, toxic int")
    rows = quality.score_documents(table(spark, good + bad), labels).collect()
    assert len(rows) == 450 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert np.mean([r.predicted for r in rows if r.doc_id < 1000]) > 0.9 and np.mean([r.predicted for r in rows if r.doc_id >= 1000]) < 0.1
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert quality.score_documents(odd, labels.limit(0)).where("score != 0.5").count() == 0
    assert quality.score_documents(empty, labels).count() == 0


def test_pipeline_keeps_clean_documents(spark, tmp_path):
    import corpus_pipeline

    draw = random.Random(11)
    english = "the cat sat on a mat and the dog ran over to that other house with some green trees".split()
    text = lambda n: " ".join(draw.choice(english) + draw.choice(["", "", "s", "er"]) for _ in range(n))
    clean = [(i, text(120)) for i in range(60)]
    item = text(30)
    copy = clean[0][1].split()
    copy[5] = "changed"
    rows = [*clean, (100, " ".join(copy)), (101, clean[1][1]), (102, text(40) + " " + item), (103, "12345"), (104, None)]
    folder = str(tmp_path)
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    packed = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in packed} == {i for i, _ in clean}
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs_after = stage(spark, docs, folder)
        assert docs_after.columns == docs.columns and docs_after.dtypes == docs.dtypes


def test_near_duplicate_blocks(spark, monkeypatch):
    """Links across classes are the same however many groups a bucket is dealt to."""
    draw = random.Random(9)
    base = list(range(100))
    sets = [sorted(set(draw.sample(base, draw.randint(80, 100)) + [1000 + k])) for k in range(60)]
    labels = [draw.choice([0, 0, 0, k]) for k in range(60)]
    members = spark.createDataFrame([(7, k, labels[k]) for k in range(60)] + [(8, 0, labels[0]), (8, 1, 99)], "band long, node long, label long")
    shingles = spark.createDataFrame([(k, x, None) for k, x in enumerate(sets)], "node long, shingles array<long>, weights array<double>")
    want = {
        (i, j) for j in range(60) for i in range(j)
        if labels[i] != labels[j] and 5 * len({*sets[i]} & {*sets[j]}) >= 4 * len({*sets[i]} | {*sets[j]})
    }
    if 5 * len({*sets[0]} & {*sets[1]}) >= 4 * len({*sets[0]} | {*sets[1]}):
        want.add((0, 1))
    for size in (1 << 16, 700):
        monkeypatch.setattr(neardup, "GROUP_SHINGLES", size)
        assert {(r.a, r.b) for r in neardup.compared(members, shingles).collect()} == want and want


def test_written_tables_and_scans_hold_few_bytes_at_a_time(spark, monkeypatch):
    import glob

    import pyarrow.parquet as pq

    from patronage.llm import common

    common.ship(spark)
    assert spark.conf.get("spark.sql.parquet.columnarReaderBatchSize") == "512"
    monkeypatch.setattr(common, "WRITTEN_BYTES", 1 << 16)
    made = common.written(spark.range(0, 100_000, 1, 1).selectExpr("id", "uuid() AS text"), "row-groups")
    (file,) = made.inputFiles()
    assert pq.ParquetFile(glob.glob(file.removeprefix("file://"))[0]).num_row_groups > 1
    assert made.agg({"id": "sum"}).first()[0] == sum(range(100_000))


def test_ranks_split_a_key_of_equal_rows(spark):
    from pyspark.sql import functions as F

    from patronage.llm.common import dealing, rank_in_groups, written

    rows = spark.range(30_000).select(F.when(F.col("id") < 20_000, 7).alias("k"), F.lit(None).cast("long").alias("doc_id"), dealing("doc_id").alias("_deal"))
    ranked = rank_in_groups(written(rows, "test"), "k", ["doc_id"], "place", rows_per_task=500)
    for key, n in ((7, 20_000), (None, 10_000)):
        found = ranked.where(F.col("k").eqNullSafe(F.lit(key))).agg(F.count_distinct("place"), F.min("place"), F.max("place")).first()
        assert tuple(found) == (n, 0, n - 1)
    assert ranked.columns == ["k", "doc_id", "place"]
    dealt = written(rows, "test").where("k = 7").withColumn("b", F.pmod("_deal", F.lit(40)))  # equal rows, some 500 a bucket
    assert dealt.groupBy("b").count().agg(F.max("count")).first()[0] < 700


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_packing_plan_is_the_grouping_one_and_no_larger_than_best_fit(seed):
    draw = random.Random(seed)
    counts = {}
    for _ in range(4000):
        size = min(4095, int(draw.lognormvariate(6, 1.2)) + 2)
        counts[size] = counts.get(size, 0) + draw.choice([1, 1, 5])
    best = packing.total(packing.best_fit([], counts, 4096))
    grouped = packing.grouped_plan(counts, 4096, 32)
    assert packing.total(packing.plan(counts)) <= best <= packing.total(grouped) * 1.02
    kept = {tuple(sorted(r.sizes)) for r in packing.plan(counts)}
    assert sum(tuple(sorted(r.sizes)) in kept for r in grouped) > len(grouped) / 4


def test_many_addresses_in_one_text(spark):
    import time

    texts = [" ".join(f"email user{i}@host{i % 7}.example.org" for i in range(n)) for n in (50_000, 255, 256, 257, 1)]
    frame = table(spark, list(enumerate(texts)))
    personal.report(frame.limit(1)).collect()
    start = time.perf_counter()
    rows = {r.doc_id: r for r in personal.report(frame).collect()}
    assert time.perf_counter() - start < 20 and rows[0].n_email == 50_000
    for i, text in enumerate(texts):
        assert rows[i].spans == ",".join(f"email:{m.start()}:{m.end()}" for m in re.finditer(r"\S+@\S+", text))
        assert set(rows[i].scores.split(",")) == {"1.00"}


def test_filters_keep_columns_of_any_name(spark):
    from pyspark.sql import functions as F

    names = ["_doc", "_hash", "_known", "known", "row", "lang_pred", "lang_score", "_text_key", "text_key", "class_id", "a.b"]
    draw = random.Random(3)
    rows = [(i, prose(draw, 30, 10**6), "en", *[f"{n}{i}" for n in names]) for i in range(12)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, " + ", ".join(f"`{n}` string" for n in names))
    benchmark = spark.createDataFrame([(1, rows[0][1]), (2, "w1 w2"), (3, " ")], "item_id long, text string")
    for done, kept in (
        (language.known_language(frame), rows), (neardup.one_of_each(frame), rows), (decontaminate.without_overlaps(frame, benchmark), rows[1:]),
    ):
        assert done.schema.simpleString() == frame.schema.simpleString()
        assert sorted(tuple(r) for r in done.collect()) == kept
    short = spark.createDataFrame([(1, " ".join(rows[3][1].split()[4:6]))], "item_id long, text string")
    assert decontaminate.without_overlaps(frame, short).count() == 12
    assert decontaminate.without_overlaps(frame, short, least_words=1).where(F.col("doc_id") == 3).isEmpty()


def test_training_samples_are_bounded_for_equal_rows(spark):
    from pyspark.sql import functions as F

    from patronage.llm.common import unit_hash

    many = spark.range(200_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("the same text").alias("text"))
    assert 150 < many.where(unit_hash("doc_id", "text") < 1e-3).count() < 260
    assert 0 < many.where(unit_hash("doc_id", "text") < 3e-5).count() < 20  # a share is never rounded to nothing
    features = many.select("doc_id", F.array(*[F.lit(float(k)).cast("float") for k in range(len(quality.FEATURES))]).alias("features"))
    features = features.unionByName(spark.createDataFrame([(4, [0.0] * len(quality.FEATURES))], features.schema))
    labels = spark.createDataFrame([(4, 1)], "doc_id long, quality int")
    seen = []
    real = quality.class_prior
    quality.class_prior = lambda p, u: seen.append((len(p), len(u))) or real(p, u)
    try:
        quality.train(features, labels, 1000, 500)
    finally:
        quality.class_prior = real
    assert seen == [(1, 500)]
