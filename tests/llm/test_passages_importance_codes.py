"""Repeated passages, importance resampling and vector codes against brute force, on odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from swipeline.llm import codes, importance, passages

#: Columns beyond those that are read, by names that the operators use themselves.
DOCS = "doc_id long, text string, a long, lo string, n_words string, words string, place int, bucket string"
VECTORS = "vec_id long, embedding array<float>, label int, part string, entry string, error string, of_label int"


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def prose(rng, n):
    return " ".join(rng.choice("ab cde fg hij kl mnop QR été x9 -- z".split()) for _ in range(n))


def texts_of():
    rng = random.Random(3)
    base = prose(rng, 400)
    shared = prose(rng, 60)
    out = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, base), (6, base), (7, base + " tail"), (8, base.upper())]
    out += [(20 + i, prose(rng, 30) + "\n" + shared + "  " + prose(rng, 30)) for i in range(12)]
    out += [(50, "ha " * 300), (51, "w" * 40_000 + " " + shared), (52, prose(rng, 9000))]
    out += [(53, " ".join(f"u{i}" for i in range(34))), (54, " ".join(f"v{i}" for i in range(35)))]
    out += [(None, base), (None, prose(rng, 80)), (None, shared), (5, base), (5, "other " + shared), (60, "x y " * 9)]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, 7, "lo", "n", "w", 1, "b") for i, t in texts_of()]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.mark.parametrize(("length", "short"), [(35, 9), (12, 3), (8, 8), (5, 1)])
def test_passages_equal_brute_force(docs, length, short):
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in texts_of()]
    count = Counter(tuple(w[k : k + length]) for _, w in split for k in range(len(w) - length + 1))
    want = []
    for i, w in split:
        gone = {k + j for k in range(len(w) - length + 1) if count[tuple(w[k : k + length])] > 1 for j in range(length)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        want.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    assert result(passages.passage_digests(docs, length, short)) == sorted(want, key=str)
    assert any(0 < removed < n for _, n, removed, _ in want)


def test_passages_stop_when_nothing_is_left(spark):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(50))) for i in range(5)]
    got = result(passages.remove_passages(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == [(i, t, 50, 0, t) for i, t in rows]


def test_passages_of_an_empty_table(spark):
    assert passages.remove_passages(spark.createDataFrame([], DOCS)).count() == 0
    with pytest.raises(ValueError, match="shortest"):
        passages.remove_passages(spark.createDataFrame([], DOCS), length=5, short=6)


def features(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return words, [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def test_grams_and_their_crcs():
    texts = [t for _, t in texts_of()]
    found, n_words = importance.grams(pa.array(texts, pa.string()))
    for row, text in enumerate(texts):
        words, grams = features(text)
        got = [int(c) for crc, owner in found for c in crc[owner == row]]
        assert got == [zlib.crc32(g.encode()) for g in grams]
        assert n_words[row] == len(words)


def test_joined_crc_of_long_texts():
    parts = [(b"a", b""), (b"", b"xyz"), (b"head", b"t" * 70_000), (b"\x00\xff", b"\x00" * 33)]
    crc = [np.array([zlib.crc32(x[k]) for x in parts], np.uint32) for k in (0, 1)]
    got = importance.joined_crc(*crc, np.array([len(b) for _, b in parts]))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in parts]


def test_resampling_equals_brute_force(docs, spark):
    target = [prose(random.Random(9), 50), None, "", "ha ha z -- x9"]
    s, t = Counter(), Counter()
    held = [(i, *features(x)) for i, x in texts_of()]
    for _, _, f in held:
        s.update(zlib.crc32(x.encode()) % 10_000 for x in f)
    for x in target:
        t.update(zlib.crc32(f.encode()) % 10_000 for f in features(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000)))) for b in s}
    rows = []
    for i, words, f in held:
        weight = sum(gain[zlib.crc32(x.encode()) % 10_000] for x in f)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(words)))
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0], r[1], r[2]))
    drawn = able[: 40 * len(able) // 100]
    want = [(*r[:4], n + 1) for n, r in enumerate(drawn)] + [(*r[:4], None) for r in able[len(drawn) :]]
    want += [(*r[:4], None) for r in rows if r[4] < 20]
    benchmark = spark.createDataFrame([(x, "s") for x in target], "text string, score string")
    assert result(importance.resample(docs, benchmark, percent=40)) == sorted(want, key=str)
    assert len(drawn) > 3


def test_resampling_of_empty_tables(docs, spark):
    none = spark.createDataFrame([], DOCS)
    assert importance.resample(none, docs).count() == 0
    alone = importance.resample(docs, none)
    assert alone.count() == len(texts_of())
    assert alone.where("rank is not null").count() == 5 * sum(len(features(t)[0]) >= 20 for _, t in texts_of()) // 100


def lloyd(rows, parts=16, entries=64, rounds=2):
    """Plain Python: rows of (vec_id, integers, label)."""
    deep = len(rows[0][1]) // parts
    first = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    book = [[list(r[1][k * deep : (k + 1) * deep]) for r in first] for k in range(parts)]

    def near(v, k):
        part = v[k * deep : (k + 1) * deep]
        return min((sum((x - y) ** 2 for x, y in zip(part, e)), n) for n, e in enumerate(book[k]))

    for _ in range(rounds):
        groups = [defaultdict(list) for _ in range(parts)]
        for _, v, _ in rows:
            for k in range(parts):
                groups[k][near(v, k)[1]].append(v[k * deep : (k + 1) * deep])
        for k in range(parts):
            for n, some in groups[k].items():
                book[k][n] = [sum(c) // len(some) for c in zip(*some)]
    found = [(i, [near(v, k) for k in range(parts)], label) for i, v, label in rows]
    total = Counter()
    for _, f, label in found:
        total[label] += sum(d for d, _ in f)
    sha = hashlib.sha256(",".join(str(c) for p in book for e in p for c in e).encode()).hexdigest()
    return [(i, "".join(f"{n:02x}" for _, n in f), sum(d for d, _ in f), total[label], sha) for i, f, label in found]


@pytest.mark.parametrize("n", [5, 64, 400])
def test_codes_equal_brute_force(spark, n):
    rng = random.Random(n)
    rows = [(i if i % 50 else None, [rng.choice([rng.gauss(0, 0.2), 0.0, -0.5]) for _ in range(32)], rng.choice([1, 2, None])) for i in range(n)]
    rows += [rows[1], rows[2][:2] + (None,), (9000, rows[3][1][:20], 1), (9001, [], 2), (9002, [0.001] * 32, 2)]
    rows += [(9003, [1e6] * 32, 1), (9004, [-3e38] * 32, 1)]
    bad = [(-1, None, 1), (-2, [float("nan")] + [0.0] * 31, 1), (-3, [float("inf")] * 32, None), (-4, [None] + [0.0] * 31, 2)]
    table = spark.createDataFrame([(*r, "p", "e", "x", 0) for r in rows + bad], VECTORS).repartition(4)
    top = 1 << 26
    whole = lambda v: [max(-top, min(top, math.floor(256 * float(np.float32(x))))) for x in v] + [0] * (32 - len(v))
    assert result(codes.codes(table)) == sorted(lloyd([(i, whole(v), label) for i, v, label in rows]), key=str)


def test_nearest_keeps_ties_low_and_sums_exact():
    rng = np.random.default_rng(2)
    for n, size, deep, spread in [(1, 1, 3, 9), (700, 64, 4, 3), (3000, 64, 2, 200), (500, 37, 8, 50), (40, 64, 1, 5)]:
        # Clusters let whole nodes go to one entry, small ranges make many ties.
        centre = rng.integers(-spread, spread, (8, deep)) * 40
        parts = centre[rng.integers(0, 8, n)] + rng.integers(-spread, spread + 1, (n, deep))
        entries = centre[rng.integers(0, 8, size)] + rng.integers(-spread, spread + 1, (size, deep))
        label, counts, sums = codes.nearest(parts, entries)
        want = ((parts[:, None] - entries) ** 2).sum(axis=2).argmin(axis=1)
        assert (label == want).all()
        assert (counts == np.bincount(want, minlength=size)).all()
        assert all((sums[e] == parts[want == e].sum(axis=0)).all() for e in range(size))


def test_codes_of_nothing_and_back(spark):
    none = spark.createDataFrame([], VECTORS)
    assert codes.codes(none).count() == 0
    assert codes.codes(spark.createDataFrame([(1, None, 1, "", "", "", 0)], VECTORS)).count() == 0
    rows = [(i, [float(i), -float(i)] * 16, 1, "", "", "", 0) for i in range(10)]
    table = spark.createDataFrame(rows, VECTORS)
    books = codes.fit(table)
    for r in codes.encode(table, books).collect():
        assert r["error"] == 0
        assert codes.decode(bytes(r["code"]), books).tolist() == [256 * r["vec_id"], -256 * r["vec_id"]] * 16
    with pytest.raises(ValueError, match="256"):
        codes.encode(table, codes.Codebooks(np.zeros((16, 300, 2), np.int64)))
