"""The corpus operators against brute force, on odd rows: nulls, empty and long texts, ties, repeats."""

from __future__ import annotations

import hashlib
import itertools
import heapq
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from swipeline.llm import language, mixing, packing, personal, repeats, simhash, urls, vectors, wordpiece
from swipeline.llm.common import components, numbered
from swipeline.llm.exact import build_index, classes_of, digests, exact_dedup, halves, merge
from swipeline.llm.queries import ORACLES, QUERIES, tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, component string"
SF = "/root/testdata/sf0.001"


def words(rng, n, alphabet="abcdefg"):
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(1, 6))) for _ in range(n))


def odd_rows():
    rng = random.Random(5)
    base = words(rng, 600)
    texts = [None, "", " ", "x", base, base, base, base[:1500], base[:700] + " Z " + base[800:], "é" * 500, "a b " * 400]
    texts += [words(rng, 5) + base[i * 40 : i * 40 + 500] + words(rng, 5) for i in range(20)]
    texts += ["w" * 30_000, words(rng, 3000)]
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s3", None]), 0, "k", "c") for i, t in enumerate(texts)]
    return [*rows, rows[4], (None, base, "en", None, 0, None, None), (7, "other text", "de", "s1", 0, "k", "c")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(odd_rows(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def union_find(pairs, nodes):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components_and_numbers(spark):
    rng = random.Random(2)
    pairs = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)] + [(None, 3), (5, 5)]
    want = union_find([p for p in pairs if None not in p], range(61))
    got = dict(result(components(spark.createDataFrame(pairs, "a long, b long"), "a", "b")))
    assert all(want[n] == c for n, c in got.items())
    assert {n for p in pairs if None not in p and p[0] != p[1] for n in p} == set(got)
    df = spark.range(200).repartition(7)
    assert result(numbered(df, [df["id"].desc()], "n")) == sorted(((i, 199 - i) for i in range(200)), key=str)


def test_packing_takes_every_id_once(docs, empty):
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    rows = [r.asDict() for r in packing.pack(docs, path, window=256, step=4, with_ids=True).collect()]
    tokenizer = Tokenizer.from_file(path)
    want = Counter()
    for doc, text, *_ in odd_rows():
        want[doc, tuple(tokenizer.encode(text or "", add_special_tokens=False).ids) + (2,)] += 1
    pieces: dict = {}
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"]
        pieces.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], tuple(ids.tolist())))
    got = sum((Counter(x for _, p in sorted(v) for x in p) for v in pieces.values()), Counter())
    assert got == sum((Counter({x: c * n for x, c in Counter(ids).items()}) for (_, ids), n in want.items()), Counter())
    assert sum(len(p) for v in pieces.values() for _, p in v) == sum(len(ids) * n for (_, ids), n in want.items())
    by_sequence: dict = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in by_sequence.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 256
    assert packing.pack(empty, path).count() == 0


def test_words_encode_like_whole_texts():
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    texts = ["It's Æon** ÆON´ ßx_ _x a|b <|endoftext|>x don't\x1cfoo 12ab ÀÉ.", "İi éx ́x", None, "ça!!! \x85 q", "x" * 3000]
    whole = Tokenizer.from_file(path)
    for text, raw in zip(texts, packing.WordIds(path).encode(texts), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == whole.encode(text or "", add_special_tokens=False).ids


def test_plan_uses_the_histogram_up():
    rng = np.random.default_rng(1)
    for units in (8, 32):
        histogram = np.r_[0, rng.integers(0, 50, units)]
        used = np.zeros(units + 1, int)
        for classes, n in packing.plan(histogram, units):
            assert sum(classes) <= units
            np.add.at(used, classes, n)
        assert (used == histogram).all()


def test_apportionment_is_by_highest_quotients(spark):
    rng = random.Random(3)
    votes = [rng.randint(1, 500) for _ in range(12)] + [40, 40]
    most = [rng.randint(5, 60) for _ in votes]
    house = 90
    heap, want = [(-v / 1, i, 0) for i, v in enumerate(votes)], [0] * len(votes)
    heapq.heapify(heap)
    while sum(want) < house:
        _, i, s = heapq.heappop(heap)
        if s < most[i]:
            want[i] += 1
            heapq.heappush(heap, (-votes[i] / (2 * s + 3), i, s + 1))
    assert mixing.apportion(np.array(votes, float), np.array(most), house).tolist() == want
    rows = spark.createDataFrame([(i, float(v), m) for i, (v, m) in enumerate(zip(votes, most, strict=True))], "i long, v double, m long")
    got = {r["i"]: r["seats"] for r in mixing.seats(rows, "v", "m", house, "i").collect()}
    assert [got[i] for i in range(len(votes))] == want


def test_mix_meets_targets(docs, empty):
    rows = mixing.mix(docs, block=4, docs_per_shard=3).collect()
    sizes = sorted(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, *_ in odd_rows())
    assert sorted(r["size"] for r in rows) == sizes
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    taken, target = Counter(), {}
    for r in rows:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert abs(sum(target.values()) - sum(sizes)) < 1e-6 * sum(sizes)
    assert all(abs(taken[s] - t) <= 8 for s, t in target.items())
    assert result(mixing.mix(docs, block=4, docs_per_shard=3)) == sorted((tuple(r) for r in rows), key=str)
    assert mixing.mix(empty).count() == 0


def test_token_counts_equal_greedy_matching(docs, empty):
    rng = random.Random(4)
    for _ in range(200):
        pieces = [words(rng, 1, "abc")[:4] for _ in range(rng.randint(1, 14))]
        first, rest = pieces[::2], pieces[1::2]
        automaton = wordpiece.Automaton(first, rest)
        for _ in range(20):
            word = "".join(rng.choice("abc") for _ in range(rng.randint(0, 12)))
            at = n = 0
            while at < len(word):
                size = max((len(p) for p in (rest if at else first) if word.startswith(p, at)), default=0)
                if not size:
                    n = 1
                    break
                at, n = at + size, n + 1
            assert automaton.count(word) == n
    model = tokenizer_path("piece_bpe_32k.model")
    assert wordpiece.token_counts(docs, model).count() == len(odd_rows())
    assert wordpiece.token_counts(empty, model).count() == 0


def test_near_vectors_find_links_and_components(spark):
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((30, 16))
    vectors_ = [(c + 0.05 * rng.standard_normal(16)).tolist() for c in centres for _ in range(rng.integers(1, 9))]
    vectors_ += [(centres[0] + 0.03 * rng.standard_normal(16)).tolist() for _ in range(60)]
    rows = [(i, v, i % 2) for i, v in enumerate(vectors_)]
    n = len(rows)
    rows += [(n, None, 1), (n + 1, [0.0] * 16, 1), (n + 2, [float("nan")] * 16, 1), (n + 3, [None] * 16, 1), (n + 4, vectors_[0], None), (n + 5, vectors_[0], 0), (n + 6, [], 1), (n + 7, [1e300] * 16, 0)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), block=16).collect()}
    unit = {}
    for i, v, y in rows:
        if y is not None and v and None not in v and np.isfinite(v).all() and any(v):
            x = np.array(v) / np.abs(v).max()
            unit[i] = (x / np.linalg.norm(x), y)
    pairs = [(a, b) for a in unit for b in unit if a < b and unit[a][1] == unit[b][1] and unit[a][0] @ unit[b][0] >= 0.98]
    degree, part = Counter(x for p in pairs for x in p), union_find(pairs, [r[0] for r in rows])
    assert got == {i: (degree[i], part[i], part[i] == i) for i, *_ in rows}
    assert vectors.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def links_and_parts(rows):
    unit = np.array([v for _, v, _ in rows])
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    near = unit @ unit.T >= 0.98
    np.fill_diagonal(near, False)
    part = union_find(list(zip(*(x.tolist() for x in np.nonzero(near)))), range(len(rows)))
    return {i: (int(near[i].sum()), part[i]) for i in range(len(rows))}


def vector_rows(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


def test_groups_that_fill_their_lists_still_meet(spark):
    rng = np.random.default_rng(9)
    a, b, far = np.linalg.qr(rng.standard_normal((32, 3)))[0].T
    centres = [a, 0.984 * a + np.sqrt(1 - 0.984**2) * b, far]
    rows = [(i, (c + 0.003 * rng.standard_normal(32)).tolist(), 0) for i, c in enumerate(c for c in centres for _ in range(40))]
    want = links_and_parts(rows)
    assert want[0][0] == 79 and len({p for _, p in want.values()}) == 2
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vectors.near_vectors(vector_rows(spark, rows)).collect()}
    assert got == want


def test_lone_pairs_are_searched_until_recall_is_met(spark):
    rng = np.random.default_rng(10)
    rows = []
    for i in range(600):
        v, w = rng.standard_normal((2, 16))
        rows += [(2 * i, v.tolist(), 0), (2 * i + 1, (v + 0.12 * w).tolist(), 0)]
    want = links_and_parts(rows)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vectors.near_vectors(vector_rows(spark, rows), tables=1, window=1).collect()}
    assert sum(got[i] == want[i] for i in want) >= 0.98 * len(want)


def base_spans(text):
    out = {k: [] for k in ("email", "ip", "card", "phone")}
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out["email"].append(m.span())
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out["ip"].append(m.span())
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 13 <= len(d) <= 19 and sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0:
            out["card"].append(m.span())
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out["phone"].append(m.span())
    return out


def test_personal_data_has_the_base_spans(spark):
    rng = random.Random(8)
    bits = ["a.b@c.de", "@", "x@y", "a@b.c@d.e", "a@b.c_x@y.z", "1.2.3.4.5.6.7.8", "300.1.1.1", "0255.1.01.9", "4111 1111 1111 1111", "4111-1111-1111-1112", "+49 (30) 1234-5678", "+1", "+44 20 7946 0958 ", " ", "é", "😀", "\n", "call ", "7", "-", "iban GB82 WEST 1234 5698 7654 32", "ssn 123-45-6789"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(120)]
    texts += [None, "", "a" * 50_000, "1" * 50_000, "a.b@c.de " * 1200, "1-" * 20_000, "a@" + "b." * 9000 + "c"]
    rows = personal.summary(personal.personal_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = base_spans(texts[r["doc_id"]] or "")
        assert [r[f"n_{k}"] for k in spans] == [len(v) for v in spans.values()], texts[r["doc_id"]]
        joined = ",".join(f"{k}:{a}:{b}" for k, v in spans.items() for a, b in v)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert r["spans"].startswith(joined)
    added = personal.summary(personal.personal_spans(spark.createDataFrame([(1, "my iban GB82 WEST 1234 5698 7654 32, not GB82 WEST 1234 5698 7654 33; ssn 123-45-6789")], "doc_id long, text string"))).first()
    assert added["spans"].endswith("iban:8:35,ssn:74:85")


def test_account_numbers_end_where_their_country_ends_them(spark):
    texts = {
        "GB82 WEST 1234 5698 7654 32 Thanks": ["iban:0:27"],
        "é😀 DE89 3704 0044 0532 0130 00 On 12 May": ["iban:3:30"],
        "GB82 WEST 1234 5698 7654 32 IS mine": ["iban:0:27"],
        "GB82 WEST 1234 5698 7654 32 BIC NWBKGB2L": ["iban:0:27"],
        "DE89370400440532013000 EUR 500": ["iban:0:22"],
        "DE89370400440532013000 GB82 WEST 1234 5698 7654 32 NO93 8601 1117 947": ["iban:0:22", "iban:23:50", "iban:51:69"],
        "FR12 GB82 WEST 1234 5698 7654 32 A": ["iban:5:32"],
        "DE89370400440532013001, DE8937040044053201300, xDE89370400440532013000, DE89370400440532013000x": [],
    }
    rows = personal.summary(personal.personal_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))).collect()
    got = {r["doc_id"]: [x for x in r["spans"].split(",") if x.startswith("iban")] for r in rows}
    assert got == dict(enumerate(texts.values()))


def test_simhash_groups_equal_brute_force(docs, empty, spark):
    rng = random.Random(11)
    base = words(rng, 400).split()
    rows = [(i, t) for i, (_, t, *_) in enumerate(odd_rows())]
    for i in range(60):
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(len(copy))] = "Q" + str(rng.randint(0, 9))
        rows.append((1000 + i, " ".join(copy)))
    fp = {}
    for i, t in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
        shingles = [" ".join(w[j : j + 4]) for j in range(max(1, len(w) - 3))] if w else []
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        fp[i] = sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h)) if h else 0
    part = union_find([(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 4], list(fp))
    got = result(simhash.simhash_groups(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == sorted(((i, f"{fp[i]:016x}", part[i]) for i in fp), key=str)
    assert simhash.simhash_groups(docs).count() == len(odd_rows())
    assert simhash.simhash_groups(empty).count() == 0


def test_simhash_links_rows_without_an_id_and_parts_rows_of_one_id(spark):
    rng = random.Random(5)
    base, other = words(rng, 400).split(), words(rng, 300)
    near = [" ".join(base), " ".join(["Q1"] + base[1:]), " ".join(base[:-1] + ["Q2"])]
    a, b, c = simhash.fingerprints_of(near)
    assert 0 < int(a ^ b).bit_count() <= 4 and 0 < int(a ^ c).bit_count() <= 4
    rows = [(7, near[1]), (None, near[0]), (5, near[2]), (5, other), (None, "alone in its kind, without any id")]
    got = simhash.simhash_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    by_text = {f"{int(fp):016x}": i for i, fp in enumerate(simhash.fingerprints_of([t for _, t in rows]))}
    assert {by_text[r["fingerprint"]]: (r["doc_id"], r["component_id"]) for r in got} == {
        0: (7, 5), 1: (None, 5), 2: (5, 5), 3: (5, 5), 4: (None, None)
    }


def test_golay_keys_meet_within_four_bits():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**64, 4000, dtype=np.uint64)
    b = a.copy()
    for i in range(len(b)):
        for bit in rng.choice(64, rng.integers(0, 5), replace=False):
            b[i] ^= np.uint64(1) << np.uint64(bit)
    keys = [set(zip(*(x.tolist() for x in simhash.keys_of(v.view(np.int64))), strict=True)) for v in (a, b)]
    assert {r for r, _ in keys[0] & keys[1]} == set(range(len(a)))


@pytest.mark.parametrize("split", [s for s in itertools.product(range(5), repeat=3) if sum(s) == 4])
def test_golay_keys_meet_however_the_bits_are_split(split):
    rng = np.random.default_rng(sum(s * 5**i for i, s in enumerate(split)))
    a = rng.integers(0, 2**64, 1500, dtype=np.uint64)
    b = a.copy()
    for i in range(len(b)):
        for first, width, n in zip((0, 23, 46), (23, 23, 18), split, strict=True):
            for bit in rng.choice(width, n, replace=False):
                b[i] ^= np.uint64(1) << np.uint64(first + bit)
    keys = [set(zip(*(x.tolist() for x in simhash.keys_of(v.view(np.int64))), strict=True)) for v in (a, b)]
    assert {r for r, _ in keys[0] & keys[1]} == set(range(len(a)))


def test_golay_keys_are_long_and_few_meet_by_chance():
    fp = np.random.default_rng(2).integers(0, 2**64, 20_000, dtype=np.uint64)
    row, key = simhash.keys_of(fp.view(np.int64))
    assert len(row) < 125 * len(fp)
    _, held = np.unique(key, return_counts=True)
    assert (held * (held - 1) // 2).sum() < 2 * len(fp) ** 2 / 2**20


@pytest.mark.parametrize("hot", [50_000, 2])
def test_repeats_equal_brute_force(docs, empty, hot):
    length = 60
    count = Counter()
    for _, t, *_ in odd_rows():
        raw = (t or "").encode()
        count.update(raw[i : i + length] for i in range(len(raw) - length + 1))
    want = []
    for doc, t, *_ in odd_rows():
        raw = (t or "").encode()
        covered = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - length + 1):
            if count[raw[i : i + length]] > 1:
                covered[i : i + length] = True
        kept = bytes(c for c, x in zip(raw, covered, strict=False) if not x)
        spans = int((np.diff(np.r_[0, covered.astype(int)]) == 1).sum())
        want.append((doc, len(raw), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest()))
    assert result(repeats.remove_repeats(docs, length=length, gram=16, at_once=50, hot=hot)) == sorted(want, key=str)
    assert repeats.remove_repeats(empty).count() == 0


def equal_crc_tail(text, crc):
    """48 letters b and c that give ``text`` the CRC-32: a sum of the changes that single letters make."""
    plain = zlib.crc32((text + "b" * 48).encode())
    basis: dict = {}
    for i in range(48):
        change, places = zlib.crc32((text + "b" * i + "c" + "b" * (47 - i)).encode()) ^ plain, 1 << i
        while change and change.bit_length() in basis:
            change, places = change ^ basis[change.bit_length()][0], places ^ basis[change.bit_length()][1]
        if change:
            basis[change.bit_length()] = (change, places)
    left, chosen = crc ^ plain, 0
    while left:
        change, places = basis[left.bit_length()]
        left, chosen = left ^ change, chosen ^ places
    return "".join("bc"[chosen >> i & 1] for i in range(48))


def test_repeats_tell_rows_without_an_id_apart(spark):
    rng = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyz "
    twice, once = ("".join(rng.choices(letters, k=270)) + " " for _ in range(2))
    once += equal_crc_tail(once, zlib.crc32((twice + "b" * 48).encode()))
    twice += "b" * 48
    assert zlib.crc32(once.encode()) == zlib.crc32(twice.encode())
    rows = [(None, twice), (1, twice), (None, once), (None, None), (None, "short")]
    got = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["n_bytes"], r["n_removed"]) for r in got) == [
        (0, 0, 0), (0, 5, 0), (0, 319, 0), (0, 319, 319), (1, 319, 319)
    ]


def test_urls_by_day(spark):
    pages = spark.createDataFrame(
        [(1, "http://WWW.a.b.example.com:80/x", "2024-01-05"), (2, "https://u@b.example.com", "2024-01-15"), (3, "//example.com", "2024-01-05"), (4, None, "2024-01-05"), (5, "nohost", "2024-01-05"), (6, "http://b.example.com/", None)],
        "page_id long, url string, day string",
    ).selectExpr("page_id", "url", "cast(day as date) fetched")
    changes = spark.createDataFrame(
        [("l1", "b.example.com", "2024-01-01", "add"), ("l1", "b.example.com", "2024-01-10", "remove"), ("l1", "b.example.com", "2024-01-02", "add"), ("l2", "example.com", "2024-01-15", "add"), ("l2", None, "2024-01-01", "add")],
        "list_name string, domain string, day string, action string",
    ).selectExpr("list_name", "domain", "cast(day as date) day", "action")
    got = {r["page_id"]: (r["blocked"], r["lists"], r["entry"]) for r in urls.filter_urls(pages, changes).collect()}
    no = (False, None, None)
    assert got == {1: (True, "l1", "b.example.com"), 2: (True, "l2", "example.com"), 3: no, 4: no, 5: no, 6: no}
    assert urls.filter_urls(pages.limit(0), changes).count() == 0
    assert urls.filter_urls(pages, changes.limit(0)).where("blocked").count() == 0


def test_exact_classes(docs, empty):
    history, incoming = halves(docs)
    groups: dict = {}
    for doc, text, *_ in odd_rows():
        groups.setdefault(text or "", []).append(doc)
    want = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    got = [(a, b, c, bool(d), e) for a, b, c, d, e in result(exact_dedup(incoming, history))]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert result(exact_dedup(docs, empty)) == result(exact_dedup(empty, docs))
    assert exact_dedup(*halves(empty)).count() == 0


def test_exact_buckets_follow_both_sides_and_halves_the_rows(spark):
    far = spark.range(1000).selectExpr("if(id = 0, -1000000000000, id) AS doc_id", "string(id % 700) AS text")
    history, incoming = halves(far)
    assert 400 <= history.count() <= 600
    classes = classes_of(digests(far))
    index, buckets = build_index(classes.limit(0), classes.count(), per_bucket=100)
    assert buckets == 7
    got = {(r["digest"], r["keep_id"], r["group_size"]) for r in merge(index, buckets, classes).collect()}
    assert got == {(r["digest"], r["keep_id"], r["group_size"]) for r in classes.collect()} and len(got) == 700


def test_language_on_held_out_documents(spark, docs, empty):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.identify(table, language.fit(table)).where("held_out").join(table.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in got) >= 0.95 * len(got)
    model = language.fit(docs)
    rows = language.identify(docs, model).collect()
    assert len(rows) == len(odd_rows())
    assert all((r["lang_pred"] == "und") == (r["score"] == 0) and 0 <= r["score"] <= 1 for r in rows)
    assert language.identify(empty, language.fit(empty)).count() == 0
    assert {r["lang_pred"] for r in language.identify(docs, language.fit(empty)).collect()} == {"und"}


def test_forward_backward_equals_enumeration():
    from itertools import product

    rng = np.random.default_rng(2)
    scores, moves = rng.standard_normal((4, 3)), rng.standard_normal((3, 3))
    weight = {p: np.exp(sum(scores[i, y] for i, y in enumerate(p)) + sum(moves[a, b] for a, b in zip(p, p[1:]))) for p in product(range(3), repeat=4)}
    want = np.array([[sum(w for p, w in weight.items() if p[i] == y) for y in range(3)] for i in range(4)]) / sum(weight.values())
    assert np.allclose(language.posteriors(scores, np.array([4]), moves), want)


def test_pipeline_stages(spark, docs):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        rows = out.collect()
        texts = [r["text"] for r in rows]
        if name == "exact_copies":
            assert len({t or "" for t in texts}) == len({t or "" for _, t, *_ in odd_rows()})
        if name == "language_id":
            assert all(any(c.isalpha() for c in t) for t in texts)
            assert len(texts) == sum(any(c.isalpha() for c in t or "") for _, t, *_ in odd_rows())
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_pipeline_keeps_one_row_of_equal_texts(spark, docs):
    rows = odd_rows()
    got = [(r["doc_id"], r["text"] or "") for r in corpus_pipeline.exact_copies(spark, docs, SF).collect()]
    ids: dict = {}
    for doc, text, *_ in rows:
        ids.setdefault(text or "", []).append(-1 if doc is None else doc)
    assert sorted((-1 if d is None else d, t) for d, t in got) == sorted((max(i), t) for t, i in ids.items())


def test_near_copies_keep_one_row_of_each_group(spark):
    rng = random.Random(12)
    base = words(rng, 300).split()
    rows = [(None, " ".join(base)), (5, " ".join(base)), (5, " ".join(base)), (3, words(rng, 200)), (None, words(rng, 90))]
    for i in range(40):
        copy = list(base)
        for at in rng.sample(range(300), rng.randint(1, 12)):
            copy[at] = f"Q{i}"
        rows.append((rng.choice([i, 3, 5, None]), " ".join(copy)))
    rows += [(50 + i, words(rng, 40)) for i in range(5)] + [(60, ""), (61, None), (None, " ")]

    def shingles(text):
        w = (text or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}

    sets = [shingles(t) for _, t in rows]
    alike = [(a, b) for a in range(len(rows)) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    part, groups = union_find(alike, range(len(rows))), {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(part[i], []).append(10**6 if doc is None else doc)
    table = spark.createDataFrame([(i, t, "en", "s", 0, "k", "c") for i, t in rows], DOCS).repartition(3)
    got = corpus_pipeline.near_copies(spark, table, SF).collect()
    where = {t: part[i] for i, (_, t) in enumerate(rows)}
    assert sorted((where[r["text"]], 10**6 if r["doc_id"] is None else r["doc_id"]) for r in got) == sorted((p, min(i)) for p, i in groups.items())


def test_mixture_takes_rows_without_an_id(spark):
    rng = random.Random(13)
    rows = [(rng.choice([None, 1, 2]), words(rng, rng.randint(1, 30)), "en", rng.choice(["a", "b", None]), 0, "k", "c") for _ in range(150)]
    table = spark.createDataFrame(rows, DOCS).repartition(3)
    keyed = table.selectExpr("xxhash64(struct(doc_id, source, text)) doc_id", "source", "text")
    taken = sum(r["taken"] for r in mixing.mix(keyed).collect())
    got = corpus_pipeline.mixture(spark, table, SF).collect()
    assert sum(len(r["text"].split()) for r in got) == taken > 0
    assert any(r["doc_id"] is None for r in got)
    whole = {(r[0], r[3]): [x[1] for x in rows if (x[0], x[3]) == (r[0], r[3])] for r in rows}
    assert all(any(t.startswith(r["text"]) for t in whole[r["doc_id"], r["source"]]) for r in got)


def test_every_query_runs_on_the_smallest_tables(spark):
    import duckdb

    connection = duckdb.connect()
    for name in ("documents", "pages"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    for name, query in QUERIES.items():
        df = query(spark, SF)
        if name in ORACLES:
            order = sorted(df.columns)
            want = connection.sql(ORACLES[name])
            assert sorted(want.columns) == order
            mine = sorted(tuple(str(r[c]) for c in order) for r in df.collect())
            assert mine == sorted(tuple(str(r[want.columns.index(c)]) for c in order) for r in want.fetchall())
        else:
            assert df.count() > 0
