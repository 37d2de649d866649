"""Near copies of the pipeline: SimHash proposes first, groups are whole, few pairs are compared across them."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from swipeline.llm import common, minhash, simhash


@pytest.fixture()
def made(monkeypatch):
    """The rows that the last joins make."""
    counts = []

    def counted(*args, _across=common.across, **names):
        pairs = _across(*args, **names)
        counts.append(pairs.count())
        return pairs

    monkeypatch.setattr(minhash, "across", counted)
    return counts


def test_bitmaps_rule_out_no_like_sets():
    rng = np.random.default_rng(3)
    base = np.unique(rng.integers(0, 2**64, 400, dtype=np.uint64))
    sets = [base] + [np.unique(np.concatenate([base[n:], rng.integers(0, 2**64, n, dtype=np.uint64)])) for n in range(0, 300, 3)]
    sets += [minhash.set_of([])]
    bits = minhash.bitmaps(sets).view(np.uint64)
    for s, b in zip(sets, bits, strict=True):
        assert np.bitwise_count(b ^ bits[0]).sum() <= len(np.setxor1d(s, sets[0]))
    assert (bits[1] == bits[0]).all()


def test_near_copies_are_met_by_simhash_without_bands(spark, monkeypatch):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(5))
    base = [word() for _ in range(400)]
    whole = " ".join(base)
    ends = [" ".join([f"z{i}", *base[1:]]) for i in range(40)] + [" ".join([*base[:-1], f"z{i}"]) for i in range(40)]
    bits = [int(fp ^ simhash.fingerprints_of([whole], 5)[0]).bit_count() for fp in simhash.fingerprints_of(ends, 5)]
    texts = [t for t, n in zip(ends, bits, strict=True) if 0 < n <= 4][:2] + [whole, " ".join(word() for _ in range(90))]
    assert len(texts) == 4
    monkeypatch.setattr(minhash, "meeting", lambda rows: rows.withColumn("n", F.lit(0)).limit(0))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["part"] for r in minhash.similar_groups(docs).collect()}
    assert got[0] == got[1] == got[2] != got[3]


def test_near_groups_of_many_copies_are_whole(spark, made):
    rng = random.Random(9)
    base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    texts = []
    for i in range(250):
        copy = list(base)
        for at in rng.sample(range(200), rng.randint(1, 8)):
            copy[at] = f"q{i}"
        texts.append(" ".join(copy))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(196)} for t in texts]
    root = list(range(250))
    for a in range(250):
        for b in range(a):
            if root[a] != root[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    got = {r["doc_id"]: r["part"] for r in minhash.similar_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    parts: dict = {}
    for i in range(250):
        parts.setdefault(got[i], set()).add(i)
    assert sorted(map(sorted, parts.values())) == sorted(sorted(i for i in range(250) if root[i] == r) for r in set(root))
    assert made and sum(made) <= 20 * 250
