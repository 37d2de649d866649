"""Links of large groups of near fingerprints: whole, without the pairs of a group."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from swipeline.llm import common, simhash


@pytest.fixture()
def made(monkeypatch):
    """The rows that the last joins make."""
    counts = []

    def counted(*args, _across=common.across, **names):
        pairs = _across(*args, **names)
        counts.append(pairs.count())
        return pairs

    monkeypatch.setattr(simhash, "across", counted)
    return counts


def test_a_large_part_is_not_compared_with_itself(spark):
    rows = [(1, i, 0 if i < 200 else i) for i in range(203)] + [(2, 0, 0), (2, 9, 0)]
    met = common.meeting(spark.createDataFrame(rows, "key long, id long, part long"))
    assert {(r["key"], r["n"]) for r in met.collect()} == {(1, 203)}
    seen = common.beside_hub(met, "id", ["id", "part"], 0).collect()
    assert len(seen) == 202 and len({r["hub"]["id"] for r in seen}) == 1
    pairs = common.across(met, ["id", "part"], lambda a, b: F.lit(True)).collect()
    ends = [frozenset((r["a"]["id"], r["b"]["id"])) for r in pairs]
    want = {frozenset((a, b)) for a in range(203) for b in range(200, 203) if a < b}
    assert len(ends) == len(set(ends)) and set(ends) == want


def test_simhash_links_a_large_group_linearly(spark, made):
    rng = np.random.default_rng(7)
    held = {int(rng.integers(0, 2**63))}
    while len(held) < 1500:
        fp = rng.choice(list(held)[:40])
        for bit in rng.choice(63, rng.integers(1, 4), replace=False):
            fp ^= np.int64(1) << np.int64(bit)
        held.add(int(fp))
    lone = {int(x) for x in rng.integers(0, 2**63, 50)} - held
    fps = np.array(sorted(held | lone), np.uint64)
    root = list(range(len(fps)))
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[:i] ^ fps[i]) <= 4):
            a, b = root[i], root[j]
            if a != b:
                root = [min(a, b) if r in (a, b) else r for r in root]
    want = {int(fp): int(fps[r]) for fp, r in zip(fps, root, strict=True)}
    got = simhash.link(spark.createDataFrame([(int(x),) for x in fps], "fp long")).collect()
    assert {r["fp"]: r["component"] for r in got} == want
    assert made and sum(made) <= 107 * len(fps)


@pytest.fixture()
def beside(monkeypatch):
    """The rows that the joins with one row of each key make."""
    counts = []

    def counted(*args, _beside=common.beside_hub, **names):
        rows = _beside(*args, **names)
        counts.append(rows.count())
        return rows

    monkeypatch.setattr(simhash, "beside_hub", counted)
    return counts


def test_keys_of_few_rows_are_compared_once(spark, made, beside):
    rng = np.random.default_rng(11)
    some = rng.integers(0, 2**63, 150, dtype=np.int64)
    # One bit in each segment, so no segment agrees.
    near = some ^ np.int64(1 << 3 | 1 << 30 | 1 << 50)
    fps = [int(x) for x in {*some.tolist(), *near.tolist()}]
    got = {r["fp"]: r["component"] for r in simhash.link(spark.createDataFrame([(x,) for x in fps], "fp long")).collect()}
    assert len(got) == 300 and all(got[int(a)] == got[int(b)] == min(int(a), int(b)) for a, b in zip(some, near, strict=True))
    assert not sum(beside) and made and 150 <= sum(made) <= 107 * 150


def _near_group(rng, size):
    """Distinct fingerprints that each differ in one to three bits from an earlier one, and lone ones."""
    held = [int(rng.integers(0, 2**63))]
    while len(held) < size:
        fp = np.int64(held[int(rng.integers(0, min(len(held), 40)))])
        for bit in rng.choice(63, rng.integers(1, 4), replace=False):
            fp ^= np.int64(1) << np.int64(bit)
        if int(fp) not in held:
            held.append(int(fp))
    return np.array(sorted({*held, *(int(x) for x in rng.integers(0, 2**63, 30))}), np.int64)


def _components(fps):
    """Each fingerprint with the least that links within four bits reach."""
    near = np.bitwise_count(fps.view(np.uint64)[:, None] ^ fps.view(np.uint64)) <= 4
    root = np.arange(len(fps))
    while (least := np.where(near, root, len(fps)).min(axis=1)).tolist() != root.tolist():
        root = least
    return {int(fp): int(fps[r]) for fp, r in zip(fps, root, strict=True)}


def test_simhash_names_the_classes_of_a_large_group_once(spark, monkeypatch):
    fps, named = _near_group(np.random.default_rng(13), 1200), []

    def counted(*args, _relabel=simhash._relabel):
        rows = _relabel(*args)
        named.append(rows.count())
        return rows

    monkeypatch.setattr(simhash, "_relabel", counted)
    got = simhash.link(spark.createDataFrame([(int(x),) for x in fps], "fp long")).collect()
    assert {r["fp"]: r["component"] for r in got} == _components(fps)
    assert named == [len(fps)]


def test_simhash_links_keys_of_several_chunks_and_batches(spark, monkeypatch):
    fps, batch = _near_group(np.random.default_rng(17), 400), "spark.sql.execution.arrow.maxRecordsPerBatch"
    monkeypatch.setattr(simhash, "CHUNK", 10)
    before = spark.conf.get(batch)
    spark.conf.set(batch, 7)
    try:
        got = simhash.link(spark.createDataFrame([(int(x),) for x in fps], "fp long")).collect()
    finally:
        spark.conf.set(batch, before)
    assert {r["fp"]: r["component"] for r in got} == _components(fps)


def test_stars_connect_what_pairs_connect_with_less_than_a_link_a_row():
    fps = _near_group(np.random.default_rng(19), 300)
    first, row = simhash.stars(fps)
    assert len(set(row.tolist())) == len(row) and (first < row).all()
    want = _components(fps)
    assert {int(fps[b]): int(fps[a]) for a, b in zip(first, row, strict=True)} == {x: y for x, y in want.items() if x != y}
    assert [len(x) for x in simhash.stars(fps[:0])] == [0, 0]
