"""Exact deduplication against a history kept in a minimal perfect hash.

The distinct digests of the history are dealt into buckets of bounded size. A bucket holds a minimal
perfect hash of levelled bit arrays (Limasset et al., 2017): a digest takes the first level on which
it collides with no other, and its slot is the rank of its bit. Slots hold the whole digest, the
locator of the winning row and the size of the class, so a lookup compares all 32 bytes before it
calls a text a repeat. Digests that are not members form classes of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swipeline.llm.common import stored, text_or_empty

INDEX = "bucket long, bits array<binary>, digests binary, winners binary, sizes binary"
CLASSES = "digest binary, keep_id long, group_size long"
_SPACE = 2.0  # bits per key on a level


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest) of every row; a null text is the empty text."""
    return docs.select("doc_id", F.unhex(F.sha2(text_or_empty().cast("binary"), 256)).alias("digest"))


def classes_of(rows: DataFrame) -> DataFrame:
    """One row per distinct digest, combined before the shuffle: largest doc_id and number of rows."""
    return rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))


def _bucketed(classes: DataFrame, buckets: int) -> DataFrame:
    head = F.conv(F.hex(F.substring("digest", 1, 6)), 16, 10).cast("long")
    return classes.withColumn("bucket", head % buckets)


def _words(digest_bytes: np.ndarray) -> np.ndarray:
    """The second quarter of each digest as a number; the first chose the bucket."""
    return digest_bytes[:, 8:16].copy().view("<u8").ravel()


def _position(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    x = keys ^ np.uint64((level * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return (x ^ (x >> np.uint64(29))) % np.uint64(size)


def build_levels(keys: np.ndarray) -> list[np.ndarray]:
    """Bit arrays of the levels for distinct keys; empty for no keys."""
    levels: list[np.ndarray] = []
    while len(keys):
        size = max(64, int(len(keys) * _SPACE))
        at = _position(keys, len(levels), size)
        alone = np.bincount(at.astype(np.int64), minlength=size) == 1
        levels.append(alone)
        keys = keys[~alone[at]]
    return levels


def slots_of(keys: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """The slot of each key, -1 where no level has a bit for it. Any key of the set has its own slot."""
    out, before = np.full(len(keys), -1, np.int64), 0
    for level, bits in enumerate(levels):
        todo = np.flatnonzero(out < 0)
        if not len(todo):
            break
        at = _position(keys[todo], level, len(bits)).astype(np.int64)
        hit = bits[at]
        rank = np.cumsum(bits) - 1
        out[todo[hit]] = before + rank[at[hit]]
        before += int(bits.sum())
    return out


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 32)


def _index_bucket(key: tuple, part: pa.Table) -> pa.Table:
    raw = _matrix(part.column("digest"))
    # Two digests alike in the hashed quarter would never part; such a bucket has no levels and is
    # looked up by whole digests.
    levels = build_levels(_words(raw)) if len(np.unique(_words(raw))) == len(raw) else []
    order = slots_of(_words(raw), levels) if levels else np.arange(len(raw))
    slot = np.empty(len(raw), np.int64)
    slot[order] = np.arange(len(raw))
    column = lambda name: part.column(name).to_numpy().astype("<i8")[slot].tobytes()
    bits = [np.uint32(len(x)).tobytes() + np.packbits(x).tobytes() for x in levels]
    return pa.table(
        {
            "bucket": pa.array([key[0].as_py()], pa.int64()),
            "bits": pa.array([bits], pa.list_(pa.binary())),
            "digests": pa.array([raw[slot].tobytes()], pa.binary()),
            "winners": pa.array([column("keep_id")], pa.binary()),
            "sizes": pa.array([column("group_size")], pa.binary()),
        }
    )


def build_index(history: DataFrame, incoming: int = 0, per_bucket: int = 50_000) -> tuple[DataFrame, int]:
    """The index over the classes of a history, a row per bucket, and the number of buckets.

    Buckets follow the number of distinct digests, of the history or of the ``incoming`` classes that
    will be looked up in it, whichever has more, so each stays at about ``per_bucket`` of either; digests
    spread evenly whatever the texts are.
    """
    classes = stored(history, "classes")
    buckets = max(1, -(-max(classes.count(), incoming) // per_bucket))
    grouped = _bucketed(classes, buckets).groupBy("bucket")
    return stored(grouped.applyInArrow(_index_bucket, INDEX), "index"), buckets


def _merge(key: tuple, index: pa.Table, new: pa.Table) -> pa.Table:
    if index.num_rows:
        row = index.to_pylist()[0]
        held = np.frombuffer(row["digests"], np.uint8).reshape(-1, 32)
        winners = np.frombuffer(row["winners"], "<i8").copy()
        sizes = np.frombuffer(row["sizes"], "<i8").copy()
        levels = [
            np.unpackbits(np.frombuffer(x, np.uint8, offset=4))[: int(np.frombuffer(x[:4], np.uint32)[0])].astype(bool)
            for x in row["bits"]
        ]
    else:
        held, levels = np.empty((0, 32), np.uint8), []
        winners = sizes = np.empty(0, np.int64)
    asked = _matrix(new.column("digest"))
    if len(held) and not levels:
        known = {x.tobytes(): i for i, x in enumerate(held)}
        at = np.array([known.get(x.tobytes(), -1) for x in asked], np.int64)
    else:
        at = slots_of(_words(asked), levels)
    member = at >= 0
    member[member] = (held[at[member]] == asked[member]).all(axis=1)
    ids, counts = new.column("keep_id").to_numpy(), new.column("group_size").to_numpy()
    winners[at[member]] = np.maximum(winners[at[member]], ids[member])
    sizes[at[member]] += counts[member]
    everything = np.concatenate([held, asked[~member]])
    return pa.table(
        {
            "digest": pa.array([x.tobytes() for x in everything], pa.binary()),
            "keep_id": pa.array(np.concatenate([winners, ids[~member]]), pa.int64()),
            "group_size": pa.array(np.concatenate([sizes, counts[~member]]), pa.int64()),
        }
    )


def merge(index: DataFrame, buckets: int, incoming: DataFrame) -> DataFrame:
    """All classes after the incoming ones: repeats join the member they equal, the rest are new."""
    new = _bucketed(incoming, buckets)
    return index.groupBy("bucket").cogroup(new.groupBy("bucket")).applyInArrow(_merge, CLASSES)


def exact_dedup(docs: DataFrame, history: DataFrame) -> DataFrame:
    """Every row of ``history`` and ``docs`` with the class of its text.

    Returns doc_id, keep_id (largest doc_id of equal texts), group_size, kept, text_sha256. Texts are
    equal when identical; null counts as empty; rows of one doc_id count each, and all of them are
    kept if theirs is the winning doc_id. A null doc_id never wins against another. Columns other than doc_id
    and text are not read. Empty tables give no rows.
    """
    old, new = digests(history), digests(docs)
    fresh = stored(classes_of(new), "fresh")
    index, buckets = build_index(classes_of(old), fresh.count())
    classes = stored(merge(index, buckets, fresh), "classes")
    return (
        old.union(new)
        .join(classes, "digest")
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )
    )


def halves(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows up to about the median id, as history, and those after it; null ids are history."""
    middle = docs.agg(F.percentile_approx("doc_id", 0.5)).first()[0]
    early = F.coalesce(F.col("doc_id") <= F.lit(middle).cast("long"), F.lit(True))
    return docs.where(early), docs.where(~early)
