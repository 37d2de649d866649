"""Importance resampling: draw the documents whose word n-grams look most like a target's.

N-grams of one to three words are hashed into buckets (Xie et al., 2023). A bucket's gain is the log of
how much likelier it is in the target, a document's weight the sum of its gains, and a seeded Gumbel
number added to the weight makes the highest scores a draw without replacement.

N-grams are never built as texts. Arrow's kernels split a batch into words and number the distinct
ones; an n-gram is the number of its first words next to the number of its last, and such pairs
are numbered again. The CRC of a pair follows from those of its halves, so it is computed once per
distinct pair, taken by the numbers, and gains are reduced by document. Only bucket counts
leave the tasks before the draw: as many numbers as there are buckets.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swipeline.llm.common import batches_of, numbered, stored

#: What lies between words: ASCII but digits and lower-case letters; the text is lower-cased before.
_GAP = r"[\x00-/:-`{-\x7f]+"
_POLYNOMIAL = 0xEDB88320  # CRC-32, reflected
_SLICE = 2 << 20


@lru_cache(maxsize=1)
def _zeros() -> list[np.ndarray]:
    """For each b what 2^b zero bytes make of a CRC register, by byte of the register: 4 x 256 numbers."""
    byte = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        byte = np.where(byte & 1, (byte >> np.uint32(1)) ^ np.uint32(_POLYNOMIAL), byte >> np.uint32(1))
    one = np.arange(256, dtype=np.uint32)
    # One zero byte: the lowest byte goes through the table, the others move down.
    tables = [np.stack([byte, one, one << np.uint32(8), one << np.uint32(16)])]
    for _ in range(31):
        tables.append(_through(tables[-1], tables[-1]))
    return tables


def _through(table: np.ndarray, register: np.ndarray) -> np.ndarray:
    low = np.uint32(255)
    out = table[0][register & low]
    for k in (1, 2, 3):
        out = out ^ table[k][(register >> np.uint32(8 * k)) & low]
    return out


def joined_crc(first: np.ndarray, second: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of texts put together, from that of the first, and that and the bytes of the second."""
    out, b = first.copy(), 0
    while len(size) and (int(size.max()) >> b):
        long = np.flatnonzero((size >> b) & 1)
        out[long] = _through(_zeros()[b], out[long])
        b += 1
    return out ^ second


def grams(texts: pa.Array, longest: int = 3) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For each n the CRCs of all n-grams and the rows they belong to, ascending; and words per row."""
    split = pc.split_pattern_regex(pc.ascii_lower(texts.fill_null("")), pattern=_GAP)
    words, owner = pc.list_flatten(split), pc.list_parent_indices(split)
    full = pc.greater(pc.binary_length(words), 0)
    words, owner = words.filter(full).dictionary_encode(), owner.filter(full).to_numpy()
    n_words = np.bincount(owner, minlength=len(texts))
    index, names = words.indices.to_numpy().astype(np.int64), words.dictionary.cast(pa.binary())
    crc = np.array([zlib.crc32(w) for w in names.to_pylist()], np.uint32)
    size = pc.binary_length(names).to_numpy().astype(np.int64)
    spaced = joined_crc(np.full(len(crc), zlib.crc32(b" "), np.uint32), crc, size)
    out, number, known = [(crc[index], owner)], index, crc
    for n in range(2, longest + 1):
        at = np.flatnonzero(owner[n - 1 :] == owner[: max(0, len(owner) - n + 1)])
        pairs = pa.array(number[at] * max(1, len(names)) + index[at + n - 1]).dictionary_encode()
        distinct, place = pairs.dictionary.to_numpy(), pairs.indices.to_numpy()
        head, tail = distinct // max(1, len(names)), distinct % max(1, len(names))
        known = joined_crc(known[head], spaced[tail], size[tail] + 1)
        number = np.full(len(owner), -1, np.int64)
        number[at] = place
        out.append((pa.array(known).take(pairs.indices).to_numpy(), owner[at]))
    return out, n_words


def _segments(values: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
    """Sums of the values by their ascending owners."""
    out = np.zeros(rows, np.int64)
    if len(values):
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        out[owner[first]] = np.add.reduceat(values, first)
    return out


def bucket_counts(texts: DataFrame, buckets: int = 10_000) -> np.ndarray:
    """How many features of all rows fall in each bucket; tasks return a row per bucket at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(buckets, np.int64)
        for whole in batches:
            for batch in batches_of(whole, "text", _SLICE):
                for crc, _ in grams(batch.column("text"))[0]:
                    held += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[some])], ["bucket", "n"])

    counted = texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in counted.collect():  # one row per bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the ratio of smoothed shares) of each bucket."""
    s, t, size = source.astype(float), target.astype(float), len(source)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + size) / ((s + 1) * (t.sum() + size)))).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and weight of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for whole in batches:
            for batch in batches_of(whole, "text", _SLICE):
                found, n_words = grams(batch.column("text"))
                weight, features = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
                for crc, owner in found:
                    weight += _segments(gain[crc % np.uint32(len(gain))], owner, batch.num_rows)
                    features += np.bincount(owner, minlength=batch.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n_words, features, weight))],
                    ["doc_id", "n_words", "n_features", "weight"],
                )

    columns = docs.select(F.col("doc_id").cast("long"), "text")
    return columns.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row; rank is null for what is not drawn.

    Draws ``percent`` in a hundred, rounded down, of the rows of at least ``least_words`` words, by
    descending score. Ties go to the smaller doc_id, a null one last, then to fewer features and
    the lower weight; rows that agree in all of these are as good as each other. A null text has no
    words; a null doc_id is hashed as an empty one; repeated rows count and are drawn each. An empty
    table gives no rows, and an empty target gives every bucket its share of nothing. Other
    columns are not read.
    """
    gain = gains(bucket_counts(docs), bucket_counts(target))
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")
    scored = stored(
        weigh(docs, gain)
        .withColumn("score", F.col("weight") + gumbel)
        .withColumn("able", F.col("n_words") >= least_words)
        .drop("n_words"),
        "scored",
    )
    drawn = scored.where("able").count() * percent // 100
    order = [F.col("able").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features").asc(), F.col("weight").asc()]
    rank = F.when(F.col("able") & (F.col("place") < drawn), F.col("place") + 1)
    return numbered(scored, order, "place").select("doc_id", "n_features", "weight", "score", rank.alias("rank"))
