"""Short codes of vectors: a codebook per part of the vector, fitted by Lloyd rounds on two trees.

Components become integers, so every sum and distance is exact. In a task, the parts of a batch form a
tree of boxes with cached sums, the entries of the codebook another. Both are descended together:
bounds on the distance between two boxes drop the pairs that cannot hold a nearest entry. A node left
with one entry goes to it as a whole, by its cached sum; the parts of leaves that stay uncertain
are compared with the entries left to them one by one.

A round is one pass over the vectors. Tasks return a row per entry that they used, Spark adds these up,
and the driver holds one codebook: entries x dimension numbers, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swipeline.llm.common import stored

_LEAF = 16
_TOP = 1 << 26  # integers are held within this, so that no sum of squares leaves 64 bits
_AT_ONCE = 1 << 19  # components in memory at a time


@dataclass
class Codebooks:
    """Integer entries by part, entry and position within the part."""

    entries: np.ndarray

    @property
    def width(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


class Boxes:
    """A balanced tree over points: level l cuts ``order`` into 2^l ranges, each with its bounding box."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.points, self.order = points, np.arange(len(points))
        self.starts, self.low, self.high = [np.array([0, len(points)])], [], []
        self._measure()
        while np.diff(self.starts[-1]).min() >= 2 * leaf:
            old = self.starts[-1]
            widest = (self.high[-1] - self.low[-1]).argmax(axis=1)
            node = np.repeat(np.arange(len(old) - 1), np.diff(old))
            value = points[self.order, widest[node]]
            self.order = self.order[np.lexsort((value, node))]
            halves = np.empty(2 * len(old) - 1, np.int64)
            halves[::2], halves[1::2] = old, (old[:-1] + old[1:]) // 2
            self.starts.append(halves)
            self._measure()
        self.sums = np.zeros((len(points) + 1, points.shape[1]), np.int64)
        np.cumsum(points[self.order], axis=0, out=self.sums[1:])

    def _measure(self) -> None:
        at, sorted_points = self.starts[-1][:-1], self.points[self.order]
        self.low.append(np.minimum.reduceat(sorted_points, at))
        self.high.append(np.maximum.reduceat(sorted_points, at))

    @property
    def depth(self) -> int:
        return len(self.starts) - 1

    def node_of(self) -> np.ndarray:
        """The node of the last level that each place of the order lies in."""
        return np.repeat(np.arange(len(self.starts[-1]) - 1), np.diff(self.starts[-1]))


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entry of each part, parts per entry, their sums); equal distances go to the lower entry."""
    tree, book = Boxes(parts, _LEAF), Boxes(entries, 1)
    # The book's levels, then the single entries in the book's order.
    low = [*book.low, entries[book.order]]
    high = [*book.high, entries[book.order]]
    above = [np.arange(len(x)) // 2 for x in book.low[1:]] + [book.node_of()]
    label = np.empty(len(parts), np.int64)
    counts, sums = np.zeros(len(entries), np.int64), np.zeros_like(entries)
    open_pairs, at, of = np.ones((1, 1), bool), 0, 0
    while True:
        p, e = np.nonzero(open_pairs)
        if not len(p):
            return label, counts, sums
        gap = np.maximum(tree.low[at][p] - high[of][e], low[of][e] - tree.high[at][p])
        reach = np.maximum(tree.high[at][p] - low[of][e], high[of][e] - tree.low[at][p])
        bound = np.full(len(open_pairs), np.iinfo(np.int64).max)
        np.minimum.at(bound, p, (reach * reach).sum(axis=1))
        far = (np.maximum(gap, 0) ** 2).sum(axis=1) > bound[p]
        open_pairs[p[far], e[far]] = False
        last = of == len(low) - 1
        if last:
            sure = np.flatnonzero(open_pairs.sum(axis=1) == 1)
            chosen = book.order[open_pairs[sure].argmax(axis=1)]
            first, end = tree.starts[at][sure], tree.starts[at][sure + 1]
            np.add.at(counts, chosen, end - first)
            np.add.at(sums, chosen, tree.sums[end] - tree.sums[first])
            for a, b, entry in zip(first.tolist(), end.tolist(), chosen.tolist(), strict=True):
                label[tree.order[a:b]] = entry
            open_pairs[sure] = False
        if last and at == tree.depth:
            break
        if not last:
            open_pairs, of = open_pairs[:, above[of]], of + 1
        if at < tree.depth:
            open_pairs, at = np.repeat(open_pairs, 2, axis=0), at + 1
    node = tree.node_of()
    unsure = np.flatnonzero(open_pairs.any(axis=1)[node])
    if len(unsure):
        rows = tree.order[unsure]
        left = np.zeros((len(unsure), len(entries)), bool)
        left[:, book.order] = open_pairs[node[unsure]]
        i, e = np.nonzero(left)
        distance = np.full(left.shape, np.iinfo(np.int64).max)
        distance[i, e] = ((parts[rows[i]] - entries[e]) ** 2).sum(axis=1)
        label[rows] = distance.argmin(axis=1)
        np.add.at(counts, label[rows], 1)
        np.add.at(sums, label[rows], parts[rows])
    return label, counts, sums


def whole_numbers(column: pa.Array, width: int, scale: int = 256) -> np.ndarray:
    """floor(scale * x) of every component, a row per vector; missing components at the end are 0."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = np.clip(flat, -_TOP, _TOP).astype(np.int64)
    return out


def usable(column: str = "embedding") -> Column:
    """True for a vector without null and non-finite components."""
    fine = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine, F.lit(False))


def _slices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    step = max(1, _AT_ONCE // width)
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            some = batch.slice(at, step)
            yield some, whole_numbers(some.column("embedding"), width)


def _round(vectors: DataFrame, books: Codebooks) -> Codebooks:
    shared = vectors.sparkSession.sparkContext.broadcast(books)
    parts, size, deep = books.entries.shape
    sums = [f"s{j}" for j in range(deep)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = shared.value.entries
        counts, total = np.zeros((parts, size), np.int64), np.zeros_like(entries)
        for _, numbers in _slices(batches, parts * deep):
            for k in range(parts):
                _, n, s = nearest(numbers[:, k * deep : (k + 1) * deep], entries[k])
                counts[k] += n
                total[k] += s
        part, entry = np.nonzero(counts)
        columns = [part, entry, counts[part, entry], *total[part, entry].T]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["part", "entry", "n", *sums])

    schema = ", ".join(f"{c} long" for c in ("part", "entry", "n", *sums))
    used = vectors.select("embedding").mapInArrow(run, schema).groupBy("part", "entry")
    after = books.entries.copy()
    for r in used.agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in sums]).collect():  # one row per entry
        after[r["part"], r["entry"]] = [r[c] // r["n"] for c in sums]
    return Codebooks(after)


def fit(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2) -> Codebooks:
    """Codebooks after ``rounds`` Lloyd rounds over all usable rows of ``vectors`` (vec_id, embedding).

    They start from the rows of smallest vec_id; null ids come last, equal ids by their components. The
    width is that of the longest vector, filled up to a multiple of ``parts``. Without rows there are
    no entries.
    """
    good = vectors.where(usable())
    longest = good.agg(F.max(F.size("embedding"))).first()[0] or 0
    deep = max(1, -(-longest // parts))
    first = good.select("vec_id", "embedding").orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries)
    seeds = pa.array([r["embedding"] for r in first.collect()], pa.list_(pa.float64()))
    start = whole_numbers(seeds, parts * deep).reshape(-1, parts, deep).transpose(1, 0, 2).copy()
    books = Codebooks(start)
    for _ in range(rounds if start.size else 0):
        books = _round(good, books)
    return books


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, label, code (a byte per part: the index of its nearest entry) and error (the squared
    distances of the parts to their entries) of every usable row, with up to 256 entries.

    Rows with a null vector, or with a null or non-finite component, are left out. Shorter vectors count
    as filled with zeros, longer ones than ``books`` are not read to their end. Repeated rows and
    null ids are coded each. Other columns are not read; an empty table gives no rows.
    """
    parts, size, deep = books.entries.shape
    if size > 256:
        raise ValueError("a code has one byte per part, so at most 256 entries")
    shared = vectors.sparkSession.sparkContext.broadcast(books)
    schema = "vec_id long, label string, code binary, error long"
    rows = vectors.where(usable() & F.lit(size > 0))
    rows = rows.select(
        F.col("vec_id").cast("long"), F.col("label").cast("string"), F.slice("embedding", 1, parts * deep).alias("embedding")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = shared.value.entries
        for some, numbers in _slices(batches, parts * deep):
            labels, error = np.empty((len(numbers), parts), np.uint8), np.zeros(len(numbers), np.int64)
            for k in range(parts):
                piece = numbers[:, k * deep : (k + 1) * deep]
                near, _, _ = nearest(piece, entries[k])
                labels[:, k] = near
                error += ((piece - entries[k][near]) ** 2).sum(axis=1)
            codes = pa.array([row.tobytes() for row in labels], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [some.column("vec_id"), some.column("label"), codes, pa.array(error)], ["vec_id", "label", "code", "error"]
            )

    return rows.mapInArrow(run, schema)


def decode(code: bytes, books: Codebooks) -> np.ndarray:
    """The integer vector that a code stands for."""
    return np.concatenate([books.entries[k][c] for k, c in enumerate(code)])


def codes(vectors: DataFrame) -> DataFrame:
    """vec_id, code (two hex digits a part), error, label_error (sum over equal labels, nulls
    together) and codebooks_sha256 of every usable row; see `fit` and `encode`."""
    books = fit(vectors)
    coded = stored(encode(vectors, books), "codes")
    totals = coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(totals, F.col("label").eqNullSafe(F.col("of_label"))).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")
    )
