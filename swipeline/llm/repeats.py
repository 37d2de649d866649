"""Removal of bytes that lie in a long string which also starts somewhere else.

Every string of ``length`` bytes has an anchor: its first run of ``gram`` bytes with the smallest hash.
Equal strings have the same anchor at the same place, so only strings of one anchor can be equal,
and a text's strings fall into runs that share an anchor. A run's context is the text its strings cover.

1. Contexts are grouped by anchor. An anchor that occurs once has no repeat. Contexts that are equal
   as a whole repeat as a whole.
2. The other contexts of an anchor are compared column by column, from the right: each round inserts
   one symbol of every context and updates the Burrows-Wheeler order of the collection and the
   common prefixes of neighbours in it. Contexts are aligned at their anchors, so this is the
   positional form of the transform: strings are equal only in the same column. A string repeats if
   its common prefix with a neighbour reaches ``length``.
3. The bytes that repeated strings cover are removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swipeline.llm.common import batches_of, stored, text_or_empty

_BASE = 0x9E3779B97F4A7C15
_PIECE = 1 << 20  # bytes hashed at once
_PLACE = np.uint64((1 << 21) - 1)
_RUNS = "key long, whole long, doc long, mark long, lo int, n int"
_CONTEXTS = "key long, doc long, mark long, lo int, left int, bytes binary"
_FOUND = "doc long, mark long, lo int, hi int"


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    size = 2 * _PIECE
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


def _hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Mixed 64-bit hashes of all runs of ``gram`` bytes."""
    up, down = _powers()
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data + np.uint64(1)) * up[: len(data)], out=sums[1:])
    h = (sums[gram:] - sums[:-gram]) * down[: len(data) - gram + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` consecutive values, from running minima of blocks of that width."""
    n = len(values)
    blocks = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    blocks[:n] = values
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchored_runs(data: np.ndarray, ends: np.ndarray, length: int, gram: int):
    """(anchor hash, anchor, first string, strings) of the runs in texts laid one after the other.

    ``ends`` are where the texts end; strings across an end are left out.
    """
    none = (np.empty(0, np.uint64),) + (np.empty(0, np.int64),) * 3
    if len(data) < length:
        return none
    h = _hashes(data, gram)
    least = _sliding_least((h & ~_PLACE) | np.arange(len(h), dtype=np.uint64), length - gram + 1)
    anchor = (least & _PLACE).astype(np.int64)
    start = np.arange(len(least))
    end_of = np.repeat(ends, np.diff(ends, prepend=0))[: len(start)]
    inside = start + length <= end_of
    start, anchor = start[inside], anchor[inside]
    if not len(start):
        return none
    first = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)])
    n = np.diff(np.r_[first, len(start)])
    return h[anchor[first]], anchor[first], start[first], n


def _mark(text: bytes) -> int:
    """What Spark's xxhash64 gives for the text."""
    value = xxhash.xxh64_intdigest(text, 42)
    return value - (value >> 63 << 64)


def _pieces(text: bytes, length: int) -> Iterator[tuple[int, bytes]]:
    for at in range(0, max(1, len(text) - length + 1), _PIECE):
        yield at, text[at : at + _PIECE + length - 1]


def runs(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """All runs of every text, with a hash of the whole context."""

    def rows_of(ids: list, texts: list) -> pa.RecordBatch:
        out: list[list] = [[] for _ in range(6)]
        group: list[tuple] = []

        def flush() -> None:
            joined = b"".join(t for *_, t in group)
            ends = np.cumsum([len(t) for *_, t in group])
            keys, _, first, n = anchored_runs(np.frombuffer(joined, np.uint8).astype(np.uint64), ends, length, gram)
            whose = np.searchsorted(ends, first, side="right")
            begins = ends - np.array([len(t) for *_, t in group])
            shift = np.array([at for _, _, at, _ in group]) - begins
            digest, extra = xxhash.xxh3_64_intdigest, length - 1
            whole = [digest(joined[a:b]) for a, b in zip(first.tolist(), (first + n + extra).tolist(), strict=True)]
            values = (
                keys.view(np.int64),
                np.array(whole, np.uint64).view(np.int64),
                np.array([d for d, *_ in group], np.int64)[whose],
                np.array([c for _, c, *_ in group], np.int64)[whose],
                first + shift[whose],
                n,
            )
            for held, value in zip(out, values, strict=True):
                held.append(value)
            group.clear()

        held = 0
        for doc, text in zip(ids, texts, strict=True):
            raw = text.encode("utf-8", "replace")
            if len(raw) < length:
                continue
            mark = _mark(raw)
            for at, piece in _pieces(raw, length):
                if group and held + len(piece) > 2 * _PIECE - length:
                    flush()
                    held = 0
                group.append((doc, mark, at, piece))
                held += len(piece)
        if group:
            flush()
        kinds = [pa.int64()] * 4 + [pa.int32()] * 2
        arrays = [pa.array(np.concatenate(x).astype(k.to_pandas_dtype()) if x else [], k) for x, k in zip(out, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, ["key", "whole", "doc", "mark", "lo", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in batches_of(whole, "text", 4 << 20):
                yield rows_of(batch.column("doc").to_pylist(), batch.column("text").to_pylist())

    return docs.select("doc", "text").mapInArrow(run, _RUNS)


def repeated_columns(contexts: list[bytes], left: np.ndarray, length: int) -> list[np.ndarray]:
    """For each context which of its strings of ``length`` bytes equal one of another context in the
    same column, where context i begins ``left[i]`` columns before the anchor.

    One round per column, from the right. ``order`` sorts the contexts by what follows from the
    column on and ``common[i]`` is how much of it number i of the order shares with number i - 1.
    """
    m = len(contexts)
    size = np.array([len(c) for c in contexts])
    begin = left.max(initial=0) - left
    end = begin + size
    width = int(end.max(initial=0))
    symbols = np.zeros((width, m), np.int16)
    for i, c in enumerate(contexts):
        symbols[begin[i] : end[i], i] = np.frombuffer(c, np.uint8)
    found = [np.zeros(max(0, s - length + 1), bool) for s in size]
    marks = np.zeros((width, m), bool)
    order, common = np.arange(m), np.zeros(m, np.int64)
    for column in range(width - 1, -1, -1):
        # A context that has not begun yet comes first, one that is over last; neither shares a symbol.
        live = (begin <= column) & (column < end)
        symbol = np.where(live, symbols[column], np.where(column >= end, -1, 256))[order]
        place = np.argsort(symbol, kind="stable")
        shared = np.zeros(m, np.int64)
        if m > 1:
            # Between two neighbours of one symbol: one more than the least shared between their old places.
            bounds = np.stack([place[:-1] + 1, place[1:] + 1], axis=1)
            same = symbol[place[1:]] == symbol[place[:-1]]
            bounds = bounds[same].ravel()
            if len(bounds):
                least = np.minimum.reduceat(np.r_[common, 0], bounds)[::2]
                shared[1:][same] = least + 1
        order, common = order[place], shared
        common[~live[order]] = 0
        after = np.r_[common[1:], 0]
        hit = order[(np.maximum(common, after) >= length) & live[order]]
        marks[column, hit] = True
    for i in range(m):
        found[i] = marks[begin[i] : begin[i] + len(found[i]), i]
    return found


def _intervals(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of the runs of true values."""
    edge = np.diff(np.r_[0, hit.astype(np.int8), 0])
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


def _compare(batches: Iterator[pa.RecordBatch], length: int, at_once: int) -> Iterator[pa.RecordBatch]:
    """Contexts come sorted by anchor; those of whole anchors are compared together."""

    def done(rows: list[dict]) -> pa.RecordBatch:
        hits = repeated_columns([r["bytes"] for r in rows], np.array([r["left"] for r in rows]), length)
        out: list[tuple] = []
        for r, hit in zip(rows, hits, strict=True):
            for a, b in zip(*_intervals(hit), strict=True):
                out.append((r["doc"], r["mark"], r["lo"] + int(a), r["lo"] + int(b)))
        columns = list(zip(*out, strict=True)) or [[], [], [], []]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc", "mark", "lo", "hi"])

    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if len(held) >= at_once and row["key"] != held[-1]["key"]:
                yield done(held)
                held = []
            held.append(row)
    if held:
        yield done(held)


def _strings(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Every string of the contexts by a 128-bit hash."""
    for batch in batches:
        for r in batch.to_pylist():
            n = len(r["bytes"]) - length + 1
            digest = [xxhash.xxh3_128_digest(r["bytes"][i : i + length]) for i in range(n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(digest, pa.binary()), pa.array([r["doc"]] * n, pa.int64()), pa.array([r["mark"]] * n, pa.int64()), pa.array(range(r["lo"], r["lo"] + n), pa.int32())],
                ["digest", "doc", "mark", "lo"],
            )


def repeated_strings(docs: DataFrame, length: int, gram: int, at_once: int, hot: int) -> DataFrame:
    """(doc, mark, lo, hi): first and last starts of repeated strings, by text."""
    found = runs(docs, length, gram)
    # Counted before the shuffle, stored and joined back, so that an anchor in every text is no task's
    # group: Spark splits a skewed join only where both sides come straight from their shuffles.
    often = stored(found.groupBy("key").agg(F.count("*").alias("of_key")).where("of_key > 1"), "often")
    known = stored(found.join(often, "key"), "anchors")
    # Stored for the same reason: one context may be that of a third of all runs.
    alike = stored(
        known.groupBy("key", "whole", "n").agg(
            F.count("*").alias("of_whole"), F.max("of_key").alias("of_key"), F.min(F.struct("doc", "mark", "lo")).alias("first")
        ),
        "alike",
    )
    entire = known.join(alike.where("of_whole > 1").select("key", "whole", "n"), ["key", "whole", "n"], "left_semi").select(
        "doc", "mark", "lo", (F.col("lo") + F.col("n") - 1).alias("hi")
    )
    # One of each group of equal contexts stands for them in the comparison.
    open_runs = alike.where("of_key > of_whole").select("key", "n", "of_key", "first.*")
    asked = open_runs.groupBy("doc", "mark").agg(
        F.collect_list(F.struct("key", "lo", "n", (F.col("of_key") > hot).alias("hot"))).alias("runs")
    )
    texts = docs.withColumn("mark", F.xxhash64("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in batches_of(whole, "text", 4 << 20):
                out: list[tuple] = []
                for doc, mark, text, runs_of in zip(*(batch.column(c).to_pylist() for c in ("doc", "mark", "text", "runs")), strict=True):
                    raw = text.encode("utf-8", "replace")
                    for r in runs_of:
                        context = raw[r["lo"] : r["lo"] + r["n"] + length - 1]
                        left = _anchor_in(context, gram, length)
                        out.append((r["key"], doc, mark, r["lo"], left, context, r["hot"]))
                columns = list(zip(*out, strict=True)) or [[]] * 7
                kinds = [pa.int64()] * 3 + [pa.int32()] * 2 + [pa.binary(), pa.bool_()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    ["key", "doc", "mark", "lo", "left", "bytes", "hot"],
                )

    contexts = stored(texts.join(asked, ["doc", "mark"]).select("doc", "mark", "text", "runs").mapInArrow(cut, _CONTEXTS + ", hot boolean"), "contexts")
    ordered = contexts.where("not hot").repartition("key").sortWithinPartitions("key", "doc", "lo")
    compared = ordered.drop("hot").mapInArrow(lambda b: _compare(b, length, at_once), _FOUND)
    # Anchors with more contexts than a task should hold: each string by its own hash, which is as
    # exact and has no group larger than the repeats of one string.
    single = contexts.where("hot").drop("hot").mapInArrow(lambda b: _strings(b, length), "digest binary, doc long, mark long, lo int")
    counts = single.groupBy("digest").count().where("count > 1").select("digest")
    hot_ones = single.join(counts, "digest", "left_semi").select("doc", "mark", "lo", F.col("lo").alias("hi"))
    return entire.union(compared).union(hot_ones)


def _anchor_in(context: bytes, gram: int, length: int) -> int:
    """Where the anchor of a context lies in it: the one that all its strings have."""
    data = np.frombuffer(context, np.uint8).astype(np.uint64)
    h = _hashes(data, gram)[: length - gram + 1]
    return int(((h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)).argmin())


def remove_repeats(docs: DataFrame, length: int = 200, gram: int = 64, at_once: int = 8192, hot: int = 50_000) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row.

    Removes each UTF-8 byte covered by a string of ``length`` bytes that also starts anywhere else,
    in any row or the same one; overlaps count, all strings are judged on the input. Strings don't
    cross rows. A null text is empty; texts shorter than ``length`` stay whole. Rows of one doc_id are
    told apart by 64 bits of a hash of their texts, rows of a null doc_id by 128; equal rows are repeats
    of each other. An empty table gives no rows; other columns are not read.
    """
    # A row without an id goes by a second hash of its text, so that two such rows differ in 128 bits.
    doc = F.coalesce("doc_id", F.xxhash64(F.lit(1), text_or_empty()))
    rows = docs.select("doc_id", doc.alias("doc"), text_or_empty().alias("text"))
    found = repeated_strings(rows.select("doc", "text"), length, gram, at_once, hot)
    spans = found.groupBy("doc", "mark").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in batches_of(whole, "text", 4 << 20):
                out = []
                for text, held in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                    raw = text.encode("utf-8", "replace")
                    if not held:
                        out.append((len(raw), 0, 0, hashlib.sha256(raw).hexdigest()))
                        continue
                    edge = np.zeros(len(raw) + 1, np.int64)
                    np.add.at(edge, [s["lo"] for s in held], 1)
                    np.add.at(edge, [s["hi"] + length for s in held], -1)
                    covered = np.cumsum(edge[:-1]) > 0
                    kept = np.frombuffer(raw, np.uint8)[~covered].tobytes()
                    out.append((len(raw), int(covered.sum()), len(_intervals(covered)[0]), hashlib.sha256(kept).hexdigest()))
                columns = list(zip(*out, strict=True)) or [[]] * 4
                kinds = [pa.int64()] * 3 + [pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")] + [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
                )

    texts = rows.withColumn("mark", F.xxhash64("text"))
    return (
        texts.join(spans, ["doc", "mark"], "left")
        .select("doc_id", "text", "spans")
        .mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    )
