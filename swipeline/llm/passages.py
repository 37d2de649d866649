"""Removal of words that lie in a long run of words which also starts somewhere else.

Level by level: only what repeats at one length is looked at at twice that length, until the wanted
length is reached or nothing is left. At a short length not all runs are asked for. Every window of the
wanted length has one run of the short length with the smallest hash, the same one wherever the
window stands; a window can only repeat if that run does. So a level counts about two runs in a
window's length, keeps the window starts whose run repeats, and cuts the texts down to them.

Short lengths go by 64-bit hashes, which can let a window through but cannot lose one. Windows of the
wanted length are told apart by the first 128 bits of the SHA-256 of their words. Equal texts are
one text from the first level on, by the first 120 bits of theirs; a text with copies repeats as a whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swipeline.llm.common import batches_of, forget, stored, text_or_empty
from swipeline.llm.repeats import anchored_runs

_AT_ONCE = 1 << 20  # words hashed at a time
_PLACE = ["a", "b", "at"]
_RUNS = "key long, a long, b long, at long, lo long, n long"
_SEGMENTS = "a long, b long, at long, words binary"
_WINDOWS = "d1 long, d2 long, a long, b long, lo long"


def _batch(columns: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.binary() if n == "words" else pa.int64()) for n, c in zip(names, columns, strict=True)], names
    )


def _hashed(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash per word, computed once per distinct word."""
    coded = pa.array(words, pa.binary()).dictionary_encode()
    known = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    return known[coded.indices.to_numpy()]


def _chosen_runs(segments: DataFrame, length: int, short: int) -> DataFrame:
    """For the window starts lo to lo + n - 1 of a text, which share their chosen run, its hash."""
    names = [c.split()[0] for c in _RUNS.split(", ")]

    def flush(group: list[tuple]) -> pa.RecordBatch:
        words = [w for *_, some in group for w in some]
        ends = np.cumsum([len(some) for *_, some in group])
        keys, _, first, n = anchored_runs(_hashed(words), ends, length, short)
        whose = np.searchsorted(ends, first, side="right")
        begins = ends - np.array([len(some) for *_, some in group])
        a, b, at, offset = (np.array([g[k] for g in group], np.int64)[whose] for k in range(4))
        return _batch([keys.view(np.int64), a, b, at, first - begins[whose] + offset, n], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in batches_of(whole, "words", 4 << 20):
                group, held = [], 0
                for a, b, at, raw in zip(*(batch.column(c).to_pylist() for c in (*_PLACE, "words")), strict=True):
                    words = raw.split()
                    for piece in range(0, max(0, len(words) - length + 1), _AT_ONCE):
                        some = words[piece : piece + _AT_ONCE + length - 1]
                        if group and held + len(some) > _AT_ONCE:
                            yield flush(group)
                            group, held = [], 0
                        group.append((a, b, at, at + piece, some))
                        held += len(some)
                if group:
                    yield flush(group)

    return segments.select(*_PLACE, "words").mapInArrow(run, _RUNS)


def _cut(segments: DataFrame, length: int) -> DataFrame:
    """The words under the window starts that are left, a row per gapless range of starts."""
    names = [c.split()[0] for c in _SEGMENTS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in batches_of(whole, "words", 4 << 20):
                out: list[list] = [[] for _ in names]
                for a, b, at, raw, left in zip(*(batch.column(c).to_pylist() for c in (*_PLACE, "words", "left")), strict=True):
                    words, ranges = raw.split(), []
                    for lo, n in sorted((r["lo"], r["n"]) for r in left):
                        if ranges and lo <= ranges[-1][1]:
                            ranges[-1][1] = max(ranges[-1][1], lo + n)
                        else:
                            ranges.append([lo, lo + n])
                    for first, end in ranges:
                        piece = words[first - at : end - at + length - 1]
                        for held, value in zip(out, (a, b, first, b" ".join(piece)), strict=True):
                            held.append(value)
                yield _batch(out, names)

    return segments.mapInArrow(run, _SEGMENTS)


def _windows(segments: DataFrame, length: int) -> DataFrame:
    """Every window that is left, by its digest and its start in the text."""
    names = [c.split()[0] for c in _WINDOWS.split(", ")]

    def flush(digests: list[bytes], places: list[tuple]) -> pa.RecordBatch:
        d = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
        n = [last - first for *_, first, last in places]
        a, b = (np.repeat(np.array([p[k] for p in places], np.int64), n) for k in (0, 1))
        return _batch([d[:, 0], d[:, 1], a, b, np.concatenate([np.arange(*p[2:]) for p in places])], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests, places = [], []
        for whole in batches:
            for batch in batches_of(whole, "words", 1 << 20):
                for a, b, at, raw in zip(*(batch.column(c).to_pylist() for c in (*_PLACE, "words")), strict=True):
                    words = raw.split()
                    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
                    ends = np.cumsum(size) - 1
                    starts, view = ends - size + 1, memoryview(b" ".join(words))
                    n = len(words) - length + 1
                    for first in range(0, n, _AT_ONCE >> 4):
                        last = min(n, first + (_AT_ONCE >> 4))
                        cuts = zip(starts[first:last].tolist(), ends[first + length - 1 : last + length - 1].tolist(), strict=True)
                        digests += [hashlib.sha256(view[x:y]).digest()[:16] for x, y in cuts]
                        places.append((a, b, at + first, at + last))
                        if len(digests) >= _AT_ONCE >> 4:
                            yield flush(digests, places)
                            digests, places = [], []
        if places:
            yield flush(digests, places)

    return segments.select(*_PLACE, "words").mapInArrow(run, _WINDOWS)


def repeated_windows(texts: DataFrame, length: int, short: int) -> DataFrame:
    """(a, b, lo): the windows of ``length`` words that start at another place too, a text by its (a, b).

    ``texts`` has (a, b, at, words); rows of one (a, b) are the same text and count as one.
    """
    segments, size = texts, short
    while size < length:
        found = stored(_chosen_runs(segments, length, size), "runs")
        ends = [f(c).alias(f"{f.__name__}_{c}") for c in ("a", "b", "lo") for f in (F.min, F.max)]
        # At least two places: their smallest and largest differ somewhere. Copies are one place.
        many = F.expr("min_a < max_a or min_b < max_b or min_lo < max_lo")
        often = stored(found.groupBy("key").agg(*ends).where(many).select("key"), "often")
        # Places are made distinct before they are gathered, so a group is no longer than its text.
        places = found.join(often, "key", "left_semi").select(*_PLACE, "lo", "n").distinct()
        left = places.groupBy(*_PLACE).agg(F.collect_list(F.struct("lo", "n")).alias("left"))
        one = segments if segments is not texts else texts.groupBy(*_PLACE).agg(F.first("words").alias("words"))
        after = stored(_cut(one.join(left, _PLACE), length), "segments")
        for table in (found, often) + ((segments,) if segments is not texts else ()):
            forget(table)
        segments, size = after, min(2 * size, length)
        if segments.isEmpty():
            break
    windows = _windows(segments, length)
    again = stored(windows.groupBy("d1", "d2").agg(F.count("*").alias("n")).where("n > 1").select("d1", "d2"), "again")
    return windows.join(again, ["d1", "d2"], "left_semi").select("a", "b", "lo")


def remove_passages(docs: DataFrame, length: int = 35, short: int = 9) -> DataFrame:
    """doc_id, text, n_words, n_removed and kept (the words left, joined by one space) of every row.

    Removes each word that a window of ``length`` words covers which also starts anywhere else, in any
    row or the same one; overlaps count and windows are judged on the input. Words are runs of
    anything but ASCII white space, unchanged; a null text has none, and texts of fewer words than a
    window keep them all. Rows are told apart by their texts, so null and repeated ids are as good as
    others; equal rows are repeats of each other. Whole texts of any length are read. An empty table
    gives no rows; other columns are not read.
    """
    if not 0 < short <= length:
        raise ValueError("the shortest length must lie between one word and the window")
    digest = F.sha2(F.col("text").cast("binary"), 256)
    part = lambda first: F.conv(F.substring(digest, first, 15), 16, 10).cast("long")
    rows = docs.select("doc_id", text_or_empty().alias("text")).withColumns({"a": part(1), "b": part(16)})
    texts = rows.select("a", "b", F.lit(0).cast("long").alias("at"), F.col("text").cast("binary").alias("words"))
    copies = rows.groupBy("a", "b").count().where("count > 1").select("a", "b", F.lit(-1).cast("long").alias("lo"))
    found = repeated_windows(texts, length, short).union(copies)
    marks = found.groupBy("a", "b").agg(F.collect_list("lo").alias("starts"))
    schema = "doc_id long, text string, n_words long, n_removed long, kept string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in batches_of(whole, "text", 4 << 20):
                n_words, n_removed, kept = [], [], []
                for text, starts in zip(batch.column("text").to_pylist(), batch.column("starts"), strict=True):
                    words = text.encode("utf-8", "replace").split()
                    edge = np.zeros(len(words) + 1, np.int64)
                    if starts.is_valid and len(words) >= length:
                        at = starts.values.to_numpy()
                        at = np.arange(len(words) - length + 1) if at.min() < 0 else at
                        np.add.at(edge, at, 1)
                        np.add.at(edge, at + length, -1)
                    stay = np.cumsum(edge[:-1]) == 0
                    n_words.append(len(words))
                    n_removed.append(int((~stay).sum()))
                    kept.append(b" ".join([w for w, s in zip(words, stay.tolist(), strict=True) if s]).decode())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("text"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                    ["doc_id", "text", "n_words", "n_removed", "kept"],
                )

    marked = rows.join(marks, ["a", "b"], "left").select(F.col("doc_id").cast("long"), "text", "starts")
    return marked.mapInArrow(run, schema)


def passage_digests(docs: DataFrame, length: int = 35, short: int = 9) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row; see `remove_passages`."""
    kept = F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    return remove_passages(docs, length, short).select("doc_id", "n_words", "n_removed", kept)
