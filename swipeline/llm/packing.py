"""Packing token ids into fixed windows by non-negative least squares over the length histogram.

A document is cut into whole windows and a rest. Rests are classed by length, in steps of ``step``
tokens; the driver holds one count per class and nothing else of the corpus. Shallow combinations of
one to three classes that fill a window are enumerated, and repeat counts x >= 0 are solved for that
make the combinations use the histogram up: min |A x - b| (Krell et al., 2021). Counts are rounded,
and what is left of the histogram is packed greedily, longest first into the tightest room, again as
combinations with repeat counts. The plan is a small table. Pieces are ranked within their class
and take the places of their rank, so no task and no driver sees more than its part.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from swipeline.llm.common import batches_of, stored

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, class int"
PLACES = "class int, first long, last long, sequence long, each long, place int"
_TOKENIZERS: dict[str, object] = {}
#: ASCII marks without the apostrophe and what special tokens are made of.
_MARKS = "".join(map(chr, (*range(33, 39), *range(40, 48), 58, 59, 61, 63, 64, *range(91, 97), 123, 125, 126)))
#: Latin letters that stay one letter when lower-cased.
_LETTERS = "".join(map(chr, (*range(65, 91), *range(97, 123), *range(192, 215), *range(216, 247), *range(248, 256))))


def _listed(column: pa.Array) -> list:
    """The values; by way of NumPy, since ``to_pylist`` makes a scalar of each."""
    return column.to_numpy(zero_copy_only=False).tolist()


class WordIds:
    """Ids of texts as little-endian bytes, looked up by parts of words without ASCII white space.

    The vocabulary drops white space before anything else, so a text's ids are those of its words one
    after the other. Most words are Latin letters, then ASCII marks; such a word is encoded by these
    two parts, letters lower-cased, each of which the vocabulary ends with an id of its own kind. Arrow
    finds the words and parts of all texts given and puts their ids together; only distinct parts, and
    words of another kind, are looked up. Beyond ``room`` parts, those that come up again are kept; beyond
    ``room`` other words a new store is started, and the one before is kept for those that come up again.
    """

    def __init__(self, path: str, room: int = 150_000):
        from tokenizers import Tokenizer, pre_tokenizers

        # A task has a core of its own; threads within it would only wait for each other.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        if path not in _TOKENIZERS:
            tokenizer = Tokenizer.from_file(path)
            last = np.zeros(tokenizer.get_vocab_size() + 1, bool)
            last[[i for token, i in tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
            # Lower-cased parts are normal and cut already; the same model takes them without these steps.
            plain = Tokenizer(tokenizer.model)
            as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), as_bytes])
            _TOKENIZERS[path] = tokenizer, plain, last
        self.tokenizer, self.plain, self.last = _TOKENIZERS[path]
        self.room = room
        self.known: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {"": b""}

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in encoded]

    def _of_parts(self, column: pa.Array) -> pa.Array:
        """The ids of each of the parts, some of which may be alike."""
        found = column.dictionary_encode()
        parts = _listed(found.dictionary)
        if len(self.parts) > self.room:
            self.parts = {"": b""} | {x: self.parts[x] for x in parts if x in self.parts}
        new = [x for x in parts if x not in self.parts]
        for at in range(0, len(new), 500):
            run = new[at : at + 500]
            ids = np.array(self.plain.encode_batch_fast([" ".join(run)], add_special_tokens=False)[0].ids, "<u4")
            ends = ((np.flatnonzero(self.last[ids]) + 1) * 4).tolist()
            raw = ids.tobytes()
            self.parts.update((part, raw[a:b]) for part, a, b in zip(run, [0, *ends[:-1]], ends, strict=True))
        return pa.array(list(map(self.parts.__getitem__, parts)), pa.large_binary()).take(found.indices)

    def _of_odd(self, words: list[bytes]) -> pa.Array:
        """The ids of each of the words, encoded whole."""
        if len(self.known) > self.room:
            self.known, self.before = {}, self.known
        self.known.update((w, self.before[w]) for w in words if w in self.before)
        new = [w for w in words if w not in self.known]
        for at in range(0, len(new), 500):
            run = new[at : at + 500]
            self.known.update((w, ids.tobytes()) for w, ids in zip(run, self._ids([w.decode("utf-8") for w in run]), strict=True))
        return pa.array(list(map(self.known.__getitem__, words)), pa.large_binary())

    def _ids_of_words(self, words: pa.Array) -> pa.Array:
        """The ids of each of the distinct words."""
        letters, marks = pc.utf8_rtrim(words, characters=_MARKS), pc.utf8_ltrim(words, characters=_LETTERS)
        size, head, tail = (pc.binary_length(x).to_numpy() for x in (words, letters, marks))
        # Else the letters hold a mark or the marks a letter, or what is neither.
        plain = (head + tail == size) & (head <= 80) & (tail <= 80)
        parts = [pc.utf8_lower(letters.filter(pa.array(plain))), marks.filter(pa.array(plain))]
        ids, many = self._of_parts(pa.concat_arrays(parts)), len(parts[0])
        odd = self._of_odd(_listed(words.filter(pa.array(~plain)).cast(pa.binary())))
        both = pc.binary_join_element_wise(ids[:many], ids[many:], pa.scalar(b"", pa.large_binary()))
        place = np.where(plain, np.cumsum(plain) - 1, np.cumsum(~plain) - 1 + len(both))
        return pa.concat_arrays([both, odd]).take(pa.array(place))

    def encode(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        if not len(texts):
            return []
        if not isinstance(texts, pa.Array):
            texts = pa.array([(t or "").encode("utf-8", "replace").decode("utf-8") for t in texts], pa.string())
        split = pc.ascii_split_whitespace(texts.fill_null(""))
        found = split.flatten().dictionary_encode()
        ids = self._ids_of_words(found.dictionary).take(found.indices)
        places = np.frombuffer(ids.buffers()[1], np.int64)
        ends = places[np.cumsum(pc.list_value_length(split).to_numpy(), dtype=np.int64)].tolist()
        data = memoryview(ids.buffers()[2] or b"")
        return [bytes(data[a:b]) for a, b in zip([0, *ends[:-1]], ends, strict=True)]


@lru_cache(maxsize=1)
def _words_of(tokenizer: str) -> WordIds:
    """One store for all tasks that a Python worker runs one after the other."""
    return WordIds(tokenizer)


def cut(docs: DataFrame, tokenizer: str, window: int, end_id: int, step: int, with_ids: bool = False) -> DataFrame:
    """The pieces of every document: whole windows from its start, then the rest."""
    schema = PIECES + (", ids binary" if with_ids else "")
    names = StructType.fromDDL(schema).fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, last = _words_of(tokenizer), np.array([end_id], "<u4").tobytes()
        for whole in batches:
            for batch in batches_of(whole, "text", 2 << 20):
                rows: list[list] = [[] for _ in names]
                encoded = words.encode(batch.column("text"))
                for doc, ids in zip(batch.column("doc_id").to_pylist(), encoded, strict=True):
                    ids += last
                    total = len(ids) // 4
                    for start in range(0, total, window):
                        piece = ids[start * 4 : (start + window) * 4]
                        n = len(piece) // 4
                        values = (doc, start, n, zlib.crc32(piece), total, -(-n // step), piece)
                        for held, value in zip(rows, values):  # noqa: B905
                            held.append(value)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(x, pa.binary() if n == "ids" else pa.int32() if n == "class" else pa.int64())
                        for n, x in zip(names, rows, strict=True)
                    ],
                    names,
                )
            pa.default_memory_pool().release_unused()

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def combinations_filling(units: int) -> np.ndarray:
    """All multisets of one to three classes that sum to ``units``, zero for no class."""
    found = [(units, 0, 0)]
    found += [(units - b, b, 0) for b in range(1, units // 2 + 1)]
    found += [
        (units - b - c, b, c)
        for c in range(1, units // 3 + 1)
        for b in range(c, (units - c) // 2 + 1)
    ]
    return np.array(found, np.int64)


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """Lawson and Hanson's active-set method for min |a x - b|, x >= 0."""
    x = np.zeros(a.shape[1])
    free = np.zeros(a.shape[1], bool)
    scale = max(np.abs(b).max(initial=0.0), 1.0)
    for _ in range(rounds):
        gain = a.T @ (b - a @ x)
        gain[free] = -np.inf
        best = int(gain.argmax())
        if gain[best] <= 1e-9 * scale:
            break
        free[best] = True
        while True:
            at = np.flatnonzero(free)
            z = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            low = z <= 1e-12 * scale
            if not low.any():
                x[:] = 0
                x[at] = z
                break
            old = x[at]
            ratio = old[low] / np.maximum(old[low] - z[low], 1e-300)
            x[at] = old + ratio.min() * (z - old)
            drop = at[(x[at] <= 1e-12 * scale) & low]
            x[drop], free[drop] = 0, False
            if not free.any():
                break
    return x


def plan(histogram: np.ndarray, units: int) -> list[tuple[list[int], int]]:
    """(classes of a sequence, repeats) that take every piece of ``histogram[class]``, class 1..units.

    A sequence's classes never sum to more than ``units``.
    """
    left = histogram.astype(np.int64).copy()
    out: list[tuple[list[int], int]] = []
    if units in range(len(left)) and left[units]:
        out.append(([units], int(left[units])))
        left[units] = 0
    used = np.flatnonzero(left)
    if len(used):
        # Only classes that occur can be asked for.
        combos = combinations_filling(units)[1:]
        combos = combos[(left[combos[:, :2]] > 0).all(axis=1) & ((combos[:, 2] == 0) | (left[combos[:, 2]] > 0))]
        if len(combos):
            a = np.zeros((units + 1, len(combos)))
            for j in range(3):
                np.add.at(a, (combos[:, j], np.arange(len(combos))), 1.0)
            repeats = np.rint(nnls(a[used], left[used].astype(float))).astype(np.int64)
            for i in np.argsort(-repeats, kind="stable"):
                classes = [int(c) for c in combos[i] if c]
                need = np.bincount(classes, minlength=units + 1)
                n = int(min(repeats[i], (left[classes] // need[classes]).min()))
                if n > 0:
                    out.append((classes, n))
                    left -= need * n
    return out + _greedy(left, units)


def _greedy(left: np.ndarray, units: int) -> list[tuple[list[int], int]]:
    """Longest first, each filled with the longest classes that still fit, as often as counts allow."""
    out = []
    while left.any():
        classes, room, free = [], units, left.copy()
        while room:
            fits = np.flatnonzero(free[: room + 1])
            if not len(fits):
                break
            top = int(fits[-1])
            many = int(min(free[top], room // top))
            classes += [top] * many
            free[top] -= many
            room -= many * top
        need = np.bincount(classes, minlength=len(left))
        some = np.flatnonzero(need)
        n = int((left[some] // need[some]).min())
        out.append((classes, n))
        left = left - need * n
    return out


def places(steps: list[tuple[list[int], int]]) -> list[tuple]:
    """For each class the ranks [first, last) that a step takes, ``each`` of them per sequence."""
    rows, taken, sequence = [], {}, 0
    for classes, repeats in steps:
        held = sorted(set(classes), reverse=True)
        for place, c in enumerate(held):
            each = classes.count(c)
            first = taken.get(c, 0)
            rows.append((c, first, first + each * repeats, sequence, each, place))
            taken[c] = first + each * repeats
        sequence += repeats
    return rows


def pack(
    docs: DataFrame,
    tokenizer: str,
    window: int = 4096,
    end_id: int = 2,
    step: int = 16,
    with_ids: bool = False,
    slices: int = 512,
) -> DataFrame:
    """Every id of every document in exactly one piece, and each piece's place in a sequence.

    Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids (little-endian
    32-bit) if asked for. Offsets in a sequence have no gaps, sequences hold at most ``window`` ids;
    with the default step padding is about half a percent. A null or empty text is its end id alone.
    Rows of one doc_id, or of none, are packed each on its own. An empty table gives no rows; other
    columns are not read. Reruns give the same rows. ``slices`` splits the ranking of one length
    class over tasks.
    """
    spark, units = docs.sparkSession, window // step
    if window % step:
        raise ValueError("the window must be a multiple of the step")
    pieces = stored(cut(docs, tokenizer, window, end_id, step, with_ids), "pieces")
    marked = pieces.withColumn("slice", F.pmod(F.xxhash64("doc_id", "start"), F.lit(slices)))
    counts = marked.groupBy("class", "slice").count()
    histogram = np.zeros(units + 1, np.int64)
    for row in counts.groupBy("class").agg(F.sum("count").alias("n")).collect():  # one row per class
        histogram[row["class"]] = row["n"]
    steps = spark.createDataFrame(places(plan(histogram, units)), PLACES)
    before = Window.partitionBy("class").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("class", "slice", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("slice", "class").orderBy("doc_id", "start", "ids_crc32")
    ranked = (
        marked.repartition("slice")
        .withColumn("rank", F.row_number().over(inside) - 1)
        .join(F.broadcast(starts), ["class", "slice"])
        .withColumn("rank", F.col("rank") + F.col("base"))
    )
    # The starts have at most classes x slices rows, about 130,000 whatever the input.
    # The plan has at most a few rows per class; its size depends on the window, not on the data.
    placed = ranked.join(
        F.broadcast(steps.withColumnRenamed("class", "c")),
        (F.col("class") == F.col("c")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last")),
    ).withColumn("sequence_id", F.col("sequence") + F.floor((F.col("rank") - F.col("first")) / F.col("each")))
    so_far = Window.partitionBy("sequence_id").orderBy("place", "rank").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(so_far), F.lit(0))).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids
    )
