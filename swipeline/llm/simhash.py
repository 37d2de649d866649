"""SimHash near-duplicates found through Golay codewords.

The perfect Golay code has a codeword within distance 3 of every 23-bit word. A word's keys are the
codewords within distance 4: one where the nearest is at distance 2 or less, six otherwise. Two words
that differ in at most two bits share a key: if one is within 2 of its codeword, the other is within
4 of it; if both are at distance 3 and share no codeword there, the block of weight 7 through the
three error bits of one and a new bit of the other is within 4 of both.

A fingerprint is cut into two words of 23 bits, S1 and S2, and a rest R of 18, itself of three parts of
6 bits. Of four differing bits

* if none lies in R, one of S1 and S2 has two or fewer: keys (R, key of S1) and (R, key of S2);
* if one lies in R, two parts agree and S1 and S2 have three or fewer together: both have at most two, keys
  (key of S1, key of S2, a part), or one of them has none, keys (S1, two parts) and (S2, two parts);
* if two lie in R, a part agrees and S1 and S2 have at most two each: (key of S1, key of S2, a part);
* else S1 and S2 have at most one together: keys (S1, key of S2) and (key of S1, S2).

Every key has 30 bits or more, so chance meetings stay few: n fingerprints make about n^2 / 2^20 comparisons.
So every pair within four bits meets under a key, and is then compared in full.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swipeline.llm.common import across, batches_of, beside_hub, components, meeting, stored

BITS = 4
#: Keys of up to so many rows are compared in a join.
CROWD = 4
#: Rows of a larger key that are compared at a time.
CHUNK = 1024
_WORD, _REST, _PART = (1 << 23) - 1, (1 << 18) - 1, 6
#: Generator polynomial of the binary Golay code (fixed value).
_GENERATOR = 0b101011100011


def _syndrome(words: np.ndarray) -> np.ndarray:
    """The remainder of 23-bit words by the generator polynomial."""
    rest = words.copy()
    for bit in range(22, 10, -1):
        rest ^= np.where(rest >> bit & 1, _GENERATOR << (bit - 11), 0)
    return rest


@lru_cache(maxsize=1)
def _patterns() -> tuple[np.ndarray, np.ndarray]:
    """For each syndrome the error patterns of weight 4 or less, six at most, and how many there are."""
    found = np.zeros((2048, 6), np.int64)
    count = np.zeros(2048, np.int64)
    for weight in range(5):
        words = np.array([sum(1 << b for b in bits) for bits in combinations(range(23), weight)], np.int64)
        for syndrome, word in zip(_syndrome(words), words, strict=True):
            found[syndrome, count[syndrome]] = word
            count[syndrome] += 1
    return found, count


def golay_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 12-bit codeword indices of each 23-bit word, (n, 6), and how many of them count."""
    patterns, count = _patterns()
    syndrome = _syndrome(words.astype(np.int64))
    return (words[:, None] ^ patterns[syndrome]) >> 11, count[syndrome]


def _shingle_hashes(text: str, size: int) -> list[int]:
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return []
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= size:
        return [digest(joined, 42)]
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-size]])
    return [digest(joined[a:b], 42) for a, b in zip(starts.tolist(), (ends[size - 1 :] - 1).tolist(), strict=True)]


def fingerprints_of(texts: list[str | None], shingle: int = 4) -> np.ndarray:
    """64-bit fingerprints; zero for a text without words."""
    return fingerprints_from([_shingle_hashes(t or "", shingle) for t in texts])


def fingerprints_from(held: list[list[int]]) -> np.ndarray:
    """64-bit fingerprints of texts by the hashes of their shingles, repeats included; zero for none."""
    n = np.array([len(h) for h in held], np.int64)
    out = np.zeros(len(held), np.uint64)
    some = np.flatnonzero(n)
    first = 0
    # Groups of texts of about 2^18 shingles: the matrix of bits stays small.
    while first < len(some):
        last, step = first, 0
        while last < len(some) and (last == first or step + n[some[last]] <= 1 << 18):
            step += n[some[last]]
            last += 1
        group = some[first:last]
        counts = np.zeros((len(group), 64), np.int64)
        if len(group) == 1:
            h = np.array(held[group[0]], np.uint64)
            for at in range(0, len(h), 1 << 18):
                counts[0] += _bits(h[at : at + (1 << 18)]).sum(axis=0, dtype=np.int64)
        else:
            h = np.fromiter((x for i in group for x in held[i]), np.uint64, step)
            starts = np.concatenate([[0], np.cumsum(n[group])[:-1]])
            counts = np.add.reduceat(_bits(h), starts, axis=0, dtype=np.int64)
        over = counts * 2 > n[group][:, None]
        out[group] = np.packbits(over, axis=1, bitorder="little").view("<u8").ravel()
        first = last
    return out


def _bits(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, fp): the fingerprint of every row's whole text as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in batches_of(whole, "text", 4 << 20):
                fp = fingerprints_of(batch.column("text").to_pylist(), shingle).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp)], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


def keys_of(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row number, key): all keys of each fingerprint. The kind of a key is in its high bits."""
    fp = fp.view(np.uint64)
    s1 = (fp & np.uint64(_WORD)).astype(np.int64)
    s2 = (fp >> np.uint64(23) & np.uint64(_WORD)).astype(np.int64)
    rest = (fp >> np.uint64(46) & np.uint64(_REST)).astype(np.int64)
    k1, n1 = golay_keys(s1)
    k2, n2 = golay_keys(s2)
    parts = [rest >> (_PART * i) & ((1 << _PART) - 1) for i in range(3)]
    row = np.arange(len(fp))
    rows, keys = [], []
    for kind, whole in ((0, s1), (3, s2)):
        for at, (p, q) in enumerate(combinations(parts, 2)):
            rows.append(row)
            keys.append((kind + at << 48) + (whole << 2 * _PART) + (p << _PART) + q)
    for kind, k, n, other in ((6, k1, n1, s2), (8, k2, n2, s1)):
        for i in range(6):
            some = n > i
            rows += [row[some]] * 2
            keys.append((kind << 48) + (rest[some] << 12) + k[some, i])
            keys.append((kind + 1 << 48) + (other[some] << 12) + k[some, i])
    for i in range(6):
        for j in range(6):
            some = (n1 > i) & (n2 > j)
            both = (k1[some, i] << 12) + k2[some, j] << _PART
            for at, part in enumerate(parts):
                rows.append(row[some])
                keys.append((10 + at << 48) + both + part[some])
    return np.concatenate(rows), np.concatenate(keys)


def _keyed(classes: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, key = keys_of(batch.column("fp").to_numpy())
            for at in range(0, len(row), 50_000):
                some = pa.array(row[at : at + 50_000])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[at : at + 50_000])] + [batch.column(c).take(some) for c in ("fp", "part")],
                    ["key", "fp", "part"],
                )

    return classes.select("fp", "part").mapInArrow(run, "key long, fp long, part long")


def _near(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= BITS


def stars(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, row): what the pairs of ``fp`` within four bits connect, as links to the first row of each group."""
    fp, left = fp.view(np.uint64), np.arange(len(fp))
    first, rows = [], []
    while len(left):
        start, left = left[0], left[1:]
        ahead = [start]
        while ahead and len(left):
            near = np.bitwise_count(fp[left] ^ fp[ahead.pop()]) <= BITS
            met, left = left[near], left[~near]
            ahead += met.tolist()
            first.append(np.full(len(met), start))
            rows.append(met)
    none = [np.empty(0, np.int64)]
    return np.concatenate(first or none), np.concatenate(rows or none)


def _crowded(rows: DataFrame) -> DataFrame:
    """(x, y): links between the rows (key, fp, n) of a key, fewer than the rows.

    They connect what the key's pairs within four bits do; of a key of more than ``CHUNK`` rows, what the
    pairs of each of its chunks do, which are dealt by hash.
    """
    columns = ["key", "chunk", "fp"]

    def links(fp: np.ndarray, ends: list[int]) -> pa.RecordBatch:
        x, y = [], []
        for first, last in zip(ends, ends[1:], strict=False):
            a, b = stars(fp[first:last])
            x.append(fp[first + a])
            y.append(fp[first + b])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)), pa.array(np.concatenate(y))], ["x", "y"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * len(columns)
        for batch in batches:
            held = [np.concatenate([h, batch.column(c).to_numpy()]) for h, c in zip(held, columns, strict=True)]
            cuts = np.flatnonzero((np.diff(held[0]) != 0) | (np.diff(held[1]) != 0)) + 1
            if len(cuts):
                yield links(held[2], [0, *cuts.tolist()])
                held = [h[cuts[-1] :] for h in held]
        yield links(held[2], [0, len(held[2])])

    chunk = F.pmod(F.xxhash64("key", "fp"), F.ceil(F.col("n") / CHUNK)).cast("long")
    dealt = rows.select("key", chunk.alias("chunk"), "fp").repartition("key", "chunk")
    return dealt.sortWithinPartitions(*columns).mapInArrow(run, "x long, y long")


def link(classes: DataFrame) -> DataFrame:
    """(fp, component): every pair of the distinct fingerprints ``fp`` within four bits ends in one
    component, named by its least fingerprint.

    The classes of a key are compared in a join up to ``CROWD``, else in chunks of about ``CHUNK``, each of
    which gives fewer links than it has rows. One search for components then joins all of them to parts,
    and only keys of more than a chunk and of several parts go on: all classes are compared with one of
    their key at a time, which then leaves the key, while many links are to be expected. One join finds
    the rest. All but this join is linear in the rows.
    """
    parts = classes.select("fp", F.col("fp").alias("part"))
    rows, turn = stored(meeting(_keyed(parts)), "meeting"), 0
    links = _paired(rows.where(F.col("n") <= CROWD)).union(_crowded(rows.where(F.col("n") > CROWD)))
    many = rows.where(F.col("n") > CHUNK)
    joined = components(links, "x", "y")
    if many.isEmpty():
        return _relabel(parts, joined).select("fp", F.col("part").alias("component"))
    joined = stored(joined, "joined")
    parts = stored(_relabel(parts, joined), "parts")
    rows = stored(meeting(_relabel(many.drop("n"), joined, "key")), "meeting")
    ahead = not rows.isEmpty()
    while ahead:
        seen = beside_hub(rows, "fp", ["fp", "part"], turn)
        links = seen.where((F.col("part") != F.col("hub.part")) & _near("fp", "hub.fp"))
        found = stored(links.select(F.col("part").alias("x"), F.col("hub.part").alias("y"), "n"), "found")
        joined = stored(components(found, "x", "y"), "joined")
        parts = stored(_relabel(parts, joined), "parts")
        rows = stored(meeting(_relabel(seen.select("key", "fp", "part"), joined, "key")), "meeting")
        # The links left, judged by those of one row of each key, against the rows left.
        ahead = (found.agg(F.sum("n")).first()[0] or 0) > 2 * rows.count()
        turn += 1
    return _relabel(parts, components(_paired(rows), "x", "y")).select("fp", F.col("part").alias("component"))


def _paired(rows: DataFrame) -> DataFrame:
    """(x, y): the parts of the pairs of rows of one key within four bits."""
    pairs = across(rows, ["fp", "part"], lambda a, b: _near(f"{a}.fp", f"{b}.fp"))
    return pairs.select(F.col("a.part").alias("x"), F.col("b.part").alias("y"))


def _relabel(parts: DataFrame, found: DataFrame, *more: str) -> DataFrame:
    return parts.join(found, parts["part"] == found["node"], "left").select(
        *more, "fp", F.coalesce("component", "part").alias("part")
    )


def simhash_groups(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row.

    A-Z are lower-cased, words are runs without ASCII white space, shingles of ``shingle`` words are
    joined by a space, repeats included; a text of fewer words is one shingle. Bits set in over half
    of the XXH64 values (seed 42) are set. A text without words, also a null, has fingerprint zero
    and is linked like any other. Rows link where fingerprints differ in at most four bits;
    component_id is the smallest doc_id reachable, so repeated rows fall together. Fingerprints are
    what is linked, so rows of a null doc_id link and bridge like others, and rows of one doc_id with
    unlike texts stay apart unless linked; a component without any id has a null one. An empty table
    gives no rows; texts of any length are read whole; further columns are not read.
    """
    rows = stored(fingerprints(docs, shingle), "fingerprints")
    classes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    linked = stored(link(classes), "linked")
    named = classes.join(linked, "fp").groupBy("component").agg(F.min("least").alias("component_id"))
    return rows.join(linked.join(named, "component"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
