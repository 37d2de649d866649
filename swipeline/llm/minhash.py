"""Near copies by the share of their word shingles: SimHash groups, then MinHash bands, whole sets confirm them.

Two texts are linked if the sets of their shingles have a Jaccard similarity of ``least`` or more. The
SimHash groups of `simhash.link` (fingerprints of the same shingles within four bits, met by Golay keys) propose
first. Four bits of 64 leave out most pairs near 0.8, so what is still apart is met by MinHash too: a text
has 20 keys of 5 minima each, and a pair at 0.8 has no key in common with chance (1 - 0.8^5)^20, one in
2,800, a more similar pair less. Of the texts that share a key but no group, all are compared with one at a time
while groups fall together; then, across the groups left, each with each. Bitmaps of 512 bits, the
parities of the hashes' counts, differ in no more bits than the sets in shingles: pairs that these rule
out are not compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swipeline.llm.common import across, batches_of, beside_hub, components, forget, meeting, stored, text_or_empty, tidy
from swipeline.llm.simhash import _shingle_hashes, fingerprints_from, link

BANDS, MINIMA = 20, 5
#: Longs of a bitmap.
LONGS = 8


def set_of(hashes: list[int]) -> np.ndarray:
    """The distinct hashes, sorted; texts without words share one of their own."""
    return np.unique(np.array(hashes or [0], np.uint64))


def bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """(n, LONGS): a bit is set if an odd number of the set's hashes fall on it."""
    every = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    word = (every >> np.uint64(6)) % np.uint64(LONGS)
    out = np.zeros(len(sets) * LONGS, np.uint64)
    np.bitwise_xor.at(out, row * LONGS + word.astype(np.int64), np.uint64(1) << (every & np.uint64(63)))
    return out.reshape(-1, LONGS).view(np.int64)


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """(n, BANDS) keys of sets of hashes, none of them empty."""
    odd = np.random.default_rng(5).integers(0, 2**63, BANDS * MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    every = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(sets), band + 1, np.uint64)
        for i in range(band * MINIMA, (band + 1) * MINIMA):
            key = (key ^ np.minimum.reduceat(every * odd[i], starts)) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        out[:, band] = key
    return out.view(np.int64)


def _digest():
    return F.unhex(F.sha2(text_or_empty().cast("binary"), 256)).alias("digest")


def _lists(values: np.ndarray) -> pa.Array:
    lists = pa.FixedSizeListArray.from_arrays(pa.array(values.ravel()), values.shape[1])
    return lists.cast(pa.list_(pa.int64()))


def _keyed(docs: DataFrame, shingle: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in batches_of(whole, "text", 2 << 20):
                hashes = [_shingle_hashes(t, shingle) for t in batch.column("text").to_pylist()]
                sets = [set_of(h) for h in hashes]
                size = pa.array([len(s) for s in sets], pa.int64())
                fp = pa.array(fingerprints_from(hashes).view(np.int64))
                columns = [size, fp, _lists(bitmaps(sets)), _lists(band_keys(sets))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("digest"), *columns], ["doc_id", "digest", "size", "fp", "bits", "keys"]
                )

    schema = "doc_id long, digest binary, size long, fp long, bits array<long>, keys array<long>"
    return docs.select("doc_id", _digest(), text_or_empty().alias("text")).mapInArrow(run, schema)


def _sets(nodes: DataFrame, docs: DataFrame, classes: DataFrame, shingle: int) -> DataFrame:
    """(node, held): the shingles' hashes of each of the nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in batches_of(whole, "text", 2 << 20):
                sets = [set_of(_shingle_hashes(t, shingle)).tobytes() for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], ["node", "held"])

    wanted = classes.select("node", "digest").join(nodes.distinct(), "node")
    texts = docs.select(_digest(), text_or_empty().alias("text")).join(wanted, "digest").select("node", "text")
    return texts.mapInArrow(run, "node long, held binary").groupBy("node").agg(F.first("held").alias("held"))


def _confirmed(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """(x, y), the parts of those pairs (a, b, x, y) whose sets are alike enough."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alike = []
            for s, t in zip(batch.column("s").to_pylist(), batch.column("t").to_pylist(), strict=True):
                s, t = np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64)
                both = len(np.intersect1d(s, t, assume_unique=True))
                alike.append(both >= least * (len(s) + len(t) - both))
            yield batch.select(["x", "y"]).filter(pa.array(alike, pa.bool_()))

    rows = pairs.join(sets.select(F.col("node").alias("a"), F.col("held").alias("s")), "a")
    rows = rows.join(sets.select(F.col("node").alias("b"), F.col("held").alias("t")), "b")
    return rows.select("x", "y", "s", "t").mapInArrow(compare, "x long, y long")


def _merged(parts: DataFrame, links: DataFrame) -> DataFrame:
    """``parts`` with those joined that links (x, y) connect."""
    found = components(links, "x", "y").withColumnRenamed("node", "part")
    joined = parts.join(found, "part", "left").withColumn("part", F.coalesce("component", "part"))
    return stored(joined.drop("component"), "parts")


def _near(a: str, b: str, least: float) -> Column:
    """What sets alike to ``least`` fulfil by their sizes and bitmaps; ``a`` and ``b`` are prefixes of columns."""
    size_a, size_b = F.col(a + "size"), F.col(b + "size")
    differ = sum(F.bit_count(F.col(a + "bits")[i].bitwiseXOR(F.col(b + "bits")[i])) for i in range(LONGS))
    most = (size_a + size_b) * F.lit((1 - least) / (1 + least)) + F.lit(1e-6)
    return (F.least(size_a, size_b) >= F.lit(least) * F.greatest(size_a, size_b)) & (differ <= most)


def similar_groups(docs: DataFrame, least: float = 0.8, shingle: int = 5) -> DataFrame:
    """digest, doc_id, part of every distinct text: its SHA-256, smallest doc_id and group.

    A-Z are lower-cased, words are runs without ASCII white space; a text of fewer words is one shingle,
    and texts without words, also nulls, are alike. Links are followed on. An empty table gives no
    rows; other columns than doc_id and text are not read.
    """
    rows = stored(_keyed(docs, shingle), "keys")
    held = [F.first(c).alias(c) for c in ("size", "fp", "bits", "keys")]
    texts = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), *held)
    classes = stored(texts.withColumn("node", F.monotonically_increasing_id()), "classes")
    forget(rows)
    alike = classes.select("node", "fp").join(link(classes.select("fp").distinct()), "fp")
    firsts = alike.groupBy("component").agg(F.min("node").alias("a"))
    pairs = alike.join(firsts, "component").where("node <> a").select("a", F.col("node").alias("b"))
    pairs = stored(pairs.select("a", "b", F.col("a").alias("x"), F.col("b").alias("y")), "pairs")
    tidy(docs.sparkSession)
    banded = classes.select("node", F.explode("keys").alias("key"))
    several = banded.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    shared = stored(banded.join(several, "key"), "shared")
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(shared.select("node"))
    sets = stored(_sets(nodes, docs, classes, shingle), "sets")
    tidy(docs.sparkSession)

    columns = ["node", "part", "size", "bits"]
    parts = _merged(classes.select("digest", "doc_id", *columns[2:], "node", F.col("node").alias("part")), _confirmed(pairs, sets, least))
    rows, turn, more = stored(meeting(shared.join(parts.select(*columns), "node")), "meeting"), 0, True
    while more:
        seen = beside_hub(rows, "node", columns, turn)
        apart = seen.where((F.col("part") != F.col("hub.part")) & _near("", "hub.", least))
        ends = [F.col("hub.node").alias("a"), F.col("node").alias("b"), F.col("hub.part").alias("x"), F.col("part").alias("y")]
        pairs = stored(apart.select(*ends, "n").groupBy("a", "b", "x", "y").agg(F.sum("n").alias("n")), "pairs")
        links = stored(_confirmed(pairs, sets, least), "links")
        parts = _merged(parts, links)
        rows = stored(meeting(seen.select("key", "node").join(parts.select(*columns), "node")), "meeting")
        # The pairs left, judged by those of one row of each key, against the rows left.
        tried, ahead = pairs.agg(F.count("*"), F.sum("n")).first()
        more = (ahead or 0) > 2 * rows.count() and 4 * links.count() > tried
        turn += 1
    left = across(rows, columns, lambda a, b: _near(f"{a}.", f"{b}.", least))
    ends = [F.col(c).alias(n) for c, n in (("a.node", "a"), ("b.node", "b"), ("a.part", "x"), ("b.part", "y"))]
    pairs = stored(left.select(*ends).distinct(), "pairs")
    parts = _merged(parts, _confirmed(pairs, sets, least))
    for done in (sets, shared, classes):
        forget(done)
    tidy(docs.sparkSession)
    return parts.select("digest", "doc_id", "part")
