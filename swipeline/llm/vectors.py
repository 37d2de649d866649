"""Near-duplicate vectors by NN-descent.

A graph of neighbour lists starts from sorted signatures of random hyperplanes and is refined by
joining it to itself: neighbours of neighbours become neighbours if they are nearer than the worst of
a full list. Lists that are full of links (saturated) may hide more of them. Inside a component all pairs
are compared, in blocks that only count, so no pair leaves a task. Towards others, nodes of components
with saturated lists get a second list, of vectors of other components only, refined the same way, until
no components meet any more.

Then a sample is compared with every vector. While too few of its vectors have all their links within
their component, the search goes on with twice as many orders of signatures.

Only edges above cos(2 theta) are followed, theta the angle of the threshold: two linked vectors have
their common near neighbours within it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from swipeline.llm.common import components, forget, stored

_EDGE = "src long, dst long, cos double"
_SIGNED = "kind long, label string, sign long, rep long, part long, unit binary"


def units(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, unit) of every row; unit, the vector's direction as little-endian doubles, is null for
    what can't be compared: null, empty or zero vectors, null or non-finite components, null labels."""

    def direction(vector: list | None) -> bytes | None:
        if not vector or any(x is None for x in vector):
            return None
        v = np.array(vector, np.float64)
        top = np.abs(v).max()
        if not np.isfinite(top) or top == 0:
            return None
        v /= top  # so that squares neither overflow nor vanish
        return ((v / np.sqrt(v @ v)) + 0.0).astype("<f8").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column("label")
            vectors = batch.column("embedding").to_pylist()
            out = [None if y is None else direction(v) for v, y in zip(vectors, labels.to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), labels, pa.array(out, pa.binary())], ["vec_id", "label", "unit"])

    rows = embeddings.select("vec_id", F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>"))
    return rows.mapInArrow(run, "vec_id long, label string, unit binary")


def _matrix(column) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), "<f8").reshape(len(values), -1)


def _signed(classes: DataFrame, tables: int, seed: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = np.array([len(x) // 8 for x in batch.column("unit").to_pylist()])
            for size in np.unique(sizes):
                part = batch.take(pa.array(np.flatnonzero(sizes == size)))
                planes = np.random.default_rng([seed, int(size)]).standard_normal((int(size), 32 * tables))
                bits = (_matrix(part.column("unit")) @ planes > 0).reshape(len(part), tables, 32)
                signs = np.packbits(bits, axis=2).view(">u4")[:, :, 0].astype(np.int64)
                for t in range(tables):
                    kind = pa.array(np.full(len(part), t * 100_000 + size))
                    yield pa.RecordBatch.from_arrays(
                        [kind, part.column("label"), pa.array(signs[:, t]), part.column("rep"), part.column("part"), part.column("unit")],
                        ["kind", "label", "sign", "rep", "part", "unit"],
                    )

    return classes.select("rep", "part", "label", "unit").mapInArrow(run, _SIGNED)


def _met(batches: Iterator[pa.RecordBatch], floor: float, window: int) -> Iterator[pa.RecordBatch]:
    """Edges of ordered rows to the ``window`` rows before their stretch of one part."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = pa.Table.from_batches([batch])
        if held is not None:
            now = pa.concat_tables([held, now])
        rows = now.to_pydict()
        group = np.unique(np.array([f"{a} {b}" for a, b in zip(rows["kind"], rows["label"])]), return_inverse=True)[1]
        ids, part = np.array(rows["rep"], np.int64), np.array(rows["part"], np.int64)
        old = 0 if held is None else held.num_rows
        length = np.array([len(u) for u in rows["unit"]])
        unit = np.zeros((len(ids), max(length, default=0) // 8))
        for size in np.unique(length):
            some = np.flatnonzero(length == size)
            unit[some, : size // 8] = np.frombuffer(b"".join(rows["unit"][i] for i in some), "<f8").reshape(len(some), -1)
        new = np.r_[True, (part[1:] != part[:-1]) | (group[1:] != group[:-1])]
        start = np.maximum.accumulate(np.where(new, np.arange(len(ids)), 0))
        for step in range(1, window + 1):
            b = np.arange(old, len(ids))
            b = b[start[b] >= step]
            a = start[b] - step
            some = (group[a] == group[b]) & (part[a] != part[b])
            a, b = a[some], b[some]
            cos = np.einsum("ij,ij->i", unit[a], unit[b])
            some = cos >= floor
            yield _both(ids[a[some]], ids[b[some]], cos[some])
        last = int(start[-1])
        held = now.take(pa.array(np.r_[max(0, last - window) : last, max(last, len(ids) - window) : len(ids)]))


def first_edges(classes: DataFrame, floor: float, tables: int, window: int, seed: int) -> DataFrame:
    """Edges above ``floor`` between vectors at most ``window`` places apart in an order of signatures.

    Vectors of one ``part`` are not compared, and a stretch of them counts as one place. The order is
    dealt in ranges down to the row, so a large group of near copies spreads over tasks; the ends of
    the ranges meet once more by themselves.
    """
    keys = ["kind", "label", "sign", "rep"]
    ordered = _signed(classes, tables, seed).repartitionByRange(*keys).sortWithinPartitions(*keys)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, last = 0, None
        for batch in batches:
            head = min(batch.num_rows, max(0, window - begun))
            begun += head
            if head:
                yield batch.slice(0, head)
            rest = pa.Table.from_batches([batch.slice(head)])
            last = rest if last is None else pa.concat_tables([last, rest])
            last = last.slice(max(0, last.num_rows - window)).combine_chunks()
        if last is not None:
            yield from last.to_batches()

    def border(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("sign", "ascending"), ("rep", "ascending")])
        found = list(_met(iter(rows.combine_chunks().to_batches()), floor, window))
        return pa.Table.from_batches(found or [_both(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))])

    inside = ordered.mapInArrow(lambda batches: _met(batches, floor, window), _EDGE)
    return inside.union(ordered.mapInArrow(ends, _SIGNED).groupBy("kind", "label").applyInArrow(border, _EDGE))


def _both(a: np.ndarray, b: np.ndarray, cos: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([a, b])), pa.array(np.concatenate([b, a])), pa.array(np.concatenate([cos, cos]))],
        ["src", "dst", "cos"],
    )


def _nearest(edges: DataFrame, k: int) -> DataFrame:
    """The k nearest of each list; edges found several times count once."""
    order = Window.partitionBy("src").orderBy(F.col("cos").desc(), "dst")
    once = edges.groupBy("src", "dst").agg(F.max("cos").alias("cos"))
    return once.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("place")


def _compared(pairs: DataFrame, classes: DataFrame, floor: float) -> DataFrame:
    one = classes.select(F.col("rep").alias("src"), F.col("unit").alias("u"))
    two = classes.select(F.col("rep").alias("dst"), F.col("unit").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cos = [float(np.frombuffer(u, "<f8") @ np.frombuffer(v, "<f8")) for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True)]
                some = np.array(cos) >= floor
                yield _both(batch.column("src").to_numpy()[some], batch.column("dst").to_numpy()[some], np.array(cos)[some])

    return pairs.join(one, "src").join(two, "dst").select("src", "dst", "u", "v").mapInArrow(run, _EDGE)


def descend(classes: DataFrame, graph: DataFrame, floor: float, k: int, rounds: int, quiet: float = 0.001) -> DataFrame:
    """Rounds of joining lists with the lists of their members, until hardly a list changes."""
    for _ in range(rounds):
        hop = graph.select(F.col("src").alias("mid"), F.col("dst").alias("far"))
        near = graph.select("src", F.col("dst").alias("mid"))
        pairs = near.join(hop, "mid").where("src < far").select("src", F.col("far").alias("dst")).distinct()
        new = pairs.join(graph.select("src", "dst"), ["src", "dst"], "left_anti")
        after = stored(_nearest(graph.union(_compared(new, classes, floor)), k), "graph")
        changed = after.join(graph.select("src", "dst"), ["src", "dst"], "left_anti").count()
        forget(graph)
        graph = after
        if changed <= quiet * max(1, graph.count()):
            break
    return graph


def _parted(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``classes`` with ``part``, their component by ``links``."""
    found = components(links, "src", "dst").select(F.col("node").alias("rep"), "component")
    joined = classes.drop("part").join(found, "rep", "left")
    return stored(joined.withColumn("part", F.coalesce("component", "rep")).drop("component"), "parts")


def bridges(classes: DataFrame, graph: DataFrame, threshold: float, floor: float, k: int, tables: int, window: int, rounds: int, seed: int) -> DataFrame:
    """Links between components whose lists are full of their own links, ``part`` in ``classes``.

    Lists hold vectors of other components only. The neighbours of a member are tried on what the
    member found, from both sides, so a pair of components is searched where they are nearest.
    """
    full = graph.where(F.col("cos") >= threshold).groupBy("src").count().where(F.col("count") >= k)
    parts = full.join(classes, full["src"] == classes["rep"]).select("part").distinct()
    several = classes.select("part", "label").join(parts, "part").distinct().groupBy("label").count().where("count > 1")
    some = stored(classes.join(parts, "part", "left_semi").join(several, "label", "left_semi"), "full")
    lists = stored(_nearest(first_edges(some, floor, tables, window, seed), k), "graph")
    part_of = lambda end: some.select(F.col("rep").alias(end), F.col("part").alias(f"{end}_part"))
    for _ in range(rounds if not lists.isEmpty() else 0):
        near = graph.select("src", F.col("dst").alias("mid"))
        far = lists.select(F.col("src").alias("mid"), F.col("dst").alias("far"))
        pairs = near.join(far, "mid").select(F.least("src", "far").alias("src"), F.greatest("src", "far").alias("dst")).distinct()
        pairs = pairs.join(part_of("src"), "src").join(part_of("dst"), "dst").where("src_part <> dst_part").select("src", "dst")
        new = pairs.join(lists.select("src", "dst"), ["src", "dst"], "left_anti")
        after = stored(_nearest(lists.union(_compared(new, some, floor)), k), "graph")
        settled = after.join(lists.select("src", "dst"), ["src", "dst"], "left_anti").isEmpty()
        forget(lists)
        lists = after
        if settled:
            break
    return lists.where(F.col("cos") >= threshold)


def recall(classes: DataFrame, threshold: float, sample: int, seed: int) -> float:
    """Of a sample of the vectors that have links, the share with all of them in their own ``part``.

    The sample is compared with every vector, in blocks; only counts leave a task.
    """
    drawn = classes.orderBy(F.xxhash64("rep", F.lit(seed)), "rep").limit(sample).select("rep", "label", "part", "unit").collect()
    groups: dict = {}
    for r in drawn:
        groups.setdefault((r["label"], len(r["unit"])), []).append(r)
    held = {
        key: (np.array([r["rep"] for r in rs]), np.array([r["part"] for r in rs]), np.frombuffer(b"".join(r["unit"] for r in rs), "<f8").reshape(len(rs), -1))
        for key, rs in groups.items()
    }
    shared = classes.sparkSession.sparkContext.broadcast(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds: dict = {}
            for i, (label, unit) in enumerate(zip(batch.column("label").to_pylist(), batch.column("unit").to_pylist(), strict=True)):
                kinds.setdefault((label, len(unit)), []).append(i)
            for key in kinds.keys() & shared.value.keys():
                ids, parts, unit = shared.value[key]
                rows = batch.take(pa.array(kinds[key]))
                near = (unit @ _matrix(rows.column("unit")).T >= threshold) & (ids[:, None] != rows.column("rep").to_numpy()[None, :])
                lost = near & (parts[:, None] != rows.column("part").to_numpy()[None, :])
                columns = [ids, near.sum(axis=1), lost.sum(axis=1)]
                yield pa.RecordBatch.from_arrays([pa.array(c[near.any(axis=1)]) for c in columns], ["rep", "links", "lost"])

    counted = classes.select("rep", "label", "part", "unit").mapInArrow(run, "rep long, links long, lost long").groupBy("rep").agg(F.sum("lost").alias("lost"))
    total, whole = counted.agg(F.count("*"), F.sum(F.when(F.col("lost") == 0, 1).otherwise(0))).first()
    return whole / total if total else 1.0


def _links_in_blocks(members: DataFrame, threshold: float, block: int, buckets: int) -> DataFrame:
    """(rep, links): for each class the rows of other classes of its component at ``threshold`` or nearer.

    Components of up to ``block`` classes share groups; larger ones are cut into blocks, a group for
    each pair of them.
    """
    sizes = members.groupBy("component").agg(F.count("*").alias("size"))
    rows = members.join(sizes, "component").withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    bucket = F.when(F.col("blocks") > 1, F.col("component")).otherwise(-1 - F.pmod(F.xxhash64("component"), F.lit(buckets)))
    rows = rows.select("component", "rep", "n", "unit", "own", bucket.alias("bucket"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    left = rows.select("bucket", F.col("own").alias("i"), F.col("other").alias("j"), "component", "rep", "unit")
    names = {"bucket": "bucket", "other": "i", "own": "j", "component": "c", "rep": "r", "unit": "u", "n": "m"}
    right = rows.select(*[F.col(old).alias(new) for old, new in names.items()])

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        out_rep, out_links = [], []
        whose_a, whose_b = a.column("component").to_numpy(), b.column("c").to_numpy()
        order_a, order_b = np.argsort(whose_a, kind="stable"), np.argsort(whose_b, kind="stable")
        parts, first = np.unique(whose_a[order_a], return_index=True)
        for part, at, end in zip(parts, first, [*first[1:], len(order_a)]):
            x = order_a[at:end]
            lo, hi = np.searchsorted(whose_b[order_b], [part, part + 1])
            y = order_b[lo:hi]
            ids, others = a.column("rep").to_numpy()[x], b.column("r").to_numpy()[y]
            near = _matrix(a.column("unit").take(pa.array(x))) @ _matrix(b.column("u").take(pa.array(y))).T >= threshold
            near &= ids[:, None] != others[None, :]
            out_rep.append(ids)
            out_links.append(near @ b.column("m").to_numpy()[y])
        empty = [np.empty(0, np.int64)]
        return pa.table({"rep": pa.array(np.concatenate(out_rep or empty)), "links": pa.array(np.concatenate(out_links or empty))})

    # Spark can't tell the sides of a self-join apart by columns they share, hence the new names.
    left = left.toDF("bucket", "i", "j", "component", "rep", "unit")
    cells = ["bucket", "i", "j"]
    counted = left.groupBy(*cells).cogroup(right.groupBy(*cells)).applyInArrow(run, "rep long, links long")
    return counted.groupBy("rep").agg(F.sum("links").alias("links"))


def near_vectors(
    embeddings: DataFrame,
    threshold: float = 0.98,
    k: int = 12,
    tables: int = 8,
    window: int = 8,
    rounds: int = 6,
    block: int = 512,
    seed: int = 17,
    least_recall: float = 0.99,
    sample: int = 1024,
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of (vec_id, embedding, label).

    Rows are compared within equal labels and sizes only. Null, empty and zero vectors, null or non-finite
    components and null labels link with nothing: no links, their own component, kept. Copies of one
    direction are one class of the graph; each counts as a link of the others. An empty table gives
    no rows; other columns are not read. The graph is approximate between components and exact
    within them; of ``sample`` vectors' links at least ``least_recall`` must be whole (see `recall`).
    """
    rows = stored(units(embeddings), "units")
    usable = rows.where("unit is not null and vec_id is not null")
    classes = stored(usable.groupBy("label", "unit").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")), "classes")
    floor = 2 * threshold * threshold - 1
    alone = classes.withColumn("part", F.col("rep"))
    graph = links = None
    while True:
        edges = first_edges(alone, floor, tables, window, seed)
        start = stored(_nearest(edges if graph is None else graph.union(edges), k), "graph")
        graph = descend(classes, start, floor, k, rounds)
        near = graph.where(F.col("cos") >= threshold).select("src", "dst")
        links = near if links is None else links.union(near)
        parted = _parted(classes, links)
        while not (more := bridges(parted, graph, threshold, floor, k, tables, window, rounds, seed)).isEmpty():
            links = stored(links.union(more.select("src", "dst")), "links")
            parted = _parted(classes, links)
        if recall(parted, threshold, sample, seed) >= least_recall:
            break
        links, tables, seed = stored(links, "links"), 2 * tables, seed + 1
    found = stored(parted.select(F.col("rep").alias("node"), F.col("part").alias("component")), "components")
    members = classes.join(found, classes["rep"] == found["node"]).select("component", "rep", "n", "unit")
    buckets = max(1, found.count() // (4 * block))
    links = _links_in_blocks(members, threshold, block, buckets)
    known = (
        classes.join(found, classes["rep"] == found["node"], "left")
        .join(links, "rep", "left")
        .select(
            F.col("label").alias("l"),
            F.col("unit").alias("u"),
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    joined = rows.join(known, (rows["label"] == known["l"]) & (rows["unit"] == known["u"]), "left")
    component = F.when(F.col("vec_id").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "vec_id"))
    return joined.select(
        "vec_id",
        F.when(F.col("vec_id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
