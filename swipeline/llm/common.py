"""Shared steps of the corpus operators: scratch tables, global ranks, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from swipeline.sources.zones import scratch_dir

#: ASCII white space; a word is a maximal run of anything else.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written below the shared checkpoint folder and read again: its lineage ends there."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Remove the files of a table made by `stored`, once nothing reads it any more."""
    spark = df.sparkSession
    files = df.inputFiles()
    if files:
        folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def tidy(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished steps.

    Its cleaner does so once the driver's JVM has collected what refers to them, which a driver with little
    to do puts off for half an hour; a job of many steps over whole texts would keep them all.
    """
    spark._jvm.System.gc()


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def batches_of(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of a record batch whose texts hold about ``limit`` bytes each, a row at least."""
    held, first = 0, 0
    sizes = pc.binary_length(batch.column(column)).to_pylist()
    for i, size in enumerate(sizes):
        if held and held + (size or 0) > limit:
            yield batch.slice(first, i - first)
            held, first = 0, i
        held += size or 0
    if batch.num_rows > first:
        yield batch.slice(first)


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with a gapless number from 0 in the given total order, without one task seeing all rows.

    Rows are dealt into sorted ranges and stored; only the number of rows per range meets in a task.
    """
    placed = stored(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()),
        "numbered",
    )
    part = F.shiftright("_at", 33)
    counts = placed.groupBy(part.alias("_part")).count()
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("_part", part)
        .join(starts, "_part")
        .withColumn(name, F.col("_start") + inside)
        .drop("_part", "_start", "_at")
    )


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """The connected components of an undirected graph: (node, component), component its least node.

    Alternating large and small stars (Kiveris et al., 2014). Every round is a pair of grouped
    minima joined back to the edges, so a hub is combined on the map side and never gathered; each
    round is a stored table. Nodes without an edge to another node are not in the result. Null ends
    and loops are dropped; repeated edges count once.
    """
    now = stored(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "edges",
    )
    mark = _mark(now)
    while mark[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(root, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        after = stored(small.union(root.select("u", F.col("m").alias("v"))).distinct(), "edges")
        forget(now)
        now, last, mark = after, mark, _mark(after)
        if mark == last:
            break
    ends = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return ends.union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v").cast("decimal(20,0)"))).first())


def meeting(rows: DataFrame) -> DataFrame:
    """Those of the rows (key, part, ...) whose key has several parts, with its number of rows as ``n``."""
    of_key = Window.partitionBy("key")
    parts = rows.withColumns({"low": F.min("part").over(of_key), "high": F.max("part").over(of_key), "n": F.count("*").over(of_key)})
    return parts.where("low < high").drop("low", "high")


def beside_hub(rows: DataFrame, name: str, columns: list[str], turn: int) -> DataFrame:
    """The rows with the ``columns`` of one row of their key as ``hub``, chosen by hash; without that row.

    ``name`` tells the rows of a key apart.
    """
    place = F.xxhash64("key", name, F.lit(turn))
    hubs = rows.groupBy("key").agg(F.min_by(F.struct(*columns), F.struct(place, name)).alias("hub"))
    return rows.join(hubs, "key").where(F.col(name) != F.col(f"hub.{name}"))


def across(rows: DataFrame, columns: list[str], near: Callable[[str, str], Column]) -> DataFrame:
    """Pairs (a, b) of rows of one key and of different parts, each once, where ``near`` holds.

    The key's largest part meets the other rows only, so what has one large part is not compared with
    the square of its rows. What is not near does not leave the join.
    """
    sizes = rows.groupBy("key", "part").agg(F.count("*").alias("rows"))
    main = sizes.groupBy("key").agg(F.max_by("part", F.struct("rows", "part")).alias("main"))
    row = F.struct(*columns)
    a = rows.join(main, "key").where("part <> main").select("key", "main", row.alias("a")).alias("l")
    b = rows.select("key", row.alias("b")).alias("r")
    once = (F.col("b.part") == F.col("main")) | (F.col("a.part") < F.col("b.part"))
    return a.join(b, (F.col("l.key") == F.col("r.key")) & once & near("a", "b")).select("a", "b")
