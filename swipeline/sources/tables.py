"""Parquet tables of the zones and CSV dimensions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from swipeline.schemas import DIMENSIONS
from swipeline.sources.zones import Zones

_OPERATORS = {
    "=": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    "<>": lambda c, v: c != v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "in": lambda c, v: c.isin(list(v)),
    "not in": lambda c, v: ~c.isin(list(v)),
    "like": lambda c, v: c.like(v),
    "is null": lambda c, v: c.isNull() if v else c.isNotNull(),
}

Filter = tuple[str, str, Any]


def condition(filters: Iterable[Filter]) -> Column:
    """AND of ``(column, operator, value)`` triples. Values are literals, never SQL text.

    ``in`` and ``not in`` take a list; ``is null`` takes True, or False for its opposite.
    """

    def clause(item: Filter) -> Column:
        column, operator, value = item
        if operator not in _OPERATORS:
            raise ValueError(f"unsupported operator {operator!r}, expected one of {sorted(_OPERATORS)}")
        return _OPERATORS[operator](F.col(column), value)

    return reduce(lambda a, b: a & b, map(clause, filters), F.lit(True))


def read_table(
    spark: SparkSession, zones: Zones, zone: str, dataset: str, filters: Sequence[Filter] = ()
) -> DataFrame:
    """A Parquet table of a zone. Filters prune folders and reach the row groups."""
    df = spark.read.parquet(zones.path(zone, dataset))
    return df.where(condition(filters)) if filters else df


def read_dimension(spark: SparkSession, zones: Zones, name: str) -> DataFrame:
    """A CSV dimension by its declared schema, e.g. ``merchants``."""
    return spark.read.schema(DIMENSIONS[name]).csv(f"{zones.seeds}/{name}.csv", header=True)


def write_table(
    df: DataFrame,
    zones: Zones,
    zone: str,
    dataset: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    rebalance: bool = False,
) -> None:
    """Write a Parquet table. Overwriting a partitioned table replaces only the partitions in ``df``.

    ``rebalance`` asks for files of even size per partition folder; use it for results that are
    as large as the facts.
    """
    if rebalance:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format("parquet").mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.save(zones.path(zone, dataset))


def write_date(df: DataFrame, zones: Zones, zone: str, dataset: str, date: str, **parts: str) -> None:
    """Replace one ``processing_date`` folder by ``df``, also when ``df`` has no rows.

    ``parts`` name further folders below the date, of which only the given one is replaced.
    """
    below = "".join(f"/{name}={value}" for name, value in parts.items())
    folder = f"{zones.path(zone, dataset)}/processing_date={date}{below}"
    df.drop("processing_date").write.mode("overwrite").parquet(folder)


def write_processed(df: DataFrame, zones: Zones, dataset: str = "transactions") -> None:
    """Write to the processed zone: one row per transaction id, under ``date/transaction_type``.

    Of several rows with one id the smallest stays, so a rerun writes the same table.
    """
    unique = deduplicate(df).withColumn("date", F.to_date("timestamp"))
    write_table(unique, zones, "processed", dataset, ["date", "transaction_type"], rebalance=True)


def deduplicate(df: DataFrame) -> DataFrame:
    """One row per ``transaction_id``, chosen by event time and then the other columns.

    A row without a time never wins against one that has it. Rows without an id are all kept: nothing
    says that two of them are one transaction.
    """
    first = [F.col("timestamp").isNull(), "timestamp", *[c for c in df.columns if c not in ("timestamp", "transaction_id")]]
    known = df.where("transaction_id is not null")
    unique = (
        known.groupBy("transaction_id")
        .agg(F.min(F.struct(*first)).alias("_row"))
        .select("transaction_id", "_row.*")
        .select(*df.columns)
    )
    return unique.union(df.where("transaction_id is null"))
