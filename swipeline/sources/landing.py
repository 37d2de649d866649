"""The landing zone: NDJSON files under ``date=YYYY-MM-DD/hour=HH``.

Files come from batch jobs, from streams and from producers that know nothing of Spark. What a job or a
micro-batch writes lies in a folder ``batch=OWNER`` below each hour, and counts as landed once the
manifest names its owner: one file per owner below ``_manifest``, written after all its data. A crashed
write leaves files that no reader takes; its replay has the same owner and replaces them. Files
right below an hour have no owner and are read as they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructType

from swipeline.schemas import TRANSACTION, optional
from swipeline.sources.zones import Zones

CORRUPT = "_corrupt_record"
_MANIFEST = "rows long, dates array<string>, batch string"
_ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def read_landing(
    spark: SparkSession,
    zones: Zones,
    dataset: str = "transactions",
    date: str | None = None,
    hour: int | None = None,
    schema: StructType = TRANSACTION,
    required: bool = False,
) -> DataFrame:
    """Landing transactions with ``date`` and ``hour`` columns, typed by ``schema``.

    Lines that do not parse are no transactions; :func:`read_landing_lines` has them. Dates and
    hours are as there.
    """
    return parsed(read_landing_lines(spark, zones, dataset, date, hour, schema, required))[0]


def read_landing_lines(
    spark: SparkSession,
    zones: Zones,
    dataset: str = "transactions",
    date: str | None = None,
    hour: int | None = None,
    schema: StructType = TRANSACTION,
    required: bool = False,
) -> DataFrame:
    """Every landing line: its fields, ``date``, ``hour``, and ``_corrupt_record`` where it has a fault.

    A line is corrupt if it is no JSON object or a field is not of its type, whichever columns a
    query reads. Blank lines are left out.

    A date, or a date and an hour, are resolved to their folder, so only that folder is listed
    and read however long the history is. A date without files gives no rows, or an
    error if it is ``required``.
    """
    if hour is not None and date is None:
        raise ValueError("an hour needs a date")
    root = zones.path("landing", dataset)
    # A glob, so that a commit log that a file sink left at the root does not decide what is there.
    path = f"{root}/date=*" if date is None else f"{root}/date={date}"
    if hour is not None:
        path += f"/hour={hour:02d}"
    try:
        return parse_json(_landed(spark, root, path, date).where(not_blank()), schema=schema, keep=("date", "hour"))
    except AnalysisException as error:
        if required or date is None or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], optional(schema).add(CORRUPT, StringType()).add("date", DateType()).add("hour", IntegerType()))


def _landed(spark: SparkSession, root: str, path: str, date: str | None) -> DataFrame:
    """The lines below ``path`` that have no owner or one that the manifest names."""

    def folder(name: str) -> Column:
        return F.regexp_extract("_metadata.file_path", f"/{name}=([^/]+)/", 1)

    lines = (
        spark.read.schema("value string")
        .option("recursiveFileLookup", True)
        .text(path)
        .select("value", folder("date").try_cast("date").alias("date"), folder("hour").try_cast("int").alias("hour"), folder("batch").alias("_owner"))
    )
    owners = committed(spark, root, date).select(F.col("batch").alias("_named")).distinct()
    named = lines.join(owners, F.col("_owner") == F.col("_named"), "left")
    return named.where("_owner = '' or _named is not null").drop("_owner", "_named")


def committed(spark: SparkSession, root: str, date: str | None = None) -> DataFrame:
    """The manifest of a landing root: rows, dates and name of every committed write.

    For a date only the writes that touched it, resolved at once, as its folder is.
    """
    try:
        manifest = spark.read.schema(_MANIFEST).json(f"{root}/_manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _MANIFEST)
    if date is None:
        return manifest
    return spark.createDataFrame(manifest.where(F.array_contains("dates", date)).collect(), _MANIFEST)


def not_blank(line: str = "value") -> Column:
    return F.trim(line) != ""


def write_landing(df: DataFrame, zones: Zones, dataset: str = "transactions", mode: str = "append") -> None:
    """Write transactions to the folder of their event hour; they are seen when all are written."""
    write_owned(df, zones.path("landing", dataset), f"job-{uuid.uuid4().hex}", mode)


def write_owned(df: DataFrame, root: str, owner: str, mode: str = "append") -> None:
    """Write the files of one owner, then name it in the manifest.

    ``replace`` first removes what an earlier attempt of the owner wrote into the same hours,
    ``overwrite`` all that has landed. Without rows nothing is named.
    """
    spark, seen, empty = df.sparkSession, Observation(), df.isEmpty()
    if empty and mode != "overwrite":
        return
    metrics = F.count(F.lit(1)).alias("rows"), F.collect_set("date").alias("dates")
    # One task per folder would be slow for a full hour and many tasks per folder make tiny files:
    # AQE cuts and merges these partitions to its advisory size.
    target = for_landing(df).observe(seen, *metrics).withColumn("batch", F.lit(owner)).hint("rebalance", "date", "hour")
    writer = target.write.partitionBy("date", "hour", "batch")
    if mode == "replace":
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").json(root)
    else:
        writer.mode(mode).json(root)
    if not empty:
        entry = spark.createDataFrame([(seen.get["rows"], sorted(map(str, seen.get["dates"])))], "rows long, dates array<string>")
        entry.coalesce(1).write.mode("overwrite").json(f"{root}/_manifest/batch={owner}")


def for_landing(df: DataFrame) -> DataFrame:
    """Landing form: exact texts for amount and time, and the folder columns."""
    return df.select(
        *[_as_text(name) for name in df.columns if name not in ("date", "hour")],
        F.date_format("timestamp", "yyyy-MM-dd").alias("date"),
        F.date_format("timestamp", "HH").alias("hour"),
    )


def _as_text(name: str) -> Column:
    if name == "amount":
        return F.col(name).cast("string").alias(name)
    if name == "timestamp":
        return F.date_format(name, _ISO).alias(name)
    return F.col(name)


def encode_json(df: DataFrame) -> Column:
    """One transaction as a JSON text, with amount and time as texts."""
    return F.to_json(F.struct(*[_as_text(name) for name in df.columns]))


def parse_json(df: DataFrame, value: str = "value", schema: StructType = TRANSACTION, keep: Sequence[str] = ()) -> DataFrame:
    """Parse a JSON column (text or bytes) to flat columns; ``_corrupt_record`` keeps what failed.

    A record without a value (a tombstone of a topic) is no transaction and is left out. Columns of
    ``keep`` stay beside the fields.
    """
    # Parsed fields are nullable whatever the source promises: a record may lack any of them.
    loose = optional(schema).add(CORRUPT, StringType())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    record = F.from_json(F.col(value).cast("string"), loose, options)
    # A generator is a border for filters: without it a filter on a field would parse every text again.
    return df.where(F.col(value).isNotNull()).select(F.inline(F.array(record)), *keep)


def parsed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split parsed records into good ones and corrupt texts, the latter with their landing hour."""
    bad = F.col(CORRUPT).isNotNull()
    return df.where(~bad).drop(CORRUPT), df.where(bad).select(CORRUPT, *[c for c in ("date", "hour") if c in df.columns])
