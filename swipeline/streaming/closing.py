"""Closing of running totals: dates that the watermark has passed move to a table of their own.

Each micro-batch leaves a folder of what it changed, so reading a date costs as much as it had
batches. Closing writes the final totals of finished dates to a closed table and then moves its mark:
one small file of ``_mark`` names the first date that is still open, and readers take all dates
before the mark from the closed table and the others from the batch folders. The mark moves in one
rename after the closed dates are complete, so a crash at any point leaves readers with either the old
place or the new one. Batch folders go one closing later: whoever resolved the old mark can end reading.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swipeline.streaming.sinks import latest_of

KEYS = ("card_hash", "date")


def final_before(spark: SparkSession, progress: str, query: str) -> str | None:
    """The first date that may still change, by the newest watermark that the progress table has.

    A day's totals are final once the watermark has reached the next day. None while nothing is known.
    """
    of_query = _read(spark, progress, F.col("query") == query)
    if of_query is None:
        return None
    newest = of_query.where("watermark is not null").agg(F.max_by("watermark", F.struct("at", "batch_id")).alias("w"))
    # The stored text is in UTC, as the dates are, whatever the session's time zone.
    mark = newest.select(F.substring("w", 1, 10)).first()[0]
    return None if mark is None or mark <= "1970-01-01" else mark


def open_since(spark: SparkSession, closed: str) -> str | None:
    """The mark of a closed table: its dates before that one are complete. None before the first closing."""
    try:
        return spark.read.schema("mark string").json(f"{closed}/_mark").agg(F.max("mark")).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def close_finished(spark: SparkSession, path: str, closed: str, before: str, keys: tuple[str, ...] = KEYS) -> None:
    """Close all dates before ``before``, which must be final (:func:`final_before`).

    A rerun, also one after a crash, ends in the same tables. The batch folders of dates that an earlier
    call closed are removed. One closing runs at a time; the stream may go on meanwhile.
    """
    old = open_since(spark, closed)
    if old is not None:
        _remove_folders(spark, path, old)
    if old is not None and before <= old:
        return
    newly = F.col("date") < F.lit(before).cast("date")
    if old is not None:
        newly &= F.col("date") >= F.lit(old).cast("date")
    changes = _read(spark, path, newly)
    if changes is not None:
        writer = latest_of(changes, keys).hint("rebalance", "date").write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(closed)
    mark = spark.createDataFrame([(before,)], "mark string").coalesce(1)
    mark.write.mode("append").json(f"{closed}/_mark")


def current_totals(spark: SparkSession, path: str, closed: str, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """The current totals of every date; a filter on ``date`` reads only the folders of that date.

    For a closed date these are the files of the closed table, however many batches it had.
    """
    mark = open_since(spark, closed)
    if mark is None:
        return latest_of(spark.read.parquet(path), keys)
    border = F.lit(mark).cast("date")
    done = _read(spark, closed, F.col("date") < border)
    changes = _read(spark, path, F.col("date") >= border)
    if changes is None and done is None:
        raise ValueError(f"neither {path} nor {closed} has totals")
    if changes is None:
        return done
    running = latest_of(changes, keys)
    return running if done is None else done.unionByName(running)


def _read(spark: SparkSession, path: str, condition) -> DataFrame | None:
    """The rows of a Parquet table that meet a condition; None where there are no files."""
    try:
        return spark.read.parquet(path).where(condition)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _remove_folders(spark: SparkSession, path: str, before: str) -> None:
    """Remove ``batch_id=N/date=D`` for all D before a date, and batches that have no other files.

    Works on names of folders only.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    files = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for folder in files.globStatus(hadoop(f"{path}/batch_id=*/date=*")) or []:
        day = re.fullmatch(r"date=(\d{4}-\d\d-\d\d)", folder.getPath().getName())
        if day and day[1] < before:
            files.delete(folder.getPath(), True)
    for batch in files.globStatus(hadoop(f"{path}/batch_id=*")) or []:
        left = [child.getPath().getName() for child in files.listStatus(batch.getPath())]
        # A batch that is being written has a folder of temporary files.
        if left == ["_SUCCESS"]:
            files.delete(batch.getPath(), True)
