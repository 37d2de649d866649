"""Streaming sinks. Each takes its checkpoint and trigger, and each survives a replayed batch."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from swipeline.operators.fraud import FraudConfig, apply_all_fraud_rules
from swipeline.sources.landing import write_owned

log = logging.getLogger(__name__)

ONCE = {"availableNow": True}


def append_table(df: DataFrame, path: str, checkpoint: str, trigger: dict, name: str | None = None) -> StreamingQuery:
    """Append finished windows to Parquet; the sink's own log makes this exactly once."""
    return _writer(df, checkpoint, trigger, name).outputMode("append").format("parquet").start(path)


def land(df: DataFrame, path: str, checkpoint: str, trigger: dict, name: str | None = None) -> StreamingQuery:
    """Append transactions as NDJSON to the folder of their event hour, as the batch jobs read it.

    A micro-batch owns its files: a replay replaces them, and readers see them once all are written.
    """
    return _writer(df, checkpoint, trigger, name).foreachBatch(landing_batch_writer(path)).start()


def landing_batch_writer(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for :func:`land`; owners are named by the checkpoint's query id."""

    def write(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        # A batch is read more than once; one that comes out of keyed state must not be computed twice.
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            with _adaptive(batch.sparkSession):
                write_owned(batch, path, f"stream-{query}-{batch_id}", "replace")
        finally:
            batch.unpersist()

    return write


@contextmanager
def _adaptive(spark: SparkSession) -> Iterator[None]:
    """Adaptive execution for a write of finished rows.

    Spark turns it off for a query with state, and then leaves out the rebalancing of a write without a word:
    each of the state's partitions would write a file into every folder.
    """
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def score_batches(
    df: DataFrame, path: str, checkpoint: str, trigger: dict, config: FraudConfig, name: str | None = None
) -> StreamingQuery:
    """Apply the fraud rules to each micro-batch and store its flagged rows."""
    return (
        _writer(df, checkpoint, trigger, name).foreachBatch(fraud_batch_writer(path, config)).start()
    )


def fraud_batch_writer(path: str, config: FraudConfig) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function writing ``batch_id=N/transaction_type=T`` folders.

    A batch owns its folder and replaces it as a whole, so a replay cannot leave rows twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # The rules read a batch more than once; without this each pass would parse its files again.
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if batch.isEmpty():
                return
            read, kept = Observation(f"read-{batch_id}"), Observation(f"kept-{batch_id}")
            rows = F.count(F.lit(1)).alias("rows")
            scored = apply_all_fraud_rules(batch, config).observe(read, rows)
            flagged = scored.where("is_fraud_flagged").observe(kept, rows)
            flagged.write.mode("overwrite").partitionBy("transaction_type").parquet(
                f"{path}/batch_id={batch_id}"
            )
            log.info("batch %s: %s transactions, %s flagged", batch_id, read.get["rows"], kept.get["rows"])
        finally:
            batch.unpersist()

    return write


def running_totals(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict,
    name: str | None = None,
    partition_by: tuple[str, ...] = ("date",),
) -> StreamingQuery:
    """Store the totals that each batch changed, in the batch's own folder (``update`` mode).

    Writes stay proportional to what changed; :func:`latest_totals` picks the current values, and a
    filter on a partition column reads only those folders.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/batch_id={batch_id}")

    return _writer(df, checkpoint, trigger, name).outputMode("update").foreachBatch(write).start()


def latest_totals(spark: SparkSession, path: str, keys: tuple[str, ...] = ("card_hash", "date")) -> DataFrame:
    """Per key the values of the last batch that changed it."""
    return latest_of(spark.read.parquet(path), keys)


def close_date(
    spark: SparkSession, path: str, closed: str, date: str, keys: tuple[str, ...] = ("card_hash", "date")
) -> None:
    """Store the final totals of one date in table ``closed``, so that reading it needs no batch folders.

    For dates that the watermark has passed. The date is replaced as a whole, so a rerun, also one
    after a failure, gives the same rows; the changes below ``path`` are left alone. A date without
    changes leaves the table as it is.
    """
    final = latest_of(spark.read.parquet(path).where(F.col("date") == F.lit(date).cast("date")), keys)
    writer = final.repartition("date", *keys[:1]).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(closed)


def latest_of(changes: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    values = [c for c in changes.columns if c not in (*keys, "batch_id")]
    return (
        changes.groupBy(*keys)
        .agg(F.max_by(F.struct(*values), "batch_id").alias("_latest"))
        .select(*keys, "_latest.*")
    )


def _writer(df: DataFrame, checkpoint: str, trigger: dict, name: str | None):
    writer = df.writeStream.option("checkpointLocation", checkpoint).trigger(**trigger)
    return writer.queryName(name) if name else writer
