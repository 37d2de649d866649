"""What each micro-batch read, dropped as late and observed, stored as a table."""

from __future__ import annotations

import json
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

log = logging.getLogger(__name__)

PROGRESS = (
    "query_id string, run_id string, query string, batch_id long, at timestamp, input_rows long, late_rows long,"
    "state_rows long, watermark string, observed map<string, string>"
)


class ProgressTable(StreamingQueryListener):
    """Appends a row per micro-batch that read or dropped something to a Parquet table at ``path``.

    Register with ``spark.streams.addListener``. A failing write is logged and does not stop the queries.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = progress_row(json.loads(event.progress.json))
        if not (row["input_rows"] or row["late_rows"]):
            return
        try:
            made = self.spark.createDataFrame([row], PROGRESS.replace("at timestamp", "at string"))
            made.withColumn("at", F.to_timestamp("at")).coalesce(1).write.mode("append").parquet(self.path)
        except Exception:
            log.exception("progress of %s not stored", row["query"])


def progress_row(progress: dict) -> dict:
    """The stored columns of one progress report."""
    operators = progress.get("stateOperators") or []
    observed = progress.get("observedMetrics") or {}
    return {
        "query_id": progress["id"],
        "run_id": progress["runId"],
        "query": progress.get("name"),
        "batch_id": progress["batchId"],
        "at": progress["timestamp"],
        "input_rows": progress.get("numInputRows", 0),
        "late_rows": sum(o.get("numRowsDroppedByWatermark", 0) for o in operators),
        "state_rows": sum(o.get("numRowsTotal", 0) for o in operators),
        "watermark": (progress.get("eventTime") or {}).get("watermark"),
        "observed": {f"{k}.{name}": str(v) for k, some in observed.items() for name, v in some.items()},
    }


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows that watermarks dropped, per query; a batch reported again after a restart counts once."""
    last = spark.read.parquet(path).groupBy("query_id", "query", "batch_id").agg(F.max("late_rows").alias("late_rows"))
    return last.groupBy("query_id", "query").agg(F.sum("late_rows").alias("late_rows"))
