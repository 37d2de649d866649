"""One parse per date: the landing lines of a date as columns, for all that a job does with them.

NDJSON has no columns to prune: every query over it parses whole lines. A job that reads a date more than
once therefore writes the parsed lines to Parquet first, below the checkpoint zone, and works on that.
The folder belongs to one run and goes with it, so jobs of one date do not disturb each other, and a
line that lands meanwhile is either in all results of the run or in none.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swipeline.sources.landing import CORRUPT, parsed, read_landing_lines
from swipeline.sources.zones import Zones


@dataclass(frozen=True)
class Staged:
    """The lines of a date: transactions with ``date`` and ``hour``, and corrupt texts with theirs."""

    transactions: DataFrame
    corrupt: DataFrame
    counts: dict[str, int]


@contextmanager
def staged(spark: SparkSession, zones: Zones, date: str, required: bool = False) -> Iterator[Staged]:
    """Parse the landing lines of a date once; the columns last as long as the block.

    ``counts`` has the number of ``transactions`` and of ``corrupt`` lines. A date that has not landed has
    no lines, or is an error if it is ``required``.
    """
    lines = read_landing_lines(spark, zones, date=date, required=required)
    path = f"{zones.path('checkpoints', 'staged')}/{date}-{uuid.uuid4().hex}"
    try:
        lines.write.parquet(path)
        columns = spark.read.schema(lines.schema).parquet(path)
        bad = F.col(CORRUPT).isNotNull()
        counts = columns.agg(F.count_if(~bad).alias("transactions"), F.count_if(bad).alias("corrupt")).first()
        yield Staged(*parsed(columns), counts.asDict())
    finally:
        _remove(spark, path)


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
