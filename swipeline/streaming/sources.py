"""Streams of transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from swipeline.schemas import TRANSACTION
from swipeline.sources.landing import not_blank, parse_json, parsed
from swipeline.sources.zones import Zones


def landing_stream(
    spark: SparkSession,
    zones: Zones,
    dataset: str = "transactions",
    files_per_trigger: int = 10,
    schema: StructType = TRANSACTION,
) -> DataFrame:
    """Transactions of new NDJSON files of the landing zone, a bounded number of files per trigger."""
    return parsed(landing_lines(spark, zones, dataset, files_per_trigger, schema))[0]


def landing_lines(
    spark: SparkSession,
    zones: Zones,
    dataset: str = "transactions",
    files_per_trigger: int = 10,
    schema: StructType = TRANSACTION,
) -> DataFrame:
    """Every line of those files, ``_corrupt_record`` holding what does not parse."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).option("recursiveFileLookup", True)
    text = reader.text(zones.path("landing", dataset))
    return parse_json(text.where(not_blank()), schema=schema)


def table_stream(spark: SparkSession, glob: str, schema: StructType, files_per_trigger: int = 10) -> DataFrame:
    """New Parquet files matching a glob."""
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(glob)
    )
