"""Kafka topics of transactions. The connector jar comes from the deployment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swipeline.sources.landing import encode_json, parse_json

ARRIVED = "arrived_at"
TOPIC = "payment.transactions.raw"


def source_options(servers: str, topic: str, starting_offsets: str = "latest") -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }


def read_stream(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "latest") -> DataFrame:
    """A stream of parsed transactions, with ``_corrupt_record`` for what did not parse.

    ``arrived_at`` is the time that the topic has for the record.
    """
    options = source_options(servers, topic, starting_offsets)
    records = spark.readStream.format("kafka").options(**options).load()
    return parse_json(records.withColumnRenamed("timestamp", ARRIVED), keep=(ARRIVED,))


def encode(df: DataFrame) -> DataFrame:
    """Key and value of each message. The card is the key: its messages share a topic partition."""
    return df.select(F.col("card_hash").alias("key"), encode_json(df).alias("value"))


def write(df: DataFrame, servers: str, topic: str) -> None:
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    encode(df).write.format("kafka").options(**options).save()
