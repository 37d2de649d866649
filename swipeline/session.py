"""Session profiles.

Operators never read these settings; a profile only fills in what a job needs and the submission
left open. Every session is in UTC, because calendar dates and day windows are defined in UTC.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession

_ZONE = {"spark.sql.session.timeZone": "UTC"}

# The size check behind every dimension join, before and during the run: above it Spark shuffles.
_JOINS = {
    "spark.sql.autoBroadcastJoinThreshold": "50MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "50MB",
}

_BY_MODE = {
    # Keyed state needs this store, which holds it off the heap.
    "streaming": {
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
    },
    "batch": {},
}


@dataclass(frozen=True)
class ObjectStore:
    """An S3-compatible store, passed through to the Hadoop file system."""

    endpoint: str
    access_key: str
    secret_key: str
    path_style: bool = True

    @classmethod
    def from_env(cls, env: Mapping[str, str]) -> ObjectStore | None:
        """The store that the environment names; None where it names none."""
        if not env.get("S3_ENDPOINT"):
            return None
        return cls(env["S3_ENDPOINT"], env["S3_ACCESS_KEY"], env["S3_SECRET_KEY"])

    def options(self) -> dict[str, str]:
        prefix = "spark.hadoop.fs.s3a."
        return {
            prefix + "endpoint": self.endpoint,
            prefix + "access.key": self.access_key,
            prefix + "secret.key": self.secret_key,
            prefix + "path.style.access": str(self.path_style).lower(),
            prefix + "impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        }


def profile(mode: str = "batch", shuffle_partitions: int | None = None, extra: dict[str, str] | None = None) -> dict[str, str]:
    """Settings of one mode.

    ``shuffle_partitions`` is the number AQE starts from before it merges small ones; take about
    shuffled bytes / 128 MB, so several tens of thousands for a 100 TB table. A stateful stream keeps
    the number of its first run.
    """
    if mode not in _BY_MODE:
        raise ValueError(f"unknown mode {mode!r}, expected one of {sorted(_BY_MODE)}")
    chosen = {"spark.sql.shuffle.partitions": str(shuffle_partitions)} if shuffle_partitions else {}
    return {**_ZONE, **_JOINS, **_BY_MODE[mode], **chosen, **(extra or {})}


def open_session(
    app_name: str = "swipeline",
    mode: str = "batch",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    store: ObjectStore | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session. What the caller or the submission set stays; the profile fills the rest."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**(store.options() if store else {}), **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    submitted = spark.sparkContext.getConf()
    for key, value in profile(mode).items():
        if key in _ZONE or not submitted.contains(key):
            spark.conf.set(key, value)
    if shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", shuffle_partitions)
    return spark
