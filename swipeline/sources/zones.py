"""Roots of the storage zones, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession

_VARIABLES = {
    "landing": ("LANDING_ZONE_PATH", "./data/landing"),
    "processed": ("PROCESSED_ZONE_PATH", "./data/processed"),
    "analytics": ("ANALYTICS_ZONE_PATH", "./data/analytics"),
    "quality": ("QUALITY_RESULTS_PATH", "./data/quality"),
    "seeds": ("SEEDS_PATH", "./data/seeds"),
    "checkpoints": ("CHECKPOINT_PATH", "./data/checkpoints"),
}


@dataclass(frozen=True)
class Zones:
    """One root path per zone; checkpoints live apart from the data they describe."""

    landing: str
    processed: str
    analytics: str
    quality: str
    seeds: str
    checkpoints: str

    @classmethod
    def from_env(cls, env: Mapping[str, str]) -> Zones:
        return cls(**{zone: env.get(*choice) for zone, choice in _VARIABLES.items()})

    @classmethod
    def under(cls, root: str) -> Zones:
        """All zones as folders of one root."""
        return cls(**{zone: f"{root}/{zone}" for zone in _VARIABLES})

    def path(self, zone: str, dataset: str) -> str:
        if zone not in _VARIABLES:
            raise ValueError(f"unknown zone {zone!r}, expected one of {sorted(_VARIABLES)}")
        return f"{getattr(self, zone)}/{dataset}"


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the session's ``spark.checkpoint.dir``, which a cluster shares.

    Where the setting is absent a local session gets a temporary folder of its own; on a cluster,
    whose executors would not share it, that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("swipeline.scratch.dir", None)
        if not root:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and the executors share")
            root = tempfile.mkdtemp(prefix="swipeline-")
            spark.conf.set("swipeline.scratch.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
