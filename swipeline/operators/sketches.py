"""Distinct counts that add up: HyperLogLog sketches per date, united over any dates later.

Exact distinct counts of two dates say nothing of both together, so the reports count exactly within a
date. A sketch is a few kilobytes a group whatever it counted, is combined on the map side, and
the union of the sketches of some dates is a sketch of all their rows. Estimates of up to some hundred
values are exact but for hash collisions; beyond that their relative standard error is
:func:`standard_error`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swipeline.schemas import SPEND_TYPES
from swipeline.sources.tables import read_table
from swipeline.sources.zones import Zones

LG_K = 12
_SKETCH, _ESTIMATE = "_sketch", "approx_"


def standard_error(lg_k: int = LG_K) -> float:
    """Relative standard error of an estimate from united sketches."""
    return 1.04 / 2 ** (lg_k / 2)


def distinct_sketches(
    txns: DataFrame, keys: Sequence[str], counted: Sequence[str], lg_k: int = LG_K
) -> DataFrame:
    """Per group its rows (``txn_count``) and a sketch ``X_sketch`` of each counted column ``X``.

    Absent values are not counted; absent keys are a group.
    """
    sketches = [F.hll_sketch_agg(F.col(name), lg_k).alias(name + _SKETCH) for name in counted]
    return txns.groupBy(*keys).agg(F.count(F.lit(1)).alias("txn_count"), *sketches)


def unite_sketches(stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add up stored sketches to coarser ``keys``; the result can be stored and added up again.

    Sketches of different precision unite to the lower one.
    """
    sketches = [F.hll_union_agg(name, True).alias(name) for name in stored.columns if name.endswith(_SKETCH)]
    return stored.groupBy(*keys).agg(F.sum("txn_count").alias("txn_count"), *sketches)


def with_estimates(df: DataFrame) -> DataFrame:
    """Replace each sketch ``X_sketch`` by its distinct count ``approx_X``."""
    return df.select(
        *[
            F.hll_sketch_estimate(name).alias(_ESTIMATE + name.removesuffix(_SKETCH)) if name.endswith(_SKETCH) else name
            for name in df.columns
        ]
    )


def merchant_sketches(txns: DataFrame) -> DataFrame:
    """Cards per merchant, over all transaction types, as :func:`reports.merchant_summary` counts them."""
    return distinct_sketches(txns, MERCHANT, ["card_hash"])


def mcc_sketches(txns: DataFrame) -> DataFrame:
    """Cards and merchants per category and currency, as :func:`reports.mcc_spending` counts them."""
    spent = txns.where(F.col("transaction_type").isin(*SPEND_TYPES))
    return distinct_sketches(spent, MCC, ["card_hash", "merchant_id"])


MERCHANT, MCC = ("merchant_id",), ("merchant_category_code", "currency")
# Stored table to its keys.
TABLES = {"merchant_sketches": MERCHANT, "mcc_sketches": MCC}


def distinct_between(spark: SparkSession, zones: Zones, dataset: str, first: str, last: str) -> DataFrame:
    """Distinct counts over all processing dates from ``first`` to ``last``; other dates are not read."""
    dates = [("processing_date", ">=", first), ("processing_date", "<=", last)]
    stored = read_table(spark, zones, "analytics", dataset, dates)
    return with_estimates(unite_sketches(stored, TABLES[dataset]))
