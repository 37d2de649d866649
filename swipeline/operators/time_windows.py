"""Event-time window aggregates, one definition for tables and for streams.

On a table the watermark has no effect; on a stream it bounds the state and decides when a window
is final. Both aggregates group twice. The first grouping is on a finer key and takes the raw rows,
combined on the map side; the second works on its small output. That makes distinct counts exact
and legal on a stream, spreads a large merchant over its cards, and spares the sliding window from
copying each transaction into every window that covers it.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swipeline.functions.columns import MONEY_SUM, magnitude, share, volume
from swipeline.schemas import SPEND_TYPES


def merchant_volume(df: DataFrame, width: str = "5 minutes", delay: str = "10 minutes") -> DataFrame:
    """Spending count, value and distinct cards per merchant and tumbling window."""
    per_card = (
        df.withWatermark("timestamp", delay)
        .where(F.col("transaction_type").isin(*SPEND_TYPES))
        .groupBy(F.window("timestamp", width), "merchant_id", "card_hash")
        .agg(F.count(F.lit(1)).alias("_txns"), F.sum(magnitude()).alias("_value"))
    )
    return (
        per_card.groupBy("window", "merchant_id")
        .agg(
            F.sum("_txns").alias("txn_count"),
            F.sum("_value").cast(MONEY_SUM).alias("total_value"),
            F.count("card_hash").alias("unique_cards"),
        )
        .select("window.start", "window.end", "merchant_id", "txn_count", "total_value", "unique_cards")
        .withColumnsRenamed({"start": "window_start", "end": "window_end"})
    )


def _seconds(duration: str) -> int:
    """Seconds of a duration such as ``1 hour 30 minutes``."""
    size = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}
    words = duration.split()
    return sum(int(n) * size[unit.rstrip("s")] for n, unit in zip(words[::2], words[1::2], strict=True))


def issuer_cross_border_ratio(
    df: DataFrame, width: str = "1 hour", slide: str = "15 minutes", delay: str = "15 minutes"
) -> DataFrame:
    """Cross-border share of all transactions per issuer and sliding window.

    Transactions are first summed in panes of the greatest length that divides both ``width`` and
    ``slide``, so every window is made of whole panes. A slide longer than the width leaves gaps.
    """
    pane = gcd(_seconds(width), _seconds(slide))
    panes = (
        df.withWatermark("timestamp", delay)
        .groupBy(F.window("timestamp", f"{pane} seconds").alias("_pane"), "issuer_id")
        .agg(
            F.count(F.lit(1)).alias("_txns"),
            F.sum(F.col("is_cross_border").cast("long")).alias("_crossing"),
        )
    )
    return (
        panes.groupBy(F.window(F.window_time("_pane"), width, slide), "issuer_id")
        .agg(
            F.sum("_txns").alias("total_txns"),
            F.sum("_crossing").alias("cross_border_txns"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "issuer_id",
            "total_txns",
            "cross_border_txns",
            share(F.col("cross_border_txns"), F.col("total_txns"), 4).alias("cross_border_ratio"),
        )
    )


def card_daily_totals(df: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Spending per card and UTC day, with the time of the last transaction.

    The key is a one-day window, not a bare date, so that a stream keeps its watermark.
    """
    return (
        df.withWatermark("timestamp", delay)
        .where(F.col("transaction_type").isin(*SPEND_TYPES))
        .groupBy("card_hash", F.window("timestamp", "1 day"))
        .agg(
            F.count(F.lit(1)).alias("daily_txn_count"),
            volume().alias("daily_spend"),
            F.max("timestamp").alias("last_seen"),
        )
        .select(
            "card_hash",
            F.to_date("window.start").alias("date"),
            "daily_txn_count",
            "daily_spend",
            "last_seen",
        )
    )
