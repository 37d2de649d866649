"""Daily batch reports over one processing date of transactions.

Each report is one grouped aggregate, so Spark combines on the map side before the only shuffle of
fact rows, and a key that holds most of the rows arrives as one partial row per task. Distinct
counts are shuffled on (group, value) first, which spreads a large group as well. Dimension joins
carry no hint: Spark broadcasts a dimension whose size it knows to be below the threshold and
otherwise shuffles, with AQE splitting skewed keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swipeline.functions.columns import (
    MONEY_SUM,
    approval_rate,
    count_of,
    distinct_count,
    magnitude,
    mean_magnitude,
    share,
    volume,
    volume_of,
)
from swipeline.schemas import SETTLED_TYPES, SPEND_TYPES


def _dated(processing_date: str) -> Column:
    return F.lit(processing_date).alias("processing_date")


def _mark_known(df: DataFrame, dimension: DataFrame, key: str, flag: str) -> DataFrame:
    keys = dimension.select(key).distinct().withColumn(flag, F.lit(True))
    return df.join(keys, key, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def settlement(
    txns: DataFrame, acquirers: DataFrame, issuers: DataFrame, processing_date: str
) -> DataFrame:
    """Net settlement per acquirer, issuer and currency; p2p is not settled.

    Declined transactions count as well. Unknown acquirers and issuers stay in the report and are
    marked by ``acquirer_known`` and ``issuer_known``.
    """
    totals = (
        txns.where(F.col("transaction_type").isin(*SETTLED_TYPES))
        .groupBy("acquirer_id", "issuer_id", "currency")
        .agg(
            *[
                column
                for kind in SETTLED_TYPES
                for column in (
                    count_of(kind).alias(f"{kind}_count"),
                    volume_of(kind).alias(f"{kind}_volume"),
                )
            ]
        )
    )
    net = F.col("purchase_volume") - F.col("refund_volume") - F.col("chargeback_volume")
    marked = _mark_known(totals, acquirers, "acquirer_id", "acquirer_known")
    marked = _mark_known(marked, issuers, "issuer_id", "issuer_known")
    return marked.select(
        *totals.columns,
        net.cast(MONEY_SUM).alias("net_settlement_amount"),
        "acquirer_known",
        "issuer_known",
        _dated(processing_date),
    )


def mcc_spending(txns: DataFrame, processing_date: str) -> DataFrame:
    """Spending per merchant category and currency."""
    return (
        txns.where(F.col("transaction_type").isin(*SPEND_TYPES))
        .groupBy("merchant_category_code", "currency")
        .agg(
            F.count(F.lit(1)).alias("txn_count"),
            volume().alias("total_spend"),
            mean_magnitude().alias("avg_txn_amount"),
            F.max(magnitude()).alias("max_txn_amount"),
            F.countDistinct("merchant_id").alias("active_merchant_count"),
            F.countDistinct("card_hash").alias("unique_cards"),
            approval_rate().alias("approval_rate"),
        )
        .withColumn("processing_date", _dated(processing_date))
    )


def merchant_summary(txns: DataFrame, processing_date: str) -> DataFrame:
    """One row per merchant over all transaction types.

    The category code is the one on the merchant's first transaction by id, so reruns agree. It is
    found apart from the other measures: it is a text, which Spark aggregates by sorting, and the
    sort should not carry along the distinct count of cards.
    """
    measures = txns.groupBy("merchant_id").agg(
        F.count(F.lit(1)).alias("total_txns"),
        count_of("purchase").alias("purchase_count"),
        count_of("refund").alias("refund_count"),
        count_of("chargeback").alias("chargeback_count"),
        volume_of("purchase").alias("purchase_volume"),
        approval_rate().alias("approval_rate"),
        distinct_count("card_hash").alias("unique_cards"),
    )
    categories = txns.groupBy(F.col("merchant_id").alias("_merchant")).agg(
        F.min_by("merchant_category_code", "transaction_id").alias("merchant_category_code")
    )
    same = F.col("merchant_id").eqNullSafe(F.col("_merchant"))
    return measures.join(categories, same).drop("_merchant").withColumn("processing_date", _dated(processing_date))


def corridor_volume(txns: DataFrame, issuers: DataFrame, processing_date: str) -> DataFrame:
    """Cross-border volume per issuing country, merchant country and currency.

    A transaction of an unknown issuer counts under its merchant country.
    """
    crossing = txns.where(F.col("is_cross_border") & F.col("transaction_type").isin(*SPEND_TYPES))
    homes = issuers.select("issuer_id", F.col("country_code").alias("_issuer_home"))
    return (
        crossing.join(homes, "issuer_id", "left")
        .groupBy(
            F.coalesce("_issuer_home", "country_code").alias("issuer_country"),
            F.col("country_code").alias("merchant_country"),
            "currency",
        )
        .agg(
            F.count(F.lit(1)).alias("txn_count"),
            volume().alias("total_value"),
            mean_magnitude().alias("avg_amount"),
            F.countDistinct("card_hash").alias("unique_cards"),
            F.countDistinct("merchant_id").alias("unique_merchants"),
        )
        .select(
            "issuer_country",
            "merchant_country",
            "currency",
            F.concat("issuer_country", F.lit("→"), "merchant_country").alias("corridor"),
            "txn_count",
            "total_value",
            "avg_amount",
            "unique_cards",
            "unique_merchants",
            _dated(processing_date),
        )
    )


def chargeback_ratios(
    txns: DataFrame, merchants: DataFrame, processing_date: str, threshold: float = 0.02
) -> DataFrame:
    """Chargeback share per merchant with at least one purchase, by count and by value.

    Merchants above ``threshold`` are flagged on the unrounded count ratio.
    """
    totals = (
        txns.where(F.col("transaction_type").isin("purchase", "chargeback"))
        .groupBy("merchant_id")
        .agg(
            count_of("purchase").alias("purchase_count"),
            volume_of("purchase").alias("purchase_volume"),
            count_of("chargeback").alias("chargeback_count"),
            volume_of("chargeback").alias("chargeback_volume"),
        )
        .where("purchase_count > 0")
    )
    names = merchants.select("merchant_id", "merchant_name", "merchant_category_code")
    bad, good = F.col("chargeback_count"), F.col("purchase_count")
    bad_value, good_value = F.col("chargeback_volume"), F.col("purchase_volume")
    return totals.join(names, "merchant_id", "left").select(
        "merchant_id",
        "merchant_name",
        "merchant_category_code",
        "purchase_count",
        "purchase_volume",
        "chargeback_count",
        "chargeback_volume",
        share(bad, good, 6).alias("chargeback_ratio_count"),
        share(bad_value, good_value + bad_value, 6).alias("chargeback_ratio_value"),
        (bad / good > F.lit(float(threshold))).alias("is_flagged"),
        F.lit(float(threshold)).alias("threshold_applied"),
        _dated(processing_date),
    )
