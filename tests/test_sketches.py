from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from swipeline.operators import reports, sketches
from swipeline.sources.tables import write_date
from swipeline.sources.zones import Zones


def many(spark, rows, cards):
    """Two groups of one key and some rows without a card; a card recurs every ``cards`` rows."""
    return spark.range(rows).select(
        F.when(F.col("id") % 10 < 9, "big").otherwise("small").alias("merchant_id"),
        F.when(F.col("id") % 7 > 0, (F.col("id") % cards).cast("string")).alias("card_hash"),
        (F.col("id") % 3).alias("day"),
    )


@pytest.mark.parametrize("lg_k", [10, 12, 14])
def test_union_of_dates_is_within_the_bound_of_the_whole(spark, lg_k):
    df = many(spark, 200_000, 50_000)
    stored = sketches.distinct_sketches(df, ["merchant_id", "day"], ["card_hash"], lg_k)
    united = sketches.with_estimates(sketches.unite_sketches(stored, ["merchant_id"]))
    exact = df.groupBy("merchant_id").agg(F.countDistinct("card_hash").alias("exact"), F.count("*").alias("n"))
    for row in united.join(exact, "merchant_id").collect():
        assert abs(row.approx_card_hash - row.exact) <= 4 * sketches.standard_error(lg_k) * row.exact
        assert row.txn_count == row.n


def test_unions_can_be_stored_and_united_again(spark):
    df = many(spark, 20_000, 3_000)
    daily = sketches.distinct_sketches(df, ["merchant_id", "day"], ["card_hash"])
    twice = sketches.unite_sketches(sketches.unite_sketches(daily, ["merchant_id"]), [])
    row = sketches.with_estimates(twice).first()
    exact = df.agg(F.countDistinct("card_hash")).first()[0]
    assert row.txn_count == 20_000 and abs(row.approx_card_hash - exact) <= 4 * sketches.standard_error() * exact


def test_few_values_are_exact_and_absent_ones_do_not_count(txns):
    df = txns({"card_hash": "a"}, {"card_hash": "b"}, {"card_hash": "a"}, {"merchant_id": None}, {"merchant_id": "x", "card_hash": None})
    got = sketches.with_estimates(sketches.merchant_sketches(df))
    exact = reports.merchant_summary(df, "2024-01-15").select("merchant_id", "total_txns", "unique_cards")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, exact.collect()), key=str)
    assert sketches.with_estimates(sketches.mcc_sketches(df.limit(0))).collect() == []


def test_dates_between(spark, txns, scratch):
    zones = Zones.under(scratch)
    for day, cards in (("2024-01-14", "ab"), ("2024-01-15", "bc"), ("2024-01-16", "cde")):
        df = sketches.mcc_sketches(txns(*[{"card_hash": card} for card in cards]))
        write_date(df, zones, "analytics", "mcc_sketches", day)
    got = sketches.distinct_between(spark, zones, "mcc_sketches", "2024-01-14", "2024-01-15")
    assert got.select("txn_count", "approx_card_hash", "approx_merchant_id").collect() == [(4, 3, 1)]
    assert "PartitionFilters: [isnotnull(processing_date" in got._jdf.queryExecution().toString()
