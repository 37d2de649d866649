"""Time the headline queries and print one JSON line.

``queries`` are this library's operators; ``baseline`` times the literal query shapes they replace
(self-join, a pass per rule, two aggregates and a join, ...) on the same tables in the same
session. After a warm-up of everything, the two forms of a query run in turn; each figure is the best
of ``BENCH_RUNS`` runs, results going nowhere. What takes longer than ``SLOW`` seconds runs once.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from swipeline.operators.fraud import flag_geo_impossibility
from swipeline.plans.binding import card_stream, ledger, merchants
from swipeline.plans.catalog import all_queries
from swipeline.session import open_session

HEADLINE = (
    "settlement", "mcc_spending", "merchant_summary", "corridor_volume", "chargeback_ratios",
    "fraud_velocity", "fraud_amount", "fraud_geo", "fraud_geo_hot_card", "fraud_all",
    "merchant_volume_5min", "issuer_xborder_1h", "card_daily", "dq_report",
)


def two_aggregates_and_a_join(spark: SparkSession, sf_dir: str) -> None:
    def sums(kind: str, prefix: str) -> DataFrame:
        size = F.abs(F.col("amount").cast("double"))
        rows = ledger(spark, sf_dir).where(F.col("transaction_type") == kind)
        return rows.groupBy("merchant_id").agg(F.count("*").alias(f"{prefix}_n"), F.sum(size).alias(f"{prefix}_v"))

    both = sums("purchase", "good").join(sums("chargeback", "bad"), "merchant_id", "left")
    named = both.join(merchants(spark, sf_dir).select("merchant_id", "merchant_name"), "merchant_id", "left")
    sink(named.withColumn("ratio", F.coalesce("bad_n", F.lit(0)) / F.col("good_n")))


def pairs_of_a_card(df: DataFrame) -> DataFrame:
    """Mark cards by joining the table to itself and the distinct hits back to it."""
    at = F.unix_seconds("timestamp")
    one = df.select("card_hash", F.col("transaction_id").alias("id"), F.col("country_code").alias("country"), at.alias("at"))
    two = one.toDF("card_hash", "other_id", "other_country", "other_at")
    apart = (F.col("id") != F.col("other_id")) & (F.col("country") != F.col("other_country"))
    near = (F.col("at") - F.col("other_at")).between(0, 300)
    hits = one.join(two, "card_hash").where(apart & near).select("card_hash").distinct()
    return df.join(hits.withColumn("geo", F.lit(True)), "card_hash", "left")


def geo_self_join(spark: SparkSession, sf_dir: str) -> None:
    sink(pairs_of_a_card(card_stream(spark, sf_dir)))


def hot_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The card stream with a third of its transactions moved to one card."""
    third = F.col("transaction_id").cast("long") % 3 == 0
    return card_stream(spark, sf_dir).withColumn("card_hash", F.when(third, "hot").otherwise(F.col("card_hash")))


def geo_on_a_hot_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flag_geo_impossibility(hot_cards(spark, sf_dir), 5, busy_card_rows=10_000)


def geo_self_join_on_a_hot_card(spark: SparkSession, sf_dir: str) -> None:
    sink(pairs_of_a_card(hot_cards(spark, sf_dir)))


def one_rule_after_the_other(spark: SparkSession, sf_dir: str) -> None:
    """Each rule adds its column to the whole rows, by a sliding frame, a growing frame and a self-join."""
    card = Window.partitionBy("card_hash")
    day = card.orderBy(F.unix_seconds("timestamp")).rangeBetween(-86400, 0)
    past = card.orderBy("timestamp").rowsBetween(Window.unboundedPreceding, -1)
    size = F.col("amount").cast("double")
    rows = card_stream(spark, sf_dir).withColumn("fast", F.count("*").over(day) > 5)
    rows = rows.withColumn("odd", (F.count("*").over(past) >= 3) & (size > 3 * F.avg(size).over(past)))
    flagged = F.col("fast") | F.col("odd") | F.col("geo").isNotNull()
    sink(pairs_of_a_card(rows).withColumn("flagged", flagged))


def every_row_in_four_windows(spark: SparkSession, sf_dir: str) -> None:
    sink(
        card_stream(spark, sf_dir)
        .groupBy(F.window("timestamp", "1 hour", "15 minutes"), "issuer_id")
        .agg(F.count("*").alias("n"), F.sum(F.col("is_cross_border").cast("int")).alias("x"))
    )


def one_action_per_check(spark: SparkSession, sf_dir: str) -> None:
    df = ledger(spark, sf_dir).cache()
    try:
        df.count()
        df.agg(*[F.count(F.when(F.col(c).isNull(), 1)) for c in ("transaction_id", "amount", "timestamp")]).collect()
        df.groupBy("transaction_type").agg(F.min("amount"), F.max("amount")).collect()
        df.agg(F.count("*"), F.countDistinct("transaction_id")).collect()
        df.agg(F.max("timestamp")).collect()
        df.where(~F.col("transaction_type").isin("purchase", "refund")).groupBy("transaction_type").count().collect()
        df.join(merchants(spark, sf_dir).select("merchant_id"), "merchant_id", "left_anti").count()
    finally:
        df.unpersist()


SLOW = 20.0
BASELINE = {
    "chargeback_ratios": two_aggregates_and_a_join,
    "fraud_geo": geo_self_join,
    "fraud_geo_hot_card": geo_self_join_on_a_hot_card,
    "fraud_all": one_rule_after_the_other,
    "issuer_xborder_1h": every_row_in_four_windows,
    "dq_report": one_action_per_check,
}


def sink(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds(run) -> float:
    began = time.perf_counter()
    run()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs, warm_up = int(os.environ.get("BENCH_RUNS", "2")), 1
    spark = open_session(
        "bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
        extra={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = {**all_queries(), "fraud_geo_hot_card": geo_on_a_hot_card}
    runs_of = {("queries", name): lambda name=name: sink(queries[name](spark, sf_dir)) for name in HEADLINE}
    runs_of |= {("baseline", name): lambda shape=shape: shape(spark, sf_dir) for name, shape in BASELINE.items()}
    taken = {key: [] for key in runs_of}
    for attempt in range(warm_up + runs):
        for key in sorted(runs_of, key=lambda k: k[1]):
            if taken[key] and taken[key][0] > SLOW:
                continue
            elapsed = seconds(runs_of[key])
            if attempt >= warm_up or elapsed > SLOW:
                taken[key].append(elapsed)
    measured = {name: round(min(t), 3) for (side, name), t in taken.items() if side == "queries"}
    baseline = {name: round(min(t), 3) for (side, name), t in taken.items() if side == "baseline"}
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(measured.values()), 3),
                "unit": "sec",
                "queries": measured,
                "baseline": baseline,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
