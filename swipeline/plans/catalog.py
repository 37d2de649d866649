"""The named queries: each operator over the driver's tables.

Thresholds are tuned to this data, where the defaults would flag everything or nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swipeline.functions.columns import card_token
from swipeline.operators import fraud, quality, reports, sketches, time_windows, validation
from swipeline.plans.binding import banks, card_stream, ledger, merchants, places, table
from swipeline.sources import kafka
from swipeline.sources.landing import encode_json, for_landing, parse_json, parsed, read_landing, write_landing
from swipeline.sources.tables import read_table, write_date, write_processed, write_table
from swipeline.sources.zones import Zones, scratch_dir
from swipeline.streaming import sinks
from swipeline.streaming.closing import close_finished, current_totals
from swipeline.streaming.replay import once_each
from swipeline.streaming.sources import table_stream
from swipeline.streaming.state import card_alerts

Query = Callable[[SparkSession, str], DataFrame]

DATE = "2024-01-15"
NOW = datetime(2024, 2, 1)
CHARGEBACK_THRESHOLD = 0.5
TUNED = fraud.FraudConfig(velocity_window_seconds=86400, geo_window_minutes=5)
# Cards of the small tables lie on both sides of this.
BUSY_ROWS = 65
REPORT_COLUMNS = ("check_name", "status", "message", "metric_value", "threshold", "passed", "processing_date")

_REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    _REGISTRY[fn.__name__] = in_utc
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


# Reports


@query
def settlement(spark, sf_dir):
    acquirers, issuers = banks(spark, sf_dir, "acquirer_id"), banks(spark, sf_dir, "issuer_id")
    return reports.settlement(ledger(spark, sf_dir), acquirers, issuers, DATE)


@query
def mcc_spending(spark, sf_dir):
    return reports.mcc_spending(ledger(spark, sf_dir), DATE)


@query
def merchant_summary(spark, sf_dir):
    return reports.merchant_summary(ledger(spark, sf_dir), DATE)


@query
def corridor_volume(spark, sf_dir):
    # The issuers of one region are unknown, so the fallback country is used as well.
    known = places(spark, sf_dir).where("r_name <> 'AFRICA'").select(
        F.col("n_nationkey").cast("string").alias("issuer_id"), F.col("n_name").alias("country_code")
    )
    return reports.corridor_volume(ledger(spark, sf_dir), known, DATE)


@query
def chargeback_ratios(spark, sf_dir):
    return reports.chargeback_ratios(
        ledger(spark, sf_dir), merchants(spark, sf_dir), DATE, CHARGEBACK_THRESHOLD
    )


@query
def distinct_sketches(spark, sf_dir):
    """Sketches stored by year, united over all years, beside the exact counts of the whole.

    ``cards_ok`` and ``merchants_ok`` say that an estimate is within four standard errors.
    """
    zones, df = Zones.under(scratch_dir(spark, "sketches")), ledger(spark, sf_dir)
    keys, counted = ("merchant_category_code", "currency"), ("card_hash", "merchant_id")
    yearly = sketches.distinct_sketches(df.withColumn("year", F.year("timestamp")), (*keys, "year"), counted)
    write_table(yearly, zones, "analytics", "yearly", ["year"])
    stored = read_table(spark, zones, "analytics", "yearly")
    united = sketches.with_estimates(sketches.unite_sketches(stored, keys))
    exact = df.groupBy(*keys).agg(*[F.countDistinct(name).alias(f"unique_{name}") for name in counted])

    def close(name):
        gap = F.abs(F.col(f"approx_{name}") - F.col(f"unique_{name}"))
        return gap <= 4 * sketches.standard_error() * F.col(f"unique_{name}")

    return united.join(exact, list(keys)).select(
        *keys, "txn_count", F.col("unique_card_hash").alias("unique_cards"),
        F.col("unique_merchant_id").alias("unique_merchants"),
        close("card_hash").alias("cards_ok"), close("merchant_id").alias("merchants_ok"),
    )


# Fraud


@query
def fraud_velocity(spark, sf_dir):
    df = card_stream(spark, sf_dir)
    return fraud.flag_velocity(df, TUNED.velocity_window_seconds, TUNED.velocity_max_txns).select(
        "transaction_id", "card_hash", "velocity_count", "fraud_velocity"
    )


@query
def fraud_amount(spark, sf_dir):
    return fraud.flag_amount_anomaly(card_stream(spark, sf_dir)).select(
        "transaction_id",
        "card_hash",
        "amount_dbl",
        F.round("rolling_avg", 6).alias("rolling_avg"),
        "prior_sample_count",
        "fraud_amount_anomaly",
    )


@query
def fraud_geo(spark, sf_dir):
    return fraud.flag_geo_impossibility(card_stream(spark, sf_dir), TUNED.geo_window_minutes).select(
        "transaction_id", "card_hash", "country_code", "fraud_geo_impossibility"
    )


@query
def multi_country_cards(spark, sf_dir):
    return fraud.multi_country_cards(card_stream(spark, sf_dir), TUNED.geo_window_minutes)


def _with_absent(df):
    """Ids, countries and times absent on some rows, by the number of the transaction."""
    number = F.col("transaction_id").cast("long")
    return df.withColumns(
        {
            "country_code": F.when(number % 5 != 1, F.col("country_code")),
            "timestamp": F.when(number % 7 != 2, F.col("timestamp")),
            "transaction_id": F.when(number % 3 != 0, F.col("transaction_id")),
            "event": F.col("transaction_id"),
        }
    )


@query
def fraud_geo_gaps(spark, sf_dir):
    """Rows without an id, a country or a time are nobody's partner, on either route."""
    df = _with_absent(card_stream(spark, sf_dir))
    routes = [
        fraud.flag_geo_impossibility(df, 60, limit).select(
            "event", "card_hash", F.col("fraud_geo_impossibility").alias(name)
        )
        for name, limit in (("geo_hit", TUNED.busy_card_rows), ("geo_hit_as_busy", BUSY_ROWS))
    ]
    return routes[0].join(routes[1], ["event", "card_hash"])


def _scored(spark, sf_dir, config=TUNED):
    return fraud.apply_all_fraud_rules(card_stream(spark, sf_dir), config).select(
        "transaction_id", "card_hash", "amount", "country_code", "transaction_type",
        "fraud_reasons", "is_fraud_flagged",
    )


@query
def fraud_all(spark, sf_dir):
    return _scored(spark, sf_dir)


@query
def fraud_all_busy_cards(spark, sf_dir):
    busy = fraud.FraudConfig(velocity_window_seconds=86400, geo_window_minutes=5, busy_card_rows=BUSY_ROWS)
    return _scored(spark, sf_dir, busy)


@query
def fraud_hot_second(spark, sf_dir):
    """A third of the rows lies in three seconds of one card, another eighth has no time at all."""
    number = F.col("transaction_id").cast("long")
    hot = number % 3 == 0
    second = F.unix_timestamp(F.lit("2024-01-10 12:00:00")) + number % 9 / 3
    df = card_stream(spark, sf_dir).withColumns(
        {
            "card_hash": F.when(hot, "hot").otherwise(F.col("card_hash")),
            "timestamp": F.when(number % 8 == 1, None).when(hot, F.timestamp_seconds(second.cast("long"))).otherwise(F.col("timestamp")),
        }
    )
    scored = fraud.flag_amount_anomaly(df, busy_card_rows=BUSY_ROWS)
    counted = fraud.flag_velocity(df, TUNED.velocity_window_seconds, TUNED.velocity_max_txns, BUSY_ROWS)
    velocity = counted.select("transaction_id", "velocity_count", "fraud_velocity")
    return scored.join(velocity, "transaction_id").select(
        "transaction_id", "card_hash", F.round("rolling_avg", 6).alias("rolling_avg"), "prior_sample_count",
        "fraud_amount_anomaly", "velocity_count", "fraud_velocity",
    )


@query
def fraud_flagged_only(spark, sf_dir):
    return _scored(spark, sf_dir).where("is_fraud_flagged")


# Windows


@query
def merchant_volume_5min(spark, sf_dir):
    return time_windows.merchant_volume(card_stream(spark, sf_dir))


@query
def issuer_xborder_1h(spark, sf_dir):
    return time_windows.issuer_cross_border_ratio(card_stream(spark, sf_dir))


@query
def issuer_xborder_50_20(spark, sf_dir):
    return time_windows.issuer_cross_border_ratio(card_stream(spark, sf_dir), "50 minutes", "20 minutes")


@query
def card_daily(spark, sf_dir):
    return time_windows.card_daily_totals(card_stream(spark, sf_dir))


# Quality


def _active_merchants(spark, sf_dir):
    solvent = table(spark, sf_dir, "supplier").where("s_acctbal > 0")
    return solvent.select(F.col("s_suppkey").cast("string").alias("merchant_id"))


def _with_gaps(df):
    """Absent amounts on declined and absent merchants on p2p transactions."""
    return df.withColumn("amount", F.when(F.col("response_code") == "00", F.col("amount"))).withColumn(
        "merchant_id", F.when(F.col("transaction_type") != "p2p", F.col("merchant_id"))
    )


@query
def dq_nulls(spark, sf_dir):
    return quality.null_counts(_with_gaps(ledger(spark, sf_dir)))


@query
def dq_referential(spark, sf_dir):
    return quality.orphan_counts(ledger(spark, sf_dir), _active_merchants(spark, sf_dir))


@query
def dq_amount_ranges(spark, sf_dir):
    return quality.amount_range_violations(ledger(spark, sf_dir))


@query
def dq_duplicates(spark, sf_dir):
    return quality.duplicate_counts(ledger(spark, sf_dir))


@query
def dq_freshness(spark, sf_dir):
    return quality.newest_age(card_stream(spark, sf_dir), NOW).select(
        "latest", F.round("age_hours", 6).alias("age_hours")
    )


@query
def dq_transaction_types(spark, sf_dir):
    odd = (
        F.when((F.col("transaction_type") == "p2p") & (F.col("currency") == "ASIA"), "wire_transfer")
        .when((F.col("transaction_type") == "p2p") & (F.col("currency") == "AFRICA"), None)
        .otherwise(F.col("transaction_type"))
    )
    df = ledger(spark, sf_dir).withColumn("transaction_type", odd)
    return quality.invalid_types(df).withColumnRenamed("count", "row_count")


def _report(df, date, dimension, now=NOW):
    return quality.quality_report(df, date, now, dimension)


@query
def dq_report(spark, sf_dir):
    report = _report(_with_gaps(ledger(spark, sf_dir)), DATE, _active_merchants(spark, sf_dir))
    return report.select(*REPORT_COLUMNS).withColumn("metric_value", F.round("metric_value", 6))


@query
def dq_gate(spark, sf_dir):
    """Store the results of a failing and a passing date, then ask for both and for a third."""
    zones = Zones.under(scratch_dir(spark, "gate"))
    bad = _report(ledger(spark, sf_dir), DATE, _active_merchants(spark, sf_dir))
    good = _report(card_stream(spark, sf_dir), "2024-01-30", merchants(spark, sf_dir), datetime(2024, 1, 1))
    for report, date in ((bad, DATE), (good, "2024-01-30")):
        write_date(report, zones, "quality", "results", date)
    stored = read_table(spark, zones, "quality", "results")
    gates = [quality.quality_gate(stored, date) for date in (DATE, "2024-01-30", "2024-01-31")]
    return gates[0].unionByName(gates[1]).unionByName(gates[2])


# Sources, sinks and validation


@query
def json_parse(spark, sf_dir):
    """Encode as JSON, spoil the declined rows, parse: good rows with their fields, bad with their text."""
    txns = card_stream(spark, sf_dir)
    spoiled = F.concat(F.lit("#"), F.col("transaction_id"))
    messages = txns.select(
        F.when(F.col("response_code") == "51", spoiled).otherwise(encode_json(txns)).cast("binary").alias("value")
    )
    good, bad = parsed(parse_json(messages))
    return good.select(
        "transaction_id", "card_hash", "amount", "timestamp", "transaction_type", "is_cross_border"
    ).unionByName(bad.withColumnRenamed("_corrupt_record", "corrupt_text"), allowMissingColumns=True)


@query
def kafka_encode(spark, sf_dir):
    fields = ("transaction_id", "amount", "timestamp", "transaction_type", "is_cross_border")
    return kafka.encode(card_stream(spark, sf_dir)).select(
        "key", *[F.get_json_object("value", f"$.{name}").alias(name) for name in fields]
    )


@query
def landing_scan(spark, sf_dir):
    zones = Zones.under(scratch_dir(spark, "landing"))
    write_landing(card_stream(spark, sf_dir), zones)
    return read_landing(spark, zones).select(
        "transaction_id", "card_hash", "amount", "timestamp", "is_cross_border",
        F.col("date").cast("string").alias("date"), "hour",
    )


@query
def filtered_scan(spark, sf_dir):
    zones = Zones(*[sf_dir] * 6)
    filters = [("l_quantity", ">=", 30.0), ("l_returnflag", "=", "N"), ("l_discount", "<", 0.05)]
    return read_table(spark, zones, "processed", "lineitem.parquet", filters).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag"
    )


@query
def processed_zone(spark, sf_dir):
    """Every declined transaction arrives twice, the second time later and with another amount."""
    zones = Zones.under(scratch_dir(spark, "processed"))
    txns = card_stream(spark, sf_dir)
    replayed = txns.where(F.col("response_code") == "51").withColumns(
        {"timestamp": F.col("timestamp") + F.expr("INTERVAL 1 HOUR"), "amount": -F.col("amount")}
    )
    write_processed(replayed.unionByName(txns), zones)
    return read_table(spark, zones, "processed", "transactions").select(
        "transaction_id", "card_hash", "merchant_id", "amount", "transaction_type",
        F.col("date").cast("string").alias("date"),
    )


@query
def settlement_roundtrip(spark, sf_dir):
    """Write two dates, the first one twice, and read the table back."""
    zones = Zones.under(scratch_dir(spark, "settlement"))
    txns = ledger(spark, sf_dir)
    acquirers, issuers = banks(spark, sf_dir, "acquirer_id"), banks(spark, sf_dir, "issuer_id")
    early = F.col("timestamp") < F.lit("2000-01-01").cast("timestamp")
    for part, date in ((early, "2024-01-15"), (~early, "2024-01-16"), (early, "2024-01-15")):
        report = reports.settlement(txns.where(part), acquirers, issuers, date)
        write_table(report, zones, "analytics", "daily_settlement", ["processing_date"])
    return read_table(spark, zones, "analytics", "daily_settlement").withColumn(
        "processing_date", F.col("processing_date").cast("string")
    )


def _with_odd_rows(df):
    """Codes cut from names in lower case, some too long, and the sign dropped on refunds."""
    country = F.when(F.col("transaction_type") == "p2p", F.lower(F.substring("country_code", 1, 3))).otherwise(
        F.lower(F.substring("country_code", 1, 2))
    )
    return df.withColumns(
        {
            "currency": F.lower(F.substring("currency", 1, 3)),
            "country_code": country,
            "merchant_category_code": F.when(
                F.col("response_code") == "00", F.col("merchant_category_code")
            ).otherwise("51"),
            "amount": F.when(F.col("transaction_type") == "refund", -F.col("amount")).otherwise(F.col("amount")),
        }
    )


def _both_sides(valid, quarantined):
    columns = ["transaction_id", "currency", "country_code", "amount"]
    return valid.select(*columns, F.lit("").alias("failed_rules")).unionByName(
        quarantined.select(*columns, F.concat_ws("|", "failed_rules").alias("failed_rules"))
    )


@query
def validate_rows(spark, sf_dir):
    raw = _with_odd_rows(card_stream(spark, sf_dir))
    return _both_sides(*validation.split(validation.validate(raw)))


@query
def response_breakdown(spark, sf_dir):
    return validation.response_breakdown(ledger(spark, sf_dir))


@query
def card_tokenize(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", card_token(F.col("user_id")).alias("card_hash"))


# Streams: run to the end of the input, then read the output table.


@contextmanager
def _rocksdb(spark):
    """The state store that keyed state needs, for as long as one query runs."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _drain(spark, sf_dir, start) -> str:
    """Run ``start(source, path, checkpoint)`` over the events; returns the output path."""
    root = scratch_dir(spark, "stream")
    events = table_stream(spark, f"{sf_dir}/event[s].parquet", table(spark, sf_dir, "events").schema)
    start(card_stream(spark, sf_dir, events), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return f"{root}/out"


def _appended(spark, sf_dir, operator):
    return spark.read.parquet(
        _drain(spark, sf_dir, lambda s, path, cp: sinks.append_table(operator(s), path, cp, sinks.ONCE))
    )


@query
def stream_merchant_volume(spark, sf_dir):
    return _appended(spark, sf_dir, time_windows.merchant_volume)


@query
def stream_issuer_xborder(spark, sf_dir):
    return _appended(spark, sf_dir, time_windows.issuer_cross_border_ratio)


@query
def stream_issuer_xborder_50_20(spark, sf_dir):
    return _appended(spark, sf_dir, lambda s: time_windows.issuer_cross_border_ratio(s, "50 minutes", "20 minutes"))


@query
def stream_card_daily(spark, sf_dir):
    path = _drain(
        spark,
        sf_dir,
        lambda s, path, cp: sinks.running_totals(time_windows.card_daily_totals(s), path, cp, sinks.ONCE),
    )
    return sinks.latest_totals(spark, path)


@query
def stream_card_closed(spark, sf_dir):
    """Close the dates before two marks, the first of which then lose their batch folders; read all."""
    path = _drain(
        spark,
        sf_dir,
        lambda s, path, cp: sinks.running_totals(time_windows.card_daily_totals(s), path, cp, sinks.ONCE),
    )
    closed = f"{path}-closed"
    for mark in ("2024-01-10", DATE):
        close_finished(spark, path, closed, mark)
    return current_totals(spark, path, closed)


@query
def stream_validated(spark, sf_dir):
    """Split a stream by the validation rules into two tables."""
    sides = [
        _appended(spark, sf_dir, lambda s, side=side: validation.split(validation.validate(_with_odd_rows(s)))[side])
        for side in (0, 1)
    ]
    return _both_sides(*sides)


@query
def stream_fraud_batches(spark, sf_dir):
    path = _drain(spark, sf_dir, lambda s, path, cp: sinks.score_batches(s, path, cp, sinks.ONCE, TUNED))
    return spark.read.parquet(path).select("transaction_id", "card_hash", "transaction_type", "fraud_reasons")


@query
def stream_card_alerts(spark, sf_dir):
    with _rocksdb(spark):
        alerts = _appended(spark, sf_dir, lambda s: card_alerts(s, TUNED))
    return alerts.withColumn("rolling_avg", F.round("rolling_avg", 6))


@query
def stream_landing(spark, sf_dir):
    root = _drain(spark, sf_dir, lambda s, path, cp: sinks.land(s, f"{path}/transactions", cp, sinks.ONCE))
    return read_landing(spark, Zones(*[root] * 6)).select(
        "transaction_id", "amount", "timestamp", F.col("date").cast("string").alias("date"), "hour"
    )


@query
def landing_mixed(spark, sf_dir):
    """A third each from a batch job, a stream and a foreign producer, and a crashed write of everything.

    ``of_date`` says whether a read of one date sees the row too.
    """
    number = F.col("transaction_id").cast("long")
    root = _drain(spark, sf_dir, lambda s, path, cp: sinks.land(s.where(number % 3 == 1), f"{path}/transactions", cp, sinks.ONCE))
    zones, txns = Zones(*[root] * 6), card_stream(spark, sf_dir)
    write_landing(txns.where(number % 3 == 0), zones)
    foreign = for_landing(txns.where(number % 3 == 2)).write.mode("append").partitionBy("date", "hour")
    foreign.json(f"{root}/transactions")
    crashed = for_landing(txns).withColumn("batch", F.lit("stream-crashed-0")).write.mode("append")
    crashed.partitionBy("date", "hour", "batch").json(f"{root}/transactions")
    dated = read_landing(spark, zones, date=DATE).select(F.col("transaction_id").alias("_id"), F.lit(True).alias("_seen"))
    landed = read_landing(spark, zones)
    return landed.join(dated, F.col("transaction_id") == F.col("_id"), "left").select(
        "transaction_id", "amount", "timestamp", F.col("date").cast("string").alias("date"), "hour",
        F.coalesce("_seen", F.lit(False)).alias("of_date"),
    )


@query
def stream_replayed(spark, sf_dir):
    """Land a stream whose producer sends the rows of odd number again, an hour and two days later."""
    number = F.col("transaction_id").cast("long")

    def start(s, path, cp):
        sends = F.when(number % 2 == 1, F.array(*map(F.lit, (0, 3600, 172_800)))).otherwise(F.array(F.lit(0)))
        sent = s.withColumn("_later", F.explode(sends))
        later = F.timestamp_micros(F.unix_micros("timestamp") + F.col("_later").cast("long") * 1_000_000)
        fresh, _ = once_each(sent.withColumn("arrived_at", later).drop("_later"))
        return sinks.land(fresh, f"{path}/transactions", cp, sinks.ONCE)

    root = _drain(spark, sf_dir, start)
    return read_landing(spark, Zones(*[root] * 6)).select("transaction_id", "card_hash", "amount", "timestamp")
