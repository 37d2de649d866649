"""Batch jobs: landing in, report tables out, for one processing date.

Row counts for the log are observed while the result is written, so nothing is computed twice.
"""

from __future__ import annotations

import argparse
import logging
import os
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from swipeline.operators import quality, reports, sketches, validation
from swipeline.schemas import optional
from swipeline.session import ObjectStore, open_session
from swipeline.sources import kafka
from swipeline.sources.landing import read_landing
from swipeline.sources.staging import Staged, staged
from swipeline.sources.tables import read_dimension, read_table, write_date, write_processed
from swipeline.sources.zones import Zones

log = logging.getLogger(__name__)

RESULTS = "data_quality_results"
CORRUPT_LINES, BROKEN_ROWS = "corrupt_lines", "quarantined_transactions"


def _settlement(spark, txns, zones, date, params):
    acquirers = read_dimension(spark, zones, "acquirers")
    issuers = read_dimension(spark, zones, "issuers")
    return {"daily_settlement": reports.settlement(txns, acquirers, issuers, date)}


def _merchants(spark, txns, zones, date, params):
    return {
        "mcc_spending": reports.mcc_spending(txns, date),
        "merchant_summary": reports.merchant_summary(txns, date),
    }


def _corridors(spark, txns, zones, date, params):
    issuers = read_dimension(spark, zones, "issuers")
    return {"cross_border_corridors": reports.corridor_volume(txns, issuers, date)}


def _chargebacks(spark, txns, zones, date, params):
    dimension = read_dimension(spark, zones, "merchants")
    return {"chargeback_ratios": reports.chargeback_ratios(txns, dimension, date, **params)}


def _sketches(spark, txns, zones, date, params):
    return {"merchant_sketches": sketches.merchant_sketches(txns), "mcc_sketches": sketches.mcc_sketches(txns)}


REPORTS: dict[str, Callable[..., dict[str, DataFrame]]] = {
    "settlement": _settlement,
    "merchants": _merchants,
    "corridors": _corridors,
    "chargebacks": _chargebacks,
    "sketches": _sketches,
}


def run_job(spark: SparkSession, name: str, date: str, zones: Zones, **params) -> dict[str, dict[str, int]]:
    """Compute the reports of one job and write them to their date partition.

    Returns the observed row counts per output table, with ``flagged`` where a report has flags, and
    those of the corrupt lines that it stored. A date that has not landed is an error and leaves what is
    stored alone.
    """
    with staged(spark, zones, date, required=True) as lines:
        counts = {CORRUPT_LINES: _store_corrupt(lines, zones, date, name)}
        for dataset, report in REPORTS[name](spark, lines.transactions, zones, date, params).items():
            metrics = [F.count(F.lit(1)).alias("rows")]
            if "is_flagged" in report.columns:
                metrics.append(F.count_if("is_flagged").alias("flagged"))
            seen = Observation(dataset)
            write_date(report.observe(seen, *metrics), zones, "analytics", dataset, date)
            counts[dataset] = dict(seen.get)
            log.info("%s for %s written to %s: %s", name, date, dataset, counts[dataset])
    return counts


def _store_corrupt(lines: Staged, zones: Zones, date: str, job: str) -> dict[str, int]:
    """The corrupt lines that a job met, in a folder of its own, so that jobs of a date can run side by side."""
    write_date(lines.corrupt.drop("date"), zones, "quality", CORRUPT_LINES, date, job=job)
    if lines.counts["corrupt"]:
        log.warning("%s for %s: %s of the lines are corrupt", job, date, lines.counts)
    return {"rows": lines.counts["corrupt"]}


def run_processed(spark: SparkSession, date: str, zones: Zones) -> None:
    """Landing to the processed zone for one date.

    Lines that do not parse and rows that break a rule are stored in the quality zone instead, the
    former as they came, the latter with the names of the rules.
    """
    with staged(spark, zones, date, required=True) as lines:
        valid, broken = validation.split(validation.validate(lines.transactions.drop("date", "hour")))
        _store_corrupt(lines, zones, date, "processed")
        write_date(broken, zones, "quality", BROKEN_ROWS, date)
        write_processed(valid, zones)


def run_publish(spark: SparkSession, date: str, zones: Zones, servers: str, topic: str) -> int:
    """Send the transactions of one date to a topic, keyed by card; returns how many.

    Corrupt lines are stored, not sent. A rerun sends all again: a topic has no partition to replace, and
    ``run_streams.py land`` takes each transaction once.
    """
    with staged(spark, zones, date, required=True) as lines:
        _store_corrupt(lines, zones, date, "publish")
        kafka.write(lines.transactions.drop("date", "hour"), servers, topic)
    return lines.counts["transactions"]


def run_quality(
    spark: SparkSession, date: str, zones: Zones, now: datetime | None = None, max_age_hours: float = 2.0
) -> None:
    """Check one date and store the results.

    If the combined report cannot run, each check runs on its own, over the landing zone itself, and
    those that cannot run are stored as failed.
    """
    now = now or datetime.now(timezone.utc)
    merchants = _merchants_or_none(spark, zones)
    try:
        with staged(spark, zones, date) as lines:
            _store_corrupt(lines, zones, date, "quality")
            report = quality.quality_report(lines.transactions, date, now, merchants, max_age_hours)
            write_date(report, zones, "quality", RESULTS, date)
    except Exception:  # a broken input is a result, not a crash
        log.exception("combined quality report failed for %s, running the checks one by one", date)
        txns = read_landing(spark, zones, date=date)
        results = _one_by_one(spark, quality.all_checks(txns, now, merchants, max_age_hours))
        write_date(quality.stamp(results, date, now), zones, "quality", RESULTS, date)


def _merchants_or_none(spark: SparkSession, zones: Zones) -> DataFrame | None:
    try:
        return read_dimension(spark, zones, "merchants")
    except Exception as error:  # the referential check is then skipped with a warning
        log.warning("merchants dimension not readable: %s", error)
        return None


def _one_by_one(spark: SparkSession, checks: dict[str, DataFrame]) -> DataFrame:
    """Evaluate single-row checks separately; an exception becomes a failed check."""
    schema = next(iter(checks.values())).schema
    rows = []
    for name, check in checks.items():
        try:
            rows.append(check.first())
        except Exception as error:
            rows.append((name, quality.FAIL, f"The check failed: {error}", None, None, {}))
    return spark.createDataFrame(rows, optional(schema))


def gate_passed(spark: SparkSession, date: str, zones: Zones) -> bool:
    """Whether the stored checks let a date go on; results that cannot be read block it."""
    try:
        results = read_table(spark, zones, "quality", RESULTS)
        return bool(quality.quality_gate(results, date).first().gate_passed)
    except Exception as error:
        log.warning("quality results not readable for %s: %s", date, error)
        return False


def main(argv: list[str] | None = None) -> int:
    """Command line of the jobs; the exit code is 1 when the gate is closed."""
    parser = argparse.ArgumentParser(description="Run one batch job")
    parser.add_argument("job", choices=[*REPORTS, "processed", "quality", "publish", "gate"])
    parser.add_argument("--date", required=True, help="processing date, YYYY-MM-DD")
    parser.add_argument("--threshold", type=float, default=0.02, help="chargeback ratio that flags a merchant")
    parser.add_argument("--max-age-hours", type=float, default=2.0, help="age at which data is stale")
    parser.add_argument("--shuffle-partitions", type=int, help="default: the cluster's setting")
    args = parser.parse_args(argv)
    logging.basicConfig(level=os.environ.get("LOG_LEVEL", "INFO"))
    servers = os.environ.get("KAFKA_BOOTSTRAP_SERVERS")
    if args.job == "publish" and not servers:
        parser.error("publishing needs KAFKA_BOOTSTRAP_SERVERS")
    store = ObjectStore.from_env(os.environ)
    spark = open_session(f"swipeline-{args.job}", shuffle_partitions=args.shuffle_partitions, store=store)
    zones = Zones.from_env(os.environ)
    if args.job == "gate":
        return 0 if gate_passed(spark, args.date, zones) else 1
    if args.job == "quality":
        run_quality(spark, args.date, zones, max_age_hours=args.max_age_hours)
    elif args.job == "processed":
        run_processed(spark, args.date, zones)
    elif args.job == "publish":
        topic = os.environ.get("KAFKA_TOPIC_TRANSACTIONS", kafka.TOPIC)
        log.info("%s transactions of %s sent to %s", run_publish(spark, args.date, zones, servers, topic), args.date, topic)
    else:
        params = {"threshold": args.threshold} if args.job == "chargebacks" else {}
        run_job(spark, args.job, args.date, zones, **params)
    return 0
