"""The streaming application: fraud scoring and the window aggregates over one source."""

from __future__ import annotations

import argparse
import os
from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from swipeline.operators import validation
from swipeline.operators.fraud import FraudConfig
from swipeline.operators.time_windows import card_daily_totals, issuer_cross_border_ratio, merchant_volume
from swipeline.session import ObjectStore, open_session
from swipeline.sources import kafka
from swipeline.sources.landing import parsed
from swipeline.sources.zones import Zones
from swipeline.streaming.closing import close_finished, final_before
from swipeline.streaming.progress import ProgressTable
from swipeline.streaming.replay import once_each
from swipeline.streaming.sinks import append_table, land, running_totals, score_batches
from swipeline.streaming.sources import landing_lines
from swipeline.streaming.state import card_alerts

QUARANTINE, ALERTS = "corrupt_stream_records", "card_alerts"
BROKEN = "quarantined_stream_transactions"
ASIDE, PROGRESS = "late_transactions", "stream_progress"
FRAUD, MERCHANTS, ISSUERS, CARDS = "fraud_flags", "merchant_volume", "issuer_xborder", "card_daily_totals"
CLOSED = "card_daily_closed"


@dataclass(frozen=True)
class Triggers:
    fraud: dict = field(default_factory=lambda: {"processingTime": "30 seconds"})
    merchants: dict = field(default_factory=lambda: {"processingTime": "5 minutes"})
    issuers: dict = field(default_factory=lambda: {"processingTime": "15 minutes"})
    cards: dict = field(default_factory=lambda: {"processingTime": "10 minutes"})

    @classmethod
    def once(cls) -> Triggers:
        """Process what is there, then stop."""
        return cls(*[{"availableNow": True}] * 4)


def start(
    source: DataFrame, zones: Zones, config: FraudConfig = FraudConfig(), triggers: Triggers = Triggers()
) -> dict[str, StreamingQuery]:
    """Start the four queries, each with its own output table and checkpoint."""

    def places(name: str) -> tuple[str, str]:
        return zones.path("analytics", name), zones.path("checkpoints", name)

    merchants, issuers = merchant_volume(source), issuer_cross_border_ratio(source)
    return {
        FRAUD: score_batches(source, *places(FRAUD), triggers.fraud, config, FRAUD),
        MERCHANTS: append_table(merchants, *places(MERCHANTS), triggers.merchants, MERCHANTS),
        ISSUERS: append_table(issuers, *places(ISSUERS), triggers.issuers, ISSUERS),
        CARDS: running_totals(card_daily_totals(source), *places(CARDS), triggers.cards, CARDS),
    }


def wait(spark: SparkSession, queries: dict[str, StreamingQuery]) -> list[str]:
    """Block until a query ends; raise its error by name, or return the names of the ended ones."""
    spark.streams.awaitAnyTermination()
    return ended(queries)


def ended(queries: dict[str, StreamingQuery]) -> list[str]:
    """Names of the queries that ended normally; raises if one failed."""
    names = [name for name, query in queries.items() if not query.isActive]
    for name in names:
        error = queries[name].exception()
        if error is not None:
            raise RuntimeError(f"streaming query {name} failed: {error}") from error
    return names


def start_quarantine(corrupt: DataFrame, zones: Zones, trigger: dict) -> StreamingQuery:
    """Store the texts that did not parse; none is dropped unseen."""
    place = zones.path("quality", QUARANTINE)
    return append_table(corrupt, place, zones.path("checkpoints", QUARANTINE), trigger, QUARANTINE)


def start_broken(broken: DataFrame, zones: Zones, trigger: dict) -> StreamingQuery:
    """Store the transactions that break a validation rule, with the names of the rules."""
    return append_table(broken, zones.path("quality", BROKEN), zones.path("checkpoints", BROKEN), trigger, BROKEN)


def close_dates(spark: SparkSession, zones: Zones) -> str | None:
    """Close the dates of the card totals that their stream's watermark has passed; returns the new mark."""
    mark = final_before(spark, zones.path("quality", PROGRESS), CARDS)
    if mark is not None:
        close_finished(spark, zones.path("analytics", CARDS), zones.path("analytics", CLOSED), mark)
    return mark


def start_landing(records: DataFrame, zones: Zones, trigger: dict) -> dict[str, StreamingQuery]:
    """Land each transaction of a topic once, and store those that come too late to be told from repeats."""
    fresh, aside = once_each(records)
    place = zones.path("landing", "transactions"), zones.path("checkpoints", "land")
    late = zones.path("quality", ASIDE), zones.path("checkpoints", ASIDE)
    return {"land": land(fresh, *place, trigger, "land"), ASIDE: append_table(aside, *late, trigger, ASIDE)}


def main(argv: list[str] | None = None) -> None:
    """Command line: the analytics queries, landing a topic, the alerts that see across batches, or the
    closing of dates, which ends by itself.

    Analytics and alerts take the transactions that keep the validation rules, with currency and country
    in capitals; the analytics job stores the others.
    """
    parser = argparse.ArgumentParser(description="Run streaming queries")
    parser.add_argument("job", nargs="?", default="analytics", choices=["analytics", "land", "alerts", "close"])
    parser.add_argument("--direct", action="store_true", help="read the topic, repeats included, not the landing zone")
    parser.add_argument("--unvalidated", action="store_true", help="take rows that break validation rules too")
    parser.add_argument("--forget-days", type=int, help="alerts forget a card that is idle for so long")
    parser.add_argument("--shuffle-partitions", type=int, help="fixed for a checkpoint by its first run")
    args = parser.parse_args(argv)
    env = os.environ
    spark = open_session(
        f"swipeline-{args.job}", "streaming", shuffle_partitions=args.shuffle_partitions, store=ObjectStore.from_env(env)
    )
    zones, config = Zones.from_env(env), FraudConfig.from_env(env)
    if args.job == "close":
        close_dates(spark, zones)
        return
    servers = env.get("KAFKA_BOOTSTRAP_SERVERS")
    topic = args.direct or args.job == "land"
    if topic and not servers:
        parser.error("the topic needs KAFKA_BOOTSTRAP_SERVERS")
    if topic:
        records = kafka.read_stream(spark, servers, env.get("KAFKA_TOPIC_TRANSACTIONS", kafka.TOPIC))
    else:
        records = landing_lines(spark, zones)
    spark.streams.addListener(ProgressTable(spark, zones.path("quality", PROGRESS)))
    source, corrupt = parsed(records)
    broken = None
    if args.job != "land" and not args.unvalidated:
        source, broken = validation.split(validation.validate(source))
    pace = {"processingTime": f"{env.get('STREAMING_TRIGGER_SECONDS', '30')} seconds"}
    if args.job == "land":
        running = start_landing(source, zones, pace)
    elif args.job == "alerts":
        places = zones.path("analytics", ALERTS), zones.path("checkpoints", ALERTS)
        forget = timedelta(days=args.forget_days) if args.forget_days else None
        running = {ALERTS: append_table(card_alerts(source, config, forget_after=forget), *places, pace, ALERTS)}
    else:
        running = start(source, zones, config, Triggers(fraud=pace))
        if broken is not None:
            running[BROKEN] = start_broken(broken, zones, pace)
    # One job of those on a source keeps its corrupt texts: the one that lands the topic, and the
    # analytics of the landing zone, where foreign files may hold some.
    if args.job == "land" or args.job == "analytics" and not topic:
        running[QUARANTINE] = start_quarantine(corrupt, zones, pace)
    wait(spark, running)
