from __future__ import annotations

import calendar
import glob
import os
import random
import time
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import T0
from swipeline.operators.fraud import FraudConfig, apply_all_fraud_rules, flag_amount_anomaly, flag_velocity
from swipeline.operators.time_windows import card_daily_totals, issuer_cross_border_ratio, merchant_volume
from swipeline.operators.validation import split, validate
from swipeline.schemas import TRANSACTION, optional
from swipeline.sources import kafka
from swipeline.sources.landing import committed, for_landing, parsed, read_landing, write_landing, write_owned
from swipeline.sources.zones import Zones
from swipeline.streaming import app
from swipeline.streaming.closing import close_finished, current_totals, final_before, open_since
from swipeline.streaming.progress import ProgressTable, late_rows
from swipeline.streaming.replay import once_each
from swipeline.streaming.sinks import (
    ONCE,
    append_table,
    close_date,
    fraud_batch_writer,
    land,
    latest_totals,
    running_totals,
    score_batches,
)
from swipeline.streaming.sources import landing_lines, landing_stream, table_stream
from swipeline.streaming.state import _last_change, card_alerts


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def traffic(n=120, minutes=300, seed=3):
    """Rows in time order, the last one far ahead so that every earlier window closes."""
    rng = random.Random(seed)
    moments = sorted(rng.sample(range(minutes * 60), n))
    rows = [
        {
            "transaction_id": f"s{i:04d}",
            "card_hash": "hot" if i % 3 == 0 else f"card{rng.randrange(6)}",
            "merchant_id": f"m{rng.randrange(3)}",
            "issuer_id": f"i{rng.randrange(2)}",
            "amount": rng.choice([5, 10, 500]),
            "country_code": rng.choice(["US"] * 9 + ["GB"]),
            "is_cross_border": rng.random() < 0.3,
            "transaction_type": rng.choice(["purchase", "p2p"]),
            "timestamp": T0 + timedelta(seconds=s),
        }
        for i, s in enumerate(moments)
    ]
    return rows


LAST = {"transaction_id": "zz", "card_hash": "end", "merchant_id": "end", "issuer_id": "end"}


def feed(txns, path, rows, files):
    """Write ``rows`` as ``files`` Parquet files whose modification times follow the order."""
    size = -(-len(rows) // files)
    for i in range(files):
        part = rows[i * size : (i + 1) * size]
        if part:
            txns(*part).coalesce(1).write.mode("append").parquet(f"{path}/f{i:02d}")
    for i in range(files):
        for name in os.listdir(f"{path}/f{i:02d}") if os.path.isdir(f"{path}/f{i:02d}") else []:
            os.utime(f"{path}/f{i:02d}/{name}", (1_700_000_000 + i * 10,) * 2)


def stream(spark, path):
    return table_stream(spark, f"{path}/*/", optional(TRANSACTION), files_per_trigger=1)


@pytest.mark.parametrize("operator", [merchant_volume, issuer_cross_border_ratio])
@pytest.mark.parametrize("files", [1, 5])
def test_window_streams_equal_their_batch_form(spark, txns, scratch, operator, files):
    rows = traffic()
    feed(txns, f"{scratch}/in", [*rows, {**LAST, "timestamp": T0 + timedelta(days=2)}], files)
    query = append_table(operator(stream(spark, f"{scratch}/in")), f"{scratch}/out", f"{scratch}/cp", ONCE)
    query.awaitTermination()
    got = spark.read.parquet(f"{scratch}/out")
    assert got.count() > 0
    assert rows_of(got) == rows_of(operator(txns(*rows)))


@pytest.mark.parametrize("files", [1, 4])
def test_running_totals_equal_their_batch_form(spark, txns, scratch, files):
    rows = traffic()
    feed(txns, f"{scratch}/in", rows, files)
    running_totals(
        card_daily_totals(stream(spark, f"{scratch}/in")), f"{scratch}/out", f"{scratch}/cp", ONCE
    ).awaitTermination()
    got = latest_totals(spark, f"{scratch}/out")
    assert rows_of(got) == rows_of(card_daily_totals(txns(*rows)))


def test_a_closed_date_holds_its_latest_totals_and_a_rerun_changes_nothing(spark, txns, scratch):
    rows = [*traffic(), {**LAST, "timestamp": T0 + timedelta(days=1)}]
    feed(txns, f"{scratch}/in", rows, 4)
    running_totals(
        card_daily_totals(stream(spark, f"{scratch}/in")), f"{scratch}/out", f"{scratch}/cp", ONCE
    ).awaitTermination()
    expected = card_daily_totals(txns(*rows))
    dates = sorted(r.date for r in expected.select("date").distinct().collect())
    assert len(dates) > 1
    for date in (*dates, dates[0]):
        close_date(spark, f"{scratch}/out", f"{scratch}/closed", str(date))
    close_date(spark, f"{scratch}/out", f"{scratch}/closed", "1999-01-01")
    got = spark.read.parquet(f"{scratch}/closed").select(*expected.columns)
    assert rows_of(got) == rows_of(expected)


def closing_case(spark, txns, scratch, files=4):
    rows = [*traffic(), *[{**LAST, "transaction_id": f"z{i}", "timestamp": T0 + timedelta(days=i)} for i in (1, 2, 3)]]
    feed(txns, f"{scratch}/in", rows, files)
    running_totals(
        card_daily_totals(stream(spark, f"{scratch}/in")), f"{scratch}/out", f"{scratch}/cp", ONCE, app.CARDS
    ).awaitTermination()
    return rows_of(card_daily_totals(txns(*rows)))


def folders(path, before):
    batches = [name for name in os.listdir(path) if name.startswith("batch_id=")]
    days = [name for batch in batches for name in os.listdir(f"{path}/{batch}") if name.startswith("date=")]
    return [day for day in days if day < f"date={before}"]


def test_closing_moves_finished_dates_and_retires_their_folders(spark, txns, scratch):
    expected = closing_case(spark, txns, scratch)
    out, closed = f"{scratch}/out", f"{scratch}/closed"
    assert open_since(spark, closed) is None
    assert rows_of(current_totals(spark, out, closed)) == expected
    for mark in ("2024-01-16", "2024-01-16", "2024-01-15", "2024-01-17", "2024-01-19", "2024-01-20"):
        before = open_since(spark, closed)
        close_finished(spark, out, closed, mark)
        assert rows_of(current_totals(spark, out, closed)) == expected
        assert not folders(out, before or "")
    assert open_since(spark, closed) == "2024-01-20"
    # All dates are closed and all batches gone: the totals no longer need the folders.
    assert [name for name in os.listdir(out) if name.startswith("batch_id=")] == []


def test_a_closed_date_is_read_from_its_own_files_only(spark, txns, scratch):
    closing_case(spark, txns, scratch, files=8)
    out, closed = f"{scratch}/out", f"{scratch}/closed"
    close_finished(spark, out, closed, "2024-01-16")
    day = current_totals(spark, out, closed).where("date = date'2024-01-15'")
    assert day.count() and all("/closed/date=2024-01-15/" in name for name in day.select(F.input_file_name()).distinct().toPandas().iloc[:, 0])


@pytest.mark.parametrize("crash", ["table", "mark", "folders"])
def test_a_closing_that_stops_midway_loses_nothing(spark, txns, scratch, monkeypatch, crash):
    from swipeline.streaming import closing

    expected = closing_case(spark, txns, scratch)
    out, closed = f"{scratch}/out", f"{scratch}/closed"
    close_finished(spark, out, closed, "2024-01-16")

    def stop(*args, **kwargs):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        if crash == "folders":
            remove = closing._remove_folders
            patch.setattr(closing, "_remove_folders", lambda *a: (remove(*a), stop()))
        elif crash == "table":
            patch.setattr(closing, "latest_of", stop)
        else:
            patch.setattr(type(spark), "createDataFrame", stop)
        with pytest.raises(RuntimeError, match="stopped"):
            close_finished(spark, out, closed, "2024-01-18")
    assert open_since(spark, closed) == "2024-01-16"
    assert rows_of(current_totals(spark, out, closed)) == expected
    close_finished(spark, out, closed, "2024-01-18")
    assert open_since(spark, closed) == "2024-01-18"
    assert rows_of(current_totals(spark, out, closed)) == expected


def test_a_replayed_batch_does_not_reopen_a_closed_date(spark, txns, scratch):
    expected = closing_case(spark, txns, scratch)
    out, closed = f"{scratch}/out", f"{scratch}/closed"
    close_finished(spark, out, closed, "2024-01-16")
    close_finished(spark, out, closed, "2024-01-17")
    stale = card_daily_totals(txns({**LAST, "timestamp": T0})).withColumn("batch_id", F.lit(99))
    stale.write.mode("append").partitionBy("batch_id", "date").parquet(out)
    assert rows_of(current_totals(spark, out, closed)) == expected
    close_finished(spark, out, closed, "2024-01-17")
    assert not folders(out, "2024-01-16")


def test_dates_close_by_the_watermark_of_their_stream(spark, txns, scratch):
    zones = Zones.under(scratch)
    assert app.close_dates(spark, zones) is None
    listener = ProgressTable(spark, zones.path("quality", app.PROGRESS))
    spark.streams.addListener(listener)
    try:
        rows = [*traffic(), *[{**LAST, "transaction_id": f"z{i}", "timestamp": T0 + timedelta(days=i)} for i in (1, 2, 3)]]
        feed(txns, f"{scratch}/in", rows, 6)
        place = zones.path("analytics", app.CARDS), zones.path("checkpoints", app.CARDS)
        running_totals(card_daily_totals(stream(spark, f"{scratch}/in")), *place, ONCE, app.CARDS).awaitTermination()
        wait_until = time.time() + 30
        while time.time() < wait_until and final_before(spark, zones.path("quality", app.PROGRESS), app.CARDS) is None:
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(listener)
    mark = app.close_dates(spark, zones)
    newest = str((T0 + timedelta(days=3)).date())
    assert mark is not None and "2024-01-15" <= mark <= newest
    got = current_totals(spark, place[0], zones.path("analytics", app.CLOSED))
    assert rows_of(got) == rows_of(card_daily_totals(txns(*rows)))


def test_the_mark_is_the_utc_date_of_the_newest_watermark(spark, scratch):
    row = {"query": app.CARDS, "input_rows": 1}
    table = [
        {**row, "batch_id": 1, "at": datetime(2024, 1, 18, 1), "watermark": "2024-01-17T23:50:00.000Z"},
        {**row, "batch_id": 2, "at": datetime(2024, 1, 18, 2), "watermark": "2024-01-18T00:05:00.000Z"},
        {**row, "batch_id": 9, "at": datetime(2024, 1, 18, 3), "watermark": "2024-01-30T00:00:00.000Z", "query": app.FRAUD},
    ]
    spark.createDataFrame(table, "query string, batch_id long, input_rows long, at timestamp, watermark string").write.parquet(f"{scratch}/p")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert final_before(spark, f"{scratch}/p", app.CARDS) == "2024-01-18"
        assert final_before(spark, f"{scratch}/p", app.MERCHANTS) is None
        assert final_before(spark, f"{scratch}/none", app.CARDS) is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_closing_has_a_command(spark, txns, scratch, monkeypatch):
    zones = Zones.under(scratch)
    monkeypatch.setattr(app, "open_session", lambda *args, **kwargs: spark)
    monkeypatch.setattr(app.Zones, "from_env", classmethod(lambda cls, env: zones))
    app.main(["close"])
    closed = zones.path("analytics", app.CLOSED)
    assert open_since(spark, closed) is None
    day = card_daily_totals(txns({}, {"card_hash": "b"})).withColumn("batch_id", F.lit(0))
    day.write.partitionBy("batch_id", "date").parquet(zones.path("analytics", app.CARDS))
    progress = [(app.CARDS, 0, datetime(2024, 1, 16, 1), "2024-01-16T00:00:00.000Z")]
    spark.createDataFrame(progress, "query string, batch_id long, at timestamp, watermark string").write.parquet(zones.path("quality", app.PROGRESS))
    app.main(["close"])
    assert open_since(spark, closed) == "2024-01-16"
    assert spark.read.parquet(closed).count() == 2


def test_broken_transactions_of_a_stream_are_stored_apart(spark, txns, scratch):
    zones = Zones.under(scratch)
    write_landing(txns({"currency": "usd"}, {"amount": -1}, {"merchant_id": None}), zones)
    good, bad = split(validate(landing_stream(spark, zones, schema=optional(TRANSACTION))))
    app.start_broken(bad, zones, ONCE).awaitTermination()
    append_table(good, f"{scratch}/out", f"{scratch}/cp", ONCE).awaitTermination()
    stored = spark.read.parquet(zones.path("quality", app.BROKEN)).select("transaction_id", "failed_rules")
    assert sorted(map(tuple, stored.collect())) == [("t0001", ["amount_sign"]), ("t0002", ["required_field"])]
    assert rows_of(spark.read.parquet(f"{scratch}/out")) == rows_of(txns({"currency": "USD"}))


def test_late_rows_are_dropped_after_the_watermark(spark, txns, scratch):
    on_time = {"transaction_id": "a", "timestamp": T0}
    ahead = {"transaction_id": "b", "timestamp": T0 + timedelta(hours=1)}
    # Spark drops late rows by the watermark of the batch before, so one more batch goes by first.
    filler = {"transaction_id": "d", "timestamp": T0 + timedelta(minutes=61)}
    late = {"transaction_id": "c", "timestamp": T0 + timedelta(minutes=1)}
    end = {**LAST, "timestamp": T0 + timedelta(days=1)}
    feed(txns, f"{scratch}/in", [on_time, ahead, filler, late, end], 5)
    append_table(
        merchant_volume(stream(spark, f"{scratch}/in")), f"{scratch}/out", f"{scratch}/cp", ONCE
    ).awaitTermination()
    counts = {r.window_start: r.txn_count for r in spark.read.parquet(f"{scratch}/out").collect()}
    assert counts[T0] == 1


def test_restart_continues_from_the_checkpoint(spark, txns, scratch):
    rows = traffic()
    source, out, checkpoint = f"{scratch}/in", f"{scratch}/out", f"{scratch}/cp"
    feed(txns, source, rows[:60], 2)
    append_table(merchant_volume(stream(spark, source)), out, checkpoint, ONCE).awaitTermination()
    txns(*rows[60:], {**LAST, "timestamp": T0 + timedelta(days=2)}).coalesce(1).write.parquet(f"{source}/g")
    append_table(merchant_volume(stream(spark, source)), out, checkpoint, ONCE).awaitTermination()
    assert rows_of(spark.read.parquet(out)) == rows_of(merchant_volume(txns(*rows)))


def test_fraud_batches_and_replay(spark, txns, scratch):
    rows = traffic(40, 5)
    config = FraudConfig(velocity_max_txns=2)
    feed(txns, f"{scratch}/in", rows, 1)
    score_batches(stream(spark, f"{scratch}/in"), f"{scratch}/out", f"{scratch}/cp", ONCE, config).awaitTermination()
    want = apply_all_fraud_rules(txns(*rows), config).where("is_fraud_flagged")
    got = spark.read.parquet(f"{scratch}/out").drop("batch_id")
    assert want.count() > 0
    assert rows_of(got) == rows_of(want)

    write = fraud_batch_writer(f"{scratch}/out", config)
    write(txns(*rows), 0)
    assert rows_of(spark.read.parquet(f"{scratch}/out").drop("batch_id")) == rows_of(want)
    write(txns(), 1)
    assert not os.path.exists(f"{scratch}/out/batch_id=1")


def test_landing_sink_feeds_the_batch_reader(spark, txns, scratch):
    rows = traffic(30)
    feed(txns, f"{scratch}/in", rows, 2)
    zones = Zones.under(f"{scratch}/z")
    land(stream(spark, f"{scratch}/in"), zones.path("landing", "transactions"), f"{scratch}/cp", ONCE).awaitTermination()
    back = read_landing(spark, zones, date="2024-01-15").drop("date", "hour")
    assert rows_of(back) == rows_of(txns(*rows))
    assert os.path.isdir(f"{scratch}/z/landing/transactions/date=2024-01-15/hour=10")


def test_a_crashed_landing_batch_is_unseen_until_its_replay(spark, txns, scratch):
    zones = Zones.under(scratch)
    root = zones.path("landing", "transactions")
    write_landing(txns(*traffic(10)), zones)
    first, replay = txns({"transaction_id": "n1"}, {"transaction_id": "n2"}), txns({"transaction_id": "n1"}, {"transaction_id": "n3"})
    for_landing(first).withColumn("batch", F.lit("stream-q-7")).write.mode("append").partitionBy("date", "hour", "batch").json(root)
    for seen in (read_landing(spark, zones), read_landing(spark, zones, date="2024-01-15")):
        assert seen.count() == 10
    write_owned(replay, root, "stream-q-7", "replace")
    for seen in (read_landing(spark, zones), read_landing(spark, zones, date="2024-01-15")):
        assert seen.count() == 12 and {"n1", "n3"} <= {r[0] for r in seen.select("transaction_id").collect()}
    write_owned(replay, root, "stream-q-7", "replace")
    assert read_landing(spark, zones).count() == 12
    named = {r["batch"]: (r["rows"], r["dates"]) for r in committed(spark, root).collect()}
    assert len(named) == 2 and named["stream-q-7"] == (2, ["2024-01-15"])
    assert committed(spark, root, "2024-01-16").count() == 0
    write_owned(txns().limit(0), root, "stream-q-8", "replace")
    assert committed(spark, root).count() == 2


def test_two_streams_of_one_name_own_their_batches(spark, txns, scratch):
    zones = Zones.under(f"{scratch}/z")
    for k in range(2):
        feed(txns, f"{scratch}/in{k}", [{"transaction_id": f"{k}-{i}"} for i in range(5)], 2)
        source = stream(spark, f"{scratch}/in{k}")
        land(source, zones.path("landing", "transactions"), f"{scratch}/cp{k}", ONCE, "land").awaitTermination()
    assert read_landing(spark, zones).select("transaction_id").distinct().count() == 10


def test_application_runs_all_queries(spark, txns, scratch):
    rows = traffic()
    zones = Zones.under(scratch)
    write_landing(txns(*rows, {**LAST, "timestamp": T0 + timedelta(days=2)}), zones)
    source = landing_stream(spark, zones, schema=optional(TRANSACTION))
    queries = app.start(source, zones, FraudConfig(velocity_max_txns=2), app.Triggers.once())
    for query in queries.values():
        query.awaitTermination()
    assert sorted(app.ended(queries)) == sorted(queries)
    for name in queries:
        assert spark.read.parquet(zones.path("analytics", name)).count() > 0


def test_corrupt_landing_lines_are_stored(spark, txns, scratch):
    zones = Zones.under(scratch)
    write_landing(txns({}, {}), zones)
    spark.createDataFrame([("{oops",)], "value string").write.text(f"{zones.landing}/transactions/date=2024-01-15/hour=09")
    source, corrupt = parsed(landing_lines(spark, zones))
    app.start_quarantine(corrupt, zones, ONCE).awaitTermination()
    append_table(source, f"{scratch}/out", f"{scratch}/cp", ONCE).awaitTermination()
    assert [r[0] for r in spark.read.parquet(zones.path("quality", app.QUARANTINE)).select("_corrupt_record").collect()] == ["{oops"]
    assert rows_of(spark.read.parquet(f"{scratch}/out")) == rows_of(txns({}, {}))


def test_last_change_equals_looking_at_every_slice():
    rng = random.Random(1)
    for _ in range(200):
        pairs = [sorted(rng.choices("ab", k=2)) if rng.random() < 0.3 else [rng.choice("ab")] * 2 for _ in range(7)]
        pairs = [p if rng.random() < 0.8 else [None, None] for p in pairs]
        got = _last_change(np.array([p[0] for p in pairs], object), np.array([p[1] for p in pairs], object))
        for end in range(7):
            varied = [a for a in range(end + 1) if len({v for p in pairs[a : end + 1] for v in p if v}) > 1]
            assert got[end] == max(varied, default=-1)


def test_a_failing_query_is_named(spark, txns, scratch):
    feed(txns, f"{scratch}/in", traffic(5), 1)

    def broken(batch, batch_id):
        raise ValueError("no disk")

    query = (
        stream(spark, f"{scratch}/in").writeStream.foreachBatch(broken)
        .option("checkpointLocation", f"{scratch}/cp").trigger(**ONCE).start()
    )
    with pytest.raises(Exception):
        query.awaitTermination()
    with pytest.raises(RuntimeError, match="streaming query bad failed"):
        app.ended({"bad": query})


def test_stream_joins_a_static_dimension(spark, txns, scratch):
    rows = traffic(20)
    feed(txns, f"{scratch}/in", rows, 2)
    names = spark.createDataFrame([("m0", "zero"), ("m1", "one")], "merchant_id string, name string")

    def named(df):
        return df.select("transaction_id", "merchant_id").join(names, "merchant_id", "left")

    append_table(named(stream(spark, f"{scratch}/in")), f"{scratch}/out", f"{scratch}/cp", ONCE).awaitTermination()
    assert rows_of(spark.read.parquet(f"{scratch}/out")) == rows_of(named(txns(*rows)))


@pytest.mark.parametrize("files", [1, 6])
def test_card_alerts_do_not_depend_on_the_batches(spark, txns, scratch, files):
    rows = traffic(150, 60)
    config = FraudConfig(velocity_window_seconds=120, velocity_max_txns=3, geo_window_minutes=2)
    feed(txns, f"{scratch}/in", [*rows, {**LAST, "timestamp": T0 + timedelta(days=2)}], files)
    append_table(
        card_alerts(stream(spark, f"{scratch}/in"), config), f"{scratch}/out", f"{scratch}/cp", ONCE
    ).awaitTermination()
    got = spark.read.parquet(f"{scratch}/out")

    static = txns(*rows)
    velocity = flag_velocity(static, 120, 3).select("card_hash", "timestamp", "velocity_count", "fraud_velocity")
    amount = flag_amount_anomaly(static).select(
        "card_hash", "timestamp", "prior_sample_count", F.round("rolling_avg", 6).alias("rolling_avg"),
        "fraud_amount_anomaly",
    )
    want = velocity.join(amount, ["card_hash", "timestamp"])
    have = got.select(
        "card_hash", F.col("second").alias("timestamp"), "velocity_count", "fraud_velocity",
        "prior_sample_count", F.round("rolling_avg", 6).alias("rolling_avg"), "fraud_amount_anomaly",
    )
    assert have.where("fraud_velocity").count() > 0
    assert rows_of(have) == rows_of(want)

    flagged = apply_all_fraud_rules(static, config).where("fraud_reasons LIKE '%GEO%'").select("card_hash")
    alerted = got.where("fraud_geo_impossibility").select("card_hash").distinct()
    assert alerted.count() > 0
    assert rows_of(alerted) == rows_of(flagged.distinct())


TOPIC = optional(TRANSACTION).add(kafka.ARRIVED, "timestamp")


def publish(txns, path, name, rows, hours=0.0):
    """A file of the topic, its records arriving so many hours after their event time."""
    sent = txns(*rows).withColumn(kafka.ARRIVED, F.expr(f"timestamp + INTERVAL '{int(hours * 3600)}' SECOND"))
    sent.coalesce(1).write.parquet(f"{path}/{name}")


def finish(queries):
    for query in queries.values():
        query.awaitTermination()


def test_a_replayed_batch_changes_no_stream_table(spark, txns, scratch):
    zones, rows = Zones.under(f"{scratch}/z"), [*traffic(), {**LAST, "timestamp": T0 + timedelta(hours=20)}]

    def run():
        finish(app.start_landing(table_stream(spark, f"{scratch}/topic/*/", TOPIC), zones, ONCE))
        source = landing_stream(spark, zones, schema=optional(TRANSACTION))
        finish(app.start(source, zones, FraudConfig(velocity_max_txns=2), app.Triggers.once()))
        tables = {n: spark.read.parquet(zones.path("analytics", n)) for n in (app.FRAUD, app.MERCHANTS, app.ISSUERS)}
        tables[app.CARDS] = latest_totals(spark, zones.path("analytics", app.CARDS))
        return {n: rows_of(df.drop("batch_id")) for n, df in tables.items()}

    publish(txns, f"{scratch}/topic", "first", rows)
    before = run()
    assert all(before.values())
    publish(txns, f"{scratch}/topic", "replay", rows[10:90], hours=2)
    publish(txns, f"{scratch}/topic", "long-after", rows[:40], hours=72)
    assert run() == before
    aside = spark.read.parquet(zones.path("quality", app.ASIDE))
    assert rows_of(aside.drop(kafka.ARRIVED)) == rows_of(txns(*rows[:40]))


def test_a_batch_with_state_lands_in_few_files(spark, txns, scratch):
    rows, zones = traffic(), Zones.under(f"{scratch}/z")
    publish(txns, f"{scratch}/topic", "first", rows)
    fresh, _ = once_each(table_stream(spark, f"{scratch}/topic/*/", TOPIC))
    land(fresh, zones.path("landing", "transactions"), f"{scratch}/cp", ONCE).awaitTermination()
    assert rows_of(read_landing(spark, zones).drop("date", "hour")) == rows_of(txns(*rows))
    hours = {f"{r['timestamp']:%Y-%m-%d %H}" for r in rows}
    files = glob.glob(f"{scratch}/z/landing/transactions/date=*/hour=*/batch=*/*.json")
    assert len(files) == len(hours) > 4


def test_records_without_an_id_pass_and_odd_times_are_set_aside(spark, txns, scratch):
    rows = [{"transaction_id": None}] * 3 + [{"transaction_id": "a"}] * 2 + [{"transaction_id": "b"}]
    publish(txns, f"{scratch}/topic", "now", rows, hours=1)
    publish(txns, f"{scratch}/topic", "ahead", [{"transaction_id": "c"}], hours=-2)
    publish(txns, f"{scratch}/topic", "edge", [{"transaction_id": "d"}], hours=24)
    timeless = spark.createDataFrame([("e", None)], "transaction_id string, timestamp timestamp")
    timeless.withColumn(kafka.ARRIVED, F.lit(T0)).write.parquet(f"{scratch}/topic/timeless")
    fresh, aside = once_each(table_stream(spark, f"{scratch}/topic/*/", TOPIC))
    for name, part in (("fresh", fresh), ("aside", aside)):
        append_table(part, f"{scratch}/{name}", f"{scratch}/cp-{name}", ONCE).awaitTermination()
    passed = spark.read.parquet(f"{scratch}/fresh")
    assert sorted(str(r[0]) for r in passed.select("transaction_id").collect()) == ["None"] * 3 + ["a", "b", "d"]
    assert kafka.ARRIVED not in passed.columns
    assert {r[0] for r in spark.read.parquet(f"{scratch}/aside").select("transaction_id").collect()} == {"c", "e"}


@pytest.mark.parametrize("files", [1, 3, 8])
def test_idle_cards_are_forgotten(spark, txns, scratch, files):
    """The card pauses for four hours, then for one; others go on, so the watermark passes its pause."""
    starts = (0, 4, 5)
    rows = [{"transaction_id": f"p{h}-{i}", "card_hash": "c", "timestamp": T0 + timedelta(hours=h, seconds=i)} for h in starts for i in range(3)]
    rows += [{**LAST, "transaction_id": f"z{h}", "timestamp": T0 + timedelta(hours=h)} for h in range(1, 12)]
    rows.sort(key=lambda r: r["timestamp"])
    feed(txns, f"{scratch}/in", rows, files)
    found, state = {}, {}
    for name, forget_after in (("kept", None), ("within", timedelta(hours=5)), ("expired", timedelta(hours=2))):
        alerts = card_alerts(stream(spark, f"{scratch}/in"), FraudConfig(), forget_after=forget_after)
        query = append_table(alerts, f"{scratch}/{name}", f"{scratch}/cp-{name}", ONCE)
        query.awaitTermination()
        out = spark.read.parquet(f"{scratch}/{name}").where("card_hash = 'c'").orderBy("second")
        found[name] = [r["prior_sample_count"] for r in out.collect()]
    assert found["kept"] == found["within"] == list(range(9))
    assert found["expired"] == [0, 1, 2, 0, 1, 2, 3, 4, 5]
    with pytest.raises(ValueError, match="look-backs"):
        card_alerts(txns({}), forget_after=timedelta(minutes=30))


def test_the_state_of_idle_cards_shrinks(spark, txns, scratch):
    rows = [{"transaction_id": f"s{i}", "card_hash": f"c{i}", "timestamp": T0 + timedelta(seconds=i)} for i in range(40)]
    rows += [{**LAST, "transaction_id": f"z{h}", "timestamp": T0 + timedelta(hours=h)} for h in range(1, 9)]
    feed(txns, f"{scratch}/in", rows, 12)
    kept = []
    for forget_after in (None, timedelta(hours=2)):
        alerts = card_alerts(stream(spark, f"{scratch}/in"), FraudConfig(), forget_after=forget_after)
        query = append_table(alerts, f"{scratch}/out{len(kept)}", f"{scratch}/cp{len(kept)}", ONCE)
        query.awaitTermination()
        kept.append(min(o["numRowsTotal"] for o in query.lastProgress["stateOperators"] if "ransformWithState" in o["operatorName"]))
    assert kept[1] < kept[0] / 4


def test_look_back_list_is_appended_to_and_cut(spark, txns, scratch):
    """Bursts hours apart over many batches: the list is cut between them, alerts stay those of one batch."""
    rows = [
        {"transaction_id": f"r{b}-{i}", "card_hash": "c", "timestamp": T0 + timedelta(hours=3 * b, seconds=7 * i), "country_code": "US" if (b, i) != (2, 4) else "GB"}
        for b in range(4)
        for i in range(9)
    ]
    rows.append({**LAST, "timestamp": T0 + timedelta(days=2)})
    found = []
    for files in (1, 12):
        feed(txns, f"{scratch}/in{files}", rows, files)
        alerts = card_alerts(stream(spark, f"{scratch}/in{files}"), FraudConfig(velocity_max_txns=4))
        append_table(alerts, f"{scratch}/out{files}", f"{scratch}/cp{files}", ONCE).awaitTermination()
        found.append(rows_of(spark.read.parquet(f"{scratch}/out{files}")))
    assert found[0] == found[1] and len(found[0]) == 36


def test_late_rows_show_up_in_a_table(spark, txns, scratch):
    listener = ProgressTable(spark, f"{scratch}/progress")
    spark.streams.addListener(listener)
    try:
        late = {"transaction_id": "late", "timestamp": T0}
        parts = [[{}, {**LAST, "timestamp": T0 + timedelta(hours=5)}], [{**LAST, "transaction_id": "y", "timestamp": T0 + timedelta(hours=5)}], [late]]
        for k, rows in enumerate(parts):
            txns(*rows).coalesce(1).write.parquet(f"{scratch}/in/f{k}")
            query = append_table(merchant_volume(stream(spark, f"{scratch}/in")), f"{scratch}/out", f"{scratch}/cp", ONCE, f"volume-{k}")
            query.awaitTermination()
        for _ in range(60):
            if os.path.isdir(f"{scratch}/progress") and late_rows(spark, f"{scratch}/progress").agg(F.sum("late_rows")).first()[0]:
                break
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(listener)
    counted = late_rows(spark, f"{scratch}/progress").groupBy("query").agg(F.sum("late_rows")).collect()
    assert {r[0]: r[1] for r in counted if r[1]} == {"volume-2": 1}
    stored = spark.read.parquet(f"{scratch}/progress")
    assert stored.agg(F.sum("input_rows")).first()[0] == 4


@pytest.mark.parametrize(("width", "slide"), [("50 minutes", "20 minutes"), ("7 minutes", "7 minutes"), ("90 seconds", "1 minute")])
def test_windows_of_any_width_and_slide(txns, width, slide):
    rows = traffic(60)
    size, step = (int(x.split()[0]) * (60 if "minute" in x else 1) for x in (width, slide))
    want = {}
    for r in rows:
        second = calendar.timegm(r["timestamp"].timetuple())
        start = second // step * step
        while start + size > second:
            held = want.setdefault((start, r["issuer_id"]), [0, 0])
            held[0] += 1
            held[1] += r["is_cross_border"]
            start -= step
    got = issuer_cross_border_ratio(txns(*rows), width, slide).collect()
    found = {(calendar.timegm(r["window_start"].timetuple()), r["issuer_id"]): [r["total_txns"], r["cross_border_txns"]] for r in got}
    assert found == want
    assert all((r["window_end"] - r["window_start"]).total_seconds() == size for r in got)
