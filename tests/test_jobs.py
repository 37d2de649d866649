from __future__ import annotations

import os
from datetime import timedelta

import pytest

from conftest import T0
from swipeline.plans import jobs
from swipeline.session import ObjectStore, open_session, profile
from swipeline.sources import kafka, landing, staging
from swipeline.sources.landing import read_landing, write_landing
from swipeline.sources.tables import read_table
from swipeline.sources.zones import Zones

DAY, NEXT = "2024-01-15", "2024-01-16"
SEEDS = {
    "merchants": "merchant_id,merchant_name,merchant_category_code,country_code,acquirer_id,city,is_active\nMER0000001,Shop,5411,US,ACQ0001,Boston,true\n",
    "acquirers": "acquirer_id,acquirer_name,country_code,is_active\nACQ0001,Bank,US,true\n",
    "issuers": "issuer_id,issuer_name,country_code,currency,network,is_active\nISS0001,Bank,US,USD,Visa,true\n",
}


@pytest.fixture
def zones(spark, txns, scratch):
    zones = Zones.under(scratch)
    os.makedirs(zones.seeds)
    for name, text in SEEDS.items():
        with open(f"{zones.seeds}/{name}.csv", "w") as out:
            out.write(text)
    tomorrow = T0 + timedelta(days=1)
    write_landing(
        txns(
            {"country_code": "GB", "is_cross_border": True},
            {"amount": -50, "transaction_type": "chargeback"},
            {"timestamp": tomorrow},
            {"timestamp": tomorrow, "amount": 60000},
        ),
        zones,
    )
    return zones


@pytest.mark.parametrize(
    ("job", "tables"),
    [
        ("settlement", ["daily_settlement"]),
        ("merchants", ["mcc_spending", "merchant_summary"]),
        ("corridors", ["cross_border_corridors"]),
        ("chargebacks", ["chargeback_ratios"]),
        ("sketches", ["merchant_sketches", "mcc_sketches"]),
    ],
)
def test_reports_per_date(spark, zones, job, tables):
    seen = jobs.run_job(spark, job, DAY, zones)
    jobs.run_job(spark, job, NEXT, zones)
    jobs.run_job(spark, job, DAY, zones)
    for name in tables:
        out = read_table(spark, zones, "analytics", name)
        assert out.where(out.processing_date == DAY).count() == seen[name]["rows"] == 1
        assert job == "corridors" or out.where(out.processing_date == NEXT).count() == 1


def test_chargeback_threshold_is_a_parameter(spark, zones):
    assert jobs.run_job(spark, "chargebacks", DAY, zones)["chargeback_ratios"] == {"rows": 1, "flagged": 1}
    assert jobs.run_job(spark, "chargebacks", DAY, zones, threshold=1.0)["chargeback_ratios"]["flagged"] == 0


def test_quality_and_gate(spark, zones):
    now = T0 + timedelta(hours=1)
    for day in (DAY, NEXT, "2024-01-17"):
        jobs.run_quality(spark, day, zones, now)
    results = read_table(spark, zones, "quality", jobs.RESULTS)
    assert results.where(results.processing_date == DAY).count() == 7
    assert [jobs.gate_passed(spark, d, zones) for d in (DAY, NEXT, "2024-01-17", "2030-01-01")] == [
        True, False, False, False,
    ]
    assert jobs.gate_passed(spark, DAY, Zones.under("/nowhere")) is False


def test_a_check_that_cannot_run_is_a_failed_check(spark, zones, monkeypatch):
    def broken(df, dimension, key="merchant_id"):
        return df.selectExpr("1L AS total_count", "CAST(raise_error('no dimension') AS LONG) AS orphan_count").limit(1)

    monkeypatch.setattr(jobs.quality, "orphan_counts", broken)
    jobs.run_quality(spark, DAY, zones, T0 + timedelta(hours=1))
    results = {r.check_name: r for r in read_table(spark, zones, "quality", jobs.RESULTS).collect()}
    assert len(results) == 7
    assert results["referential_integrity"].status == "FAIL"
    assert "no dimension" in results["referential_integrity"].message
    assert results["null_check"].status == "PASS"


def test_processed_job(spark, zones):
    jobs.run_processed(spark, DAY, zones)
    assert read_table(spark, zones, "processed", "transactions").count() == 2


def test_processed_job_keeps_what_it_rejects(spark, zones):
    folder = f"{zones.landing}/transactions/date={DAY}/hour=11"
    bad_amount = '{"transaction_id":"x","amount":"abc"}'
    no_amount = '{"transaction_id":"y","amount":null}'
    spark.createDataFrame([("{oops",), (bad_amount,), ("",), (no_amount,)], "value string").write.text(folder)
    before = read_landing(spark, zones, date=DAY)
    assert before.count() == before.select("amount").count()
    jobs.run_processed(spark, DAY, zones)
    assert read_table(spark, zones, "processed", "transactions").count() == 2
    corrupt = read_table(spark, zones, "quality", jobs.CORRUPT_LINES).collect()
    assert sorted((r._corrupt_record, r.hour) for r in corrupt) == sorted([("{oops", 11), (bad_amount, 11)])
    (broken,) = read_table(spark, zones, "quality", jobs.BROKEN_ROWS).collect()
    assert broken.transaction_id == "y" and "required_field" in broken.failed_rules


def test_each_job_parses_a_date_once(spark, zones, monkeypatch):
    """What the jobs write comes from staged columns; only staging itself reads the landed lines."""
    written, lines_read = [], []

    def watched(write):
        def run(df, *args, **kwargs):
            written.append(df._jdf.queryExecution().toString())
            return write(df, *args, **kwargs)

        return run

    def counted(*args, **kwargs):
        lines_read.append(kwargs["date"])
        return landing.read_landing_lines(*args, **kwargs)

    monkeypatch.setattr(jobs, "write_date", watched(jobs.write_date))
    monkeypatch.setattr(jobs, "write_processed", watched(jobs.write_processed))
    monkeypatch.setattr(staging, "read_landing_lines", counted)
    for job, outputs in (("merchants", 3), ("processed", 3), ("quality", 2)):
        written.clear()
        lines_read.clear()
        if job == "merchants":
            jobs.run_job(spark, job, DAY, zones)
        elif job == "processed":
            jobs.run_processed(spark, DAY, zones)
        else:
            jobs.run_quality(spark, DAY, zones, T0 + timedelta(hours=1))
        assert lines_read == [DAY] and len(written) == outputs
        assert not any("FileScan text" in plan for plan in written)
        assert all("FileScan parquet" in plan for plan in written)
    assert os.listdir(zones.path("checkpoints", "staged")) == []


def test_report_jobs_store_their_corrupt_lines(spark, zones):
    folder = f"{zones.landing}/transactions/date={DAY}/hour=11"
    spark.createDataFrame([("{oops",), ("[]x",)], "value string").write.text(folder)
    for job in ("settlement", "chargebacks"):
        assert jobs.run_job(spark, job, DAY, zones)["corrupt_lines"] == {"rows": 2}
    assert jobs.run_job(spark, "settlement", NEXT, zones)["corrupt_lines"] == {"rows": 0}
    stored = read_table(spark, zones, "quality", jobs.CORRUPT_LINES).where("job = 'settlement'").collect()
    assert sorted((r._corrupt_record, r.hour, str(r.processing_date)) for r in stored) == [("[]x", 11, DAY), ("{oops", 11, DAY)]


def test_staged_lines_go_when_a_job_fails(spark, zones):
    with pytest.raises(ValueError), staging.staged(spark, zones, DAY) as lines:
        assert lines.counts == {"transactions": 2, "corrupt": 0} and lines.transactions.count() == 2
        raise ValueError
    assert os.listdir(zones.path("checkpoints", "staged")) == []
    with staging.staged(spark, zones, "2031-01-01") as nothing:
        assert nothing.counts == {"transactions": 0, "corrupt": 0} and nothing.transactions.count() == 0


def test_a_session_keeps_what_was_submitted(spark):
    before = {key: spark.conf.get(key) for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone")}
    assert open_session(mode="streaming") is not None
    assert {key: spark.conf.get(key) for key in before} == before


def test_command_line(spark, zones, monkeypatch):
    for zone in ("landing", "processed", "analytics", "seeds"):
        monkeypatch.setenv(f"{zone.upper()}_ZONE_PATH" if zone != "seeds" else "SEEDS_PATH", getattr(zones, zone))
    monkeypatch.setenv("QUALITY_RESULTS_PATH", zones.quality)
    monkeypatch.setattr(jobs, "open_session", lambda name, **kwargs: spark)
    assert jobs.main(["chargebacks", "--date", DAY, "--threshold", "0.9"]) == 0
    out = read_table(spark, zones, "analytics", "chargeback_ratios").first()
    assert (out.threshold_applied, out.is_flagged) == (0.9, True)
    assert jobs.main(["quality", "--date", DAY, "--max-age-hours", "1000000"]) == 0
    assert jobs.main(["gate", "--date", DAY]) == 0
    assert jobs.main(["gate", "--date", NEXT]) == 1
    with pytest.raises(SystemExit):
        jobs.main(["other", "--date", DAY])


def test_publishing_sends_the_transactions_of_a_date(spark, zones, monkeypatch):
    sent = []
    monkeypatch.setattr(jobs.kafka, "write", lambda df, servers, topic: sent.append((kafka.encode(df).collect(), servers, topic)))
    spark.createDataFrame([("{oops",)], "value string").write.text(f"{zones.landing}/transactions/date={DAY}/hour=09")
    assert jobs.run_publish(spark, DAY, zones, "host:1", "topic") == 2
    [(messages, servers, topic)] = sent
    assert (servers, topic, {m.key for m in messages}) == ("host:1", "topic", {"abc123"})
    landed = read_landing(spark, zones, date=DAY).drop("date", "hour")
    texts = spark.createDataFrame([(m.value,) for m in messages], "value string")
    again = landing.parsed(landing.parse_json(texts))[0]
    assert sorted(map(str, again.collect())) == sorted(map(str, landed.collect()))
    lost = read_table(spark, zones, "quality", jobs.CORRUPT_LINES).where("job = 'publish'")
    assert [r[0] for r in lost.select("_corrupt_record").collect()] == ["{oops"]
    monkeypatch.delenv("KAFKA_BOOTSTRAP_SERVERS", raising=False)
    with pytest.raises(SystemExit):
        jobs.main(["publish", "--date", DAY])


def test_profiles():
    store_key = "spark.sql.streaming.stateStore.providerClass"
    assert store_key in profile("streaming") and store_key not in profile("batch")
    assert "spark.sql.shuffle.partitions" not in profile()
    assert profile(extra={"spark.sql.shuffle.partitions": "7"})["spark.sql.shuffle.partitions"] == "7"
    assert profile(shuffle_partitions=20000)["spark.sql.shuffle.partitions"] == "20000"
    assert ObjectStore.from_env({}) is None
    env = {"S3_ENDPOINT": "http://store", "S3_ACCESS_KEY": "a", "S3_SECRET_KEY": "b"}
    store = ObjectStore.from_env(env).options()
    assert store["spark.hadoop.fs.s3a.endpoint"] == "http://store"
    with pytest.raises(ValueError):
        profile("other")
