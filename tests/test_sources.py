from __future__ import annotations

import os
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import T0
from swipeline.functions.columns import card_token
from swipeline.operators import validation
from swipeline.schemas import TRANSACTION, optional
from swipeline.sources import kafka
from swipeline.sources.landing import encode_json, parse_json, parsed, read_landing, write_landing
from swipeline.sources.tables import (
    deduplicate,
    read_dimension,
    read_table,
    write_date,
    write_processed,
    write_table,
)
from swipeline.sources.zones import Zones, scratch_dir


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture
def zones(scratch):
    return Zones.under(scratch)


def test_zones_from_environment():
    zones = Zones.from_env({"LANDING_ZONE_PATH": "s3a://bucket/landing"})
    assert zones.path("landing", "transactions") == "s3a://bucket/landing/transactions"
    assert zones.analytics == "./data/analytics"
    assert not zones.checkpoints.startswith(zones.landing)
    with pytest.raises(ValueError):
        zones.path("attic", "x")


def test_scratch_is_below_the_shared_folder(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_landing_round_trip_and_pruning(spark, txns, zones):
    df = txns(
        {"timestamp": T0 + timedelta(microseconds=123456), "amount": "0.10", "terminal_id": None},
        {"timestamp": T0 + timedelta(hours=1)},
        {"timestamp": T0 + timedelta(days=1)},
    )
    write_landing(df, zones)
    back = read_landing(spark, zones)
    assert rows_of(back.drop("date", "hour")) == rows_of(df)
    day = read_landing(spark, zones, date="2024-01-15")
    assert sorted(r.hour for r in day.collect()) == [10, 11]
    assert all("date=2024-01-15" in f for f in day.inputFiles())
    hour = read_landing(spark, zones, date="2024-01-15", hour=10)
    assert hour.count() == 1 and all("hour=10" in f for f in hour.inputFiles())
    assert read_landing(spark, zones, date="2030-01-01").count() == 0
    assert read_landing(spark, zones, date="2030-01-01").columns == back.columns
    with pytest.raises(ValueError):
        read_landing(spark, zones, hour=1)


def test_landing_amount_and_time_are_texts(spark, txns, zones):
    write_landing(txns({"amount": "84.50"}), zones)
    line = spark.read.text(f"{zones.landing}/transactions").first().value
    assert '"amount":"84.50"' in line and '"timestamp":"2024-01-15T10:30:00.000000+00:00"' in line


def test_parse_json_splits_corrupt_records(spark, txns):
    df = txns({}, {})
    good = df.select(encode_json(df).cast("binary").alias("value"))
    iso = spark.createDataFrame([('{"transaction_id":"i","amount":"84.50","timestamp":"2024-01-15T10:23:45+00:00"}',)], "value string")
    bad = spark.createDataFrame([("{oops",), ('{"amount":"abc","transaction_id":"x"}',)], "value string")
    fine, broken = parsed(parse_json(good.select(F.col("value").cast("string")).union(iso).union(bad)))
    assert rows_of(fine.where("transaction_id <> 'i'")) == rows_of(df)
    (typed,) = fine.where("transaction_id = 'i'").collect()
    assert (typed.amount, typed.timestamp) == (Decimal("84.50"), datetime(2024, 1, 15, 10, 23, 45))
    assert sorted(r[0] for r in broken.collect()) == sorted(r.value for r in bad.collect())


def test_kafka_messages(txns):
    df = txns({"card_hash": "k"})
    (row,) = kafka.encode(df).collect()
    assert row.key == "k" and '"amount":"50.00"' in row.value
    assert rows_of(parse_json(kafka.encode(df)).drop("_corrupt_record")) == rows_of(df)
    options = kafka.source_options("host:1", "t")
    assert options == {"kafka.bootstrap.servers": "host:1", "subscribe": "t", "startingOffsets": "latest"}


def test_filters(spark, zones):
    df = spark.createDataFrame([(1, "a'b"), (2, "c"), (3, "d")], "n int, s string")
    write_table(df, zones, "analytics", "t")
    keep = read_table(spark, zones, "analytics", "t", [("n", ">=", 1), ("s", "=", "a'b")])
    assert [r.n for r in keep.collect()] == [1]
    assert read_table(spark, zones, "analytics", "t").count() == 3
    more = spark.createDataFrame([(1, "a'b"), (2, "c"), (3, None)], "n int, s string")
    write_table(more, zones, "analytics", "u")
    for item, want in (
        (("n", "in", [1, 3]), [1, 3]),
        (("n", "not in", [1, 3]), [2]),
        (("s", "like", "a%"), [1]),
        (("s", "is null", True), [3]),
        (("s", "is null", False), [1, 2]),
    ):
        assert sorted(r.n for r in read_table(spark, zones, "analytics", "u", [item]).collect()) == want
    with pytest.raises(ValueError):
        read_table(spark, zones, "analytics", "t", [("n", "; DROP", 1)])


def test_overwrite_keeps_other_partitions(spark, zones):
    for day, n in (("d1", 1), ("d2", 2), ("d1", 3)):
        write_table(spark.createDataFrame([(n, day)], "n int, processing_date string"), zones, "analytics", "t", ["processing_date"])
    assert sorted(tuple(r) for r in read_table(spark, zones, "analytics", "t").collect()) == [(2, "d2"), (3, "d1")]
    empty = spark.createDataFrame([], "n int, processing_date string")
    write_date(empty, zones, "analytics", "t", "d1")
    assert [tuple(r) for r in read_table(spark, zones, "analytics", "t").collect()] == [(2, "d2")]


def test_dimensions_have_declared_types(spark, zones):
    os.makedirs(zones.seeds)
    with open(f"{zones.seeds}/merchants.csv", "w") as out:
        out.write("merchant_id,merchant_name,merchant_category_code,country_code,acquirer_id,city,is_active\n")
        out.write("M1,Shop,0742,US,A1,Boston,true\n")
    row = read_dimension(spark, zones, "merchants").first()
    assert (row.merchant_category_code, row.is_active) == ("0742", True)


def test_processed_zone_is_typed_unique_and_partitioned(spark, txns, zones):
    df = txns(
        {"transaction_id": "x", "timestamp": T0 + timedelta(days=1)}, {"transaction_id": "x"},
        {"amount": -1, "transaction_type": "refund"},
    )
    write_processed(df, zones)
    back = read_table(spark, zones, "processed", "transactions")
    assert back.count() == 2
    assert back.where("transaction_id = 'x'").first().timestamp == T0
    assert os.path.isdir(f"{zones.processed}/transactions/date=2024-01-15/transaction_type=refund")
    assert dict(back.dtypes)["amount"] == "decimal(18,2)"
    assert rows_of(deduplicate(df.orderBy("timestamp"))) == rows_of(deduplicate(df.orderBy(F.desc("timestamp"))))


def test_validation(txns):
    df = txns(
        {"currency": "usd", "country_code": "us"},
        {"merchant_category_code": "54", "currency": "US1", "country_code": "USA"},
        {"amount": -1}, {"amount": 1, "transaction_type": "refund"}, {"amount": 0, "transaction_type": "chargeback"},
        {"transaction_type": "odd"}, {"issuer_id": None},
    )
    checked = validation.validate(df)
    got = {r.transaction_id: r.failed_rules for r in checked.collect()}
    assert list(got.values()) == [
        [], ["mcc_format", "currency_format", "country_format"], ["amount_sign"], ["amount_sign"], ["amount_sign"],
        ["type_domain"], ["required_field"],
    ]
    valid, quarantined = validation.split(checked)
    assert valid.columns == df.columns and valid.first().currency == "USD" and valid.first().country_code == "US"
    assert (valid.count(), quarantined.count()) == (1, 6)


def test_response_breakdown(txns):
    df = txns({}, {"response_code": "51"}, {"response_code": "xx"}, {"response_code": None})
    got = {r.response_code: (r.response_label, r.is_approved) for r in validation.response_breakdown(df).collect()}
    assert got == {"00": ("APPROVED", True), "51": ("INSUFFICIENT_FUNDS", False), "xx": (None, False), None: (None, None)}


def test_card_token(spark):
    token = spark.range(1).select(card_token(F.lit("4111"))).first()[0]
    assert len(token) == 64 and token == token.lower()


def test_schema_is_shared_and_unchanged():
    assert len(TRANSACTION.fields) == 16 and len(optional(TRANSACTION).fields) == 16


def test_deduplicate_keeps_rows_without_id_and_prefers_a_time(spark, txns):
    df = txns({"transaction_id": None}, {"transaction_id": None}, {"transaction_id": "a", "timestamp": None}, {"transaction_id": "a"})
    rows = deduplicate(df).collect()
    assert sorted(str(r["transaction_id"]) for r in rows) == ["None", "None", "a"]
    assert all(r["timestamp"] is not None for r in rows)


def test_a_message_without_value_is_no_transaction(spark):
    assert parse_json(spark.createDataFrame([(None,)], "value string")).count() == 0


def test_a_required_date_must_have_landed(spark, scratch):
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException):
        read_landing(spark, Zones.under(scratch), date="2031-01-01", required=True)
