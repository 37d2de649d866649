from __future__ import annotations

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import T0
from swipeline.operators.fraud import (
    FraudConfig,
    apply_all_fraud_rules,
    flag_amount_anomaly,
    flag_geo_impossibility,
    flag_velocity,
    multi_country_cards,
)

# Each rule is tested on both routes: 0 makes every card a busy one.
ROUTES = [1_000_000, 0]


def at(**delta):
    return T0 + timedelta(**delta)


def flagged(df, column):
    return [r.transaction_id for r in df.where(column).orderBy("transaction_id").collect()]


@pytest.mark.parametrize("busy", ROUTES)
def test_velocity_flags_only_the_sixth(txns, busy):
    df = txns(*[{"timestamp": at(seconds=5 * i)} for i in range(6)])
    assert flagged(flag_velocity(df, 60, 5, busy), "fraud_velocity") == ["t0005"]


@pytest.mark.parametrize("busy", ROUTES)
def test_velocity_spread_out(txns, busy):
    df = txns(*[{"timestamp": at(seconds=30 * i)} for i in range(6)])
    out = flag_velocity(df, 60, 5, busy)
    assert flagged(out, "fraud_velocity") == []
    assert out.agg(F.max("velocity_count")).first()[0] == 3


@pytest.mark.parametrize("busy", ROUTES)
def test_velocity_counts_peers_of_the_same_second(txns, busy):
    df = txns(*[{"timestamp": at(microseconds=1000 * i)} for i in range(3)], {"timestamp": at(seconds=60)})
    out = flag_velocity(df, 60, 5, busy).orderBy("transaction_id").collect()
    assert [r.velocity_count for r in out] == [3, 3, 3, 4]


@pytest.mark.parametrize("busy", ROUTES)
def test_amount_outlier_and_too_few_samples(txns, busy):
    many = txns(*[{"timestamp": at(seconds=i)} for i in range(5)], {"amount": 5000, "timestamp": at(seconds=9)})
    assert flagged(flag_amount_anomaly(many, busy_card_rows=busy), "fraud_amount_anomaly") == ["t0005"]
    few = txns({}, {"amount": 5000, "timestamp": at(seconds=1)})
    assert flagged(flag_amount_anomaly(few, busy_card_rows=busy), "fraud_amount_anomaly") == []


@pytest.mark.parametrize("busy", ROUTES)
def test_amount_ties_follow_the_id_and_null_amounts_count_as_samples(txns, busy):
    df = txns({"amount": 10}, {"amount": 20}, {"amount": None}, {"amount": 100})
    out = flag_amount_anomaly(df, busy_card_rows=busy).orderBy("transaction_id").collect()
    assert [r.prior_sample_count for r in out] == [0, 1, 2, 3]
    assert [r.rolling_avg for r in out] == [None, 10.0, 15.0, 15.0]
    assert [r.fraud_amount_anomaly for r in out] == [False, False, False, True]


@pytest.mark.parametrize("busy", ROUTES)
def test_geo_pairs(txns, busy):
    near = txns({}, {"country_code": "GB", "timestamp": at(minutes=15)})
    assert flagged(flag_geo_impossibility(near, 30, busy), "fraud_geo_impossibility") == ["t0000", "t0001"]
    assert multi_country_cards(near, 30, busy).count() == 1
    edge = txns({}, {"country_code": "GB", "timestamp": at(minutes=30)})
    assert len(flagged(flag_geo_impossibility(edge, 30, busy), "fraud_geo_impossibility")) == 2
    far = txns({}, {"country_code": "GB", "timestamp": at(hours=2)})
    assert flagged(flag_geo_impossibility(far, 30, busy), "fraud_geo_impossibility") == []


@pytest.mark.parametrize("busy", ROUTES)
def test_geo_ignores_absent_countries_and_copies_of_one_transaction(txns, busy):
    absent = txns({}, {"country_code": None})
    assert flagged(flag_geo_impossibility(absent, 30, busy), "fraud_geo_impossibility") == []
    copies = txns({"transaction_id": "same"}, {"transaction_id": "same", "country_code": "GB"})
    assert flagged(flag_geo_impossibility(copies, 30, busy), "fraud_geo_impossibility") == []


@pytest.mark.parametrize("busy", ROUTES)
def test_composite_reasons_and_shape(txns, busy):
    rows = [{"timestamp": at(seconds=i)} for i in range(6)]
    rows += [{"amount": 5000, "country_code": "GB", "timestamp": at(seconds=7)}]
    rows += [{"card_hash": "calm", "timestamp": at(seconds=i)} for i in range(2)]
    df = txns(*rows)
    out = apply_all_fraud_rules(df, FraudConfig(busy_card_rows=busy))
    assert out.columns == [*df.columns, "fraud_reasons", "is_fraud_flagged"]
    got = {r.transaction_id: (r.fraud_reasons, r.is_fraud_flagged) for r in out.collect()}
    assert len(got) == len(rows)
    assert got["t0000"] == ("GEO_IMPOSSIBILITY", True)
    assert got["t0006"] == ("VELOCITY|AMOUNT_ANOMALY|GEO_IMPOSSIBILITY", True)
    assert got["t0007"] == ("", False)


def brute_force(rows, config):
    """The rules read off row by row, quadratic per card."""
    def second(r):
        return int(r.timestamp.timestamp() // 1)

    hit_cards = {
        a.card_hash
        for a in rows
        for b in rows
        if a.card_hash == b.card_hash and a.transaction_id != b.transaction_id
        and a.country_code and b.country_code and a.country_code != b.country_code
        and second(a) - config.geo_window_seconds <= second(b) <= second(a)
    }
    out = {}
    for a in rows:
        mine = [b for b in rows if b.card_hash == a.card_hash]
        recent = sum(second(a) - config.velocity_window_seconds <= second(b) <= second(a) for b in mine)
        prior = [b for b in mine if (b.timestamp, b.transaction_id) < (a.timestamp, a.transaction_id)]
        amounts = [b.amount for b in prior]
        mean = float(sum(amounts)) / len(amounts) if amounts else None
        odd = len(prior) >= config.amount_min_samples and float(a.amount) > mean * config.amount_multiplier
        reasons = [
            name for name, on in (
                ("VELOCITY", recent > config.velocity_max_txns),
                ("AMOUNT_ANOMALY", odd),
                ("GEO_IMPOSSIBILITY", a.card_hash in hit_cards),
            ) if on
        ]
        out[a.transaction_id] = "|".join(reasons)
    return out


@pytest.mark.parametrize("busy", [1_000_000, 60, 0])
@pytest.mark.parametrize("windows", [(60, 5), (10_000, 300)])
def test_random_history_equals_brute_force(txns, busy, windows):
    """One card holds a third of the rows; look-backs shorter and longer than a slice."""
    rng = random.Random(7)
    rows = []
    for i in range(240):
        card = "hot" if i % 3 == 0 else f"card{rng.randrange(12)}"
        country = rng.choice(["US"] * 8 + ["GB"]) if card in ("hot", "card1", "card2") else "US"
        rows.append({
            "card_hash": card,
            "country_code": country,
            "amount": rng.choice([5, 10, 20, -7, 400]),
            "timestamp": at(seconds=rng.randrange(0, 30_000) // 3, microseconds=rng.randrange(3) * 1000),
        })
    df = txns(*rows)
    config = FraudConfig(
        velocity_window_seconds=windows[0], velocity_max_txns=2, geo_window_minutes=windows[1],
        busy_card_rows=busy,
    )
    got = {r.transaction_id: r.fraud_reasons for r in apply_all_fraud_rules(df, config).collect()}
    want = brute_force(df.collect(), config)
    assert got == want
    assert {"VELOCITY", "AMOUNT_ANOMALY"} <= {p for v in want.values() for p in v.split("|")}


def test_config_from_environment():
    config = FraudConfig.from_env({"FRAUD_VELOCITY_MAX_TXN": "9", "FRAUD_AMOUNT_MULTIPLIER": "2.5"})
    assert (config.velocity_max_txns, config.amount_multiplier) == (9, 2.5)
    assert config.velocity_window_seconds == 60


@pytest.mark.parametrize("busy", [1_000_000, 8, 0])
@pytest.mark.parametrize("seed", [1, 2])
def test_geo_on_messy_histories_equals_the_self_join(txns, busy, seed):
    """Repeated ids, absent countries and ties, on many short histories."""
    rng = random.Random(seed)
    rows = [
        {
            "transaction_id": f"id{rng.randrange(3)}",
            "card_hash": f"card{i % 60}",
            "country_code": rng.choice(["US", "US", "GB", None]),
            "timestamp": at(seconds=rng.choice([0, 0, 50, 61, 110, 3595, 3605, 3700, 7190, 7300])),
        }
        for i in range(420 if seed == 1 else 180)
    ]
    df = txns(*rows)
    want = {
        a["card_hash"] for a in rows for b in rows
        if a["card_hash"] == b["card_hash"] and a["transaction_id"] != b["transaction_id"]
        and a["country_code"] and b["country_code"] and a["country_code"] != b["country_code"]
        and 0 <= (a["timestamp"] - b["timestamp"]).total_seconds() <= 60
    }
    got = {r.card_hash for r in multi_country_cards(df, 1, busy).collect()}
    assert got == want
    assert 0 < len(want) < 60


@pytest.mark.parametrize("busy", ROUTES)
def test_absent_cards_and_times_are_groups_of_their_own(txns, busy):
    df = txns(
        {"card_hash": None}, {"card_hash": None, "country_code": "GB"},
        {"timestamp": None}, {"timestamp": None}, {},
    )
    out = {r.transaction_id: r for r in flag_velocity(df, 60, 5, busy).collect()}
    assert [out[f"t{i:04d}"].velocity_count for i in range(5)] == [2, 2, 2, 2, 1]
    assert multi_country_cards(df, 30, busy).count() == 0
    amounts = {r.transaction_id: r.prior_sample_count for r in flag_amount_anomaly(df, busy_card_rows=busy).collect()}
    assert [amounts[f"t{i:04d}"] for i in range(5)] == [0, 1, 0, 1, 2]
