from __future__ import annotations

from datetime import date, datetime, timedelta

from conftest import T0
from swipeline.operators.time_windows import card_daily_totals, issuer_cross_border_ratio, merchant_volume


def test_merchant_volume_leaves_refunds_out(txns):
    df = txns({"amount": 100}, {"amount": -50, "transaction_type": "refund"}, {"amount": 7, "card_hash": "b"})
    (row,) = merchant_volume(df).collect()
    assert (row.window_start, row.window_end) == (T0, T0 + timedelta(minutes=5))
    assert (row.txn_count, row.total_value, row.unique_cards) == (2, 107, 2)


def test_merchant_volume_per_merchant_and_window(txns):
    df = txns({}, {"merchant_id": "m2"}, {"timestamp": T0 + timedelta(minutes=5)}, {"card_hash": None})
    got = {(r.merchant_id, r.window_start.minute): (r.txn_count, r.unique_cards) for r in merchant_volume(df).collect()}
    assert got == {("MER0000001", 30): (2, 1), ("m2", 30): (1, 1), ("MER0000001", 35): (1, 1)}


def test_issuer_ratio_over_sliding_windows(txns):
    df = txns(
        *[
            {"is_cross_border": x, "timestamp": T0 + timedelta(minutes=5 * i)}
            for i, x in enumerate([True, False, False, True])
        ]
    )
    got = {
        r.window_start.strftime("%H:%M"): (r.total_txns, r.cross_border_txns, r.cross_border_ratio)
        for r in issuer_cross_border_ratio(df).collect()
    }
    assert got == {
        "09:45": (3, 1, 0.3333),
        "10:00": (4, 2, 0.5),
        "10:15": (4, 2, 0.5),
        "10:30": (4, 2, 0.5),
        "10:45": (1, 1, 1.0),
    }


def test_card_daily(txns):
    late = datetime(2024, 1, 15, 23, 59, 59)
    df = txns(
        {"card_hash": "x", "amount": 100},
        {"card_hash": "x", "amount": 200, "timestamp": late},
        {"card_hash": "x", "amount": 1, "timestamp": late + timedelta(seconds=1)},
        {"card_hash": "y"},
    )
    got = {(r.card_hash, r.date): (r.daily_txn_count, r.daily_spend, r.last_seen) for r in card_daily_totals(df).collect()}
    assert got == {
        ("x", date(2024, 1, 15)): (2, 300, late),
        ("x", date(2024, 1, 16)): (1, 1, late + timedelta(seconds=1)),
        ("y", date(2024, 1, 15)): (1, 50, T0),
    }
