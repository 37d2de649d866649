from __future__ import annotations

from decimal import Decimal

from swipeline.operators import reports

D = "2024-01-15"


def one(df, **keys):
    rows = [r for r in df.collect() if all(r[k] == v for k, v in keys.items())]
    assert len(rows) == 1, rows
    return rows[0]


def test_settlement_nets_and_marks_unknown_banks(spark, txns):
    df = txns(
        {"amount": 100},
        {"amount": 20, "response_code": "51"},
        {"amount": -30, "transaction_type": "refund"},
        {"amount": -50, "transaction_type": "chargeback"},
        {"amount": 999, "transaction_type": "p2p"},
        {"amount": -5, "transaction_type": "refund", "acquirer_id": "NEW", "issuer_id": None},
    )
    acquirers = spark.createDataFrame([("ACQ0001",), ("ACQ0001",)], "acquirer_id string")
    issuers = spark.createDataFrame([("ISS0001",)], "issuer_id string")
    out = reports.settlement(df, acquirers, issuers, D)
    known = one(out, acquirer_id="ACQ0001")
    assert (known.purchase_count, known.purchase_volume) == (2, Decimal("120.00"))
    assert (known.refund_volume, known.chargeback_volume) == (Decimal("30.00"), Decimal("50.00"))
    assert known.net_settlement_amount == Decimal("40.00")
    assert (known.acquirer_known, known.issuer_known, known.processing_date) == (True, True, D)
    other = one(out, acquirer_id="NEW")
    assert (other.net_settlement_amount, other.purchase_volume) == (Decimal("-5.00"), Decimal("0.00"))
    assert (other.acquirer_known, other.issuer_known) == (False, False)


def test_mcc_spending(txns):
    df = txns(
        {"amount": 10, "card_hash": "a"},
        {"amount": 30, "card_hash": "b", "response_code": "51", "transaction_type": "p2p"},
        {"amount": -5, "transaction_type": "refund"},
    )
    row = one(reports.mcc_spending(df, D))
    assert (row.txn_count, row.total_spend, row.avg_txn_amount, row.max_txn_amount) == (2, 40, 20.0, 30)
    assert (row.active_merchant_count, row.unique_cards, row.approval_rate) == (1, 2, 0.5)


def test_merchant_summary_counts_every_type(txns):
    df = txns(
        {"merchant_category_code": "1111"},
        {"transaction_type": "p2p", "merchant_category_code": "2222"},
        {"amount": -5, "transaction_type": "refund", "response_code": None},
    )
    row = one(reports.merchant_summary(df, D))
    assert (row.total_txns, row.purchase_count, row.refund_count, row.chargeback_count) == (3, 1, 1, 0)
    assert (row.purchase_volume, row.approval_rate, row.merchant_category_code) == (50, 0.6667, "1111")


def test_corridors_fall_back_to_the_merchant_country(spark, txns):
    df = txns(
        {"is_cross_border": True, "country_code": "GB"},
        {"is_cross_border": True, "country_code": "GB", "issuer_id": "NEW"},
        {"is_cross_border": None, "country_code": "GB"},
        {"is_cross_border": False},
        {"is_cross_border": True, "transaction_type": "refund", "amount": -1},
    )
    issuers = spark.createDataFrame([("ISS0001", "US")], "issuer_id string, country_code string")
    out = reports.corridor_volume(df, issuers, D)
    assert sorted(r.corridor for r in out.collect()) == ["GB→GB", "US→GB"]
    assert one(out, issuer_country="US").txn_count == 1


def test_chargeback_ratios(spark, txns):
    rows = [{"merchant_id": "m1", "amount": 100} for _ in range(3)]
    rows += [{"merchant_id": "m1", "amount": -100, "transaction_type": "chargeback"}]
    rows += [{"merchant_id": "m2"}, {"merchant_id": "only_bad", "amount": -1, "transaction_type": "chargeback"}]
    names = spark.createDataFrame(
        [("m1", "One", "5411")], "merchant_id string, merchant_name string, merchant_category_code string"
    )
    out = reports.chargeback_ratios(txns(*rows), names, D)
    bad = one(out, merchant_id="m1")
    assert (bad.chargeback_ratio_count, bad.chargeback_ratio_value) == (0.333333, 0.25)
    assert (bad.is_flagged, bad.threshold_applied, bad.merchant_name) == (True, 0.02, "One")
    fine = one(out, merchant_id="m2")
    assert (fine.is_flagged, fine.chargeback_count, fine.merchant_name) == (False, 0, None)
    assert out.count() == 2
    strict = reports.chargeback_ratios(txns(*rows), names, D, threshold=1 / 3)
    assert one(strict, merchant_id="m1").is_flagged is False
