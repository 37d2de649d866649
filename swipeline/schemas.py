"""Schemas and fixed domain values."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DecimalType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

MONEY = DecimalType(18, 2)
TEXT = StringType()
FLAG = BooleanType()


def _schema(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


def optional(schema: StructType) -> StructType:
    """The same fields, all nullable."""
    return StructType([StructField(f.name, f.dataType, True) for f in schema.fields])


def _texts(*names: str) -> dict[str, DataType]:
    return dict.fromkeys(names, TEXT)


TRANSACTION = StructType(
    [
        StructField("transaction_id", TEXT, False),
        StructField("card_hash", TEXT, False),
        StructField("merchant_id", TEXT, False),
        StructField("merchant_category_code", TEXT),
        StructField("amount", MONEY, False),
        StructField("currency", TEXT),
        StructField("timestamp", TimestampType(), False),
        StructField("transaction_type", TEXT, False),
        StructField("country_code", TEXT),
        StructField("acquirer_id", TEXT),
        StructField("issuer_id", TEXT),
        StructField("response_code", TEXT),
        StructField("is_cross_border", FLAG),
        StructField("merchant_name", TEXT),
        StructField("terminal_id", TEXT),
        StructField("auth_code", TEXT),
    ]
)

DIMENSIONS = {
    "merchants": _schema(
        **_texts(
            "merchant_id", "merchant_name", "merchant_category_code", "country_code", "acquirer_id", "city"
        ),
        is_active=FLAG,
    ),
    "acquirers": _schema(**_texts("acquirer_id", "acquirer_name", "country_code"), is_active=FLAG),
    "issuers": _schema(
        **_texts("issuer_id", "issuer_name", "country_code", "currency", "network"), is_active=FLAG
    ),
    "country_codes": _schema(**_texts("country_code", "country_name", "region", "currency_code")),
}

# The domain of the card network, stated as data.
TRANSACTION_TYPES = ("purchase", "refund", "chargeback", "p2p")
SPEND_TYPES = ("purchase", "p2p")
SETTLED_TYPES = ("purchase", "refund", "chargeback")
CREDIT_TYPES = ("refund", "chargeback")
APPROVED = "00"
RESPONSE_CODES = {
    "00": "APPROVED",
    "51": "INSUFFICIENT_FUNDS",
    "05": "DO_NOT_HONOUR",
    "03": "INVALID_MERCHANT",
    "54": "EXPIRED_CARD",
    "59": "SUSPECTED_FRAUD",
    "62": "RESTRICTED_CARD",
    "61": "EXCEEDS_WITHDRAWAL_LIMIT",
}
REQUIRED_NOT_NULL = ("transaction_id", "amount", "timestamp", "card_hash", "merchant_id")
# Both bounds are allowed values.
AMOUNT_RANGES = {
    "purchase": (Decimal("0.01"), Decimal("50000.00")),
    "refund": (Decimal("-50000.00"), Decimal("-0.01")),
    "chargeback": (Decimal("-50000.00"), Decimal("-0.01")),
    "p2p": (Decimal("0.01"), Decimal("10000.00")),
}

# The columns a batch must bring; the trailing four are enrichment.
EXPECTED_COLUMNS = tuple(TRANSACTION.fieldNames()[:12])
