"""Row validation: every rule a boolean column, rows split into valid and quarantined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swipeline.functions.columns import volume
from swipeline.schemas import APPROVED, CREDIT_TYPES, RESPONSE_CODES, SPEND_TYPES, TRANSACTION, TRANSACTION_TYPES

_MANDATORY = tuple(TRANSACTION.fieldNames()[:13])


def _breaches() -> dict[str, Column]:
    """Rule name to the condition that breaks it. An absent value breaks ``required_field`` only."""
    amount, kind = F.col("amount"), F.col("transaction_type")
    return {
        "required_field": F.greatest(*[F.col(c).isNull() for c in _MANDATORY]),
        "mcc_format": ~F.col("merchant_category_code").rlike("^[0-9]{4}$"),
        "currency_format": ~F.col("currency").rlike("^[A-Za-z]{3}$"),
        "country_format": ~F.col("country_code").rlike("^[A-Za-z]{2}$"),
        "type_domain": ~kind.isin(*TRANSACTION_TYPES),
        "amount_sign": (kind.isin(*SPEND_TYPES) & (amount <= 0)) | (kind.isin(*CREDIT_TYPES) & (amount >= 0)),
    }


def validate(df: DataFrame) -> DataFrame:
    """Upper-case currency and country, and add ``failed_rules``: the names of the broken rules."""
    named = [F.when(broken, F.lit(rule)) for rule, broken in _breaches().items()]
    return df.withColumns(
        {
            "currency": F.upper("currency"),
            "country_code": F.upper("country_code"),
            "failed_rules": F.array_compact(F.array(*named)),
        }
    )


def split(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The valid rows in their plain schema, and the quarantined ones with their broken rules."""
    clean = F.size("failed_rules") == 0
    return validated.where(clean).drop("failed_rules"), validated.where(~clean)


def _label() -> Column:
    pairs = [F.lit(part) for pair in RESPONSE_CODES.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), F.col("response_code"))


def response_breakdown(df: DataFrame) -> DataFrame:
    """Count and absolute amount per response code, with its label; unknown codes have none."""
    return (
        df.groupBy("response_code")
        .agg(F.count(F.lit(1)).alias("txn_count"), volume().alias("total_value"))
        .select(
            "response_code",
            F.when(F.col("response_code").isNotNull(), _label()).alias("response_label"),
            (F.col("response_code") == APPROVED).alias("is_approved"),
            "txn_count",
            "total_value",
        )
    )
