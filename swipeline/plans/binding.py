"""Give the driver's star-schema tables the shape of card transactions.

``card_stream`` has one row per event with a unique id and a rising unique time; ``ledger`` has one
row per lineitem, with ids that repeat and times that are whole days. Joins carry no hint: customer,
supplier, part and orders grow with the data, so Spark decides from their size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swipeline.functions.columns import card_token
from swipeline.schemas import CREDIT_TYPES, MONEY


# Declared, so that opening a table does not start a job that reads footers.
_TABLES = {
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,"
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string,"
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "n_name", "r_name"
    )


def _with_sellers(spark: SparkSession, sf_dir: str, facts: DataFrame, key: str) -> DataFrame:
    """``facts`` with the columns of their supplier.

    Spark takes the size of a join for the product of its sides, so a supplier already joined with its nation
    would look too large to broadcast and move all facts. Each table is joined by its own size instead.
    """
    sellers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nations = places(spark, sf_dir).select(
        F.col("n_nationkey").alias("_seller_nation"), F.col("n_name").alias("country_code"), F.col("r_name").alias("currency")
    )
    return (
        facts.join(sellers, F.col(key) == F.col("s_suppkey"))
        .join(nations, F.col("s_nationkey") == F.col("_seller_nation"))
        .withColumn("acquirer_id", F.col("s_nationkey").cast("string"))
    )


def _with_holders(spark: SparkSession, sf_dir: str, facts: DataFrame, key: str) -> DataFrame:
    """``facts`` with issuer and region of their customer, as :func:`_with_sellers`."""
    holders = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = places(spark, sf_dir).select(
        F.col("n_nationkey").alias("_holder_nation"), F.col("r_name").alias("_holder_region")
    )
    return (
        facts.join(holders, F.col(key) == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("_holder_nation"))
        .withColumn("issuer_id", F.col("c_nationkey").cast("string"))
    )


def _signed(amount, kind):
    value = amount.cast(MONEY)
    return F.when(kind.isin(*CREDIT_TYPES), -value).otherwise(value)


def card_stream(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Transactions from events; pass a streaming ``events`` for a stream."""
    events = table(spark, sf_dir, "events") if events is None else events
    sellers = table(spark, sf_dir, "supplier").count()
    kind = (
        F.when(F.col("event_type") == "error", "chargeback")
        .when(F.col("event_type") == "signup", "refund")
        .when(F.col("event_type") == "click", "p2p")
        .otherwise("purchase")
    )
    refused = F.get_json_object("props", "$.k").cast("int") < 6
    facts = events.select(
        "event_id",
        "user_id",
        (F.col("event_id") % sellers).alias("_seller"),
        F.col("value"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        kind.alias("transaction_type"),
        F.when(refused, "51").otherwise("00").alias("response_code"),
    )
    sold = _with_sellers(spark, sf_dir, facts, "_seller")
    return (
        _with_holders(spark, sf_dir, sold, "user_id")
        .select(
            F.col("event_id").cast("string").alias("transaction_id"),
            card_token(F.col("user_id")).alias("card_hash"),
            F.col("s_suppkey").cast("string").alias("merchant_id"),
            (F.lit(5000) + F.col("event_id") % 20).cast("string").alias("merchant_category_code"),
            _signed(F.col("value"), F.col("transaction_type")).alias("amount"),
            "currency",
            "timestamp",
            "transaction_type",
            "country_code",
            "acquirer_id",
            "issuer_id",
            "response_code",
            (F.col("currency") != F.col("_holder_region")).alias("is_cross_border"),
            F.col("s_name").alias("merchant_name"),
            F.lit(None).cast("string").alias("terminal_id"),
            F.lit(None).cast("string").alias("auth_code"),
        )
    )


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions from lineitems.

    Orders meet their customers first, and texts are made last: facts move once, by order, and narrow.
    """
    kind = (
        F.when(F.col("l_returnflag") == "N", "purchase")
        .when(F.col("l_returnflag") == "A", "refund")
        .when(F.col("l_linestatus") == "O", "chargeback")
        .otherwise("p2p")
    )
    facts = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_returnflag",
        "l_linestatus",
        "l_extendedprice",
        "l_shipdate",
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    sold = facts.join(_with_holders(spark, sf_dir, orders, "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return (
        _with_sellers(spark, sf_dir, sold.join(part, F.col("l_partkey") == F.col("p_partkey")), "l_suppkey")
        .withColumn("transaction_type", kind)
        .select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("transaction_id"),
            F.col("o_custkey").cast("string").alias("card_hash"),
            F.col("l_suppkey").cast("string").alias("merchant_id"),
            F.col("p_brand").alias("merchant_category_code"),
            _signed(F.col("l_extendedprice"), F.col("transaction_type")).alias("amount"),
            "currency",
            F.col("l_shipdate").cast("timestamp").alias("timestamp"),
            "transaction_type",
            "country_code",
            "acquirer_id",
            "issuer_id",
            F.when(F.col("o_orderstatus") == "P", "51").otherwise("00").alias("response_code"),
            (F.col("currency") != F.col("_holder_region")).alias("is_cross_border"),
            F.col("s_name").alias("merchant_name"),
            F.lit(None).cast("string").alias("terminal_id"),
            F.lit(None).cast("string").alias("auth_code"),
        )
    )


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("merchant_id"),
        F.col("s_name").alias("merchant_name"),
        (F.lit(5000) + F.col("s_suppkey") % 20).cast("string").alias("merchant_category_code"),
    )


def banks(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    """Nations as acquirers or issuers, under the given key name."""
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias(key), F.col("n_name").alias("country_code")
    )
