"""The given test tables seen as transactions, customers and dates of the data model."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

# Fixed calendar of the test data.
EVENTS_SNAPSHOT = dt.date(2024, 1, 31)
RETAIL_SNAPSHOT = dt.date(2001, 8, 2)
EVENTS_PROMOTED = ["purchase", "signup"]
RETAIL_PROMOTED = ["PROMO", "ECONOMY", "SMALL"]
EVENTS_BOUNDS = {"features_end": 19, "labels_end": 24}
RETAIL_BOUNDS = {"features_end": 2300, "labels_end": 2352}
PERSONA_OF_SEGMENT = {"AUTOMOBILE": "A", "BUILDING": "B"}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event stream as transactions; the channel is the parity of a number inside the JSON text."""
    k = F.from_json("props", "k int")["k"]
    return _read(spark, sf_dir, "events").select(
        F.concat(F.lit("TXN-"), F.col("event_id").cast("string")).alias("transaction_id"),
        F.concat(F.lit("CUST-"), F.col("user_id").cast("string")).alias("customer_id"),
        F.col("event_type").alias("category"),
        F.col("value").alias("total_amount"),
        F.col("ts").alias("timestamp"),
        F.when(k % 2 == 0, "online").otherwise("in-store").alias("channel"),
        F.to_date("ts").alias("ingest_date"),
    )


def retail_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as transactions of the ordering customer on the order date.

    Two equi-joins; which side is broadcast is left to the optimiser, which knows the sizes.
    """
    lines = _read(spark, sf_dir, "lineitem")
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    parts = _read(spark, sf_dir, "part").select("p_partkey", "p_type")
    joined = (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .join(parts, lines.l_partkey == parts.p_partkey)
    )
    return joined.select(
        F.concat_ws(
            "-", F.lit("TXN"), F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
            F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"),
            F.date_format("l_shipdate", "yyyyMMdd"),
        ).alias("transaction_id"),
        F.concat(F.lit("CUST-"), F.col("o_custkey").cast("string")).alias("customer_id"),
        F.concat(F.lit("STORE-"), F.col("l_suppkey").cast("string")).alias("store_id"),
        F.concat(F.lit("PROD-"), F.col("l_partkey").cast("string")).alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.col("l_extendedprice").alias("total_amount"),
        F.col("o_orderdate").alias("timestamp"),
        F.when(F.col("l_linestatus") == "O", "online").otherwise("in-store").alias("channel"),
        F.to_date("o_orderdate").alias("ingest_date"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer dimension: id, persona, market segment."""
    seg = F.col("c_mktsegment")
    persona = F.when(seg == "AUTOMOBILE", "A").when(seg == "BUILDING", "B").otherwise("C")
    return _read(spark, sf_dir, "customer").select(
        F.concat(F.lit("CUST-"), F.col("c_custkey").cast("string")).alias("customer_id"),
        persona.alias("persona"),
        seg.alias("market_segment"),
    )
