"""The engine's entities, derived lazily from the star-schema tables.

The same derivations are written as SQL in ``oracles.py``. Amounts are decimals here, so that
sums do not depend on the order of addition and both engines give the same digits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import normalize_customer_id

MONEY = "decimal(18,2)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def padded_customer_id(key: str) -> Column:
    """An id of six places or more: ``lpad`` alone would cut the key of the millionth customer."""
    number = F.col(key).cast("string")
    return F.concat(F.lit("C"), F.lpad(number, F.greatest(F.length(number), F.lit(6)), F.lit("0")))


def six_place_customer_id(key: str) -> Column:
    """As the SQL of ``normalize_ids`` and ``land_files`` has it, of longer keys the first six places."""
    return F.concat(F.lit("C"), F.lpad(F.col(key).cast("string"), 6, "0"))


def transaction_id(key: str) -> Column:
    return F.concat(F.lit("T"), F.lpad(F.col(key).cast("string"), 8, "0"))


def _status(code: Column) -> Column:
    return (F.when(code == "F", "approved").when(code == "P", "pending")
            .when(code == "O", "rejected"))


def _side(key: Column) -> Column:
    return F.when(key % 2 == 0, "buy").otherwise("sell")


def customers(spark: SparkSession, sf_dir: str,
              padded: Callable[[str], Column] = padded_customer_id) -> DataFrame:
    """Customers as delivered, with padded ids."""
    return table(spark, sf_dir, "customer").select(
        padded("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("customer_email"),
        "c_nationkey", "c_mktsegment")


def silver_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned customers. The version lies some days after 1995, the file is the segment."""
    return customers(spark, sf_dir).select(
        normalize_customer_id("customer_id").alias("customer_id"),
        "customer_name", "customer_email",
        (F.to_timestamp(F.lit("1995-01-01")) + F.make_interval(days=F.col("c_nationkey") * 90))
        .alias("_ingested_at"),
        F.struct(F.col("c_mktsegment").alias("audit_id")).alias("_metadata"))


def _financial_columns() -> list[Column]:
    return [
        transaction_id("o_orderkey").alias("transaction_id"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("transaction_date"),
        F.col("o_totalprice").cast(MONEY).alias("transaction_amount"),
        _status(F.col("o_orderstatus")).alias("transaction_status"),
        F.col("o_orderdate").cast("timestamp").alias("_ingested_at"),
        F.struct(F.col("o_orderpriority").alias("audit_id")).alias("_metadata")]


def financial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First delivered column set of the transactions."""
    return table(spark, sf_dir, "orders").select(*_financial_columns())


def _line_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
            .agg(F.sum(F.col("l_quantity").cast(MONEY)).alias("qtty"),
                 F.max(F.col("l_extendedprice").cast(MONEY)).alias("price")))


def composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second delivered column set. Transactions without lines have none."""
    return _line_sums(spark, sf_dir).select(
        transaction_id("l_orderkey").alias("transaction_id"),
        _side(F.col("l_orderkey")).alias("transaction_type"), "qtty", "price")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned transactions; quantity and price are NULL where an order has no lines."""
    # Joined on the plain key, which the sums are already partitioned by.
    both = table(spark, sf_dir, "orders").join(
        _line_sums(spark, sf_dir), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return both.select(*_financial_columns(), "qtty", "price",
                       _side(F.col("o_orderkey")).alias("transaction_type"))


def line_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line as a later or earlier version of its transaction."""
    return table(spark, sf_dir, "lineitem").select(
        transaction_id("l_orderkey").alias("transaction_id"),
        F.concat(F.lit("C"), F.col("l_suppkey").cast("string")).alias("customer_id"),
        F.col("l_shipdate").cast("date").alias("transaction_date"),
        F.col("l_extendedprice").cast(MONEY).alias("transaction_amount"),
        F.when(F.col("l_returnflag") == "A", "approved").when(F.col("l_returnflag") == "R",
                                                              "rejected")
        .otherwise("pending").alias("transaction_status"),
        F.when(F.col("l_linestatus") == "F", "buy").otherwise("sell").alias("transaction_type"),
        F.col("l_quantity").cast(MONEY).alias("qtty"),
        F.col("l_extendedprice").cast(MONEY).alias("price"),
        F.col("l_shipdate").cast("timestamp").alias("_ingested_at"),
        F.struct(F.col("l_returnflag").alias("audit_id")).alias("_metadata"),
        "l_linenumber", "l_partkey", "l_suppkey")


# Orders in which lines of one transaction and one ship date count as newer.
LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "transaction_amount")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click events as landing messages of one record each; a user's events are one path."""
    entity = F.when(F.col("event_type").isin("signup", "error"), "customers").otherwise(
        "transactions")
    at = F.col("ts").cast("timestamp")
    path = F.concat(F.lit("entity="), entity, F.lit("/user="), F.col("user_id").cast("string"),
                    F.lit("/events.csv"))
    return table(spark, sf_dir, "events").select(
        F.lit("events").alias("subscription_name"),
        F.col("event_id").cast("string").alias("message_id"),
        at.alias("publish_time"),
        F.concat(F.lit("["), F.col("props"), F.lit("]")).alias("data"),
        F.create_map(
            F.lit("audit_id"), F.concat(F.lit("audit-"), F.col("event_id").cast("string")),
            F.lit("entity"), entity,
            F.lit("source_path"), path,
            F.lit("source_file"), F.lit("events.csv"),
            F.lit("ingested_at"), F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"),
        ).alias("attributes"),
        F.col("event_type"))


def packed_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions as landing messages of one all-text record each, NULL fields left out."""
    t = transactions(spark, sf_dir)
    fields = ["transaction_id", "customer_id", "transaction_date", "transaction_amount",
              "transaction_status", "transaction_type", "qtty", "price"]
    record = F.to_json(F.struct(*[F.col(f).cast("string").alias(f) for f in fields]))
    return t.select(
        F.col("transaction_id").alias("message_id"),
        F.col("_ingested_at").alias("publish_time"),
        F.concat(F.lit("["), record, F.lit("]")).alias("data"),
        F.create_map(
            F.lit("audit_id"), F.col("_metadata.audit_id"),
            F.lit("entity"), F.lit("transactions"),
            F.lit("source_path"), F.concat(F.lit("entity=transactions/"),
                                           F.col("_metadata.audit_id"), F.lit(".csv")),
        ).alias("attributes"))


def order_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as one more version of its customer."""
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("customer_id"),
        F.col("o_orderpriority").alias("customer_name"),
        F.concat(F.lit("order"), F.col("o_orderkey").cast("string")).alias("customer_email"),
        F.col("o_orderdate").cast("timestamp").alias("_ingested_at"), "o_orderkey")
