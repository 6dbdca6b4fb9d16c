"""Transactions with the name and e-mail of their customer."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich(transactions: DataFrame, customers: DataFrame, mark: datetime,
           now: datetime) -> DataFrame:
    """Left join of the transactions ingested after the mark to the customers.

    Which side is broadcast, and the split of hot customers, is left to adaptive execution.
    """
    recent = transactions.filter(F.col("_ingested_at") > F.lit(mark))
    if "_ingested_date" in transactions.columns:
        recent = recent.filter(F.col("_ingested_date") >= F.lit(mark.date()))
    who = customers.select(
        "customer_id", "customer_name", "customer_email",
        F.col("_metadata.audit_id").alias("_audit_customers"))
    return recent.join(who, "customer_id", "left").select(
        "transaction_id", "customer_id", "customer_name", "customer_email", "transaction_date",
        "transaction_amount", "transaction_status", "transaction_type", "qtty", "price",
        "_ingested_at", F.lit(now).alias("_processed_at"),
        F.struct(F.col("_metadata.audit_id").alias("audit_id_transactions"),
                 F.col("_audit_customers").alias("audit_id_customers")).alias("_metadata"))
