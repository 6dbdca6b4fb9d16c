"""Aggregate expressions shared by the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STATUSES = ("approved", "pending", "rejected")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL for a zero denominator. Always a double."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def amount_where(status: str, amount: str = "transaction_amount",
                 status_col: str = "transaction_status") -> Column:
    """Sum of the amounts of one status. Rows of other statuses, or of none, add zero."""
    return F.sum(F.when(F.col(status_col) == status, F.col(amount)).otherwise(F.lit(0)))


def status_breakdown(amount: str = "transaction_amount",
                     status_col: str = "transaction_status") -> list[Column]:
    """Row counts and amounts, in total and by status."""
    counts = [F.count_if(F.col(status_col) == s).alias(f"total_{s}") for s in STATUSES]
    amounts = [amount_where(s, amount, status_col).cast("double").alias(f"amount_{s}")
               for s in STATUSES]
    return [
        F.count(F.lit(1)).alias("total"), *counts,
        F.sum(amount).cast("double").alias("amount_total"), *amounts,
    ]
