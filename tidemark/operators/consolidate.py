"""One transactions file out of the two that carry its columns."""

from __future__ import annotations

from pyspark.sql import DataFrame


def consolidate(financial: DataFrame, composition: DataFrame) -> DataFrame:
    """Join both column sets on the transaction and order the rows as the file is delivered."""
    return (financial.join(composition, "transaction_id", "inner")
            .orderBy("transaction_status", "customer_id", "transaction_id"))
