"""Reports on what came in, what was set aside, and where rows came from."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import watermark
from tidemark.operators.reconcile import missing_rows
from tidemark.schemas import ENTITIES
from tidemark.session import utc_now
from tidemark.sources.tables import Tables

KEPT_DAYS = 7  # how long a file that could not be read stays in the quarantine report


def _records() -> Column:
    """Records of a message: as counted at landing, or else counted in its payload."""
    known = F.col("attributes")["records"]
    return F.coalesce(known.cast("long"), F.when(known.isNull(), F.json_array_length("data")),
                      F.lit(0))


def ingest_report(raw: DataFrame) -> DataFrame:
    """Records per ingested file."""
    a = F.col("attributes")
    records = _records()
    return (raw.groupBy(a["audit_id"].alias("audit_id"), a["entity"].alias("entity"),
                        a["source_path"].alias("source_path"))
            .agg(F.sum(records).alias("records")))


def ingest_rejects(rejects: DataFrame) -> DataFrame:
    """Files that belong to no known entity."""
    return rejects.select("path", "source_path", "length", "modificationTime", "error", "seen_at")


def quarantine(aside: DataFrame, now: datetime, days: int = KEPT_DAYS) -> DataFrame:
    """Files that could not be read in the last days: their latest error and their attempts."""
    return (aside.filter(F.col("seen_at") >= F.lit(now - timedelta(days=days)))
            .groupBy("path", "source_path", "audit_id")
            .agg(F.max("attempts").alias("attempts"), F.max("seen_at").alias("seen_at"),
                 F.max_by("error", "seen_at").alias("error")))


def trace_layers(raw: DataFrame, customers: DataFrame, transactions: DataFrame, gold: DataFrame,
                 audit_id: str | None = None) -> DataFrame:
    """Rows per layer that trace back to a file event, or to each of them.

    Silver and gold count rows whose current version came from the file.
    """

    def rows(df: DataFrame, layer: str, found: str, count=None) -> DataFrame:
        own = df.select(F.expr(found).alias("audit_id"),
                        (F.lit(1) if count is None else count).alias("n"))
        own = own.filter(F.col("audit_id").isNotNull() if audit_id is None
                         else F.col("audit_id") == audit_id)
        return (own.groupBy("audit_id").agg(F.sum("n").alias("rows"))
                .select("audit_id", F.lit(layer).alias("layer"), "rows"))

    records = _records()
    return (rows(raw, "landing_events", "attributes['audit_id']", records)
            .unionByName(rows(customers, "silver_customers", "_metadata.audit_id"))
            .unionByName(rows(transactions, "silver_transactions", "_metadata.audit_id"))
            .unionByName(rows(gold, "gold_transactions", "_metadata.audit_id_transactions"))
            .unionByName(rows(gold, "gold_transactions_by_customer",
                              "_metadata.audit_id_customers")))


def audit_trace(tables: Tables, audit_id: str | None = None) -> DataFrame:
    raw = tables.read("landing_events")
    if audit_id is not None:
        # Find the partition first, without the payloads; then read the payloads of that one.
        parts = (raw.filter(F.col("attributes")["audit_id"] == audit_id)
                 .select("_publish_date", "_entity").distinct().collect())
        raw = raw.filter(F.col("_publish_date").isin([p["_publish_date"] for p in parts])
                         & F.col("_entity").isin([p["_entity"] for p in parts]))
    others = [tables.read(t) for t in (
        "silver_customers", "silver_transactions", "gold_transactions")]
    return trace_layers(raw, *others, audit_id=audit_id)


def late_rows(raw: DataFrame, ledger: DataFrame, entity: str, mark: datetime) -> DataFrame:
    """Messages at or below the mark that no run has consumed, so none will."""
    a = F.col("attributes")
    below = raw.filter((F.col("publish_time") <= F.lit(mark)) & (a["entity"] == entity))
    if "_publish_date" in raw.columns:
        below = below.filter((F.col("_publish_date") <= F.lit(mark.date()))
                             & (F.col("_entity") == entity))
    consumed = ledger.filter(F.col("entity") == entity).select("message_id")
    return (below.select("message_id", a["audit_id"].alias("audit_id"),
                         a["entity"].alias("entity"), a["source_path"].alias("source_path"),
                         "publish_time")
            .join(consumed, "message_id", "left_anti"))


def late_gold_rows(tables: Tables, now: datetime | None = None) -> DataFrame:
    """Silver transactions at or below gold's mark whose version gold does not have.

    Gold takes what is ingested after its mark, so a file that reached silver late, with an earlier
    ingestion time, never gets there by itself; ``gold.promote_late`` brings it. Rows are the same
    by id and version; those without an id, by version alone.
    """
    gold = tables.read("gold_transactions")
    mark = F.lit(watermark(gold, "_ingested_at", now or utc_now()))
    below = tables.read("silver_transactions").filter(
        (F.col("_ingested_at") <= mark) & (F.col("_ingested_date") <= F.to_date(mark)))
    return missing_rows(below, gold, ["transaction_id", "_ingested_at"], "_ingested_date")


def late_events(tables: Tables, now: datetime | None = None) -> DataFrame:
    now = now or utc_now()
    raw, ledger = tables.read("landing_events"), tables.read("ledger")
    late = [late_rows(raw, ledger, entity, watermark(
        tables.read(f"silver_{entity}"), "_metadata.publish_time", now)) for entity in ENTITIES]
    return late[0].unionByName(late[1])
