"""From landing messages to the typed, deduplicated silver tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import (
    empty_to_null,
    normalize_customer_id,
    safe_date,
    safe_double,
    well_formed_customer_id,
)
from tidemark.operators import (
    explode_records,
    new_events,
    newest_messages,
    unreadable,
    watermark,
)
from tidemark.operators.envelope import UNREADABLE
from tidemark.operators.incremental import EPOCH
from tidemark.session import materialized, utc_now
from tidemark.sources.tables import Run, Tables, merge_into

# Message identities up to this many rows (about 200 bytes each) are broadcast.
BROADCAST_MESSAGES = 200_000
# Characters of a message that cannot be read which its report shows.
SHOWN = 1000

CUSTOMER_FIELDS = ("customer_id", "customer_name", "customer_email")
TRANSACTION_FIELDS = (
    "transaction_id", "customer_id", "transaction_date", "transaction_amount",
    "transaction_status", "transaction_type", "qtty", "price")


def _stamped(records: DataFrame, now: datetime) -> DataFrame:
    return records.withColumns({
        "_ingested_at": F.col("ingested_at"),
        "_processed_at": F.lit(now),
        "_metadata": F.struct("audit_id", "message_id", "entity", "source_file", "source_path",
                              "publish_time"),
    })


def clean_customers(records: DataFrame, now: datetime, id_mode: str = "strict") -> DataFrame:
    return _stamped(records, now).select(
        normalize_customer_id("customer_id", id_mode).alias("customer_id"),
        empty_to_null("customer_name").alias("customer_name"),
        empty_to_null("customer_email").alias("customer_email"),
        "_ingested_at", "_processed_at", "_metadata", "uploaded_at")


def clean_transactions(records: DataFrame, now: datetime, id_mode: str = "strict") -> DataFrame:
    return _stamped(records, now).select(
        empty_to_null("transaction_id").alias("transaction_id"),
        normalize_customer_id("customer_id", id_mode).alias("customer_id"),
        safe_date("transaction_date").alias("transaction_date"),
        safe_double("transaction_amount").alias("transaction_amount"),
        empty_to_null("transaction_status").alias("transaction_status"),
        empty_to_null("transaction_type").alias("transaction_type"),
        safe_double("qtty").alias("qtty"),
        safe_double("price").alias("price"),
        "_ingested_at", "_processed_at", "_metadata", "uploaded_at")


CLEANERS: dict[str, tuple[str, tuple[str, ...], Callable[..., DataFrame]]] = {
    "customers": ("customer_id", CUSTOMER_FIELDS, clean_customers),
    "transactions": ("transaction_id", TRANSACTION_FIELDS, clean_transactions),
}

# Which of two rows with one key and one ingestion time is newer. Files landed together share
# that time; the later upload wins, as it would if the files were processed one by one.
UPLOAD_ORDER = ("_metadata.publish_time", "uploaded_at", "_metadata.source_path",
                "_metadata.audit_id")


def _malformed(records: DataFrame, fields: tuple[str, ...], now: datetime) -> DataFrame:
    return records.filter(~well_formed_customer_id("customer_id")).select(
        "entity", F.to_json(F.struct(*fields)).alias("record"), "audit_id",
        F.lit("malformed customer id").alias("error"), F.lit(now).alias("seen_at"))


def _with_use(run: Run, events: DataFrame, newest: DataFrame, messages: int, alone: bool,
              identity: tuple[str, ...]) -> DataFrame:
    """``events`` with ``_used``, whether they are among the newest messages. Payloads are not
    shuffled for it if that can be avoided.

    If no path sent a file twice, all are used. Few messages are told by a broadcast of their
    identities. Among many, those to leave out are usually few. Only if both are many, messages are
    shuffled, evenly, by identity.
    """
    if alone:
        return events.withColumn("_used", F.lit(True))
    newest = newest.select(*identity)
    if messages <= BROADCAST_MESSAGES:
        few, used = F.broadcast(newest), F.col("_told").isNotNull()
    else:
        older = materialized(events.select(*identity).join(newest, list(identity), "left_anti"),
                             run.scratch("older"))
        if older.count() <= BROADCAST_MESSAGES:
            few, used = F.broadcast(older), F.col("_told").isNull()
        else:
            few, used = newest, F.col("_told").isNotNull()
    told = few.withColumn("_told", F.lit(True))
    return events.join(told, list(identity), "left").withColumn("_used", used).drop("_told")


def _consumed(marked: DataFrame, now: datetime) -> DataFrame:
    """A ledger line for every message this run has taken into account."""
    return marked.select(
        "message_id", "audit_id", "entity", "source_path",
        F.when(F.col("_used"), "used").otherwise("superseded").alias("outcome"),
        F.lit(now).alias("processed_at"))


def _refresh(tables: Tables, entity: str, now: datetime | None, mark: datetime | None,
             id_mode: str, on_duplicate: str) -> int:
    now = now or utc_now()
    key, fields, clean = CLEANERS[entity]
    silver = f"silver_{entity}"
    if mark is None:
        mark = watermark(tables.read(silver), "_metadata.publish_time", now)
    events = new_events(tables.read("landing_events", with_files=True), entity, mark)
    identity = ("_file", "_row")
    with tables.run() as run:
        newest = materialized(newest_messages(events.drop("data"), identity, alone="_alone"),
                              run.scratch("newest"))
        found = newest.agg(F.count(F.lit(1)).alias("messages"),
                           F.bool_and("_alone").alias("alone")).first()
        if not found["messages"]:
            return 0
        marked = _with_use(run, events, newest, found["messages"], found["alone"], identity)
        picked = marked.filter("_used").drop("_used")
        # one message that cannot be read must not stop all others
        broken = unreadable(picked, fields)
        run.add("malformed_records", broken.select(
            "entity", F.left("data", F.lit(SHOWN)).alias("record"), "audit_id",
            F.lit(UNREADABLE).alias("error"), F.lit(now).alias("seen_at")))
        records = explode_records(picked, fields, skip_unreadable=True)
        if id_mode == "quarantine":
            run.add("malformed_records", _malformed(records, fields, now))
            records = records.filter(well_formed_customer_id("customer_id"))
        rows = merge_into(run, silver, clean(records, now, id_mode), key,
                          newer=[F.col(c) for c in UPLOAD_ORDER], on_duplicate=on_duplicate)
        # of one entity, so that rebalancing by it would bring all lines to few tasks
        run.add("ledger", _consumed(marked, now), rebalance=False)
    return rows


def refresh_silver_customers(tables: Tables, now: datetime | None = None,
                             mark: datetime | None = None, id_mode: str = "strict",
                             on_duplicate: str = "error") -> int:
    """Upsert the customers of all new messages; returns the number of rows considered.

    The rows, the ledger of consumed messages and any malformed records take effect together.
    """
    return _refresh(tables, "customers", now, mark, id_mode, on_duplicate)


def refresh_silver_transactions(tables: Tables, now: datetime | None = None,
                                mark: datetime | None = None, id_mode: str = "strict",
                                on_duplicate: str = "error") -> int:
    """Upsert the transactions of all new messages; returns the number of rows considered."""
    return _refresh(tables, "transactions", now, mark, id_mode, on_duplicate)


def rebuild(tables: Tables, entity: str, now: datetime | None = None,
            id_mode: str = "strict", on_duplicate: str = "error",
            since: datetime | None = None) -> int:
    """Read an entity's raw messages again, from the beginning or those published ``since``."""
    mark = EPOCH if since is None else since - timedelta(microseconds=1)
    return _refresh(tables, entity, now, mark, id_mode, on_duplicate)


def withdraw(tables: Tables, entity: str, since: datetime, now: datetime | None = None,
             id_mode: str = "strict", on_duplicate: str = "error") -> int:
    """Replay that also takes back rows whose message is gone from raw; returns how many it took.

    Of the messages published ``since``, those that raw no longer holds are found by their audit ids,
    pruned to the raw partitions from then on, without payloads. Their rows leave silver, and the
    versions that they had replaced come back from all older messages of raw.
    """
    silver, key = f"silver_{entity}", CLEANERS[entity][0]
    rows = tables.read(silver, with_files=True)
    raw = new_events(tables.read("landing_events"), entity, since - timedelta(microseconds=1))
    mine = rows.filter((F.col("_metadata.publish_time") >= F.lit(since))
                       & (F.col("_ingested_date") >= F.lit(since.date())))
    mine = mine.withColumn("_audit", F.col("_metadata.audit_id"))
    there = raw.select(F.col("audit_id").alias("_audit")).distinct()
    with tables.run() as run:
        gone = materialized(mine.join(there, "_audit", "left_anti").select(
            F.col(key).alias("_gone"), "_file", "_row"), run.scratch("gone"))
        count = gone.count()
        if not count:
            return 0
        touched = [r[0] for r in gone.select("_file").distinct().collect()]
        kept = rows.join(F.broadcast(gone.select("_file").distinct()), "_file", "left_semi").join(
            gone.select("_file", "_row"), ["_file", "_row"], "left_anti").drop("_file", "_row")
        run.add(silver, kept)
        run.drop(silver, touched)
    rebuild(tables, entity, now, id_mode, on_duplicate)
    return count
