"""Fixed schemas of the layered tables, and the columns they are partitioned and clustered by."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

ENTITIES = ("transactions", "customers")


def _col(name: str, kind: T.DataType, comment: str) -> T.StructField:
    return T.StructField(name, kind, True, {"comment": comment})


_TEXT, _TS, _DATE, _NUM = T.StringType(), T.TimestampType(), T.DateType(), T.DoubleType()

LINEAGE = T.StructType([
    _col("audit_id", _TEXT, "audit id of the file event"),
    _col("message_id", _TEXT, "raw message the row was read from"),
    _col("entity", _TEXT, "customers or transactions"),
    _col("source_file", _TEXT, "file name"),
    _col("source_path", _TEXT, "file path below the landing folder"),
    _col("publish_time", _TS, "when the message was published"),
])

GOLD_LINEAGE = T.StructType([
    _col("audit_id_transactions", _TEXT, "file event that brought the transaction"),
    _col("audit_id_customers", _TEXT, "file event that brought the customer"),
])

LANDING_EVENTS = T.StructType([
    _col("subscription_name", _TEXT, "landing feed that delivered the message"),
    _col("message_id", _TEXT, "identifier of the message"),
    _col("publish_time", _TS, "when the message was published"),
    _col("data", _TEXT, "JSON array holding the records of the file, as text"),
    _col("attributes", T.MapType(_TEXT, _TEXT), "audit attributes of the file"),
])

CUSTOMERS = T.StructType([
    _col("customer_id", _TEXT, "customer, normalized"),
    _col("customer_name", _TEXT, "full name"),
    _col("customer_email", _TEXT, "e-mail address"),
    _col("_ingested_at", _TS, "when the file was ingested; the row version"),
    _col("_processed_at", _TS, "when the row was last written"),
    _col("_metadata", LINEAGE, "where the current version came from"),
])

TRANSACTIONS = T.StructType([
    _col("transaction_id", _TEXT, "transaction"),
    _col("customer_id", _TEXT, "customer, normalized"),
    _col("transaction_date", _DATE, "day of the transaction"),
    _col("transaction_amount", _NUM, "monetary value"),
    _col("transaction_status", _TEXT, "approved, pending or rejected"),
    _col("transaction_type", _TEXT, "buy or sell"),
    _col("qtty", _NUM, "quantity of items"),
    _col("price", _NUM, "price of one item"),
    _col("_ingested_at", _TS, "when the file was ingested; the row version"),
    _col("_processed_at", _TS, "when the row was last written"),
    _col("_metadata", LINEAGE, "where the current version came from"),
])

GOLD = T.StructType([
    TRANSACTIONS["transaction_id"],
    TRANSACTIONS["customer_id"],
    CUSTOMERS["customer_name"],
    CUSTOMERS["customer_email"],
    *[f for f in TRANSACTIONS.fields[2:10]],
    _col("_metadata", GOLD_LINEAGE, "file events of both sides"),
])

LEDGER = T.StructType([
    _col("message_id", _TEXT, "raw message"),
    _col("audit_id", _TEXT, "audit id of the file event"),
    _col("entity", _TEXT, "customers or transactions"),
    _col("source_path", _TEXT, "file path below the landing folder"),
    _col("outcome", _TEXT, "used, or superseded by a newer file of the same path"),
    _col("processed_at", _TS, "run that consumed the message"),
])

ASIDE = T.StructType([
    _col("path", _TEXT, "full path of the file"),
    _col("source_path", _TEXT, "file path below the landing folder"),
    _col("entity", _TEXT, "customers or transactions, if the path names one"),
    _col("audit_id", _TEXT, "audit id of the file event"),
    _col("modificationTime", _TS, "upload time of the file"),
    _col("length", T.LongType(), "file size in bytes"),
    _col("error", _TEXT, "why the file was set aside"),
    _col("attempts", T.IntegerType(), "how often the file was tried"),
    _col("seen_at", _TS, "when it was set aside"),
])

LANDED_FILES = T.StructType([
    _col("source_path", _TEXT, "file path below the landing folder"),
    _col("audit_id", _TEXT, "audit id of the file event"),
    _col("seen_at", _TS, "when the file was landed or set aside"),
])

MALFORMED = T.StructType([
    _col("entity", _TEXT, "customers or transactions"),
    _col("record", _TEXT, "the record as JSON"),
    _col("audit_id", _TEXT, "audit id of the file event"),
    _col("error", _TEXT, "why the record was set aside"),
    _col("seen_at", _TS, "run that set it aside"),
])


@dataclass(frozen=True)
class Layout:
    """How one table is laid out on storage.

    ``partitions`` maps each partition column to its type and to the SQL expression that derives
    it; ``cluster`` lists the columns rows are sorted by inside each file; ``key`` is what upserts
    look rows up by.
    """

    schema: T.StructType
    partitions: dict[str, tuple[T.DataType, str]] = field(default_factory=dict)
    cluster: tuple[str, ...] = ()
    key: str | None = None

    @property
    def stored(self) -> T.StructType:
        fields = [T.StructField(n, kind) for n, (kind, _) in self.partitions.items()]
        return T.StructType([*self.schema.fields, *fields])


_BY_INGESTED = {"_ingested_date": (_DATE, "to_date(_ingested_at)")}

# The landing stream writes the first three tables in one pass, so they share their partitions.
# The entity partition lets each silver job read only its own payloads.
_BY_SEEN = {"_publish_date": (_DATE, "to_date(seen_at)"), "_entity": (_TEXT, "entity")}

LAYOUTS = {
    "landing_events": Layout(LANDING_EVENTS, {
        "_publish_date": (_DATE, "to_date(publish_time)"),
        "_entity": (_TEXT, "attributes['entity']"),
    }),
    "rejects": Layout(ASIDE, _BY_SEEN),
    "quarantine": Layout(ASIDE, _BY_SEEN),
    "silver_customers": Layout(CUSTOMERS, _BY_INGESTED, ("customer_id",), "customer_id"),
    "silver_transactions": Layout(TRANSACTIONS, _BY_INGESTED, ("transaction_id",),
                                  "transaction_id"),
    "gold_transactions": Layout(
        GOLD, _BY_INGESTED, ("transaction_status", "transaction_type", "customer_id"),
        "transaction_id"),
    "landed_files": Layout(LANDED_FILES),
    "ledger": Layout(LEDGER, {"_entity": (_TEXT, "entity")}),
    "malformed_records": Layout(MALFORMED),
}
