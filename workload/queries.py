"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import functions as fn
from tidemark import operators as op
from tidemark.operators.incremental import EPOCH
from tidemark.plans import gold as gold_plan
from tidemark.plans import lineage, reports, silver, views
from tidemark.plans.medallion import refresh_all
from tidemark.session import materialized, new_folder
from tidemark.sources import parse_files
from tidemark.sources.csv_files import as_messages
from tidemark.sources.large_files import parse_large_files
from tidemark.schemas import LAYOUTS
from tidemark.sources.tables import Tables, merge_into, replace_all
from tidemark.streaming.landing import (
    land_batch,
    outcomes_of,
    retry_quarantined,
    start_landing,
)
from workload import entities as e

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DAY = "year=2026/month=03/day=25"
NOW = datetime(2026, 3, 25, 12, tzinfo=UTC)
STATE_OF = datetime(2024, 1, 20, 12, tzinfo=UTC)


def query(run: Query) -> Query:
    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return run(spark, sf_dir)

    QUERIES[run.__name__] = prepared
    return prepared


def _plain_time(*columns: str) -> dict:
    return {c: F.col(c).cast("timestamp_ntz") for c in columns}


# Reports

@query
def monthly_ttm(spark, sf_dir):
    return reports.monthly_ttm(e.financial(spark, sf_dir))


@query
def customers_last_quarter(spark, sf_dir):
    named = op.enrich(e.transactions(spark, sf_dir), e.silver_customers(spark, sf_dir), EPOCH, NOW)
    return reports.customers_last_quarter(named)


@query
def first_transactions(spark, sf_dir):
    return reports.first_transactions(e.transactions(spark, sf_dir)).select(
        "customer_id", "transaction_date", "transaction_id", "is_buy")


@query
def later_buys(spark, sf_dir):
    buys = reports.later_buys(e.transactions(spark, sf_dir))
    return buys.withColumns({c: F.col(c).cast("double") for c in ("qtty", "price")})


@query
def running_avg_price(spark, sf_dir):
    return reports.running_avg_price(e.transactions(spark, sf_dir)).select(
        "transaction_date", "transaction_id", F.col("qtty").cast("double").alias("qtty"),
        F.col("total_cost").cast("double").alias("total_cost"), "running_avg_price")


@query
def daily_avg_price(spark, sf_dir):
    return reports.daily_avg_price(e.transactions(spark, sf_dir))


@query
def current_avg_price(spark, sf_dir):
    return reports.current_avg_price(e.transactions(spark, sf_dir))


# Cleaning

@query
def normalize_ids(spark, sf_dir):
    fn.register_sql_functions(spark)
    return e.customers(spark, sf_dir, e.six_place_customer_id).select(
        "customer_id",
        fn.normalize_customer_id("customer_id").alias("normalized"),
        F.expr("func_normalize_customer_id(customer_id)").alias("normalized_in_sql"),
        fn.well_formed_customer_id("customer_name").alias("name_would_do"))


@query
def safe_casts(spark, sf_dir):
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    texts = e.table(spark, sf_dir, "lineitem").select(
        *keys, "l_returnflag", F.date_format("l_shipdate", "yyyy-MM-dd").alias("day_text"),
        F.col("l_extendedprice").cast("string").alias("number_text"))
    day, number = F.col("day_text"), F.col("number_text")
    return texts.select(
        *keys,
        fn.safe_date(day).alias("day"),
        fn.safe_date(F.substr(day, F.lit(1), F.lit(4))).alias("year_only"),
        fn.safe_date(F.concat(F.substr(day, F.lit(1), F.lit(8)), F.lit("31"))).alias("day_31"),
        fn.safe_date("l_returnflag").alias("flag_as_day"),
        fn.safe_double(number).alias("number"),
        fn.safe_double(F.concat(number, F.lit("d"))).alias("suffixed"),
        fn.safe_double(F.translate(number, ".", ",")).alias("decimal_comma"),
        fn.safe_timestamp(F.concat(day, F.lit("T12:30:00.123456+00:00")))
        .cast("timestamp_ntz").alias("instant"),
        fn.safe_timestamp(F.substr(day, F.lit(1), F.lit(4)))
        .cast("timestamp_ntz").alias("year_as_instant"),
        fn.empty_to_null(F.regexp_replace("l_returnflag", "N", "")).alias("flag"))


@query
def extract_records(spark, sf_dir):
    events = op.new_events(e.messages(spark, sf_dir), "transactions", EPOCH)
    return op.explode_records(events, ["k", "missing"]).select(
        "message_id", "entity", "source_path", "k", "missing")


@query
def extract_foreign_records(spark, sf_dir):
    """The same from messages with nested values, which give NULL."""
    messages = e.messages(spark, sf_dir)
    nested = F.concat(F.lit('[{"outer": '), F.col("data"), F.lit(', "kind": "'),
                      F.col("event_type"), F.lit('"}]'))
    return op.explode_records(
        messages.select("message_id", nested.alias("data")), ["outer", "kind"], foreign=True)


@query
def extract_odd_payloads(spark, sf_dir):
    """Documents as messages that begin with a line break or a tab and hold one element that is no
    object, read as the landing stream's own messages and as those of other producers."""
    documents = e.table(spark, sf_dir, "documents")
    record = F.to_json(F.struct("doc_id", "text"))
    messages = documents.select("doc_id", F.concat(
        F.when(F.col("doc_id") % 2 == 0, "\n\t[").otherwise("\r\n ["), record, F.lit(" , 1 ]"))
        .alias("data")).withColumnRenamed("doc_id", "message")
    both = [op.explode_records(messages, ["doc_id", "text"], foreign=foreign)
            .withColumn("foreign", F.lit(foreign)) for foreign in (False, True)]
    return both[0].unionByName(both[1]).select(
        "message", "foreign", "doc_id", F.md5("text").alias("text_md5"))


@query
def clean_records(spark, sf_dir):
    """Records of packed messages, typed by the silver job's own projection."""
    events = op.new_events(e.packed_transactions(spark, sf_dir), "transactions", EPOCH)
    records = op.explode_records(events, silver.TRANSACTION_FIELDS)
    return silver.clean_transactions(records, NOW).select(
        *silver.TRANSACTION_FIELDS, F.col("_metadata.audit_id").alias("audit_id"),
        F.col("_metadata.message_id").alias("message_id"))


# Incremental reads

@query
def latest_per_path(spark, sf_dir):
    everything = op.new_events(e.messages(spark, sf_dir), "customers", EPOCH)
    return op.latest_per_path(everything).select(
        "source_path", "message_id", "data", F.col("ingested_at").cast("timestamp_ntz")
        .alias("ingested_at"))


def _silver_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the silver job had consumed by ``STATE_OF``."""
    done = e.messages(spark, sf_dir).filter(F.col("publish_time") <= F.lit(STATE_OF))
    return done.filter(F.col("attributes")["entity"] == "customers").select(
        F.col("publish_time").alias("_ingested_at"),
        F.struct("publish_time").alias("_metadata"))


def _increment(spark: SparkSession, sf_dir: str, now: datetime) -> DataFrame:
    mark = op.watermark(_silver_as_of(spark, sf_dir), "_metadata.publish_time", now)
    events = op.new_events(e.messages(spark, sf_dir), "customers", mark)
    return events.select("message_id", "entity", "source_path", "audit_id", "source_file",
                         "publish_time", "data").withColumns(_plain_time("publish_time"))


@query
def incremental_events(spark, sf_dir):
    return _increment(spark, sf_dir, datetime(2024, 1, 21, tzinfo=UTC))


@query
def incremental_after_idle(spark, sf_dir):
    """More than a week after the last row, everything is read again."""
    return _increment(spark, sf_dir, datetime(2024, 3, 1, tzinfo=UTC))


@query
def gold_enrich(spark, sf_dir):
    named = op.enrich(e.transactions(spark, sf_dir), e.silver_customers(spark, sf_dir), EPOCH, NOW)
    return named.select(
        "transaction_id", "customer_id", "customer_name", "customer_email", "transaction_date",
        F.col("transaction_amount").cast("double").alias("transaction_amount"),
        "transaction_status", "transaction_type", F.col("qtty").cast("double").alias("qtty"),
        F.col("price").cast("double").alias("price"),
        F.col("_ingested_at").cast("timestamp_ntz").alias("_ingested_at"),
        "_metadata.audit_id_transactions", "_metadata.audit_id_customers")


@query
def gold_increment(spark, sf_dir):
    """The transactions above the mark of a gold table that was last refreshed in 1998."""
    moves = e.transactions(spark, sf_dir)
    refreshed = datetime(1998, 7, 1, tzinfo=UTC)
    in_gold = moves.filter(F.col("_ingested_at") <= F.lit(refreshed))
    mark = op.watermark(in_gold, "_ingested_at", refreshed)
    fresh = op.enrich(moves, e.silver_customers(spark, sf_dir), mark, NOW)
    return fresh.select("transaction_id", "customer_id", "customer_name", "transaction_date",
                        "_metadata.audit_id_transactions", "_metadata.audit_id_customers")


# Upserts

@query
def upsert_customers(spark, sf_dir):
    """Customers, updated by each of their orders as one more version."""
    target = e.silver_customers(spark, sf_dir).select(
        "customer_id", "customer_name", "customer_email", "_ingested_at")
    source = e.order_versions(spark, sf_dir)
    return op.upsert(target, source, "customer_id", newer=[F.col("o_orderkey")]).withColumns(
        _plain_time("_ingested_at"))


def _flat(df: DataFrame) -> DataFrame:
    money = ("transaction_amount", "qtty", "price")
    return df.withColumns({**{c: F.col(c).cast("double") for c in money if c in df.columns},
                           **_plain_time("_ingested_at")})


@query
def upsert_transactions(spark, sf_dir):
    """Transactions, updated by each of their order lines as one more version."""
    columns = ["transaction_id", "customer_id", "transaction_date", "transaction_amount",
               "transaction_status", "transaction_type", "qtty", "price", "_ingested_at"]
    target = e.transactions(spark, sf_dir).select(*columns)
    source = e.line_versions(spark, sf_dir)
    return _flat(op.upsert(target, source, "transaction_id",
                           newer=[F.col(c) for c in e.LINE_ORDER]))


@query
def upsert_gold(spark, sf_dir):
    """Enriched transactions, updated by the enriched newest lines."""
    who = e.silver_customers(spark, sf_dir)
    target = op.enrich(e.transactions(spark, sf_dir), who, EPOCH, NOW)
    newest = op.newest_per_key(e.line_versions(spark, sf_dir), "transaction_id",
                               newer=[F.col(c) for c in e.LINE_ORDER])
    source = op.enrich(newest, who, EPOCH, NOW)
    return _flat(op.upsert(target, source, "transaction_id")).select(
        "transaction_id", "customer_id", "customer_name", "transaction_date",
        "transaction_amount", "transaction_status", "transaction_type", "qtty", "price",
        "_ingested_at", "_metadata.audit_id_transactions", "_metadata.audit_id_customers")


@query
def consolidate(spark, sf_dir):
    first = e.financial(spark, sf_dir).drop("_ingested_at", "_metadata")
    whole = op.consolidate(first, e.composition(spark, sf_dir))
    return whole.withColumns({c: F.col(c).cast("double")
                              for c in ("transaction_amount", "qtty", "price")})


# Lineage

@query
def ingest_report(spark, sf_dir):
    return lineage.ingest_report(e.packed_transactions(spark, sf_dir))


@query
def discover_fields(spark, sf_dir):
    return op.discover_fields(e.packed_transactions(spark, sf_dir))


@query
def audit_trace(spark, sf_dir):
    who, moves = e.silver_customers(spark, sf_dir), e.transactions(spark, sf_dir)
    return lineage.trace_layers(
        e.packed_transactions(spark, sf_dir), who, moves, op.enrich(moves, who, EPOCH, NOW))


@query
def late_events(spark, sf_dir):
    """Messages below the mark that the ledger does not know: here, those of type error."""
    messages = e.messages(spark, sf_dir)
    ledger = messages.filter(F.col("event_type") != "error").select(
        "message_id", F.col("attributes")["entity"].alias("entity"))
    mark = op.watermark(_silver_as_of(spark, sf_dir), "_metadata.publish_time", STATE_OF)
    late = lineage.late_rows(messages, ledger, "customers", mark)
    return late.withColumns(_plain_time("publish_time"))


# Landing and the table jobs. The queries write CSV files out of the given tables first.

def _deliver(df: DataFrame, folder: str, **options) -> None:
    (df.write.mode("append").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .options(**options).csv(folder))


def _customer_file(spark, sf_dir, padded=e.padded_customer_id) -> DataFrame:
    return e.customers(spark, sf_dir, padded).select(
        "customer_id", "customer_name", "customer_email")


def _transaction_file(spark, sf_dir) -> DataFrame:
    return e.transactions(spark, sf_dir).select(
        "price", "qtty", "transaction_type", "transaction_id", "customer_id", "transaction_date",
        "transaction_amount", "transaction_status")


def _delivered(spark, sf_dir, label: str, padded=e.padded_customer_id) -> tuple[str, Tables]:
    """A landing folder with both files, and empty tables beside it."""
    base = new_folder(spark, label)
    _deliver(_customer_file(spark, sf_dir, padded), f"{base}/landing/entity=customers/{DAY}")
    _deliver(_transaction_file(spark, sf_dir), f"{base}/landing/entity=transactions/{DAY}")
    return base, Tables(spark, f"{base}/tables")


def _land(spark, base: str, tables: Tables, after=None) -> None:
    start_landing(spark, f"{base}/landing", tables, f"{base}/stream",
                  after_batch=after).awaitTermination()


@query
def land_files(spark, sf_dir):
    """Stream both files into raw and read their records back as text."""
    base, tables = _delivered(spark, sf_dir, "land", e.six_place_customer_id)
    _land(spark, base, tables)
    events = op.new_events(tables.read("landing_events"), "transactions", EPOCH)
    people = op.new_events(tables.read("landing_events"), "customers", EPOCH)
    fields = ["transaction_id", "customer_id", "transaction_date", "transaction_amount",
              "customer_name", "customer_email"]
    both = op.explode_records(events, fields).unionByName(op.explode_records(people, fields))
    return both.select("entity", *fields, F.regexp_extract(
        "source_path", r"^(.*/)[^/]*$", 1).alias("folder"))


@query
def land_quoted_text(spark, sf_dir):
    """Web pages as CSV fields with quotes and line breaks, each file parsed by one task."""
    folder = new_folder(spark, "pages")
    _deliver(e.table(spark, sf_dir, "pages"), f"{folder}/landing")
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
             .load(f"{folder}/landing"))
    return _pages(as_messages(parse_files(files), folder, F.lit(NOW)))


@query
def land_large_files(spark, sf_dir):
    """The same files, cut into byte ranges as files too large for one task are."""
    folder = new_folder(spark, "pages")
    _deliver(e.table(spark, sf_dir, "pages"), f"{folder}/landing")
    paths = [r["path"] for r in spark.read.format("binaryFile")
             .option("pathGlobFilter", "*.csv").load(f"{folder}/landing").select("path").collect()]
    chunks = parse_large_files(spark, paths, chunk_bytes=64 * 1024)
    return _pages(as_messages(chunks, folder, F.lit(NOW)))


def _pages(messages: DataFrame) -> DataFrame:
    return op.explode_records(messages.select("data"), ["page_id", "url", "html"]).select(
        F.col("page_id").cast("bigint").alias("page_id"), "url",
        F.length("html").alias("characters"), F.md5("html").alias("html_md5"))


def _landed_once(spark, base: str, tables: Tables) -> None:
    root = tables.storage.qualified(f"{base}/landing")
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.csv").load(root))
    land_batch(tables, root, outcomes_of(files, root, F.lit(NOW)), "once", NOW)


@query
def ingest_rejects(spark, sf_dir):
    """Files below folders that name no entity, here a folder for each order status with a file for
    each month."""
    base = new_folder(spark, "rejects")
    orders = e.table(spark, sf_dir, "orders").withColumnRenamed("o_orderstatus", "entity")
    orders = orders.withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    (orders.repartition("entity", "month").write.partitionBy("entity", "month")
     .option("header", True).csv(f"{base}/landing"))
    tables = Tables(spark, f"{base}/tables")
    _landed_once(spark, base, tables)
    return lineage.ingest_rejects(tables.read("rejects")).groupBy(
        F.regexp_extract("source_path", "^([^/]*)/", 1).alias("folder"), "error").agg(
        F.count_distinct("source_path").alias("files"), F.count("*").alias("reports"))


@query
def quarantine(spark, sf_dir):
    """Files that are not UTF-8, here a folder for each market segment with a file a nation."""
    return _quarantined(_unreadable_files(spark, sf_dir)[1], NOW)


@query
def retry_quarantine(spark, sf_dir):
    """The same files after two more attempts to read them."""
    base, tables = _unreadable_files(spark, sf_dir)
    for hour in (1, 2):
        retry_quarantined(tables, f"{base}/landing", NOW + timedelta(hours=hour))
    return _quarantined(tables, NOW + timedelta(hours=2))


def _unreadable_files(spark, sf_dir) -> tuple[str, Tables]:
    base = new_folder(spark, "quarantine")
    people = e.table(spark, sf_dir, "customer").withColumns(
        {"entity": F.lit("customers"), "nation": F.col("c_nationkey")})
    split = ["entity", "c_mktsegment", "nation"]
    (people.repartition(*split).write.partitionBy(*split).option("header", True)
     .option("encoding", "UTF-16").csv(f"{base}/landing"))
    tables = Tables(spark, f"{base}/tables")
    _landed_once(spark, base, tables)
    return base, tables


def _quarantined(tables: Tables, now: datetime) -> DataFrame:
    return lineage.quarantine(tables.read("quarantine"), now).select(
        F.regexp_extract("source_path", "c_mktsegment=([^/]*)/", 1).alias("segment"),
        F.regexp_extract("source_path", "nation=([^/]*)/", 1).cast("int").alias("nation"),
        F.substring_index("error", ":", 1).alias("error"), "attempts")


def _gold_rows(tables: Tables) -> DataFrame:
    return tables.read("gold_transactions").select(
        "transaction_id", "customer_id", "customer_name", "customer_email", "transaction_date",
        "transaction_amount", "transaction_status", "transaction_type", "qtty", "price")


@query
def medallion_run(spark, sf_dir):
    """From CSV files to gold, and a second run that must change nothing."""
    base, tables = _delivered(spark, sf_dir, "medallion")
    _land(spark, base, tables, after=refresh_all)
    refresh_all(tables)
    return _gold_rows(tables)


def _stored_view(spark, sf_dir, view: str) -> DataFrame:
    """A view that was registered before half of the transactions came and gold was rewritten.

    Gold stores doubles, whose sums depend on the order of rows. They are given in thousandths,
    cut off at places that no ratio of such amounts falls on.
    """
    base = new_folder(spark, "views")
    tables = Tables(spark, f"{base}/tables")
    _deliver(_customer_file(spark, sf_dir), f"{base}/landing/entity=customers/{DAY}")
    moves, even = _transaction_file(spark, sf_dir), F.crc32("transaction_id") % 2 == 0
    _deliver(moves.filter(even), f"{base}/landing/entity=transactions/{DAY}")
    _land(spark, base, tables, after=refresh_all)
    views.register_views(tables)
    _deliver(moves.filter(~even), f"{base}/landing/entity=transactions/{DAY}")
    _land(spark, base, tables, after=refresh_all)
    gold_plan.refresh_gold_full(tables)
    found = spark.table(view)
    return found.withColumns({f.name: F.floor(F.col(f.name) * 1000 + 0.123456789)
                              for f in found.schema if f.dataType.typeName() == "double"})


@query
def gold_views(spark, sf_dir):
    """The monthly view over the stored gold table, all columns."""
    return _stored_view(spark, sf_dir, "transactions_monthly_ttm_vw")


@query
def gold_view_last_quarter(spark, sf_dir):
    return _stored_view(spark, sf_dir, "transactions_customers_last_quarter_vw")


@query
def gold_view_daily(spark, sf_dir):
    return _stored_view(spark, sf_dir, "transactions_daily_avg_price_vw")


@query
def merge_customers(spark, sf_dir):
    """The upsert that the jobs run, twice on a stored table, with rows that are replaced."""
    tables = Tables(spark, f"{new_folder(spark, 'merge')}/tables")

    def stored(rows: DataFrame) -> DataFrame:
        lineage_type = LAYOUTS["silver_customers"].schema["_metadata"].dataType
        return rows.withColumns({"_processed_at": F.lit(NOW),
                                 "_metadata": F.lit(None).cast(lineage_type)})

    with tables.run() as run:
        run.add("silver_customers", stored(e.silver_customers(spark, sf_dir)))
    source = stored(e.order_versions(spark, sf_dir))
    for _ in range(2):
        with tables.run() as run:
            merge_into(run, "silver_customers", source, "customer_id",
                       newer=[F.col("o_orderkey")])
    return tables.read("silver_customers").select(
        "customer_id", "customer_name", "customer_email", "_ingested_at").withColumns(
        _plain_time("_ingested_at"))


@query
def land_audit(spark, sf_dir):
    """Audit attributes and message data of each landed file, beside its silver rows."""
    base, tables = _delivered(spark, sf_dir, "audit")
    _land(spark, base, tables, after=refresh_all)
    a, raw = F.col("attributes"), tables.read("landing_events")
    silver_rows = tables.read("silver_customers").select("_metadata.audit_id").unionAll(
        tables.read("silver_transactions").select("_metadata.audit_id"))
    files = raw.select(
        a["entity"].alias("entity"), a["audit_id"].alias("audit_id"),
        a["records"].cast("long").alias("records"),
        (a["source_path"].endswith(a["source_file"]) & a["source_file"].endswith(".csv")
         & (F.length(a["audit_id"]) == 64) & F.col("message_id").startswith(a["audit_id"])
         & (a["ingested_at"].cast("timestamp") == F.col("publish_time"))).alias("well_formed"))
    # a large file has several messages
    files = files.groupBy("entity", "audit_id").agg(
        F.sum("records").alias("records"), F.bool_and("well_formed").alias("well_formed"))
    rows = silver_rows.groupBy("audit_id").agg(F.count("*").alias("rows"))
    return files.join(rows, "audit_id", "left").groupBy("entity").agg(
        F.sum("records").alias("records"), F.sum("rows").alias("rows"),
        F.bool_and("well_formed").alias("well_formed"))


@query
def rebuild(spark, sf_dir):
    """Silver transactions read again from raw, on top of what is there."""
    base, tables = _delivered(spark, sf_dir, "rebuild")
    _land(spark, base, tables)
    silver.refresh_silver_transactions(tables)
    silver.rebuild(tables, "transactions")
    return tables.read("silver_transactions").select(*silver.TRANSACTION_FIELDS)


@query
def refresh_gold_full(spark, sf_dir):
    """Customers that arrive after their transactions reach gold only by the full refresh."""
    base = new_folder(spark, "gold-full")
    tables = Tables(spark, f"{base}/tables")
    _deliver(_transaction_file(spark, sf_dir), f"{base}/landing/entity=transactions/{DAY}")
    _land(spark, base, tables, after=refresh_all)
    _deliver(_customer_file(spark, sf_dir), f"{base}/landing/entity=customers/{DAY}")
    _land(spark, base, tables, after=refresh_all)
    stale = materialized(tables.read("gold_transactions").select(
        "transaction_id", F.col("customer_name").alias("name_before")))
    gold_plan.refresh_gold_full(tables)
    return _gold_rows(tables).join(stale, "transaction_id").select(
        "transaction_id", "customer_id", "name_before", "customer_name")


@query
def gold_table_scan(spark, sf_dir):
    """Gold written in its partitions and clustering, and read back by a clustered filter."""
    tables = Tables(spark, f"{new_folder(spark, 'scan')}/tables")
    named = op.enrich(e.transactions(spark, sf_dir), e.silver_customers(spark, sf_dir), EPOCH, NOW)
    typed = {c: F.col(c).cast("double") for c in ("transaction_amount", "qtty", "price")}
    with tables.run() as run:
        # One ingestion per quarter; one per order date would make thousands of partitions.
        run.add("gold_transactions", named.withColumns(
            {**typed, "_ingested_at": F.date_trunc("quarter", "_ingested_at")}))
    approved = tables.read("gold_transactions").filter(
        (F.col("transaction_status") == "approved") & (F.col("transaction_type") == "buy"))
    return approved.select("transaction_id", "customer_id", "customer_name",
                           "transaction_amount", "_ingested_date")


# Changes of stored tables. Versions are cut to the quarter: many are equal, and one partition for each
# day of seven years would make thousands of files.

def _quarterly(rows: DataFrame) -> DataFrame:
    money = ("transaction_amount", "qtty", "price")
    return rows.withColumns({**{c: F.col(c).cast("double") for c in money},
                             "_ingested_at": F.date_trunc("quarter", "_ingested_at")})


def _as_stored(rows: DataFrame, name: str) -> DataFrame:
    """Rows in the shape of a table, with as much of its lineage as they have."""
    lineage_type = LAYOUTS[name].schema["_metadata"].dataType
    audit = (F.struct(*[(F.col("_metadata")[f.name] if f.name in held else F.lit(None))
                        .cast("string" if f.name != "publish_time" else "timestamp").alias(f.name)
                        for f in lineage_type])
             if (held := rows.schema["_metadata"].dataType.names) else F.lit(None))
    return rows.withColumns({"_processed_at": F.lit(NOW), "_metadata": audit.cast(lineage_type)})


def _new_and_keyless(spark, sf_dir) -> DataFrame:
    """Transactions that no table knows: suppliers, those of even number without an id."""
    number = F.col("s_suppkey")
    return e.table(spark, sf_dir, "supplier").select(
        F.when(number % 2 == 1, F.concat(F.lit("X"), number.cast("string")))
        .alias("transaction_id"),
        F.concat(F.lit("C"), number.cast("string")).alias("customer_id"),
        F.lit(None).cast("date").alias("transaction_date"),
        F.col("s_acctbal").cast("double").alias("transaction_amount"),
        F.lit("pending").alias("transaction_status"), F.lit("buy").alias("transaction_type"),
        F.lit(1.0).alias("qtty"), F.lit(None).cast("double").alias("price"),
        F.to_timestamp(F.lit("1997-01-01")).alias("_ingested_at"),
        F.struct(F.lit("suppliers").alias("audit_id")).alias("_metadata"))


_MERGED = ["transaction_id", "customer_id", "transaction_date", "transaction_amount",
           "transaction_status", "transaction_type", "qtty", "price"]


@query
def merge_transactions(spark, sf_dir):
    """The jobs' upsert on stored silver transactions: newer, equal, older and unknown keys, and rows
    without a key; then the keyed rows once more, which must change nothing."""
    tables, name = Tables(spark, f"{new_folder(spark, 'merge')}/tables"), "silver_transactions"
    with tables.run() as run:
        run.add(name, _as_stored(_quarterly(e.transactions(spark, sf_dir)), name))
    columns = [*_MERGED, "_ingested_at", "_metadata", "l_linenumber", "l_partkey", "l_suppkey"]
    new = _new_and_keyless(spark, sf_dir).withColumns(
        {c: F.lit(None).cast("int") for c in columns[-3:]})
    keyed = _as_stored(_quarterly(e.line_versions(spark, sf_dir)).select(*columns)
                       .unionByName(new.filter("transaction_id is not null")), name)
    keyless = _as_stored(new.filter("transaction_id is null"), name)
    newer = [F.col(c) for c in e.LINE_ORDER]
    for batch in (keyed.unionByName(keyless), keyed):
        with tables.run() as run:
            merge_into(run, name, batch, "transaction_id", newer=newer)
    return tables.read(name).select(*_MERGED, "_ingested_at").withColumns(
        _plain_time("_ingested_at"))


@query
def merge_gold(spark, sf_dir):
    """The jobs' upsert on stored gold: the enriched newest lines into the enriched transactions."""
    tables, name = Tables(spark, f"{new_folder(spark, 'merge')}/tables"), "gold_transactions"
    who = e.silver_customers(spark, sf_dir)
    rows = op.enrich(_quarterly(e.transactions(spark, sf_dir)), who, EPOCH, NOW)
    with tables.run() as run:
        run.add(name, _as_stored(rows, name))
    newest = materialized(op.newest_per_key(
        _quarterly(e.line_versions(spark, sf_dir)), "transaction_id",
        newer=[F.col(c) for c in e.LINE_ORDER]))  # both merges take it
    for _ in range(2):
        with tables.run() as run:
            merge_into(run, name, _as_stored(op.enrich(newest, who, EPOCH, NOW), name),
                       "transaction_id")
    return tables.read(name).select(
        *_MERGED[:2], "customer_name", *_MERGED[2:], "_ingested_at",
        "_metadata.audit_id_transactions", "_metadata.audit_id_customers").withColumns(
        _plain_time("_ingested_at"))


@query
def merge_after_cut_off(spark, sf_dir):
    """What readers see before, during and after an upsert whose first attempt is cut off when all its
    files are written."""
    tables, name = Tables(spark, f"{new_folder(spark, 'cut-off')}/tables"), "silver_customers"

    def stored(rows: DataFrame) -> DataFrame:
        return _as_stored(rows.withColumn("_metadata", F.struct(F.lit("x").alias("audit_id"))), name)

    with tables.run() as run:
        run.add(name, stored(e.silver_customers(spark, sf_dir)))
    source = stored(e.order_versions(spark, sf_dir))
    opened = tables.read(name)
    merge_into(tables.run(), name, source, "customer_id", newer=[F.col("o_orderkey")])
    during = Tables(spark, tables.root).read(name)
    with tables.run() as run:
        merge_into(run, name, source, "customer_id", newer=[F.col("o_orderkey")])
    seen = {"before": opened, "during": during, "after": tables.read(name)}
    parts = [rows.select(F.lit(when).alias("seen"), "customer_id", "customer_name",
                         "customer_email") for when, rows in seen.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _passed_by(spark, sf_dir) -> Tables:
    """Gold after a file of urgent transactions reached silver behind its mark."""
    tables = Tables(spark, f"{new_folder(spark, 'late')}/tables")
    moves = _quarterly(e.transactions(spark, sf_dir)).withColumn(
        "_ingested_at", F.date_trunc("month", F.col("transaction_date").cast("timestamp")))
    first = (F.col("_metadata.audit_id") != "1-URGENT") & (F.col("_ingested_at") < "1998-06-01")
    now = datetime(1998, 5, 2, tzinfo=UTC)
    with tables.run() as run:
        run.add("silver_customers", _as_stored(e.silver_customers(spark, sf_dir),
                                               "silver_customers"))
    for part in (first, ~first):
        with tables.run() as run:
            run.add("silver_transactions", _as_stored(moves.filter(part), "silver_transactions"))
        gold_plan.refresh_gold_transactions(tables, now)
    return tables


@query
def late_gold_rows(spark, sf_dir):
    """Silver transactions that gold's mark has passed by."""
    # gold has taken all it will take; its mark is that of its newest rows
    late = lineage.late_gold_rows(_passed_by(spark, sf_dir), datetime(1998, 8, 2, tzinfo=UTC))
    return late.select("transaction_id", "customer_id", "transaction_date",
                       F.col("_metadata.audit_id").alias("audit_id"))


@query
def promote_late_rows(spark, sf_dir):
    """Gold after these were promoted."""
    tables = _passed_by(spark, sf_dir)
    gold_plan.promote_late(tables, datetime(1998, 8, 2, tzinfo=UTC))
    return _gold_rows(tables)


@query
def discover_schema(spark, sf_dir):
    """Types of fields that are numbers, texts, both, and nested, from messages of two entities."""
    documents = e.table(spark, sf_dir, "documents")
    key = F.col("doc_id")
    record = F.to_json(F.struct(
        key.alias("number"), F.col("lang").alias("text"), (key / 4).alias("fraction"),
        F.struct(key.alias("a"), F.col("source").alias("b")).alias("nested"),
        F.array(key, key + 1).alias("list"), (key % 2 == 0).alias("flag")))
    mixed = F.concat(F.regexp_replace(record, r"\}$", ', "mixed": '),
                     F.when(key % 2 == 0, '"even"}').otherwise("1}"))
    entity = F.when(key % 3 == 0, "customers").otherwise("transactions")
    raw = documents.select(
        F.concat(F.lit("[1, "), mixed, F.lit("]")).alias("data"),
        F.create_map(F.lit("entity"), entity, F.lit("source_path"),
                     F.concat(F.lit("file-"), key.cast("string"))).alias("attributes"),
        F.timestamp_seconds(key).alias("publish_time"))
    # precision and scale follow from the numbers of the table
    return op.discover_schema(raw).withColumns(
        {**_plain_time("first_seen"), "type": F.regexp_replace("type", r"\(\d+,\d+\)", "")})


def _delivered_by_month(spark, sf_dir) -> Tables:
    """Raw messages of transactions, one file a year, published on the first day of the next one."""
    tables = Tables(spark, f"{new_folder(spark, 'replay')}/tables")
    year = F.year(F.to_date("transaction_date"))
    rows = _transaction_file(spark, sf_dir)
    record = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in rows.columns]))
    at = F.make_timestamp(year + 1, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    names = rows.select(
        F.col("transaction_id").alias("message_id"), at.alias("publish_time"),
        F.concat(F.lit("["), record, F.lit("]")).alias("data"), year.cast("string").alias("year"))
    events = names.select(
        F.lit("landing-files").alias("subscription_name"), "message_id", "publish_time", "data",
        F.create_map(F.lit("entity"), F.lit("transactions"), F.lit("audit_id"), F.col("year"),
                     F.lit("source_path"), F.concat(F.col("year"), F.lit("/"), F.col("message_id")),
                     F.lit("ingested_at"), F.date_format("publish_time", "yyyy-MM-dd'T'HH:mm:ssxxx"))
        .alias("attributes"))
    with tables.run() as run:
        run.add("landing_events", events)
    silver.refresh_silver_transactions(tables, NOW)
    return tables


@query
def rebuild_from(spark, sf_dir):
    """Silver after the file of 1996 was taken out of raw: a replay from then on withdraws its rows."""
    tables = _delivered_by_month(spark, sf_dir)
    with tables.run() as run:
        replace_all(run, "landing_events", tables.read("landing_events").filter(
            F.col("attributes")["audit_id"] != "1996"))
    silver.rebuild(tables, "transactions", NOW, since=datetime(1996, 6, 1, tzinfo=UTC))
    silver.withdraw(tables, "transactions", datetime(1996, 6, 1, tzinfo=UTC), NOW)
    return tables.read("silver_transactions").select(*silver.TRANSACTION_FIELDS)


@query
def catalog_views(spark, sf_dir):
    """Gold's monthly report from a view of the catalog, read by another session; it was registered
    when gold was empty."""
    base, tables = _delivered(spark, sf_dir, "catalog")
    database = f"finance_{base[-12:]}"
    views.register_views(tables, database)
    _land(spark, base, tables, after=refresh_all)
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "UTC")
    found = materialized(other.table(f"{database}.transactions_monthly_ttm_vw").select(
        "month", "total", "total_approved", "total_pending", "total_rejected"))
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return found
