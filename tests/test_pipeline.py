from __future__ import annotations

import os
import time
from datetime import UTC, date, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.plans import gold, lineage, reports, silver, views
from tidemark.plans.medallion import refresh_all
from tidemark.session import materialized, utc_now
from tidemark.sources.storage import Storage
from tidemark.sources.tables import Tables, create_table_sql, replace_all
from tidemark.streaming import landing, start_landing
from tidemark.streaming.landing import retry_quarantined

DAY = "year=2026/month=03/day=25"
PEOPLE = "customer_id,customer_name,customer_email\nC01,Ann,ann@x\nC02,Bob,\n"
MOVES = ("transaction_id,customer_id,transaction_date,transaction_amount,transaction_status,"
         "transaction_type,qtty,price\n"
         "T1,C1,2023-09-01,10.5,approved,buy,1,2\n"
         "T2,C002,2023-09-02,x,pending,,2.5,\n"
         "T3,C9,2023-02-30,7,rejected,sell,,3\n")


class Feed:
    """A landing folder with its stream and tables."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        self.tables = Tables(spark, str(folder / "tables"))

    def put(self, path, content):
        target = self.folder / "landing" / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(content if isinstance(content, bytes) else content.encode())

    def land(self, after_batch=refresh_all, **options):
        (self.folder / "landing").mkdir(exist_ok=True)
        query = start_landing(self.spark, str(self.folder / "landing"), self.tables,
                              str(self.folder / "stream"), after_batch=after_batch, **options)
        query.awaitTermination()

    def rows(self, table, *columns):
        df = self.tables.read(table)
        return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def _both(feed):
    feed.put(f"entity=customers/{DAY}/customers.csv", PEOPLE)
    feed.put(f"entity=transactions/{DAY}/transactions.csv", MOVES)


GOLD = ("transaction_id", "customer_id", "customer_name", "customer_email", "transaction_date",
        "transaction_amount", "transaction_status", "transaction_type", "qtty", "price")


def test_files_reach_gold_and_a_second_run_changes_nothing(feed):
    _both(feed)
    feed.land()
    expected = [
        ("T1", "C1", "Ann", "ann@x", date(2023, 9, 1), 10.5, "approved", "buy", 1.0, 2.0),
        ("T2", "C2", "Bob", None, date(2023, 9, 2), None, "pending", None, 2.5, None),
        ("T3", "C9", None, None, None, 7.0, "rejected", "sell", None, 3.0)]
    assert feed.rows("gold_transactions", *GOLD) == expected
    stamps = ("transaction_id", "_ingested_at", "_processed_at")
    before = feed.rows("gold_transactions", *stamps), feed.rows("silver_transactions", *stamps)
    feed.land()
    refresh_all(feed.tables)
    silver.rebuild(feed.tables, "transactions")
    refresh_all(feed.tables)
    assert before == (feed.rows("gold_transactions", *stamps),
                      feed.rows("silver_transactions", *stamps))
    assert feed.tables.read("landing_events").count() == 2
    # Lineage of every layer points at the two file events.
    ids = {r["entity"]: r["audit_id"] for r in
           lineage.ingest_report(feed.tables.read("landing_events")).collect()}
    trace = {tuple(r) for r in lineage.audit_trace(feed.tables, ids["customers"]).collect()}
    assert trace == {(ids["customers"], "landing_events", 2),
                     (ids["customers"], "silver_customers", 2),
                     (ids["customers"], "gold_transactions_by_customer", 2)}
    everything = lineage.audit_trace(feed.tables)
    assert {r["layer"] for r in everything.collect()} == {
        "landing_events", "silver_customers", "silver_transactions", "gold_transactions",
        "gold_transactions_by_customer"}


def test_new_columns_and_column_order_do_not_matter(feed):
    feed.put(f"entity=customers/{DAY}/a.csv", "vip,customer_email,customer_id\nyes,z@x,C07\n")
    feed.land()
    assert feed.rows("silver_customers", "customer_id", "customer_name", "customer_email") == [
        ("C7", None, "z@x")]
    from tidemark.operators import discover_fields
    fields = discover_fields(feed.tables.read("landing_events")).collect()
    assert ("customers", "vip", 1) in {tuple(r) for r in fields}


def test_updates_replace_rows_but_gold_keeps_old_names(feed):
    _both(feed)
    feed.land()
    feed.put(f"entity=customers/{DAY}/more.csv",
             "customer_id,customer_name\nC1,Anna\nC9,Zoe\n")
    feed.put(f"entity=transactions/{DAY}/more.csv",
             "transaction_id,customer_id,transaction_amount\nT2,C9,8\n")
    feed.land()
    assert feed.rows("silver_customers", "customer_id", "customer_name") == [
        ("C1", "Anna"), ("C2", "Bob"), ("C9", "Zoe")]
    names = feed.rows("gold_transactions", "transaction_id", "customer_name",
                      "transaction_amount")
    assert names == [("T1", "Ann", 10.5), ("T2", "Zoe", 8.0), ("T3", None, 7.0)]
    gold.refresh_gold_full(feed.tables)
    assert feed.rows("gold_transactions", "transaction_id", "customer_name") == [
        ("T1", "Anna"), ("T2", "Zoe"), ("T3", "Zoe")]


def test_later_upload_of_a_batch_wins(feed):
    """Two files landed together behave as if processed in the order of their upload."""
    feed.put(f"entity=customers/{DAY}/z-first.csv", "customer_id,customer_name\nC1,First\n")
    feed.put(f"entity=customers/{DAY}/a-second.csv", "customer_id,customer_name\nC1,Second\n")
    landing = feed.folder / "landing" / "entity=customers" / DAY
    os.utime(landing / "z-first.csv", (time.time() - 60,) * 2)
    feed.land()
    assert feed.rows("silver_customers", "customer_id", "customer_name") == [("C1", "Second")]


def test_newest_file_of_a_path_wins(feed):
    path = f"entity=customers/{DAY}/c.csv"
    feed.put(path, "customer_id,customer_name\nC1,Old\nC2,Gone\n")
    feed.land(after_batch=None)
    time.sleep(1.1)
    feed.put(path, "customer_id,customer_name\nC1,New one\n")
    feed.land(after_batch=None)
    refresh_all(feed.tables)
    assert feed.rows("silver_customers", "customer_id", "customer_name") == [("C1", "New one")]
    assert [r[0] for r in feed.rows("ledger", "outcome")] == ["superseded", "used"]
    assert lineage.late_events(feed.tables).count() == 0


@pytest.mark.parametrize("few", [0, 1, 200_000])
def test_superseded_messages_are_left_out_however_many_there_are(feed, monkeypatch, few):
    """Two newest messages and one older: all are too many to be broadcast, the newest, or none."""
    monkeypatch.setattr(silver, "BROADCAST_MESSAGES", few)
    path = f"entity=customers/{DAY}/c.csv"
    feed.put(path, "customer_id,customer_name\nC1,Old\nC2,Gone\n")
    feed.put(f"entity=customers/{DAY}/d.csv", "customer_id,customer_name\nC3,Other\n")
    feed.land(after_batch=None)
    time.sleep(1.1)
    feed.put(path, "customer_id,customer_name\nC1,New one\n")
    feed.land(after_batch=None)
    silver.refresh_silver_customers(feed.tables)
    assert feed.rows("silver_customers", "customer_id", "customer_name") == [
        ("C1", "New one"), ("C3", "Other")]
    assert [r[0] for r in feed.rows("ledger", "outcome")] == ["superseded", "used", "used"]


def test_messages_are_not_compared_if_no_path_came_twice(feed, monkeypatch):
    monkeypatch.setattr(silver, "BROADCAST_MESSAGES", 0)
    written = []
    monkeypatch.setattr(silver, "materialized", lambda df, folder: (
        written.append(folder.rpartition("/")[2]), materialized(df, folder))[1])
    feed.put(f"entity=customers/{DAY}/c.csv", PEOPLE)
    feed.put(f"entity=customers/{DAY}/d.csv", "customer_id,customer_name\nC3,Other\n")
    feed.land(after_batch=None)
    silver.refresh_silver_customers(feed.tables)
    assert written == ["newest-1"]
    assert [r[0] for r in feed.rows("ledger", "outcome")] == ["used", "used"]
    assert len(feed.rows("silver_customers", "customer_id")) == 3


def test_rejected_quarantined_and_ignored_files(feed):
    feed.put("entity=other/x.csv", "a\n1\n")
    feed.put("x/entity=customers/c.csv", "customer_id\nC1\n")
    feed.put("entity=customers/c.CSV", "customer_id\nC1\n")
    feed.put("entity=customers/c.txt", "customer_id\nC1\n")
    feed.put("entity=customers/bad.csv", b"customer_id\n\xff\n")
    feed.put("entity=customers/header.csv", "customer_id,customer_name\n")
    feed.land()
    rejects = lineage.ingest_rejects(feed.tables.read("rejects"))
    assert {(r["source_path"], r["error"]) for r in rejects.collect()} == {
        ("entity=other/x.csv", "unknown entity"),
        ("x/entity=customers/c.csv", "unknown entity")}
    assert feed.rows("landing_events", "data") == [("[]",)]
    assert feed.rows("silver_customers", "customer_id") == []
    now = utc_now()

    def aside(at):
        report = lineage.quarantine(feed.tables.read("quarantine"), at)
        return [(r["source_path"], r["attempts"]) for r in report.collect()]

    assert aside(now) == [("entity=customers/bad.csv", 1)]
    assert aside(now + timedelta(days=8)) == []
    landing = str(feed.folder / "landing")
    assert retry_quarantined(feed.tables, landing) == 1
    assert aside(utc_now()) == [("entity=customers/bad.csv", 2)]
    assert retry_quarantined(feed.tables, landing, max_attempts=2) == 0


def test_a_replaced_file_is_landed_again(feed):
    """The file stream alone takes each path once."""
    bad, good = f"entity=customers/{DAY}/bad.csv", f"entity=customers/{DAY}/good.csv"
    feed.put(bad, b"customer_id\n\xff\n")
    feed.put(good, "customer_id,customer_name\nC1,Ann\n")
    feed.land()
    time.sleep(1.1)
    feed.put(bad, "customer_id,customer_name\nC2,Bob\n")
    feed.put(good, "customer_id,customer_name\nC1,Anna\n")
    feed.land()
    assert feed.rows("silver_customers", "customer_id", "customer_name") == [
        ("C1", "Anna"), ("C2", "Bob")]
    feed.put(f"entity=customers/{DAY}/third.csv", "customer_id,customer_name\nC3,Cid\n")
    feed.land()
    feed.land()
    assert feed.tables.read("landing_events").count() == 4
    assert lineage.late_events(feed.tables).count() == 0


def test_large_files_land_in_parts(feed):
    rows = "".join(f'C{i},"Name ""{i}""\nsecond line",m{i}@x\n' for i in range(1, 400))
    feed.put(f"entity=customers/{DAY}/big.csv",
             "customer_id,customer_name,customer_email\n" + rows)
    feed.put(f"entity=customers/{DAY}/small.csv", "customer_id,customer_name\nC1000,Small\n")
    feed.put(f"entity=customers/{DAY}/bigbad.csv", b"customer_id\n" + b"C1\n" * 900 + b"\xff\n")
    feed.land(inline_bytes=1000)
    found = feed.rows("silver_customers", "customer_id", "customer_name", "customer_email")
    assert len(found) == 400
    assert ("C77", 'Name "77"\nsecond line', "m77@x") in found
    assert [r[0] for r in feed.rows("quarantine", "source_path")] == [
        f"entity=customers/{DAY}/bigbad.csv"]


def test_a_repeated_batch_is_landed_once_and_refreshed(feed):
    _both(feed)

    def fail(tables):
        raise RuntimeError("refresh failed")

    with pytest.raises(Exception, match="refresh failed"):
        feed.land(after_batch=fail)
    assert feed.tables.read("landing_events").count() == 2
    feed.land()
    assert feed.tables.read("landing_events").count() == 2
    assert feed.tables.read("gold_transactions").count() == 3


def test_files_with_old_times_are_landed(feed):
    landing = feed.folder / "landing" / "entity=customers" / DAY
    feed.put(f"entity=customers/{DAY}/new.csv", "customer_id,customer_name\nC1,Ann\n")
    feed.land()
    old = time.time() - 30 * 86400
    feed.put(f"entity=customers/{DAY}/old.csv", "customer_id,customer_name\nC2,Bob\n")
    os.utime(landing / "old.csv", (old, old))
    feed.land()
    feed.put(f"entity=customers/{DAY}/new.csv", "customer_id,customer_name\nC1,Anna\n")
    os.utime(landing / "new.csv", (old, old))
    feed.land()
    assert feed.rows("silver_customers", "customer_id", "customer_name") == [
        ("C1", "Anna"), ("C2", "Bob")]
    assert feed.tables.read("landed_files").count() == 3


def test_a_batch_repeated_after_a_replaced_file_is_not_below_the_mark(feed, monkeypatch):
    feed.put(f"entity=customers/{DAY}/a.csv", "customer_id,customer_name\nC1,Ann\n")
    feed.land()
    feed.put(f"entity=customers/{DAY}/b.csv", "customer_id,customer_name\nC2,Bob\n")
    with monkeypatch.context() as broken:
        broken.setattr(landing, "land_batch", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(Exception, match="gone"):
            feed.land()
    time.sleep(1.1)
    feed.put(f"entity=customers/{DAY}/a.csv", "customer_id,customer_name\nC1,Anna\n")
    feed.land()
    assert feed.rows("silver_customers", "customer_id", "customer_name") == [
        ("C1", "Anna"), ("C2", "Bob")]
    assert lineage.late_events(feed.tables).count() == 0


def test_opening_tables_leaves_a_running_change_alone(feed, monkeypatch):
    _both(feed)
    write_text, opened = Storage.write_text, []

    def opens_meanwhile(self, name, text):
        if "/versions/" in name:
            seen = Tables(feed.spark, str(feed.folder / "tables"))
            opened.append((seen.read("landing_events").count(), seen.read("ledger").count()))
        write_text(self, name, text)

    monkeypatch.setattr(Storage, "write_text", opens_meanwhile)
    feed.land()
    # nothing is seen before the landing, both messages before each later switch
    assert opened[0] == (0, 0) and {o[0] for o in opened[1:]} == {2}
    assert feed.tables.read("gold_transactions").count() == 3


def test_large_files_in_quarantine_are_retried_as_large(feed):
    path = f"entity=customers/{DAY}/big.csv"
    feed.put(path, b"customer_id,customer_name\n" + b"C1,x\n" * 300 + b"\xff\n")
    feed.land(inline_bytes=1000)
    landing_dir = feed.folder / "landing"
    stamp = (landing_dir / path).stat().st_mtime
    assert retry_quarantined(feed.tables, str(landing_dir), inline_bytes=1000) == 1
    attempts = lineage.quarantine(feed.tables.read("quarantine"), utc_now()).first()["attempts"]
    assert attempts == 2 and stamp > 0
    assert feed.tables.read("landing_events").count() == 0


def test_a_landing_cut_off_while_publishing_is_repeated_whole(feed, monkeypatch):
    _both(feed)
    write_text = Storage.write_text

    def breaks(self, name, text):
        if "/versions/" in name:
            raise OSError("gone")
        write_text(self, name, text)

    feed.put("entity=other/x.csv", "a\n1\n")
    with monkeypatch.context() as broken:
        broken.setattr(Storage, "write_text", breaks)
        with pytest.raises(Exception, match="gone"):
            feed.land()
    assert feed.tables.read("landing_events").count() == 0
    feed.land()
    assert feed.tables.read("landing_events").count() == 2
    assert feed.tables.read("rejects").count() == 1
    assert feed.tables.read("gold_transactions").count() == 3


def test_a_failing_silver_job_stops_the_run_before_gold(feed):
    _both(feed)
    feed.put(f"entity=customers/{DAY}/wrong.csv", "customer_id\nCX\n")
    feed.land(after_batch=None)
    with pytest.raises(Exception, match="malformed customer id"):
        refresh_all(feed.tables)
    assert feed.rows("gold_transactions", "transaction_id") == []
    refresh_all(feed.tables, id_mode="quarantine")
    assert len(feed.rows("gold_transactions", "transaction_id")) == 3
    assert [(r[0], r[1]) for r in feed.rows("malformed_records", "entity", "record")] == [
        ("customers", '{"customer_id":"CX"}')]


def test_duplicate_ids_within_a_file(feed):
    feed.put(f"entity=customers/{DAY}/c.csv", "customer_id,customer_name\nC1,a\nC01,b\n")
    feed.land(after_batch=None)
    with pytest.raises(Exception, match="duplicate customer_id in one file"):
        refresh_all(feed.tables)
    refresh_all(feed.tables, on_duplicate="insert")
    assert feed.rows("silver_customers", "customer_id", "customer_name") == [
        ("C1", "a"), ("C1", "b")]


def _message(feed, entity, message_id, at, data, ingested_at=None, path=None):
    attributes = {"audit_id": f"a-{message_id}", "entity": entity,
                  "source_path": path or f"entity={entity}/{message_id}.csv",
                  "source_file": "f.csv", "ingested_at": ingested_at or at.isoformat()}
    row = feed.spark.createDataFrame(
        [("test", message_id, at, data, attributes)],
        feed.tables.read("landing_events").drop("_publish_date", "_entity").schema)
    with feed.tables.run() as run:
        run.add("landing_events", row)


def test_idle_reset_late_events_and_rows_without_keys(feed):
    now = utc_now()
    keyless = '[{"transaction_id":"","customer_id":"C1"},{"transaction_id":"T1"}]'
    _message(feed, "transactions", "m1", now, keyless)
    refresh_all(feed.tables, now)
    assert feed.rows("silver_transactions", "transaction_id") == [("T1",), (None,)]
    # Published below the mark: no run will take it.
    _message(feed, "transactions", "m0", now - timedelta(hours=1), '[{"transaction_id":"T0"}]')
    refresh_all(feed.tables, now)
    assert [r["message_id"] for r in lineage.late_events(feed.tables, now).collect()] == ["m0"]
    assert feed.rows("silver_transactions", "transaction_id") == [("T1",), (None,)]
    # After more than a week without rows everything is read again: known keys stay as they
    # are, the late message is taken, and the row without key is inserted once more.
    later = now + timedelta(days=8)
    assert lineage.late_events(feed.tables, later).count() == 0
    stamps = dict(feed.rows("silver_transactions", "transaction_id", "_processed_at"))
    refresh_all(feed.tables, later)
    found = feed.rows("silver_transactions", "transaction_id", "_processed_at")
    assert [r[0] for r in found] == ["T0", "T1", None, None]
    assert dict(found[:2])["T1"] == stamps["T1"]


def test_rows_without_ingestion_time_stay_in_silver(feed):
    now = utc_now()
    _message(feed, "transactions", "m1", now, '[{"transaction_id":"T1"}]', ingested_at="soon")
    refresh_all(feed.tables, now)
    assert feed.rows("silver_transactions", "transaction_id", "_ingested_date") == [("T1", None)]
    assert feed.rows("gold_transactions", "transaction_id") == []


def test_an_older_file_processed_late_never_reaches_gold(feed):
    now = utc_now()
    _message(feed, "transactions", "m1", now, '[{"transaction_id":"T1"}]')
    refresh_all(feed.tables, now)
    early = (now - timedelta(days=1)).isoformat()
    _message(feed, "transactions", "m2", now + timedelta(seconds=1),
             '[{"transaction_id":"T2"}]', ingested_at=early)
    refresh_all(feed.tables, now)
    assert feed.rows("silver_transactions", "transaction_id") == [("T1",), ("T2",)]
    assert feed.rows("gold_transactions", "transaction_id") == [("T1",)]


def test_views(feed):
    _both(feed)
    feed.land()
    names = views.register_views(feed.tables)
    assert {n for n in names if n.endswith("_vw")} == set(views.VIEWS)
    spark = feed.spark
    assert spark.sql("SELECT sum(total) AS n FROM transactions_monthly_ttm_vw").first()["n"] == 3
    assert spark.sql("SELECT * FROM transactions_customers_last_quarter_vw").count() == 2
    assert spark.sql("SELECT * FROM transactions_daily_avg_price_vw").count() == 0


def test_daily_view_adds_amounts_without_error(feed):
    header = MOVES.splitlines()[0]
    buys = [("2023-07-02", 1, 0.1), ("2023-07-02", 1, 0.2), ("2023-07-02", 1, 0.3),
            ("2023-07-03", 0.000015, 2), ("2023-07-04", 1e9, 1.5), ("2023-07-04", "", 2)]
    assert (0.1 + 0.2 + 0.3) / 3 != 0.6 / 3  # what doubles give
    lines = ["V0,C1,2023-07-01,1,approved,sell,1,1"] + [
        f"V{i},C1,{day},1,approved,buy,{qtty},{price}" for i, (day, qtty, price) in enumerate(buys, 1)]
    feed.put(f"entity=transactions/{DAY}/buys.csv", "\n".join([header, *lines]))
    feed.land()
    views.register_views(feed.tables)
    found = feed.spark.table("transactions_daily_avg_price_vw").orderBy("transaction_date").collect()
    assert [r["buy_qtty"] for r in found] == [3.0, 0.000015, 1e9]
    assert [r["daily_avg_price"] for r in found] == [0.6 / 3, 0.00003 / 0.000015, 1.5]
    assert [r["running_avg_price"] for r in found] == [
        max(0.1, 0.3 / 2, 0.6 / 3), (0.6 + 0.00003) / (3 + 0.000015),
        (0.6 + (0.00003 + 1.5e9)) / (3 + (0.000015 + 1e9))]


def test_views_show_the_table_as_it_is(feed):
    _both(feed)
    feed.land()
    views.register_views(feed.tables)
    lines = [f"U{i:03d},C{i % 4},2023-{i % 3 + 7:02d}-{i % 5 + 1:02d},{i}.5,"
             f"{('approved', 'approved', 'rejected')[i % 3]},buy,{i % 7 + 1},{i % 11}"
             for i in range(200)]
    feed.put(f"entity=transactions/{DAY}/more.csv", MOVES.splitlines()[0] + "\n" + "\n".join(lines))
    feed.land()
    made = (reports.monthly_ttm, reports.customers_last_quarter, reports.daily_avg_price)
    for step in ("append", "rewrite"):
        if step == "rewrite":
            gold.refresh_gold_full(feed.tables)
        rows = feed.tables.read("gold_transactions")
        assert rows.count() == 203
        for report, view in zip(made, views.VIEWS, strict=True):
            expected = report(rows)
            found = feed.spark.table(view)
            assert found.columns == expected.columns
            for a, b in zip(found.orderBy(found.columns[0]).collect(),
                            expected.orderBy(expected.columns[0]).collect(), strict=True):
                for x, y in zip(a, b, strict=True):
                    assert x == (pytest.approx(y) if isinstance(y, float) else y)


def test_catalog_tables(feed):
    _both(feed)
    feed.land()
    feed.tables.register("finance")
    spark = feed.spark
    try:
        assert spark.sql("SELECT * FROM finance.gold_transactions").count() == 3
        told = {r["col_name"]: r["comment"] for r in
                spark.sql("DESCRIBE finance.silver_customers").collect()}
        assert told["customer_name"] == "full name"
        # a table of its own, by the same DDL
        spark.sql(create_table_sql("finance.imported", "silver_customers",
                                   str(feed.folder / "imported")))
        spark.sql("INSERT INTO finance.imported (customer_id, _ingested_date) "
                  "VALUES ('C5', DATE '2026-03-25')")
        row = spark.table("finance.imported").first()
        assert row["_processed_at"] is not None and row["customer_name"] is None
    finally:
        spark.sql("DROP DATABASE finance CASCADE")


def test_views_of_the_catalog_follow_the_table_from_empty(feed):
    names = views.register_views(feed.tables, "finance")
    other = feed.spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        assert [other.table(n).count() for n in names] == [0, 0, 0, 0]
        _both(feed)
        feed.land()
        made = (reports.monthly_ttm, reports.customers_last_quarter, reports.daily_avg_price)
        for _ in range(2):
            rows = feed.tables.read("gold_transactions")
            assert other.table(names[0]).count() == rows.count() == 3
            for report, name in zip(made, names[1:], strict=True):
                assert other.table(name).count() == report(rows).count()
            gold.refresh_gold_full(Tables(feed.spark, feed.tables.root))
        assert other.sql("SELECT finance.func_normalize_customer_id('C007')").first()[0] == "C7"
        # another session's job renews them, too, as the tables know where they are offered
        assert feed.tables.state()["database"] == "finance"
    finally:
        feed.spark.sql("DROP DATABASE finance CASCADE")


def test_gold_is_partitioned_and_sorted_by_its_clustering(feed):
    _both(feed)
    feed.land()
    files = feed.tables.files("gold_transactions")
    assert len(files) == 1 and "_ingested_date=" in files[0]
    rows = feed.spark.read.parquet(files[0].removeprefix("file:")).select(
        "transaction_status", "transaction_type", "customer_id").collect()
    assert rows == sorted(rows)
    plan = feed.tables.read("gold_transactions").filter(
        (F.col("_ingested_date") >= "2026-01-01") & (F.col("transaction_status") == "approved")
    ).select("price")._jdf.queryExecution().toString()
    assert "EqualTo(transaction_status,approved)" in plan and "PartitionFilters: [isnotnull" in plan


def test_sessions_must_run_on_utc(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        with pytest.raises(ValueError, match="UTC"):
            Tables(spark, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_golden_run(feed):
    """Invented rows through all layers, and the reports as worked out by hand."""
    feed.put(f"entity=customers/{DAY}/c.csv",
             "customer_id,customer_name\nC01,Ana\nC02,Rui\nC03,Eva\n")
    head = MOVES.splitlines()[0]
    rows = ["T01,C1,2024-01-10,100,approved,buy,10,10", "T02,C2,2024-01-20,50,rejected,buy,5,10",
            "T03,C1,2024-02-01,60,approved,buy,4,15", "T04,C2,2024-02-01,30,approved,buy,2,15",
            "T05,C1,2024-04-05,80,approved,sell,8,10", "T06,C1,2024-04-05,90,approved,buy,6,15",
            "T07,C3,2024-05-06,70,pending,buy,7,10", "T08,C3,2024-05-07,40,rejected,buy,4,10"]
    feed.put(f"entity=transactions/{DAY}/t.csv", "\n".join([head, *rows]))
    feed.land()
    gold_rows = feed.tables.read("gold_transactions")
    monthly = {r["month"]: r for r in reports.monthly_ttm(gold_rows).collect()}
    assert {k.month: (r["total"], r["amount_total"], r["total_rejected"], r["rate_rejected_amount"])
            for k, r in monthly.items()} == {
        1: (2, 150.0, 1, 50 / 150), 2: (2, 90.0, 0, 0.0), 4: (2, 170.0, 0, 0.0),
        5: (2, 110.0, 1, 40 / 110)}
    quarter = {r["customer_name"]: (r["total"], r["total_approved"], r["amount_pending"])
               for r in reports.customers_last_quarter(gold_rows).collect()}
    assert quarter == {"Ana": (2, 2, 0.0), "Eva": (2, 0, 70.0)}
    # T01, T02 and T07 open their customers; T03, T04 and T06 remain
    daily = [tuple(r) for r in reports.daily_avg_price(gold_rows).orderBy("ranking").collect()]
    assert daily == [(date(2024, 4, 5), 6.0, 15.0, 15.0, 1), (date(2024, 2, 1), 6.0, 15.0, 15.0, 2)]


def test_a_message_that_cannot_be_read_does_not_stop_the_others(feed):
    _both(feed)
    feed.land()
    events = feed.tables.read("landing_events")
    broken = events.filter("_entity = 'customers'").limit(1).withColumns({
        "message_id": F.lit("broken"), "data": F.concat(F.lit("["), F.repeat(F.lit("x"), 17_000_000)),
        "publish_time": F.col("publish_time") + F.expr("interval 1 second"),
        "attributes": F.map_concat(F.map_filter("attributes", lambda k, v: ~k.isin(
            "source_path", "audit_id")), F.create_map(
            F.lit("source_path"), F.lit("entity=customers/broken.csv"),
            F.lit("audit_id"), F.lit("broken")))})
    with feed.tables.run() as run:
        run.add("landing_events", broken)
    before = feed.rows("silver_customers", "customer_id")
    silver.refresh_silver_customers(feed.tables)
    assert feed.rows("silver_customers", "customer_id") == before
    aside = feed.tables.read("malformed_records").collect()
    assert [(r["audit_id"], len(r["record"])) for r in aside] == [("broken", 1000)]


def test_withdrawn_files_give_way_to_what_they_replaced(feed):
    feed.put(f"entity=customers/{DAY}/a.csv", "customer_id,customer_name\nC1,Ann\nC2,Bob\n")
    feed.land()
    time.sleep(1.1)
    feed.put(f"entity=customers/{DAY}/b.csv", "customer_id,customer_name\nC1,Wrong\nC3,Eve\n")
    feed.land()
    raw = feed.tables.read("landing_events")
    wrong = raw.filter(F.col("attributes")["source_path"].endswith("b.csv"))
    since = wrong.first()["publish_time"].replace(tzinfo=UTC)
    with feed.tables.run() as run:
        replace_all(run, "landing_events", raw.filter(
            ~F.col("attributes")["source_path"].endswith("b.csv")))
    assert silver.withdraw(feed.tables, "customers", since) == 2
    assert feed.rows("silver_customers", "customer_id", "customer_name") == [
        ("C1", "Ann"), ("C2", "Bob")]
    assert silver.withdraw(feed.tables, "customers", since) == 0
