from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import functions as F

from tidemark.operators import latest_per_path, new_events, watermark
from tidemark.operators.incremental import EPOCH

NOW = datetime(2026, 3, 25, 12, tzinfo=UTC)


def _target(spark, rows):
    return spark.createDataFrame(
        [(i, (p,)) for i, p in rows],
        "_ingested_at timestamp, _metadata struct<publish_time: timestamp>")


def _raw(spark, rows):
    made = [(m, p, d, {"entity": e, "audit_id": f"a-{m}", "source_path": path,
                       "source_file": "f.csv", "ingested_at": i, **extra})
            for m, p, d, e, path, i, extra in rows]
    return spark.createDataFrame(
        made, "message_id string, publish_time timestamp, data string, "
              "attributes map<string,string>")


def test_mark_is_the_epoch_for_an_empty_or_idle_target(spark):
    assert watermark(_target(spark, []), "_metadata.publish_time", NOW) == EPOCH
    old = _target(spark, [(NOW - timedelta(days=7, seconds=1), NOW), (None, NOW)])
    assert watermark(old, "_metadata.publish_time", NOW) == EPOCH


def test_mark_is_the_latest_recent_value(spark):
    precise = NOW - timedelta(days=3, microseconds=7)
    rows = [(NOW - timedelta(days=7), precise), (NOW - timedelta(days=9), NOW),
            (NOW, NOW - timedelta(days=5))]
    assert watermark(_target(spark, rows), "_metadata.publish_time", NOW) == precise
    dated = _target(spark, rows).withColumn("_ingested_date", F.to_date("_ingested_at"))
    assert watermark(dated, "_metadata.publish_time", NOW) == precise
    assert watermark(dated, "_ingested_at", NOW) == NOW


def test_events_at_the_mark_are_skipped(spark):
    iso = NOW.isoformat()
    raw = _raw(spark, [("1", NOW, "[]", "customers", "p", iso, {}),
                       ("2", NOW + timedelta(microseconds=1), "[]", "customers", "p", "bad", {}),
                       ("3", NOW + timedelta(days=1), "[]", "transactions", "p", iso, {})])
    found = new_events(raw, "customers", NOW).collect()
    assert [(r["message_id"], r["ingested_at"], r["part"]) for r in found] == [("2", None, 0)]
    dated = raw.withColumns({"_publish_date": F.to_date("publish_time"),
                             "_entity": F.col("attributes")["entity"]})
    assert [r["message_id"] for r in new_events(dated, "customers", NOW).collect()] == ["2"]


def test_newest_file_of_a_path_with_all_its_parts(spark):
    t0, t1 = NOW.isoformat(), (NOW + timedelta(hours=1)).isoformat()
    raw = _raw(spark, [
        ("old", NOW, "x", "customers", "p", t0, {}),
        ("new-0", NOW, "x", "customers", "p", t1, {"part": "0", "audit_id": "big"}),
        ("new-5", NOW, "x", "customers", "p", t1, {"part": "5", "audit_id": "big"}),
        ("new-5", NOW, "x", "customers", "p", t1, {"part": "5", "audit_id": "big"}),
        ("tie-a", NOW, "x", "customers", "q", t0, {}),
        ("tie-b", NOW + timedelta(seconds=1), "x", "customers", "q", t0, {}),
        ("none", NOW, "x", "customers", "r", "not a time", {}),
        ("some", NOW, "x", "customers", "r", t0, {}),
        ("alone", NOW, "x", "customers", "s", "not a time", {}),
    ]).withColumn("_row", F.monotonically_increasing_id()).withColumn("_file", F.lit("f"))
    events = new_events(raw, "customers", EPOCH)
    found = latest_per_path(events, ("_file", "_row"))
    assert sorted(r["message_id"] for r in found.collect()) == [
        "alone", "new-0", "new-5", "some", "tie-b"]


def test_a_path_with_most_messages_is_reduced_before_the_shuffle(spark):
    rows = [(str(i), NOW, "x", "customers", "hot" if i % 3 else f"p{i}", NOW.isoformat(), {})
            for i in range(300)]
    events = new_events(_raw(spark, rows), "customers", EPOCH)
    found = latest_per_path(events)
    assert found.count() == 101
    plan = found._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    assert "partial_max" in physical
