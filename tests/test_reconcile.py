from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import discover_schema, explode_records, missing_rows, unreadable
from tidemark.operators.running import running_sums, slice_bounds


@pytest.mark.parametrize("group", [None, "day"])
def test_missing_rows(spark, group):
    rng = random.Random(5)
    rows = [(rng.choice([None, *(f"k{i}" for i in range(300))]), rng.choice([None, 1, 2]),
             rng.choice([None, 7, 8])) for _ in range(900)]
    schema = "id string, version int, day int"
    target = [r for r in rows if rng.random() < 0.97]
    target += target[:50]  # copies are no difference of what is there
    for mine, theirs in ((rows, target), (rows, []), ([], rows), (rows, rows[::-1])):
        found = missing_rows(spark.createDataFrame(mine, schema), spark.createDataFrame(
            theirs, schema), ["id", "version", "day"], group, buckets=16)
        assert found.columns == ["id", "version", "day"]
        assert Counter(map(tuple, found.collect())) == Counter(
            r for r in mine if r not in set(theirs))


def test_equal_sums_need_equal_numbers(spark):
    mine, theirs = ["a", "a", "b", "b"], ["c", "c", "d", "d"]  # their exclusive or would be equal
    one = spark.createDataFrame([(x,) for x in mine], "id string")
    other = spark.createDataFrame([(x,) for x in theirs], "id string")
    assert missing_rows(one, other, ["id"], buckets=1).count() == 4


def _plain_running(rows):
    out, total = [], None
    for key in sorted({r[:2] for r in rows}, key=lambda k: [(x is not None, x or "") for x in k]):
        same = [r for r in rows if r[:2] == key]
        values = [r[2] for r in same if r[2] is not None]
        total = total if not values else (total or 0) + sum(values)
        out += [(*r, total) for r in same]
    return Counter(out)


@pytest.mark.parametrize("start", ["T", "a very long common start of all ids "])
def test_running_sums_of_a_heavy_day(spark, start):
    rng = random.Random(6)
    rows = [(day, rng.choice([None, f"{start}{rng.randrange(800):06d}"]),
             rng.choice([None, 1, 2, 5])) for day in ["d1", None, "d3"] + ["d2"] * 60
            for _ in range(20)]
    df = spark.createDataFrame(rows, "day string, id string, value int").repartition(5)
    found = running_sums(df, ["day", "id"], {"total": "value"}, slice_rows=50)
    assert found.columns == ["day", "id", "value", "total"]
    assert Counter(map(tuple, found.collect())) == _plain_running(rows)
    bounds = {r["_day"]: r["_bounds"] for r in slice_bounds(df, "day", ["id"], 50).collect()}
    assert set(bounds) == {"d2"} and len(bounds["d2"]) > 15
    # slices of the heavy day are of about the size asked for, the same whenever they are taken
    ids = sorted(r[1] for r in rows if r[0] == "d2" and r[1])
    places = [sum(i < b["id"] for i in ids) for b in bounds["d2"] if b["id"]]
    assert max(b - a for a, b in zip([0, *places], [*places, len(ids)], strict=True)) < 200
    again = {r["_day"]: r["_bounds"] for r in slice_bounds(
        df.repartition(3), "day", ["id"], 50).collect()}
    assert again == bounds


def test_running_sums_of_days_alone(spark):
    df = spark.createDataFrame([(1, 2), (1, 3), (2, 4), (None, 1)], "day int, v int")
    found = running_sums(df, ["day"], {"t": "v"})
    assert sorted(map(tuple, found.collect()), key=str) == [
        (1, 2, 6), (1, 3, 6), (2, 4, 10), (None, 1, 1)]
    assert running_sums(df.limit(0), ["day"], {"t": "v"}).collect() == []


def test_messages_that_cannot_be_read_are_told_apart(spark):
    broken = "[" + "x" * 17_000_000
    rows = [("good", '[{"a": "1"}]'), ("broken", broken), ("short", "[oops"), ("none", None)]
    df = spark.createDataFrame(rows, "name string, data string")
    assert [r["name"] for r in unreadable(df, ["a"]).collect()] == ["broken"]
    assert [tuple(r) for r in explode_records(df, ["a"], skip_unreadable=True).collect()] == [
        ("good", "1")]
    with pytest.raises(Exception, match="too long to be parsed"):
        explode_records(df, ["a"]).collect()


def test_types_of_fields(spark):
    rows = [('[{"a": 1, "b": "x", "c": {"d": 1}}, 7, "t"]', "one", 2), ('[{"a": "y"}]', "two", 1),
            ('{"a": 5}', "three", 0), ("broken", "four", 0), (None, "five", 0)]
    raw = spark.createDataFrame(rows, "data string, path string, at int").select(
        "data", F.create_map(F.lit("entity"), F.lit("e"), F.lit("source_path"), "path")
        .alias("attributes"), F.timestamp_seconds("at").alias("publish_time"))
    assert sorted((r["field"], r["type"], r["records"], r["first_file"])
                  for r in discover_schema(raw).collect()) == [
        ("a", "VARIANT", 2, "two"), ("b", "STRING", 1, "one"), ("c", "OBJECT<d: BIGINT>", 1, "one")]
