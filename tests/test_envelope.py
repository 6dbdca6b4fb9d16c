from __future__ import annotations

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tidemark.operators import discover_fields, explode_records


def _explode(spark, payloads, foreign=False):
    df = spark.createDataFrame(list(enumerate(payloads)), "id int, data string")
    return sorted((tuple(r) for r in
                   explode_records(df, ["a", "b"], foreign=foreign).collect()), key=str)


def test_records_become_rows(spark):
    assert _explode(spark, ['[{"a":"1"},{"b":"x","a":"007","c":"new"}]']) == [
        (0, "007", "x"), (0, "1", None)]


def test_payloads_that_are_no_arrays_give_nothing(spark):
    assert _explode(spark, ["[]", None, "nope", '{"a":"1"}', ' {"a":"1"}', '[{"a":"1"', ""]) == []


def test_an_element_that_is_no_object_is_an_empty_record(spark):
    assert _explode(spark, ['[1,{"a":"z"},"t",null]', ' [{"a":"1"}]']) == sorted([
        (0, None, None), (0, None, None), (0, None, None), (0, "z", None), (1, "1", None)],
        key=str)


def test_nested_values_of_foreign_payloads_are_null(spark):
    payload = '[{"a":{"x":1},"b":"[kept]"},{"a":[1],"b":5},{"b":true,"a":null},3]'
    assert _explode(spark, [payload, "nope", '{"a":"1"}'], foreign=True) == sorted([
        (0, None, "[kept]"), (0, None, "5"), (0, None, "true"), (0, None, None)], key=str)


def test_text_that_looks_nested_is_kept(spark):
    assert _explode(spark, ['[{"a":"{not json","b":"[1]"}]']) == [(0, "{not json", "[1]")]


def test_discovered_fields(spark):
    raw = spark.createDataFrame([
        Row(data='[{"a":"1","b":""},{"a":"2","null":["s","t"]}]', attributes={"entity": "x"}),
        Row(data='[{"a":"3"}]', attributes={"entity": "y"}),
        Row(data="[]", attributes={"entity": "y"})])
    assert {tuple(r) for r in discover_fields(raw).collect()} == {
        ("x", "a", 2), ("x", "b", 1), ("x", "null", 1), ("y", "a", 1)}


def test_white_space_and_elements_that_are_no_objects(spark):
    payloads = ['\n[{"a":"1"}]', '\t [{"a":"1"},2]', '\r\n[ {"a":"1"} , "x"]']
    events = spark.createDataFrame([(p, {"entity": "customers"}) for p in payloads],
                                   "data string, attributes map<string,string>")
    for foreign in (False, True):
        found = explode_records(events, ["a"], foreign=foreign).select("a").collect()
        assert sorted((r["a"] or "") for r in found) == ["", "", "1", "1", "1"]
    assert [tuple(r) for r in discover_fields(events).collect()] == [("customers", "a", 3)]


@pytest.mark.parametrize("foreign", [False, True])
def test_very_long_values_are_kept_or_refused(spark, foreign):
    def message(size):
        return spark.range(1).select(F.concat(
            F.lit('[{"a":"'), F.repeat(F.lit("x"), size), F.lit('"}]')).alias("data"))

    kept = explode_records(message(19_000_000), ["a"], foreign=foreign)
    assert kept.select(F.length("a")).first()[0] == 19_000_000
    with pytest.raises(Exception, match="too long"):
        explode_records(message(21_000_000), ["a"], foreign=foreign).collect()
