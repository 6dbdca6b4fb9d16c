from __future__ import annotations

from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark import functions as fn


def _apply(spark, values, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["r"] for r in df.select("i", make(F.col("v")).alias("r")).orderBy("i").collect()]


def test_customer_ids_lose_their_padding(spark):
    ids = ["C01", "D001", "C10", None, "C00", "1234", "0012", "C-07"]
    expected = ["C1", "D1", "C10", None, "C0", "1234", "012", "C-7"]
    assert _apply(spark, ids, fn.normalize_customer_id) == expected
    fn.register_sql_functions(spark)
    sql = _apply(spark, ids, lambda v: F.call_function("func_normalize_customer_id", v))
    assert sql == expected


@pytest.mark.parametrize("bad", ["", "C", "CAB", "C5.7", "C99999999999999999999"])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_malformed_customer_ids(spark, bad, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="malformed customer id"):
            _apply(spark, [bad], fn.normalize_customer_id)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert _apply(spark, [bad], lambda v: fn.normalize_customer_id(v, "quarantine")) == [None]
    assert _apply(spark, [bad, "C1", None], fn.well_formed_customer_id) == [False, True, True]


def test_safe_date(spark):
    values = ["2023-09-01", "2023-9-1", "2023-02-30", "x", "", None, "2023", "2023-01-05T",
              " 2023-01-05"]
    day = date(2023, 9, 1)
    assert _apply(spark, values, fn.safe_date) == [day, day] + [None] * 7


def test_safe_double(spark):
    values = ["64.0", "1e3", "-.5", "7.", "+2", "1,5", "", "x", None, "1.5d", "2f", " 7", "1e999"]
    expected = [64.0, 1000.0, -0.5, 7.0, 2.0] + [None] * 8
    assert _apply(spark, values, fn.safe_double) == expected
    assert _apply(spark, ["inf", "-Infinity"], fn.safe_double) == [float("inf"), -float("inf")]
    assert str(_apply(spark, ["NaN"], fn.safe_double)[0]) == "nan"


def test_safe_timestamp(spark):
    values = ["2026-03-25T12:00:00.123456+00:00", "2026-03-25 14:00:00+02:00", "2026-03-25",
              "x", None, "2026", "2026-13-01"]
    micros = _apply(spark, values, lambda v: F.unix_micros(fn.safe_timestamp(v)))

    def at(*parts):
        return int(datetime(*parts, tzinfo=UTC).timestamp()) * 1_000_000

    assert micros == [at(2026, 3, 25, 12) + 123456, at(2026, 3, 25, 12), at(2026, 3, 25),
                      None, None, None, None]


def test_empty_to_null_and_ratio(spark):
    assert _apply(spark, ["", "a", None], fn.empty_to_null) == [None, "a", None]
    row = spark.range(1).select(
        fn.ratio(F.lit(1), F.lit(4)).alias("a"), fn.ratio(F.lit(1), F.lit(0)).alias("b"),
        fn.ratio(F.lit(None).cast("double"), F.lit(2)).alias("c")).first()
    assert tuple(row) == (0.25, None, None)
