from __future__ import annotations

import math
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import consolidate, running_sums
from tidemark.plans import reports

SCHEMA = ("transaction_id string, customer_id string, customer_name string, "
          "transaction_date date, transaction_amount double, transaction_status string, "
          "transaction_type string, qtty double, price double")


def _gold(spark, rows):
    """Rows as (id, customer, date, status, type, qtty, price[, amount, name])."""
    made = []
    for r in rows:
        i, who, day, status, kind, qtty, price, *rest = r
        amount, name = (rest + [1.0, who][len(rest):])[:2]
        made.append((i, who, name, day, amount, status, kind, qtty, price))
    return spark.createDataFrame(made, SCHEMA)


def _null_first(value):
    return (value is not None, value or "")


def _divide(a, b):
    return None if a is None or b in (None, 0) else a / b


def _add(a, b):
    return b if a is None else a if b is None else a + b


def daily_model(rows):
    """The daily report, row by row."""
    order = sorted(rows, key=lambda r: (_null_first(r[2]) if r[2] is None else (True, r[2]),
                                        _null_first(r[0])))
    seen, later = set(), []
    for r in order:
        if r[1] in seen:
            later.append(r)
        seen.add(r[1])
    buys = [r for r in later if r[3] == "approved" and r[4] == "buy"]
    cost = [None if r[5] is None or r[6] is None else r[5] * r[6] for r in buys]
    running, c, q = {}, None, None
    for r, x in zip(buys, cost, strict=True):
        c, q = _add(c, x), _add(q, r[5])
        running[(r[2], r[0])] = _divide(c, q)  # the last of equal rows stands for all
    days, carried, out = {}, None, []
    for r, x in zip(buys, cost, strict=True):
        day = days.setdefault(r[2], {"q": None, "c": None, "high": None})
        day["q"], day["c"] = _add(day["q"], r[5]), _add(day["c"], x)
        value = running[(r[2], r[0])]
        if value is not None and (day["high"] is None or value > day["high"]):
            day["high"] = value
    ordered = sorted(days, key=lambda d: (d is not None, d or date.min))
    for place, d in enumerate(ordered):
        carried = days[d]["high"] if days[d]["high"] is not None else carried
        out.append((d, days[d]["q"], _divide(days[d]["c"], days[d]["q"]), carried,
                    len(ordered) - place))
    return out


def _same(found, expected):
    assert len(found) == len(expected)
    for f, e in zip(found, expected, strict=True):
        for a, b in zip(f, e, strict=True):
            if isinstance(b, float):
                assert a is not None and math.isclose(a, b, rel_tol=1e-9), (f, e)
            else:
                assert a == b, (f, e)


def _daily(spark, rows):
    report = reports.daily_avg_price(_gold(spark, rows))
    return [tuple(r) for r in report.orderBy(F.asc_nulls_first("transaction_date")).collect()]


D = date(2024, 1, 1)


def test_daily_rules(spark):
    rows = [
        ("t0", "a", D, "rejected", "sell", 1.0, 1.0),  # opening, of whatever kind
        ("t1", "a", D, "approved", "buy", 2.0, 10.0),
        ("t2", "a", D, "approved", "buy", 2.0, 4.0),  # cheaper: the day keeps its higher value
        ("t3", "a", D, "approved", "sell", 9.0, 9.0),
        ("t4", "b", D + timedelta(2), "approved", "buy", 50.0, 50.0),  # opening
        ("t5", "b", D + timedelta(3), "approved", "buy", 4.0, None),  # adds to quantity only
        ("t6", None, D, "approved", "buy", 7.0, 7.0),  # no customer: one group, opening
        ("t7", None, D + timedelta(4), "approved", "buy", 1.0, 1.0),
        ("t8", "a", None, "pending", "buy", 1.0, 1.0),  # no date sorts first: opening of a
        ("t9", "c", None, "approved", "buy", 1.0, 1.0),
        ("u1", "c", None, "approved", "buy", 0.0, 5.0),  # no quantity: average unknown
    ]
    found = _daily(spark, rows)
    _same(found, daily_model(rows))
    assert found[0][:4] == (None, 0.0, None, None)


def test_current_average_is_that_of_the_last_day(spark):
    rows = [("t0", "a", D, "approved", "buy", 1.0, 1.0),
            ("t1", "a", D, "approved", "buy", 1.0, 2.0),
            ("t2", "a", D + timedelta(1), "approved", "buy", 1.0, 4.0)]
    assert reports.current_avg_price(_gold(spark, rows)).first()["running_avg_price"] == 3.0
    assert reports.current_avg_price(_gold(spark, [])).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_daily_against_the_model(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(120):
        hot = rng.random() < 0.4  # one day holds a large share
        day = D if hot else rng.choice([None, *(D + timedelta(days=d) for d in range(9))])
        rows.append((f"t{i:03d}", rng.choice(["a", "b", "c", None]), day,
                     rng.choice(["approved", "approved", "rejected", None]),
                     rng.choice(["buy", "buy", "sell", None]),
                     rng.choice([None, 0.0, 1.5, 2.0, 8.0]), rng.choice([None, 0.1, 3.0, 70.0])))
    rng.shuffle(rows)
    _same(_daily(spark, rows), daily_model(rows))


def test_equal_rows_are_taken_out_one_at_a_time(spark):
    same = (None, "a", D, "approved", "buy", 2.0, 3.0)
    left = reports.later_buys(_gold(spark, [same] * 5)).collect()
    assert [(r["copies"], r["qtty"]) for r in left] == [(4, 2.0)]


@pytest.mark.parametrize("partitions", ["1", "8"])
def test_running_sums_equal_the_direct_window(spark, partitions):
    rng = random.Random(7)
    rows = [(rng.choice([None, 1, 1, 1, 2, 3]), rng.choice([None, *"abcdefghij"]),
             rng.choice([None, *range(9)])) for _ in range(400)]
    df = spark.createDataFrame(rows, "d int, i string, x int")
    saved = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = running_sums(df, ["d", "i"], {"total": "x"}).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", saved)
    direct = df.withColumn("total", F.sum("x").over(Window.orderBy("d", "i"))).collect()
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, direct), key=str)


def test_monthly_rules(spark):
    months = [date(2023, m, 3) for m in (1, 2, 4, 5, 6, 7, 8, 9, 10, 11, 12)]
    months += [date(2024, 1, 9), date(2024, 3, 9), None]
    rows = [(f"t{i}", "a", d, "approved", "buy", 1.0, 1.0, 2.0) for i, d in enumerate(months)]
    rows += [("x1", "a", date(2024, 3, 1), "rejected", "buy", 1.0, 1.0, 6.0),
             ("x2", "a", date(2024, 3, 31), "other", "buy", 1.0, 1.0, 1.0),
             ("x3", "a", date(2024, 3, 31), None, "buy", 1.0, 1.0, 1.0),
             ("x4", "a", date(2024, 3, 31), "pending", "buy", 1.0, 1.0, None),
             ("x5", "a", date(2024, 1, 9), "rejected", "buy", 1.0, 1.0, -2.0)]
    found = {r["month"]: r for r in reports.monthly_ttm(_gold(spark, rows)).collect()}
    assert len(found) == 12 and date(2023, 1, 1) not in found and None not in found
    assert date(2024, 2, 1) not in found and date(2023, 2, 1) in found
    march = found[date(2024, 3, 1)].asDict()
    assert march == {
        "month": date(2024, 3, 1), "total": 5, "total_approved": 1, "total_pending": 1,
        "total_rejected": 1, "amount_total": 10.0, "amount_approved": 2.0,
        "amount_pending": 0.0, "amount_rejected": 6.0, "rate_rejected_total": 0.2,
        "rate_rejected_amount": 0.6}
    assert found[date(2024, 1, 1)]["rate_rejected_amount"] is None
    few = reports.monthly_ttm(_gold(spark, [rows[0], rows[13]])).collect()
    assert {r["month"] for r in few} == {date(2023, 1, 1), None}


def test_last_quarter_rules(spark):
    rows = [("1", "a", date(2023, 9, 30), "approved", "buy", 1.0, 1.0, 5.0, "Ann"),
            ("2", "a", date(2023, 10, 1), "approved", "buy", 1.0, 1.0, 5.0, "Ann"),
            ("3", "b", date(2023, 12, 31), "rejected", "buy", 1.0, 1.0, 7.0, "Ann"),
            ("4", "c", date(2023, 11, 1), "pending", "buy", 1.0, 1.0, 1.0, None),
            ("5", "d", None, "pending", "buy", 1.0, 1.0, 1.0, "Dan")]
    found = {r["customer_name"]: r for r in
             reports.customers_last_quarter(_gold(spark, rows)).collect()}
    assert set(found) == {"Ann", None}
    assert (found["Ann"]["total"], found["Ann"]["amount_total"]) == (2, 12.0)
    assert found["Ann"]["amount_rejected"] == 7.0 and found[None]["total_pending"] == 1
    assert reports.customers_last_quarter(_gold(spark, rows[4:])).collect() == []


def test_consolidated_rows_are_in_file_order(spark):
    first = spark.createDataFrame(
        [("T3", "C2", "pending"), ("T1", "C10", "approved"), ("T2", "C2", "approved"),
         ("T0", "C2", "approved"), ("T9", "C1", "approved")],
        "transaction_id string, customer_id string, transaction_status string")
    second = spark.createDataFrame([(f"T{i}", float(i)) for i in range(5)],
                                   "transaction_id string, qtty double")
    found = [(r["transaction_id"], r["qtty"]) for r in consolidate(first, second).collect()]
    assert found == [("T1", 1.0), ("T0", 0.0), ("T2", 2.0), ("T3", 3.0)]
