"""The reports as views for SQL users."""

from __future__ import annotations

from tidemark.functions import register_sql_functions
from tidemark.functions.measures import STATUSES
from tidemark.operators.running import _SHADES, SAMPLED, SLICE_ROWS
from tidemark.sources.tables import Tables

_BREAKDOWN = ", ".join([
    "count(*) AS total",
    *[f"count_if(transaction_status = '{s}') AS total_{s}" for s in STATUSES],
    "sum(transaction_amount) AS amount_total",
    *[f"sum(CASE WHEN transaction_status = '{s}' THEN transaction_amount ELSE 0 END) AS amount_{s}"
      for s in STATUSES]])

_MONTHLY = f"""
WITH monthly AS (
  SELECT CAST(date_trunc('MONTH', transaction_date) AS DATE) AS month, {_BREAKDOWN}
  FROM gold_transactions GROUP BY 1),
ranked AS (SELECT *, dense_rank() OVER (ORDER BY month DESC) AS latest FROM monthly)
SELECT * EXCEPT (latest),
       try_divide(CAST(total_rejected AS DOUBLE), CAST(total AS DOUBLE)) AS rate_rejected_total,
       try_divide(amount_rejected, amount_total) AS rate_rejected_amount
FROM ranked WHERE latest <= 12"""

_QUARTER = f"""
SELECT customer_name, {_BREAKDOWN} FROM gold_transactions
WHERE transaction_date >= (
  SELECT date_trunc('QUARTER', max(transaction_date)) FROM gold_transactions)
GROUP BY customer_name"""


def _sum(*parts: str) -> str:
    """Sum of the parts that are not null; null if none is."""
    total = " + ".join(f"coalesce({p}, 0)" for p in parts)
    return f"CASE WHEN coalesce({', '.join(parts)}) IS NOT NULL THEN {total} END"


# Gold stores doubles, whose sums depend on the order of rows. Amounts below ten million of up to 4
# places are added up as decimals, without error; all others are added up as doubles beside them.
_PLACES = "DECIMAL(11, 4)"
_TOTAL = "DECIMAL(34, 8)"  # holds a million million rows; three of these add up without losing a place
_SUMMED = ("q", "q_rest", "c", "c_rest")


def _sums(over: str = "") -> str:
    """The sums of quantity and cost, each in its two parts."""
    whole = {"q": _TOTAL, "c": _TOTAL, "q_rest": "DOUBLE", "c_rest": "DOUBLE"}
    return ", ".join(f"CAST(sum({m}){over} AS {whole[m]}) AS {m}" for m in _SUMMED)


def _total(measure: str, *levels: str) -> str:
    """The sum of a measure's two parts over some levels."""
    exact, rest = ([f"{at}.{part}" for at in levels] for part in (measure, f"{measure}_rest"))
    return _sum(f"CAST({_sum(*exact)} AS DOUBLE)", _sum(*rest))


# The running sum is taken in three levels: in each slice of a day's ids, over a day's slices, over
# the days. A day of over a million rows has slices of about that many, whose bounds are taken at
# equal steps from ids drawn by their hash, as in ``operators.running``.
_DAILY = f"""
WITH openings AS (
  SELECT min(struct(transaction_date, transaction_id, is_buy, if(is_buy, qtty, NULL) AS qtty,
                    if(is_buy, price, NULL) AS price)) AS first
  FROM (SELECT *, coalesce(transaction_status = 'approved' AND transaction_type = 'buy', FALSE)
               AS is_buy FROM gold_transactions)
  GROUP BY customer_id),
moves AS (
  SELECT transaction_date, transaction_id, qtty, price, 1 AS n FROM gold_transactions
  WHERE transaction_status = 'approved' AND transaction_type = 'buy'
  UNION ALL
  SELECT first.transaction_date, first.transaction_id, first.qtty, first.price, -1
  FROM openings WHERE first.is_buy),
later AS (
  SELECT transaction_date AS day, transaction_id AS id, qtty, price, sum(n) AS n,
         try_cast(sum(n) AS INT) AS copies, try_cast(qtty AS {_PLACES}) AS places_of_qtty,
         try_cast(price AS {_PLACES}) AS places_of_price
  FROM moves GROUP BY transaction_date, transaction_id, qtty, price HAVING sum(n) > 0),
exact AS (
  SELECT day, id, n * qtty AS q_double, n * (qtty * price) AS c_double,
         if(CAST(places_of_qtty AS DOUBLE) = qtty, copies * places_of_qtty, NULL) AS q,
         if(CAST(places_of_qtty AS DOUBLE) = qtty AND CAST(places_of_price AS DOUBLE) = price,
            copies * (places_of_qtty * places_of_price), NULL) AS c
  FROM later),
costed AS (
  SELECT day, id, q, c, if(q IS NULL, q_double, NULL) AS q_rest,
         if(c IS NULL, c_double, NULL) AS c_rest
  FROM exact),
heavy AS (
  SELECT day, count(*) AS n, CAST(ceil(count(*) / {SLICE_ROWS}) AS INT) AS k FROM costed
  GROUP BY day HAVING count(*) > {SLICE_ROWS}),
drawn AS (
  SELECT h.day, array_sort(collect_set(id)) AS ids, max(k) AS k
  FROM costed c JOIN heavy h ON c.day <=> h.day
  WHERE pmod(xxhash64(id), {_SHADES}L) < k * {SAMPLED} / n * {_SHADES}L GROUP BY h.day),
bounds AS (
  SELECT day, array_distinct(transform(sequence(1, k - 1), i ->
         get(ids, CAST(floor(i * size(ids) / k) AS INT)))) AS cuts FROM drawn),
sliced AS (
  SELECT c.*, CASE WHEN cuts IS NULL THEN 0 ELSE size(filter(cuts, b -> b <= id)) END AS slice
  FROM costed c LEFT JOIN bounds b ON c.day <=> b.day),
inside AS (
  SELECT day, slice, {_sums(" OVER ids")} FROM sliced
  WINDOW ids AS (PARTITION BY day, slice ORDER BY id)),
slices AS (SELECT day, slice, {_sums()} FROM sliced GROUP BY day, slice),
before_slices AS (
  SELECT day, slice, {_sums(" OVER earlier")} FROM slices
  WINDOW earlier AS (PARTITION BY day ORDER BY slice
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
days AS (SELECT day, {_sums()} FROM slices GROUP BY day),
before_days AS (
  SELECT day, {_total("q", "days")} AS day_q, {_total("c", "days")} AS day_c,
         {_sums(" OVER earlier")} FROM days
  WINDOW earlier AS (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
highest AS (
  SELECT i.day, max(try_divide({_total("c", "i", "s", "d")}, {_total("q", "i", "s", "d")})) AS value
  FROM inside i JOIN before_slices s ON i.day <=> s.day AND i.slice <=> s.slice
       JOIN before_days d ON i.day <=> d.day
  GROUP BY i.day)
SELECT d.day AS transaction_date, day_q AS buy_qtty, try_divide(day_c, day_q) AS daily_avg_price,
       last_value(value) IGNORE NULLS OVER (ORDER BY d.day) AS running_avg_price,
       CAST(row_number() OVER (ORDER BY d.day DESC) AS BIGINT) AS ranking
FROM before_days d JOIN highest h ON d.day <=> h.day"""

VIEWS = {
    "transactions_monthly_ttm_vw": _MONTHLY,
    "transactions_customers_last_quarter_vw": _QUARTER,
    "transactions_daily_avg_price_vw": _DAILY,
}


def register_views(tables: Tables, database: str | None = None) -> list[str]:
    """Offer gold, the three reports and the id function in SQL; returns the names of the views.

    With ``database`` they are views of the catalog, which other sessions read and which last as
    long as it does, beside those of all tables; else temporary views of this session. The reports are
    SQL text over the view of gold, which each change of gold renews, also from empty.
    """
    spark, gold = tables.spark, "gold_transactions"
    if database is None:
        tables.show([gold])
        register_sql_functions(spark)
        for view, text in VIEWS.items():
            spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {view} AS {text}")
        return [gold, *VIEWS]
    tables.register(database)
    register_sql_functions(spark, database)
    for view, text in VIEWS.items():
        text = text.replace(gold, f"{database}.{gold}")
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{view} AS {text}")
    return [f"{database}.{name}" for name in (gold, *VIEWS)]
