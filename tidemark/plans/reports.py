"""The analytic reports over the gold table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import month_start, quarter_start, ratio, status_breakdown
from tidemark.functions.measures import amount_where
from tidemark.operators import running_sums


def monthly_ttm(gold: DataFrame, months: int = 12) -> DataFrame:
    """Volume, value and rejection rates of the latest months that have transactions."""
    rejected = F.col("transaction_status") == "rejected"
    monthly = (gold.groupBy(month_start("transaction_date").alias("month"))
               .agg(*status_breakdown(),
                    ratio(F.count_if(rejected), F.count(F.lit(1))).alias("rate_rejected_total"),
                    ratio(amount_where("rejected"), F.sum("transaction_amount"))
                    .alias("rate_rejected_amount")))
    latest = F.dense_rank().over(Window.orderBy(F.desc("month")))  # month rows only: few
    return monthly.withColumn("_latest", latest).filter(F.col("_latest") <= months).drop("_latest")


def customers_last_quarter(gold: DataFrame) -> DataFrame:
    """Volume and value per customer name in the latest quarter that has transactions."""
    quarter = gold.select(quarter_start(F.max("transaction_date"))).scalar()
    # Nothing is later than the latest quarter, so its start alone selects it.
    return (gold.filter(F.col("transaction_date") >= quarter)
            .groupBy("customer_name").agg(*status_breakdown()))


def _is_approved_buy() -> Column:
    return (F.col("transaction_status") == "approved") & (F.col("transaction_type") == "buy")


def first_transactions(gold: DataFrame) -> DataFrame:
    """The opening transaction of each customer, of whatever status and type.

    A combinable minimum instead of a window: a customer with a third of all rows is reduced to
    one row per input partition before the shuffle. Customers without id count as one customer.
    """
    buy = F.coalesce(_is_approved_buy(), F.lit(False))
    first = F.min(F.struct(
        "transaction_date", "transaction_id", buy.alias("is_buy"),
        F.when(buy, F.col("qtty")).alias("qtty"), F.when(buy, F.col("price")).alias("price")))
    return gold.groupBy("customer_id").agg(first.alias("first")).select("customer_id", "first.*")


def later_buys(gold: DataFrame) -> DataFrame:
    """Approved buys without the opening transactions, as (date, id, qtty, price, copies).

    Openings are rows of the same table, so taking them out is a difference of bags: equal rows
    are counted, openings count negative. This joins nothing and keeps one shuffle, on a key
    that spreads hot days and hot customers, and copies are counted before the shuffle.
    """
    key = ["transaction_date", "transaction_id", "qtty", "price"]
    buys = gold.filter(_is_approved_buy()).select(*key, F.lit(1).alias("n"))
    openings = first_transactions(gold).filter("is_buy").select(*key, F.lit(-1).alias("n"))
    return (buys.unionByName(openings).groupBy(*key)
            .agg(F.sum("n").alias("copies")).filter(F.col("copies") > 0))


def running_avg_price(gold: DataFrame) -> DataFrame:
    """Average price so far, at each later approved buy in the order of date and id."""
    costed = later_buys(gold).select(
        "transaction_date", "transaction_id",
        (F.col("copies") * F.col("qtty")).alias("qtty"),
        (F.col("copies") * (F.col("qtty") * F.col("price"))).alias("total_cost"))
    summed = running_sums(costed, ["transaction_date", "transaction_id"],
                          {"_cost": "total_cost", "_qtty": "qtty"})
    return (summed.withColumn("running_avg_price", ratio(F.col("_cost"), F.col("_qtty")))
            .drop("_cost", "_qtty"))


def daily_avg_price(gold: DataFrame) -> DataFrame:
    """Bought quantity, average price of the day, and the running average, day by day."""
    days = running_avg_price(gold).groupBy("transaction_date").agg(
        F.sum("qtty").cast("double").alias("buy_qtty"),
        ratio(F.sum("total_cost"), F.sum("qtty")).alias("daily_avg_price"),
        F.max("running_avg_price").alias("_highest"))
    by_day = Window.orderBy("transaction_date")  # day rows only: few
    return days.select(
        "transaction_date", "buy_qtty", "daily_avg_price",
        F.last("_highest", ignorenulls=True).over(by_day).alias("running_avg_price"),
        F.row_number().over(Window.orderBy(F.desc("transaction_date"))).cast("bigint")
        .alias("ranking"))


def current_avg_price(gold: DataFrame) -> DataFrame:
    """The row of the latest day: its running average is the current average price."""
    return daily_avg_price(gold).filter(F.col("ranking") == 1)
