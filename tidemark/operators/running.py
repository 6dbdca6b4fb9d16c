"""Running sums over one global order, without sorting everything in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a slice, about; a day of fewer rows is one slice.
SLICE_ROWS = 1_000_000
#: Ids that are looked at for each slice, to find its bounds.
SAMPLED = 100
_SHADES = 1 << 40


def _plus(*sums: Column) -> Column:
    # NULL means that no value has been seen yet, which is not the same as zero.
    total = sum((F.coalesce(s, F.lit(0)) for s in sums[1:]), F.coalesce(sums[0], F.lit(0)))
    return F.when(F.coalesce(*sums).isNotNull(), total)


def slice_bounds(df: DataFrame, day: str, rest: Sequence[str],
                 slice_rows: int = SLICE_ROWS) -> DataFrame:
    """For each day of more than ``slice_rows`` rows, the values of ``rest`` that cut it into slices
    of about that many rows.

    Bounds are taken at equal steps from a sample: the values whose hash falls below a share that
    follows from the day's number of rows. So they depend on the rows alone, not on how tasks come
    upon them, and a lost task finds the same ones. A sample has some ``SAMPLED`` values a slice.
    """
    heavy = df.groupBy(F.col(day).alias("_day")).agg(F.count(F.lit(1)).alias("_rows")).filter(
        F.col("_rows") > slice_rows).withColumn("_slices", F.ceil(F.col("_rows") / slice_rows))
    share = F.col("_slices") * SAMPLED / F.col("_rows")
    drawn = F.pmod(F.xxhash64(*rest), F.lit(_SHADES)) < share * _SHADES
    value = F.struct(*rest)
    # one row for each heavy day, and below one bound for each slice: rows / slice_rows at most
    picked = (df.join(F.broadcast(heavy), F.col(day).eqNullSafe(F.col("_day"))).filter(drawn)
              .groupBy("_day").agg(F.array_sort(F.collect_set(value)).alias("_sample"),
                                   F.max("_slices").alias("_slices")))
    steps = F.sequence(F.lit(1), F.col("_slices").cast("int") - 1)
    cuts = F.transform(steps, lambda i: F.get(
        "_sample", F.floor(i * F.size("_sample") / F.col("_slices")).cast("int")))
    return picked.select("_day", F.array_distinct(cuts).alias("_bounds"))


def running_sums(df: DataFrame, order: Sequence[str], measures: dict[str, str],
                 slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Add ``sum(measure) over (order by ...)`` columns; rows equal in ``order`` share a value.

    ``measures`` maps each new column to the column it sums. The first column of ``order`` is the day
    (any value with many rows), the others order the rows of a day. The sum is taken in three levels:
    inside a slice of a day, over the slices of a day, and over the days. Only the first one sees rows;
    the others see one row for each slice and each day. Nothing is written: the bounds of slices are
    the same whenever they are computed. All of a day's rows that are equal in ``order`` lie in one
    slice.
    """
    day, rest = order[0], list(order[1:])
    if rest:
        bounds = slice_bounds(df, day, rest, slice_rows)
        value = F.struct(*rest)
        below = F.size(F.filter("_bounds", lambda b: b <= value))
        sliced = df.join(F.broadcast(bounds), F.col(day).eqNullSafe(F.col("_day")), "left").withColumn(
            "_slice", F.when(F.col("_bounds").isNull(), 0).otherwise(below)).drop("_day", "_bounds")
    else:
        sliced = df.withColumn("_slice", F.lit(0))
    names = list(measures.values())
    slices = sliced.groupBy(F.col(day).alias("_day"), F.col("_slice").alias("_of")).agg(
        *[F.sum(m).alias(m) for m in dict.fromkeys(names)])
    days = slices.groupBy("_day").agg(*[F.sum(m).alias(m) for m in dict.fromkeys(names)])
    unbounded = Window.unboundedPreceding
    in_day = Window.partitionBy("_day").orderBy("_of").rowsBetween(unbounded, -1)
    by_day = Window.orderBy("_day").rowsBetween(unbounded, -1)  # day rows only: few
    before_slices = slices.select("_day", "_of", *[
        F.sum(m).over(in_day).alias(f"_slices_{m}") for m in dict.fromkeys(names)])
    before_days = days.select(F.col("_day").alias("_that_day"), *[
        F.sum(m).over(by_day).alias(f"_days_{m}") for m in dict.fromkeys(names)])
    before = before_slices.join(before_days, F.col("_day").eqNullSafe(F.col("_that_day")))
    within = Window.partitionBy(day, "_slice")
    within = within.orderBy(*rest) if rest else within
    summed = sliced.withColumns({f"_within_{m}": F.sum(m).over(within) for m in names})
    both = summed.join(before, F.col(day).eqNullSafe(F.col("_day"))
                       & (F.col("_slice") == F.col("_of")))
    return both.select(*df.columns, *[
        _plus(F.col(f"_days_{m}"), F.col(f"_slices_{m}"), F.col(f"_within_{m}")).alias(name)
        for name, m in measures.items()])
