"""What one table has and another lacks, without shuffling what both have."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Cells into which each group of rows is cut by the hash of their identity.
BUCKETS = 1024


def missing_rows(source: DataFrame, target: DataFrame, identity: Sequence[str],
                 group: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Rows of ``source`` whose ``identity`` no row of ``target`` has; nulls are equal.

    Rows of both are put into cells, by ``group`` (such as a date that both are partitioned by) and by
    the hash of the identity. Number and sums of hashes of a cell are combined before the shuffle, so
    it moves one narrow row for each cell and task. Only rows of cells that differ are
    compared one by one. Equal sums of two 64-bit hashes stand for equal cells.
    """
    places = ["_group", "_bucket"]

    def in_cells(df: DataFrame) -> DataFrame:
        return df.withColumns({
            "_group": F.lit(0) if group is None else F.col(group),
            "_bucket": F.pmod(F.xxhash64(*identity), F.lit(buckets))})

    def prints(df: DataFrame) -> DataFrame:
        sums = [F.sum(F.xxhash64(F.lit(lane), *identity).cast("decimal(20,0)")).alias(f"h{lane}")
                for lane in (1, 2)]
        return in_cells(df).groupBy(*places).agg(
            F.struct(F.count(F.lit(1)).alias("n"), *sums).alias("print"))

    def same(left: DataFrame, right: DataFrame, names: Sequence[str]):
        return [left[c].eqNullSafe(right[c]) for c in names]

    there, known = prints(source), prints(target).withColumnRenamed("print", "known")
    differ = (there.join(known, same(there, known, places), "left")
              .filter(~F.col("print").eqNullSafe(F.col("known")))
              .select(there["_group"], there["_bucket"]))

    def open_cells(df: DataFrame) -> DataFrame:
        cells = in_cells(df)
        return cells.join(differ, same(cells, differ, places), "left_semi").drop(*places)

    mine, theirs = open_cells(source), open_cells(target.select(
        *identity, *([group] if group and group not in identity else [])))
    return mine.join(theirs, same(mine, theirs, identity), "left_anti")
