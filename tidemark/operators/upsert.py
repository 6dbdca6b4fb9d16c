"""Versioned upsert: a newer version replaces the row of its key, an unknown key is inserted.

A source row replaces a target row only if its version is strictly newer. Rows without a key
match nothing and are always inserted. A row without a version is inserted but replaces nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialized

_CHOICES = ("error", "insert")


def newest_per_key(source: DataFrame, key: str, version: str = "_ingested_at",
                   newer: Sequence[Column] = (), on_duplicate: str = "error",
                   columns: Sequence[str] | None = None, keyless: bool = True) -> DataFrame:
    """One row per key, the newest by ``version`` and then by the ``newer`` expressions.

    Rows equal in all of these are duplicates of one file. ``error`` fails the job on them;
    ``insert`` keeps them all, and marks them in ``_copies`` and ``_first`` for the merge.
    A key with very many versions is reduced before the shuffle. Each row without a key is a group
    of its own, so these spread evenly too; say ``keyless=False`` if there are none, and the result is
    partitioned by key for a join.
    """
    if on_duplicate not in _CHOICES:
        raise ValueError(f"on_duplicate must be one of {_CHOICES}")
    columns = list(columns or source.columns)
    if on_duplicate == "error":
        return _single_newest(source, key, [F.col(version), *newer], columns, keyless)
    rank = F.struct(F.col(version).alias("version"),
                    *[c.alias(f"then_{i}") for i, c in enumerate(newer)])
    rows = source.select(
        F.col(key).alias("_key"), rank.alias("_rank"),
        F.monotonically_increasing_id().alias("_row"),
        F.struct(*[c for c in columns if c != key]).alias("_value"))
    rows = materialized(rows)  # row numbers are used twice and must not change between
    alone = F.when(F.col("_key").isNull(), F.col("_row")) if keyless else F.lit(None)
    rows = rows.withColumn("_alone", alone.cast("bigint"))
    group = ["_key", "_alone"] if keyless else ["_key"]
    highest = F.max(F.struct("_rank", "_row", "_value"))
    lowest = F.max(F.struct(F.col("_rank"), (-F.col("_row")).alias("_row")))
    best = (rows.groupBy(*group).agg(highest.alias("top"), lowest.alias("low"))
            .withColumn("_copies", F.col("top._row") != -F.col("low._row")))

    def fields(value: str) -> list[Column]:
        return [F.col("_key").alias(c) if c == key else F.col(f"{value}.{c}") for c in columns]

    chosen = best.select(*[F.col(g).alias(f"_of{g}") for g in group],
                         F.col("top._rank").alias("_of_rank"), F.col("top._row").alias("_of_row"),
                         "_copies")
    same = F.col("_rank") == F.col("_of_rank")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_of{g}"))
    return (rows.join(chosen, same)
            .select(*fields("_value"), "_copies",
                    (F.col("_row") == F.col("_of_row")).alias("_first")))


def _single_newest(source: DataFrame, key: str, rank: Sequence[Column], columns: Sequence[str],
                   keyless: bool) -> DataFrame:
    """The highest row of each key. Of each key Spark keeps the highest row, and its equals, before
    the shuffle and after it. Rows stay as they are, without copies of what ranks them."""
    group, rows = [F.col(key)], source
    if keyless:
        rows = rows.withColumn("_newest_alone", F.when(
            F.col(key).isNull(), F.monotonically_increasing_id()).cast("bigint"))
        group.append(F.col("_newest_alone"))
    highest = Window.partitionBy(*group).orderBy(*[c.desc() for c in rank])
    best = rows.withColumns({"_newest_rank": F.rank().over(highest),
                             "_newest_place": F.row_number().over(highest)})
    single = F.assert_true(
        F.col("_newest_place") == 1,
        F.concat(F.lit(f"duplicate {key} in one file: "), F.col(key).cast("string")))
    return best.filter("_newest_rank = 1").filter(single.isNull()).select(*columns)


def _refuse_copies(copies: Column, key: Column) -> Column:
    return F.assert_true(
        ~copies, F.concat(F.lit("several source rows update one row: "), key.cast("string")))


def upsert(target: DataFrame, source: DataFrame, key: str, version: str = "_ingested_at",
           newer: Sequence[Column] = (), on_duplicate: str = "error") -> DataFrame:
    """The whole target table after the upsert, as one plan with one full outer join."""
    columns = target.columns
    has_key, no_key = F.col(key).isNotNull(), F.col(key).isNull()
    changes = newest_per_key(source.filter(has_key), key, version, newer, on_duplicate, columns,
                             keyless=False)
    mine = target.filter(has_key).select(
        *[F.col(c).alias(f"t_{c}") for c in columns], F.lit(True).alias("t_there"))
    theirs = changes.select(
        *[F.col(c).alias(f"s_{c}") for c in changes.columns], F.lit(True).alias("s_there"))
    newer_version = F.col(f"s_{version}") > F.col(f"t_{version}")
    both = mine.join(theirs, F.col(f"t_{key}") == F.col(f"s_{key}"), "full").withColumn(
        "_take", F.col("t_there").isNull() | F.coalesce(newer_version, F.lit(False)))
    if on_duplicate == "insert":
        clash = F.col("t_there").isNotNull() & F.col("_take") & F.col("s__copies")
        both = both.filter(_refuse_copies(F.coalesce(clash, F.lit(False)),
                                          F.col(f"t_{key}")).isNull())
        both = both.filter(F.col("_take") | F.col("s_there").isNull() | F.col("s__first"))
    keyed = both.select(
        *[F.when(F.col("_take"), F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")).alias(c)
          for c in columns])
    return (keyed.unionByName(target.filter(no_key))
            .unionByName(source.filter(no_key).select(*columns)))


# The pieces of the same upsert, for tables too large to rewrite.

def find_matches(changes: DataFrame, target_keys: DataFrame, key: str,
                 version: str = "_ingested_at") -> DataFrame:
    """Target rows that have a change, with ``_newer`` true where the change replaces them."""
    keyed = changes.filter(F.col(key).isNotNull())
    if "_first" in changes.columns:
        keyed = keyed.filter("_first")
    new = keyed.select(key, F.col(version).alias("_new"))
    return (target_keys.withColumnRenamed(version, "_old")
            .join(new, key)
            .withColumn("_newer", F.coalesce(F.col("_new") > F.col("_old"), F.lit(False))))


def rows_to_write(changes: DataFrame, matches: DataFrame, key: str) -> DataFrame:
    """Changes to insert, and one copy of a change for each target row it replaces."""
    verdict = matches.select(F.col(key).alias("_match"), "_newer")
    judged = changes.filter(F.col(key).isNotNull()).join(
        verdict, F.col(key) == F.col("_match"), "left")
    if "_copies" in changes.columns:
        clash = F.coalesce(F.col("_newer") & F.col("_copies"), F.lit(False))
        judged = judged.filter(_refuse_copies(clash, F.col(key)).isNull())
    applied = judged.filter(F.col("_match").isNull() | F.col("_newer"))
    own = [c for c in changes.columns if c not in ("_copies", "_first")]
    return applied.select(*own).unionByName(changes.filter(F.col(key).isNull()).select(*own))


def survivors(rows: DataFrame, changes: DataFrame, key: str,
              version: str = "_ingested_at") -> DataFrame:
    """Target rows that no change replaces."""
    new = changes.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("_match"), F.col(version).alias("_new"))
    replaced = (F.col(key) == F.col("_match")) & (F.col("_new") > F.col(version))
    return rows.join(new, replaced, "left_anti")
