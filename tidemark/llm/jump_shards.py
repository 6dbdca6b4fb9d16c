"""Shards by jump consistent hashing: no table of ring places, and appending a shard moves rows
only into it."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.frames import kept


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard, 0 to ``shards`` - 1, of each unsigned 64-bit key. Each key jumps forward by steps
    drawn from its own pseudo-random sequence, until the next step would pass the last shard."""
    state = keys.astype(np.uint64)
    shard, ahead = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    moving = np.arange(len(keys))
    while len(moving):
        shard[moving] = ahead[moving]
        # fixed values: the multiplier of the generator and the 31 bits of the draw
        state[moving] = state[moving] * np.uint64(2862933555777941757) + np.uint64(1)
        draw = (state[moving] >> np.uint64(33)).astype(np.float64) + 1
        ahead[moving] = ((shard[moving] + 1) * (float(1 << 31) / draw)).astype(np.int64)
        moving = moving[ahead[moving] < shards]
    return shard


def assign(df: DataFrame, key: str = "doc_id", shards: int = 16) -> DataFrame:
    """``df`` with ``shard``, ``slot`` (the place in the shard, from 0 without gaps) and
    ``grown_shard`` (the shard if there were one more). Columns of these names are replaced.

    Key and shard count alone decide the shard: the key's 64-bit XXH64 jumps. Equal keys, so also
    repeated rows and null keys, share a shard. A row's slot is its place in its part of the table
    plus the sizes of the shard in the parts before; only one count for each part and shard is
    gathered, rows are neither shuffled nor sorted, and a hot key does not matter. Empty tables
    stay empty. Select the columns that are needed first: ``df`` is written to the shared folder.
    """
    rest = [c for c in df.columns if c not in ("shard", "slot", "grown_shard")]
    hidden = "_jump_key"
    while hidden in rest:
        hidden = "_" + hidden
    rows = df.select(*[F.col(f"`{c}`") for c in rest], F.xxhash64(F.col(f"`{key}`")).alias(hidden))
    part, place = hidden + "_part", hidden + "_place"
    schema = T.StructType([*(rows.schema[c] for c in rest),
                           T.StructField("shard", T.IntegerType()),
                           T.StructField("grown_shard", T.IntegerType()),
                           T.StructField(part, T.IntegerType()), T.StructField(place, T.LongType())])

    def apply(batches):
        number, seen = TaskContext.get().partitionId(), np.zeros(shards, np.int64)
        for batch in batches:
            keys = batch.column(len(rest)).to_numpy().view(np.uint64)
            shard = jump_hash(keys, shards)
            order = np.argsort(shard, kind="stable")
            count = np.bincount(shard, minlength=shards)
            inside = np.empty(len(keys), np.int64)
            inside[order] = np.arange(len(keys)) - np.repeat(np.cumsum(count) - count, count)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(shard.astype(np.int32)),
                 pa.array(jump_hash(keys, shards + 1).astype(np.int32)),
                 pa.array(np.full(len(keys), number, np.int32)), pa.array(inside + seen[shard])],
                schema.names)
            seen += count

    placed = kept(rows.mapInArrow(apply, schema), "shards")
    sizes = placed.groupBy("shard", part).agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    first = hidden + "_first"
    sizes = sizes.select("shard", part, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(first))
    return (placed.join(sizes, ["shard", part])
            .select(*[F.col(f"`{c}`") for c in rest], "shard",
                    (F.col(first) + F.col(place)).alias("slot"), "grown_shard"))


def write_shards(df: DataFrame, folder: str, key: str = "doc_id", shards: int = 16) -> None:
    """Write the rows of ``df`` to one sub-folder for each shard."""
    assign(df, key, shards).write.partitionBy("shard").parquet(folder)
