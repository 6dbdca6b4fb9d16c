"""Hashes of groups whose pieces must be taken in order."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def streamed_sha256(pieces: DataFrame, between: str) -> DataFrame:
    """SHA-256 of each group's pieces: ``pieces`` has a group, a place and a text, null for none.

    A hash of this kind is made in order, so each group's bytes pass one task, piece by piece; no
    more than a batch of them is held.
    """
    group, place, text = pieces.columns
    schema = T.StructType([pieces.schema[group], T.StructField("sha256", T.StringType())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, any_text = None, None, False
        kind = None
        for batch in batches:
            kind, names, hexes = batch.schema.field(0).type, [], []
            for i in range(batch.num_rows):
                key, piece = batch.column(0)[i].as_py(), batch.column(2)[i].as_py()
                if state is None or key != now:
                    if state is not None:
                        names.append(now)
                        hexes.append(state.hexdigest())
                    now, state, any_text = key, hashlib.sha256(), False
                if piece is not None:
                    state.update(((between if any_text else "") + piece).encode())
                    any_text = True
            if names:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, kind), pa.array(hexes, pa.string())], schema.names)
        if state is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([now], kind), pa.array([state.hexdigest()], pa.string())], schema.names)

    return (pieces.repartition(group).sortWithinPartitions(group, place)
            .mapInArrow(apply, schema))
