"""Small helpers: batches of texts inside tasks, results as Arrow, tables in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import new_folder
from tidemark.sources.storage import Storage

#: Characters of text that a task works on at once, unless one text alone is longer.
CHUNK_CHARS = 1_000_000
#: Bytes of texts or ids in rows that are handed over at once.
SLICE_BYTES = 4_000_000
#: Spark's setting to remove the shuffle files of a query when it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def chunks(texts: Sequence[str | None], most: int = CHUNK_CHARS) -> Iterator[tuple[int, list[str]]]:
    """Neighbouring texts, nulls as empty ones, of at most ``most`` characters together, each group
    with the place of its first text. A longer text comes alone and whole."""
    first, size, group = 0, 0, []
    for place, text in enumerate(texts):
        text = text or ""
        if group and size + len(text) > most:
            yield first, group
            first, size, group = place, 0, []
        group.append(text)
        size += len(text)
    if group:
        yield first, group


def binaries(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """A binary column whose values are the neighbouring slices of ``data``; lengths in bytes."""
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    if offsets[-1] >= 1 << 31:
        raise ValueError("over 2 GB in one batch: lower spark.sql.execution.arrow.maxRecordsPerBatch")
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)),
               pa.py_buffer(np.ascontiguousarray(data).view(np.uint8))]
    return pa.Array.from_buffers(pa.binary(), len(lengths), buffers)


def slices(batch: pa.RecordBatch, column: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Neighbouring rows of a batch whose values in a column of texts or bytes have at most
    ``most`` bytes together, or one larger row, so that what is made of them stays small."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy().astype(np.int64)
    ends, begin = np.cumsum(sizes), 0
    while begin < len(sizes):
        done = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + most, "right")))
        yield batch.slice(begin, end - begin)
        begin = end


def with_results(df: DataFrame, text: str, fields: str,
                 make: Callable[[], Callable[[list[str | None]], list[pa.Array]]],
                 keep: Sequence[str] | None = None) -> DataFrame:
    """``df``'s columns ``keep`` (default: all) and behind them the columns of ``fields``, which
    the function that ``make()`` gives draws from a list of texts, one Arrow array each. ``make``
    runs once in each task. A column of ``df`` with the name of a result gives way.
    """
    added = T.StructType.fromDDL(fields)
    keep = [c for c in (df.columns if keep is None else keep) if c not in added.names]
    source = "_source_text"
    while source in keep:
        source = "_" + source
    rows = df.select(*[F.col(f"`{c}`") for c in keep],
                     F.col(f"`{text}`").cast("string").alias(source))
    schema = T.StructType([rows.schema[c] for c in keep] + list(added.fields))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = make()
        for batch in batches:
            for rows in slices(batch, len(keep)):
                results = of(rows.column(len(keep)).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(i) for i in range(len(keep))), *results], [*keep, *added.names])

    return rows.mapInArrow(apply, schema)


def kept(df: DataFrame, label: str, last_use: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, safe from lost executors.
    With ``last_use``, what its shuffles wrote is removed then, as nothing reads it again."""
    folder, conf = new_folder(df.sparkSession, label), df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    if last_use:
        conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(folder)
    finally:
        conf.set(_CLEANUP, before)
    table = df.sparkSession.read.schema(df.schema).parquet(folder)
    table.kept_in = folder
    return table


def discard(*tables: DataFrame) -> None:
    """Remove tables that :func:`kept` has written and that nothing reads again."""
    for table in tables:
        Storage(table.sparkSession).remove(table.kept_in, whole_folder=True)
