"""Parsing CSV files too large for one task: byte ranges in parallel, records kept whole.

A byte range may start inside a quoted field, which only the ranges before it can tell. So each
range is scanned once, under both assumptions, giving its quote state at the end as a function of
the state at its start. These small functions are chained along each file, and the lines then
fall into chunks of whole records, which become the messages of the file.
"""

from __future__ import annotations

import csv
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import materialized, materialized_texts, new_folder
from tidemark.sources.csv_files import PARSED, append_records, literal_paths, texts_of
from tidemark.sources.storage import Storage

CHUNK_BYTES = 8 * 1024 * 1024
# Lines that one task sorts into chunks, about.
TASK_BYTES = 4 * CHUNK_BYTES
# A single record longer than this cannot be held as one text and sets its file aside.
RECORD_BYTES = 512 * 1024 * 1024

# One row for each line and, with line -1, one for each block.
_SCANNED = ("file string, block long, line long, value string, if_outside int, if_inside int, "
            "bytes long, valid boolean, header array<string>, "
            "outside_ends_inside boolean, inside_ends_inside boolean")
_SCANNED_ARROW = pa.schema([
    ("file", pa.string()), ("block", pa.int64()), ("line", pa.int64()), ("value", pa.string()),
    ("if_outside", pa.int32()), ("if_inside", pa.int32()), ("bytes", pa.int64()),
    ("valid", pa.bool_()), ("header", pa.list_(pa.string())),
    ("outside_ends_inside", pa.bool_()), ("inside_ends_inside", pa.bool_())])
_CHUNKS = "file string, part long, data string, error string, records long"


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line leaves a quoted field open, given whether one was open at its start.

    Only a quote at the start of a field opens it; one after a closed field is plain text.
    """
    at = 0
    while True:
        if not inside:
            if not line.startswith('"', at):
                comma = line.find(",", at)
                if comma < 0:
                    return False
                at = comma + 1
                continue
            at += 1
        close = line.find('"', at)
        while close >= 0 and line.startswith('"', close + 1):
            close = line.find('"', close + 2)
        if close < 0:
            return True
        comma = line.find(",", close + 1)
        if comma < 0:
            return False
        inside, at = False, comma + 1


class _Assumption:
    """Progress through one block, assuming how it starts."""

    def __init__(self, inside: bool):
        self.inside = inside
        self.chunks = 0  # 0: still in a record that began in an earlier block
        self.bytes = 0

    def take(self, line: str, size: int, quoted: bool, limit: int) -> int:
        if not self.inside and (self.chunks == 0 or self.bytes >= limit):
            self.chunks += 1
            self.bytes = 0
        self.bytes += size
        if quoted:
            self.inside = ends_inside(line, self.inside)
        return self.chunks


def _first_record(lines: list[str]) -> list[str]:
    try:
        return next(csv.reader(line + "\n" for line in lines), [])
    except csv.Error:
        return []  # the chunk that holds the header reports the error


def _blocks(ended: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, field.type)
         for column, field in zip(zip(*ended, strict=True), _SCANNED_ARROW, strict=True)],
        schema=_SCANNED_ARROW)


def _scan(chunk_bytes: int) -> Callable:
    """A scan of lines in file order that reports each line and, at its end, each block."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here: tuple | None = None
        outside = inside = None
        size_seen, number, valid, head, head_done = 0, 0, True, [], False

        def summary() -> tuple:
            header = _first_record(head) if here[1] == 0 else None
            return (*here, -1, None, outside.chunks, inside.chunks, size_seen, valid, header,
                    outside.inside, inside.inside)

        for batch in batches:
            ended, numbers, sizes, if_outside, if_inside = [], [], [], [], []
            given = [batch.column(c) for c in ("file", "block", "value", "valid")]
            for file, block, value, ok in zip(*(c.to_pylist() for c in given), strict=True):
                if here != (file, block):
                    if here is not None:
                        ended.append(summary())
                    here = (file, block)
                    outside, inside = _Assumption(False), _Assumption(True)
                    size_seen, number, valid, head, head_done = 0, 0, True, [], block != 0
                size, quoted = len(value) + 1, '"' in value
                if not head_done:
                    head.append(value)
                if_outside.append(outside.take(value, size, quoted, chunk_bytes))
                if_inside.append(inside.take(value, size, quoted, chunk_bytes))
                head_done = head_done or not outside.inside
                numbers.append(number)
                sizes.append(size)
                number += 1
                size_seen += size
                valid = valid and ok
            files, blocks, values, valids = given  # as they came, texts are not made anew
            nothing = [pa.nulls(len(numbers), f.type) for f in list(_SCANNED_ARROW)[-3:]]
            yield pa.RecordBatch.from_arrays(
                [files, blocks, pa.array(numbers, pa.int64()), values,
                 pa.array(if_outside, pa.int32()), pa.array(if_inside, pa.int32()),
                 pa.array(sizes, pa.int64()), valids, *nothing], schema=_SCANNED_ARROW)
            if ended:
                yield _blocks(ended)
        if here is not None:
            yield _blocks([summary()])

    return scan


def _chained(blocks: DataFrame) -> DataFrame:
    """Add how each block starts, and the chunk that its first, unfinished record belongs to.

    Over a block the quote state either becomes a fixed one, or flips, or stays. The state at a
    block's start is thus the last fixed one, flipped as often as blocks since then flip it.
    """
    before = (Window.partitionBy("file").orderBy("block")
              .rowsBetween(Window.unboundedPreceding, -1))
    fixed = F.col("outside_ends_inside") == F.col("inside_ends_inside")
    flips = (~fixed & F.col("outside_ends_inside")).cast("int")
    counted = blocks.withColumns({
        "_fixed": fixed,
        "_flips": F.sum(flips).over(before.rowsBetween(Window.unboundedPreceding, 0))})
    last_fixed = F.last(F.when(F.col("_fixed"), F.struct(
        F.col("outside_ends_inside").alias("state"), F.col("_flips").alias("flips"))),
        ignorenulls=True).over(before)
    flips_before = F.coalesce(F.max("_flips").over(before), F.lit(0))
    started = counted.withColumns({"_last": last_fixed, "_before": flips_before})
    odd = (F.col("_before") - F.coalesce("_last.flips", F.lit(0))) % 2 == 1
    started = started.withColumn(
        "inside", F.coalesce("_last.state", F.lit(False)) != odd)
    chunks = F.when(F.col("inside"), F.col("if_inside")).otherwise(F.col("if_outside"))
    begun = F.when(chunks > 0, F.col("block") + chunks - 1)
    return started.select(
        "file", "block", "bytes", "valid", "header", "inside", chunks.alias("chunks"),
        F.last(begun, ignorenulls=True).over(before).alias("carried"))


def _problems(chained: DataFrame) -> DataFrame:
    undecodable = chained.filter(~F.col("valid")).select(
        "file", F.lit("UnicodeDecodeError: not UTF-8").alias("error"))
    oversized = (chained.filter("chunks = 0").groupBy("file", "carried")
                 .agg(F.sum("bytes").alias("size")).filter(F.col("size") > RECORD_BYTES)
                 .select("file", F.lit("Error: record too long").alias("error")))
    return (undecodable.unionByName(oversized).groupBy("file")
            .agg(F.max("error").alias("error")))


def _chunk_parser(files: list[str], headers: dict[str, list[str]], marked: set[str]) -> Callable:
    def parse(key: tuple, lines: pa.Table) -> pa.Table:
        file, part = files[key[0].as_py()], key[1].as_py()
        order = pc.sort_indices(lines, [("block", "ascending"), ("line", "ascending")])
        text = "\n".join(lines.column("value").take(order).to_pylist())
        del lines, order
        header = None if part == 0 else headers[file]
        if part == 0 and file in marked:
            text = "\ufeff" + text
        data, count, error = bytearray(), 0, None
        try:
            count = append_records(data, text, header)
        except csv.Error as problem:
            error = f"{type(problem).__name__}: {problem}"
        return pa.table({"file": [file], "part": pa.array([part], pa.int64()),
                         "data": texts_of(data, [len(data)], [error is None]),
                         "error": pa.array([error], pa.string()),
                         "records": pa.array([count], pa.int64())})

    return parse


def parse_large_files(spark: SparkSession, paths: list[str], scratch: str | None = None,
                      chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """As ``parse_files``, but one row per chunk of a file; an unreadable file gives one row.

    Goes through the driver: the names of these files and their header lines.
    """
    storage = Storage(spark)
    scratch = scratch or new_folder(spark, "large")
    paths = literal_paths(paths)
    known = spark.read.format("binaryFile").load(paths).select(
        "path", "modificationTime", "length", F.col("_metadata.file_path").alias("file"))
    text = F.col("value")
    lines = (spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.make_valid_utf8(text).alias("value"), F.is_valid_utf8(text).alias("valid")))

    # Lines and blocks come from one scan that is written down: how Spark cuts files into blocks
    # depends on settings and cores, and a second scan could see other ones.
    scanned = materialized(lines.mapInArrow(_scan(chunk_bytes), _SCANNED), f"{scratch}/lines")
    chained = materialized(_chained(scanned.filter("line = -1")), f"{scratch}/blocks")
    headers, marked = {}, set()
    for row in chained.filter("block = 0").select("file", "header").collect():
        path = storage.from_uri(row["file"])
        headers[row["file"]] = list(row["header"] or [])
        if storage.first_bytes(path, 3) == b"\xef\xbb\xbf":  # the line reader drops this mark
            marked.add(row["file"])
            if headers[row["file"]]:
                headers[row["file"]][0] = "\ufeff" + headers[row["file"]][0]

    unreadable = _problems(chained)
    # each line goes to its chunk with the number of its file, as names may be longer than lines
    files = sorted(headers)
    numbers = spark.createDataFrame(list(enumerate(files)), "number int, file string")
    where = (chained.select("file", "block", "inside", "carried")
             .join(F.broadcast(numbers), "file").join(unreadable, "file", "left_anti"))
    place = F.when(F.col("inside"), F.col("if_inside")).otherwise(F.col("if_outside"))
    parts = (scanned.filter("line >= 0").join(where, ["file", "block"])
             .select("number", "block", "line", "value",
                     F.when(place > 0, F.col("block") + place - 1)
                     .otherwise(F.col("carried")).alias("part")))
    size = chained.agg(F.sum("bytes")).first()[0] or 0
    tasks = max(1, -(-size // TASK_BYTES))  # whatever the session's number of partitions is
    chunks = materialized_texts(
        parts.repartition(tasks, "number", "part").groupBy("number", "part").applyInArrow(
            _chunk_parser(files, headers, marked), _CHUNKS), f"{scratch}/chunks")

    failed = unreadable.unionByName(
        chunks.filter(F.col("error").isNotNull()).groupBy("file")
        .agg(F.min_by("error", "part").alias("error")))
    # one row a file, whose names the driver has; by a shuffle, all of a file would meet in one task
    good = chunks.join(F.broadcast(failed), "file", "left_anti")
    bad = failed.select("file", F.lit(0).cast("long").alias("part"),
                        F.lit(None).cast("string").alias("data"), "error",
                    F.lit(0).cast("long").alias("records"))
    columns = [f.split()[0] for f in PARSED.split(", ")]
    return good.unionByName(bad).join(F.broadcast(known), "file").select(*columns)
