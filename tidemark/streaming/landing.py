"""The landing stream: every new CSV file becomes raw messages, then the layers refresh."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime
from itertools import batched

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.plans.lineage import quarantine
from tidemark.plans.medallion import refresh_all
from tidemark.session import LONG_TEXTS, materialized, setting, utc_now
from tidemark.sources.csv_files import (
    CSV_GLOB,
    INLINE_BYTES,
    as_messages,
    below,
    entity_of,
    literal_paths,
    parse_files,
    with_file_identity,
)
from tidemark.sources.large_files import parse_large_files
from tidemark.sources.tables import Run, Tables

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
FILES_PER_BATCH = 100_000
REPLACED_PER_BATCH = 10_000
MAX_ATTEMPTS = 5
# Longer than files are old: by default the file source skips files older than a week before the
# newest one, such as those renamed into the folder or copied with their times.
ANY_AGE = "36500d"

# Files that a task writes side by side: one for each outcome and entity. Up to that many Spark does not
# sort rows by their file first, which would hold all messages of a task in memory.
OPEN_FILES = 8

# Outcome of a file -> table that records it. "large" files are parsed in a second step.
OUTCOMES = {"message": "landing_events", "reject": "rejects", "quarantine": "quarantine"}


def _outcomes(parsed: DataFrame, root: str, published: Column, outcome: Column,
              attempts: Column) -> DataFrame:
    """Parsed files in the common shape of all outcome tables, with their partitions."""
    messages = as_messages(parsed, root, published, extra=[
        "path", "source_path", "entity", "audit_id", "modificationTime", "length", "error",
        outcome.alias("outcome"), attempts.alias("attempts"), published.alias("seen_at")])
    return messages.withColumns({
        "_publish_date": F.to_date("publish_time"), "_entity": F.col("entity")})


def _parsed_outcome() -> Column:
    return F.when(F.col("error").isNull(), "message").otherwise("quarantine")


def outcomes_of(files: DataFrame, root: str, published: Column,
                inline_bytes: int = INLINE_BYTES) -> DataFrame:
    """What becomes of each landed file. The content of rejected and large files is not read."""
    entity = entity_of(below(root, F.col("path")))
    fits = F.col("length") <= inline_bytes
    parsed = _outcomes(parse_files(files.filter(entity.isNotNull() & fits)), root, published,
                       _parsed_outcome(), F.lit(1))
    empty = F.lit(None).cast("string")
    unread = files.filter(entity.isNull() | ~fits).select(
        "path", "modificationTime", "length", F.lit(0).cast("long").alias("part"),
        empty.alias("data"),
        F.when(entity.isNull(), "unknown entity").alias("error"),
        F.lit(None).cast("long").alias("records"))
    unread = _outcomes(unread, root, published,
                       F.when(F.col("error").isNull(), "large").otherwise("reject"), F.lit(1))
    return parsed.unionByName(unread)


def _staged(run: Run, rows: DataFrame) -> str:
    """Write outcomes once, split by what they are, without making them part of a table."""
    folder = run.scratch("outcomes")
    with setting(rows.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", OPEN_FILES):
        (rows.write.options(**LONG_TEXTS).partitionBy("outcome", "_publish_date", "_entity")
         .parquet(folder))
    return folder


def _adopt(run: Run, folder: str) -> None:
    """Make written outcomes parts of their tables."""
    for outcome, table in OUTCOMES.items():
        run.adopt(table, f"{folder}/outcome={outcome}")


def _stamped(rows: DataFrame, published: datetime) -> DataFrame:
    """Outcomes with the time of this attempt to publish them.

    A stream repeats a batch that was cut off with the time of the first attempt. Other files may
    have been published meanwhile, and rows below their time would never be read.
    """
    now = F.lit(published)
    instant = F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return rows.withColumns({
        "publish_time": now, "seen_at": now, "_publish_date": F.to_date(now),
        "attributes": F.transform_values("attributes", lambda key, value: F.when(
            key == "ingested_at", instant).otherwise(value))})


def land_batch(tables: Tables, root: str, rows: DataFrame, run_id: str,
               published: datetime) -> None:
    """Make one batch of outcomes visible, exactly once for its ``run_id``."""
    if tables.landed(run_id):
        return
    with tables.run(run_id) as run:
        folder = _staged(run, _stamped(rows, published))
        files = tables.spark.read.schema(rows.schema).parquet(folder)
        large = f"{folder}/outcome=large"
        if tables.storage.exists(large):
            paths = [r["path"] for r in
                     tables.spark.read.parquet(large).select("path").toLocalIterator()]
            chunks = parse_large_files(tables.spark, paths, run.scratch("large"))
            _adopt(run, _staged(run, _outcomes(chunks, root, F.lit(published), _parsed_outcome(),
                                               F.lit(1))))
        run.add("landed_files", files.filter("_entity is not null").select(
            "source_path", "audit_id", "seen_at"))
        _adopt(run, folder)


def land_reuploads(tables: Tables, landing_dir: str, inline_bytes: int = INLINE_BYTES,
                   files_per_batch: int = REPLACED_PER_BATCH) -> int:
    """Land files that replaced one already landed or quarantined; returns how many.

    A file stream takes each path once, so replaced files are found by their audit id, which
    changes with every upload, whatever the time of the file is. The whole listing is compared with
    the narrow table of landed files; payloads are not read. The driver sees the paths of one
    batch at a time.
    """
    landed = tables.read("landed_files").select("source_path", "audit_id")
    root = tables.storage.qualified(landing_dir)
    files = (tables.spark.read.format("binaryFile").option("pathGlobFilter", CSV_GLOB)
             .option("recursiveFileLookup", "true").load(root)
             .select("path", "modificationTime", "length"))
    count = 0
    with tables.run() as run:  # for its scratch folder only
        replaced = materialized(
            with_file_identity(files, root).filter(F.col("entity").isNotNull())
            .select("path", "source_path", "audit_id")
            .join(landed.select("audit_id"), "audit_id", "left_anti")
            .join(landed.select("source_path"), "source_path", "left_semi").select("path"),
            run.scratch("replaced"))
        for due in batched(replaced.toLocalIterator(), files_per_batch):
            now = utc_now()
            again = tables.spark.read.format("binaryFile").load(
                literal_paths(r["path"] for r in due))
            land_batch(tables, root, outcomes_of(again, root, F.lit(now), inline_bytes),
                       uuid.uuid4().hex, now)
            count += len(due)
    return count


def start_landing(spark: SparkSession, landing_dir: str, tables: Tables, checkpoint: str,
                  trigger: dict | None = None, files_per_batch: int = FILES_PER_BATCH,
                  inline_bytes: int = INLINE_BYTES, archive_dir: str | None = None,
                  after_batch: Callable[[Tables], object] | None = refresh_all
                  ) -> StreamingQuery:
    """Watch a folder and land each new ``.csv`` file below it, then refresh silver and gold.

    By default takes what is there and stops; pass ``trigger={"processingTime": "1 minute"}`` to
    keep running. Replaced files are taken at the start and after each batch. ``archive_dir``
    moves finished files away, which keeps the listing short. A failing refresh stops the query;
    on restart its batch is not landed twice but refreshed.
    """
    root = tables.storage.qualified(landing_dir)
    source = (spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
              .option("pathGlobFilter", CSV_GLOB).option("recursiveFileLookup", "true")
              .option("maxFilesPerTrigger", files_per_batch).option("maxFileAge", ANY_AGE))
    if archive_dir:
        source = source.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    rows = outcomes_of(source.load(root), root, F.current_timestamp(), inline_bytes)
    feed = tables.feed_id(checkpoint)
    if land_reuploads(tables, landing_dir, inline_bytes) and after_batch is not None:
        after_batch(tables)

    def land(batch: DataFrame, batch_id: int) -> None:
        land_batch(tables, root, batch, f"{feed}-{batch_id}", utc_now())
        land_reuploads(tables, landing_dir, inline_bytes)
        if after_batch is not None:
            after_batch(tables)

    return (rows.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def retry_quarantined(tables: Tables, landing_dir: str, now: datetime | None = None,
                      max_attempts: int = MAX_ATTEMPTS, inline_bytes: int = INLINE_BYTES) -> int:
    """Try the files in quarantine again, until each has been tried ``max_attempts`` times.

    Large files go through the parser for such files, as they do when they land.
    """
    now = now or utc_now()
    root = tables.storage.qualified(landing_dir)
    report = quarantine(tables.read("quarantine"), now)
    landed = tables.read("landing_events").select(
        F.col("attributes")["audit_id"].alias("audit_id"))
    listed = (tables.spark.read.format("binaryFile").option("pathGlobFilter", CSV_GLOB)
              .option("recursiveFileLookup", "true").load(root).select("path", "length"))
    with tables.run() as run:
        due = materialized(
            report.filter(F.col("attempts") < max_attempts)
            .join(landed, "audit_id", "left_anti").join(listed, "path")
            .select("path", "length", F.col("attempts").alias("tried")), run.scratch("due"))
        count = 0
        for some in batched(due.toLocalIterator(), REPLACED_PER_BATCH):
            parsed = None
            small = [r["path"] for r in some if r["length"] <= inline_bytes]
            if small:
                parsed = parse_files(tables.spark.read.format("binaryFile")
                                     .load(literal_paths(small)))
            big = [r["path"] for r in some if r["length"] > inline_bytes]
            if big:
                chunks = parse_large_files(tables.spark, big, run.scratch("large"))
                parsed = chunks if parsed is None else parsed.unionByName(chunks)
            tried = parsed.join(due.select("path", "tried"), "path")
            _adopt(run, _staged(run, _outcomes(tried, root, F.lit(now), _parsed_outcome(),
                                               F.col("tried") + 1)))
            count += len(some)
    return count
