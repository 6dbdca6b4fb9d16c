"""High-water marks taken from the target table, and the events above them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import safe_timestamp

EPOCH = datetime(1970, 1, 1, tzinfo=UTC)
LOOKBACK_DAYS = 7


def watermark(target: DataFrame, column: str, now: datetime,
              lookback_days: int = LOOKBACK_DAYS) -> datetime:
    """The largest ``column`` among target rows ingested in the last days; the epoch if none.

    The answer is one value on the driver, so that it can prune partitions of the next scan.
    """
    since = now - timedelta(days=lookback_days)
    recent = target.filter(F.col("_ingested_at") >= F.lit(since))
    if "_ingested_date" in target.columns:
        recent = recent.filter(F.col("_ingested_date") >= F.lit(since.date()))
    mark = F.coalesce(F.unix_micros(F.max(column)), F.lit(0))
    return EPOCH + timedelta(microseconds=recent.agg(mark.alias("mark")).first()["mark"])


def new_events(raw: DataFrame, entity: str, mark: datetime) -> DataFrame:
    """Messages of one entity published after the mark, with their attributes as columns."""
    events = raw.filter(F.col("publish_time") > F.lit(mark))
    if "_publish_date" in raw.columns:
        events = events.filter(F.col("_publish_date") >= F.lit(mark.date()))
    if "_entity" in raw.columns:
        events = events.filter(F.col("_entity") == entity)
    attribute = F.col("attributes")
    extra = [c for c in raw.columns if c in ("_file", "_row")]
    return events.filter(attribute["entity"] == entity).select(
        "publish_time", "message_id",
        attribute["audit_id"].alias("audit_id"),
        attribute["entity"].alias("entity"),
        safe_timestamp(attribute["ingested_at"]).alias("ingested_at"),
        attribute["source_file"].alias("source_file"),
        attribute["source_path"].alias("source_path"),
        F.coalesce(attribute["part"].try_cast("bigint"), F.lit(0)).alias("part"),
        attribute["uploaded_at"].alias("uploaded_at"),
        "data", *extra)


def newest_messages(events: DataFrame, identity: Sequence[str] = ("message_id",),
                    alone: str | None = None) -> DataFrame:
    """The ``identity`` of the messages that make up the newest file of each path.

    A file is one message, or one message per ``part`` when it was too large for one. Only
    narrow columns are grouped and shuffled, never the payload, and the grouping is combined
    before the shuffle: a path that sends a third of all messages costs no more than others.
    ``alone`` names a column that says whether all messages of the path are among them.
    """
    part = F.col("part") if "part" in events.columns else F.lit(0)
    file = F.coalesce("audit_id", "message_id") if "audit_id" in events.columns \
        else F.col("message_id")
    newest_copy = F.max(F.struct(
        F.struct("ingested_at", "publish_time", file.alias("file")).alias("version"), *identity))
    copies = [F.count(F.lit(1)).alias("_copies")] if alone else []
    parts = (events.groupBy("source_path", part.alias("part"))
             .agg(newest_copy.alias("m"), *copies)
             .select("source_path", "m.*", *(["_copies"] if alone else [])))
    path = Window.partitionBy("source_path")
    parts = parts.withColumn("_newest", F.max("version").over(path))
    if alone:
        parts = parts.withColumn(alone, (F.max("_copies").over(path) == 1)
                                 & (F.min("version").over(path) == F.col("_newest")))
    return (parts.filter(F.col("version") == F.col("_newest"))
            .select(*identity, *([alone] if alone else [])))


def latest_per_path(events: DataFrame, identity: Sequence[str] = ("message_id",),
                    newest: DataFrame | None = None) -> DataFrame:
    """Keep only the newest file of each source path. Ties go to the later published one."""
    newest = (newest_messages(events, identity) if newest is None else newest)
    renamed = newest.select(*[F.col(c).alias(f"_keep_{c}") for c in identity])
    same = [F.col(c).eqNullSafe(F.col(f"_keep_{c}")) for c in identity]
    return events.join(renamed, same, "left_semi")
