"""Reading the JSON array of records that one landing message carries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _trimmed(json: Column) -> Column:
    return F.ltrim(json, F.lit(" \t\r\n"))  # what JSON takes as white space


def _is_array(data: Column) -> Column:
    # from_json wraps a lone object into a one-element array; only real arrays hold records.
    return _trimmed(data).startswith("[")


def _record_type(fields: Sequence[str]) -> str:
    return "struct<" + ",".join(f"`{f}`:string" for f in fields) + ">"


def _own_records(data: Column, fields: Sequence[str]) -> Column:
    """Records as all-text structs. An element that is no object becomes an all-NULL record."""
    record = _record_type(fields)
    whole = F.from_json(data, f"array<{record}>")
    # One element that is not an object makes the whole array unreadable to from_json, so such
    # arrays, and only those, are read element by element.
    return F.coalesce(whole, _one_by_one(data, record))


def _one_by_one(data: Column, record: str) -> Column:
    return F.transform(
        F.from_json(data, "array<string>"),
        lambda item: F.when(_trimmed(item).startswith("{"), F.from_json(item, record))
        .otherwise(F.from_json(F.lit("{}"), record)))


def _foreign_records(data: Column, fields: Sequence[str]) -> Column:
    """As :func:`_own_records`, for payloads whose values may be nested: those give NULL."""

    def scalar(item: Column, field: str) -> Column:
        value = F.try_variant_get(item, f"$['{field}']", "variant")
        nested = F.schema_of_variant(value).rlike("^(OBJECT|ARRAY)")
        return F.when(~nested, F.try_variant_get(item, f"$['{field}']", "string")).alias(field)

    items = F.try_variant_get(F.try_parse_json(data), "$", "array<variant>")
    return F.transform(items, lambda item: F.struct(*[scalar(item, f) for f in fields]))


# Spark's JSON parsers give NULL for a value of some 20 million characters, as for broken JSON.
_LONG = 16_000_000


def _lost(records: Column, data: Column) -> Column:
    return records.isNull() & (F.length(data) >= _LONG)


def _read_or_fail(records: Column, data: Column) -> Column:
    return F.when(F.isnotnull(F.when(_lost(records, data), F.raise_error(F.lit(UNREADABLE)))),
                  None).otherwise(records)


UNREADABLE = "a message is broken or holds a value too long to be parsed"


def unreadable(events: DataFrame, fields: Sequence[str], data: str = "data") -> DataFrame:
    """Messages that :func:`explode_records` takes as an error, with all their columns."""
    payload = F.col(data)
    # bytes are known without a look at the text, and there are as many as characters at least
    long = events.filter((F.octet_length(payload) >= _LONG) & (F.length(payload) >= _LONG)
                         & _is_array(payload))
    return long.filter(_lost(_own_records(payload, fields), payload))


def explode_records(events: DataFrame, fields: Sequence[str], data: str = "data",
                    foreign: bool = False, skip_unreadable: bool = False) -> DataFrame:
    """One row per record, with ``fields`` as text columns beside the event's other columns.

    Events whose payload is NULL, empty, not JSON or not an array give no row; one that Spark cannot
    read because a value is too long is an error, or gives no row with ``skip_unreadable``, for use
    beside :func:`unreadable`. Records of the landing stream hold text only; set
    ``foreign`` for messages of other producers.
    """
    payload = F.col(data)
    records = _foreign_records(payload, fields) if foreign else _own_records(payload, fields)
    others = [c for c in events.columns if c != data and c not in fields]
    return (events.filter(_is_array(payload))
            .select(*others, F.inline(records if skip_unreadable
                                      else _read_or_fail(records, payload))))


def discover_fields(raw: DataFrame) -> DataFrame:
    """Which record fields each entity has sent, and in how many records."""
    data, record = F.col("data"), "map<string,string>"
    records = F.coalesce(F.from_json(data, f"array<{record}>"), _one_by_one(data, record))
    return (raw.filter(_is_array(F.col("data")))
            .select(F.col("attributes")["entity"].alias("entity"),
                    F.explode(records).alias("record"))
            .select("entity", F.explode(F.map_keys("record")).alias("field"))
            .groupBy("entity", "field").agg(F.count(F.lit(1)).alias("records")))


def discover_schema(raw: DataFrame) -> DataFrame:
    """Every record field an entity has sent: its type over all records, how many have it, and the
    first file and time it was seen. Numbers, texts and nested values are told apart; a field of
    several of them is of type VARIANT. The types are a combinable aggregate."""
    item = F.explode(F.try_variant_get(F.try_parse_json("data"), "$", "array<variant>"))
    records = (raw.filter(_is_array(F.col("data")))
               .select(F.col("attributes")["entity"].alias("entity"),
                       F.col("attributes")["source_path"].alias("source_path"), "publish_time",
                       item.alias("item"))
               .filter(F.schema_of_variant("item").startswith("OBJECT")))
    fields = records.select("entity", "source_path", "publish_time", F.explode(
        F.col("item").cast("map<string,variant>")).alias("field", "value"))
    return (fields.groupBy("entity", "field")
            .agg(F.schema_of_variant_agg("value").alias("type"),
                 F.count(F.lit(1)).alias("records"),
                 F.min(F.struct("publish_time", "source_path")).alias("first"))
            .select("entity", "field", "type", "records",
                    F.col("first.publish_time").alias("first_seen"),
                    F.col("first.source_path").alias("first_file")))
