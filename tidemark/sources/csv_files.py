"""Landing CSV files: path rules, file identity, and parsing by each file's own header."""

from __future__ import annotations

import csv
import json
import re
from collections.abc import Iterable, Iterator, Sequence
from itertools import batched

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import ENTITIES

# The parser's own limit of 131,072 characters a field would set whole files aside.
csv.field_size_limit(2**31 - 1)

CSV_GLOB = "*.csv"
SUBSCRIPTION = "landing-files"

# Larger files are split into several messages, see large_files.py.
INLINE_BYTES = 16 * 1024 * 1024

# Parsed files are handed back to the JVM in batches of about this many bytes of input.
YIELD_BYTES = 4 * 1024 * 1024

# Records held as objects at a time; they take some ten times the room of their text.
RECORDS_AT_ONCE = 1000

_text = json.encoder.encode_basestring  # a JSON text, not limited to ASCII

PARSED = ("path string, modificationTime timestamp, length long, part long, data string, "
          "error string, records long")


def literal_paths(paths: Iterable[str]) -> list[str]:
    """Paths for a reader that would take brackets and the like in file names as patterns."""
    return [re.sub(r"([\\\[\]{}*?])", r"\\\1", path) for path in paths]


def below(root: str, path: Column) -> Column:
    """A file's path relative to the landing folder ``root`` (a qualified path)."""
    return F.substr(path, F.lit(len(root.rstrip("/")) + 2))


def entity_of(source_path: Column) -> Column:
    """The entity a path belongs to, or NULL. Only a leading ``entity=`` folder counts."""
    found = F.regexp_extract(source_path, f"^entity=({'|'.join(ENTITIES)})/", 1)
    return F.nullif(found, F.lit(""))


def with_file_identity(files: DataFrame, root: str) -> DataFrame:
    """Add source path, file name, entity and audit id to rows with path, time and length.

    The audit id is drawn from the file event itself, so a retried task gives the same one, and
    a new upload of the same path another.
    """
    source_path = below(root, F.col("path"))
    event = F.concat_ws("|", F.col("path"), F.unix_micros("modificationTime"), F.col("length"))
    return files.withColumns({
        "source_path": source_path,
        "source_file": F.element_at(F.split(F.col("path"), "/"), -1),
        "entity": entity_of(source_path),
        "audit_id": F.sha2(event, 256),
    })


def counted_records(text: str, header: list[str] | None = None) -> tuple[str, int]:
    """All records of a CSV text as one JSON array of objects, and their number.

    Fields are bound to the names in ``header``, or else in the first record.
    """
    data = bytearray()
    count = append_records(data, text, header)
    return data.decode("utf-8", "surrogatepass"), count


def append_records(data: bytearray, text: str, header: list[str] | None = None) -> int:
    """As :func:`counted_records`, at the end of ``data``, so that the JSON text of a file is made once
    and handed over as it is. ``data`` is as before if the text cannot be read."""
    begin = len(data)
    try:
        return _append_records(data, text, header)
    except csv.Error:
        del data[begin:]
        raise


def _append_records(data: bytearray, text: str, header: list[str] | None) -> int:
    rows, count = csv.reader(_lines(text)), 0
    names = next(rows, []) if header is None else header
    # Rows as wide as the header need no object: their texts go into the place of each name.
    usual = len(names) if len(set(names)) == len(names) else -1
    shape = ", ".join(f"{_text(name).replace('%', '%%')}: %s" for name in names)
    data += b"["
    for some in batched(filter(None, rows), RECORDS_AT_ONCE):
        piece = ", ".join([
            f"{{{shape % tuple(map(_text, row))}}}" if len(row) == usual
            else json.dumps(_record(names, row), ensure_ascii=False) for row in some])
        data += b", " if count else b""
        data += piece.encode("utf-8", "surrogatepass")
        count += len(some)
    data += b"]"
    return count


def _record(names: Sequence[str], row: Sequence[str]) -> dict:
    """A row as ``csv.DictReader`` gives it: absent fields are null, those beyond the header a list."""
    record = dict(zip(names, row, strict=False)) | dict.fromkeys(names[len(row):])
    return record | ({None: row[len(names):]} if len(row) > len(names) else {})


def _lines(text: str) -> Iterator[str]:
    """Lines with their ends, without the copy of four bytes a character that ``StringIO`` makes."""
    at = 0
    while at < len(text):
        end = text.find("\n", at) + 1 or len(text)
        yield text[at:end]
        at = end


def records_as_json(text: str, header: list[str] | None = None) -> str:
    return counted_records(text, header)[0]


def _parse_one(data: bytearray, content: pa.Buffer) -> tuple[str | None, int]:
    try:
        return None, append_records(data, str(content, "utf-8"))
    except (UnicodeDecodeError, csv.Error) as problem:
        return f"{type(problem).__name__}: {problem}", 0


def texts_of(data: bytearray, ends: Sequence[int], valid: Sequence[bool]) -> pa.Array:
    """A text column over the neighbouring slices of ``data``, which is not copied."""
    offsets = pa.array([0, *ends], pa.int32()).buffers()[1]
    return pa.Array.from_buffers(
        pa.string(), len(ends), [pa.array(valid, pa.bool_()).buffers()[1], offsets, pa.py_buffer(data)])


def _parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        contents = batch.column("content")
        data, found, size, start = bytearray(), [], 0, 0
        for place in range(batch.num_rows):
            content = contents[place].as_buffer()
            found.append((*_parse_one(data, content), len(data)))
            size += content.size
            if size >= YIELD_BYTES or place == batch.num_rows - 1:
                errors, counts, ends = zip(*found, strict=True)
                files = batch.slice(start, len(found))
                yield pa.RecordBatch.from_arrays(
                    [*[files.column(c) for c in ("path", "modificationTime", "length")],
                     pa.array([0] * len(found), pa.int64()),
                     texts_of(data, ends, [e is None for e in errors]),
                     pa.array(errors, pa.string()), pa.array(counts, pa.int64())],
                    names=[f.split()[0] for f in PARSED.split(", ")])
                data, found, size, start = bytearray(), [], 0, place + 1


def parse_files(files: DataFrame) -> DataFrame:
    """Parse whole files (``binaryFile`` rows), many files at once, one row each.

    Spark's own CSV reader takes one header for all files and binds by position; here each file
    brings its own header. Unreadable files give a row with ``error`` instead of ``data``.
    """
    return files.select("path", "modificationTime", "length", "content").mapInArrow(
        _parse_batches, PARSED)


def as_messages(parsed: DataFrame, root: str, published: Column,
                extra: Sequence[Column | str] = ()) -> DataFrame:
    """Parsed files as landing messages with their audit attributes, plus ``extra`` columns."""
    known = with_file_identity(parsed, root)
    instant = F.date_format(published, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    uploaded = F.date_format("modificationTime", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    attributes = F.create_map(
        F.lit("audit_id"), F.col("audit_id"),
        F.lit("entity"), F.col("entity"),
        F.lit("source_path"), F.col("source_path"),
        F.lit("source_file"), F.col("source_file"),
        F.lit("ingested_at"), instant,
        F.lit("uploaded_at"), uploaded,
        F.lit("part"), F.col("part").cast("string"),
        F.lit("records"), F.col("records").cast("string"))
    return known.select(
        F.lit(SUBSCRIPTION).alias("subscription_name"),
        F.concat_ws("-", "audit_id", "part").alias("message_id"),
        published.alias("publish_time"),
        "data", attributes.alias("attributes"), *extra)
