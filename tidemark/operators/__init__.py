from tidemark.operators.consolidate import consolidate
from tidemark.operators.enrich import enrich
from tidemark.operators.envelope import (
    discover_fields,
    discover_schema,
    explode_records,
    unreadable,
)
from tidemark.operators.incremental import (
    latest_per_path,
    new_events,
    newest_messages,
    watermark,
)
from tidemark.operators.reconcile import missing_rows
from tidemark.operators.running import running_sums
from tidemark.operators.upsert import find_matches, newest_per_key, rows_to_write, survivors, upsert

__all__ = [
    "consolidate", "discover_fields", "discover_schema", "enrich", "explode_records",
    "find_matches", "latest_per_path", "missing_rows", "new_events", "newest_messages",
    "newest_per_key", "rows_to_write", "running_sums", "survivors", "unreadable", "upsert",
    "watermark",
]
