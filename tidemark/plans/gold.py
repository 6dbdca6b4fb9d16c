"""From silver to the enriched gold table."""

from __future__ import annotations

from datetime import datetime

from tidemark.operators import enrich, watermark
from tidemark.operators.incremental import EPOCH
from tidemark.plans.lineage import late_gold_rows
from tidemark.session import utc_now
from tidemark.sources.tables import Tables, merge_into, replace_all


def refresh_gold_transactions(tables: Tables, now: datetime | None = None,
                              on_duplicate: str = "error") -> int:
    """Upsert transactions ingested since the last gold run; returns the rows considered.

    A later change of a customer does not reach rows that are already in gold; see
    :func:`refresh_gold_full`.
    """
    now = now or utc_now()
    mark = watermark(tables.read("gold_transactions"), "_ingested_at", now)
    fresh = enrich(tables.read("silver_transactions"), tables.read("silver_customers"), mark, now)
    with tables.run() as run:
        return merge_into(run, "gold_transactions", fresh, "transaction_id",
                          on_duplicate=on_duplicate)


def promote_late(tables: Tables, now: datetime | None = None,
                 on_duplicate: str = "error") -> int:
    """Upsert the transactions that gold's mark has passed by; returns the rows considered."""
    now = now or utc_now()
    late = enrich(late_gold_rows(tables, now), tables.read("silver_customers"), EPOCH, now)
    with tables.run() as run:
        return merge_into(run, "gold_transactions", late, "transaction_id",
                          on_duplicate=on_duplicate)


def refresh_gold_full(tables: Tables, now: datetime | None = None) -> None:
    """Write gold anew from all of silver, with the customers as they are now."""
    everything = enrich(tables.read("silver_transactions"), tables.read("silver_customers"),
                        EPOCH, now or utc_now())
    with tables.run() as run:
        replace_all(run, "gold_transactions", everything)
