"""One run over all layers: both silver tables at the same time, then gold."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from tidemark.plans.gold import refresh_gold_transactions
from tidemark.plans.silver import refresh_silver_customers, refresh_silver_transactions
from tidemark.session import utc_now
from tidemark.sources.tables import Tables


def refresh_all(tables: Tables, now: datetime | None = None, id_mode: str = "strict",
                on_duplicate: str = "error") -> dict[str, int]:
    """Refresh silver and gold; returns the rows considered per table.

    The silver jobs do not depend on each other and run as two Spark jobs side by side. If one
    fails, its error ends the run before gold.
    """
    now = now or utc_now()
    jobs = {"silver_customers": refresh_silver_customers,
            "silver_transactions": refresh_silver_transactions}
    with ThreadPoolExecutor(len(jobs)) as pool:
        started = {name: pool.submit(job, tables, now, id_mode=id_mode,
                                     on_duplicate=on_duplicate) for name, job in jobs.items()}
        done = {name: job.result() for name, job in started.items()}
    done["gold_transactions"] = refresh_gold_transactions(tables, now, on_duplicate)
    return done
