from tidemark.functions.measures import STATUSES, ratio, status_breakdown
from tidemark.functions.scalars import (
    empty_to_null,
    month_start,
    normalize_customer_id,
    quarter_start,
    register_sql_functions,
    safe_date,
    safe_double,
    safe_timestamp,
    well_formed_customer_id,
)

__all__ = [
    "STATUSES", "empty_to_null", "month_start", "normalize_customer_id", "quarter_start", "ratio",
    "register_sql_functions", "safe_date", "safe_double", "safe_timestamp", "status_breakdown",
    "well_formed_customer_id",
]
