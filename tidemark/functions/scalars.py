"""Column functions for cleaning text fields. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Text shapes a safe cast accepts. Spark's own casts take more ('2023', '1.5d', ' 7 ').
_DATE_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2}$"
_NUMBER_SHAPE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_NON_FINITE_SHAPE = r"(?i)^([+-]?inf(inity)?|nan)$"
_TIMESTAMP_SHAPE = (
    r"^\d{4}-\d{1,2}-\d{1,2}"
    r"([T ]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d{1,6})?)?( ?(Z|UTC|[+-]\d{1,2}(:\d{2})?))?)?$"
)


def _as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def empty_to_null(value: Column | str) -> Column:
    return F.nullif(_as_column(value), F.lit(""))


def safe_date(value: Column | str) -> Column:
    """A date, or NULL where the text is not a year-month-day."""
    value = _as_column(value)
    return F.when(value.rlike(_DATE_SHAPE), value.try_cast("date"))


def safe_double(value: Column | str) -> Column:
    """A double, or NULL where the text is not a number in the range of a double."""
    value = _as_column(value)
    # Only inside the branches: a cast of text that is no number costs an exception per row.
    number = value.try_cast("double")
    in_range = F.when(F.abs(number) != F.lit(float("inf")), number)
    return (F.when(value.rlike(_NUMBER_SHAPE), in_range)
            .when(value.rlike(_NON_FINITE_SHAPE), number))


def safe_timestamp(value: Column | str) -> Column:
    """A timestamp, or NULL where the text is not an ISO date or instant."""
    value = _as_column(value)
    return F.when(value.rlike(_TIMESTAMP_SHAPE), value.try_cast("timestamp"))


def _id_number(value: Column) -> Column:
    return F.substr(value, F.lit(2)).try_cast("bigint")


def well_formed_customer_id(value: Column | str) -> Column:
    """False only for ids that have no whole number after their first character."""
    value = _as_column(value)
    return value.isNull() | _id_number(value).isNotNull()


def normalize_customer_id(value: Column | str, mode: str = "strict") -> Column:
    """Drop the zero padding of an id's number: ``C01`` becomes ``C1``.

    ``strict`` fails the job on a malformed id whatever the session's ANSI setting;
    ``quarantine`` gives NULL, for use behind :func:`well_formed_customer_id`.
    """
    if mode not in ("strict", "quarantine"):
        raise ValueError(f"unknown mode {mode!r}")
    value = _as_column(value)
    tidy = F.concat(F.left(value, F.lit(1)), _id_number(value).cast("string"))
    if mode == "quarantine":
        return tidy
    complaint = F.raise_error(F.concat(F.lit("malformed customer id: '"), value, F.lit("'")))
    return F.when(~well_formed_customer_id(value), complaint).otherwise(tidy)


def month_start(day: Column | str) -> Column:
    return F.trunc(_as_column(day), "month")


def quarter_start(day: Column | str) -> Column:
    return F.trunc(_as_column(day), "quarter")


def register_sql_functions(spark: SparkSession, database: str | None = None) -> None:
    """Offer the id normalization to SQL users, as a function of the session or of a database."""
    kind = f"FUNCTION {database}." if database else "TEMPORARY FUNCTION "
    spark.sql(
        f"CREATE OR REPLACE {kind}func_normalize_customer_id(id STRING) RETURNS STRING "
        "RETURN concat(substring(id, 1, 1), string(cast(substring(id, 2) AS BIGINT)))")
