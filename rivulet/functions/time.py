"""Time helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_ms_to_ts_seconds(ms: Column) -> Column:
    """Event time in epoch milliseconds -> timestamp at second precision (session zone)."""
    return F.timestamp_seconds(F.floor(ms / 1000))


def month_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def batch_id_for_date(d: Column) -> Column:
    """``batch_YYYYMMDD`` for a date column (same rule as the run context)."""
    return F.concat(F.lit("batch_"), F.date_format(d, "yyyyMMdd"))


def try_parse_ts(raw: Column) -> Column:
    """Parse a raw ISO string; NULL when it is not a valid timestamp (never raises)."""
    return F.try_to_timestamp(raw)
