"""Retention by partition folders: old days are dropped whole, kept ones are not touched."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import SparkSession

from rivulet.session import remove_path


def partition_days(spark: SparkSession, path: str, column: str) -> list[date]:
    """The days of a table laid out in ``column=<day>`` folders, oldest first (from the folders; no row is read)."""
    rows = spark.read.parquet(path).select(column).distinct().where(f"{column} IS NOT NULL").collect()
    return sorted(date.fromisoformat(str(r[0])) for r in rows)


def drop_old_days(spark: SparkSession, path: str, column: str, keep_days: int, newest: date | None = None) -> list[date]:
    """Remove the day folders that are ``keep_days`` or more older than the ``newest`` day (the table's own by
    default); returns them.  Nothing is rewritten, and dropping again drops nothing."""
    days = partition_days(spark, path, column)
    if not days:
        return []
    limit = (newest or days[-1]) - timedelta(days=keep_days)
    old = [d for d in days if d <= limit]
    for d in old:
        remove_path(spark, f"{path.rstrip('/')}/{column}={d.isoformat()}")
    return old
