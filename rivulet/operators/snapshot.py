"""Incremental snapshot: a source table is read in key ranges beside its live change log.

While a range is read the source goes on changing, so the rows read may be older
or newer than the log says.  Each range therefore has a window of the log: the
position before the read (low) and after it (high).  Rows whose key the log
changed inside the window are dropped - the log has them - and all others are the
same at low and at high, so they take the high position in one order with the
log.  Finished ranges are folders of a chunk table; a run that stops goes on with
the first range that has none.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.operators.cdc import ORDER_COLS, TableConfig
from rivulet.session import path_exists

#: Changes and chunk rows in one order: the log position first.
ORDER = ("position", *ORDER_COLS)


class Source(Protocol):
    """A table that can be read by key range while its changes go to a log."""

    def position(self) -> int:
        """The newest position of the log."""

    def rows(self, low: int, high: int) -> DataFrame:
        """The rows with ``low <= key < high`` as they are now."""

    def changes(self, after: int, upto: int) -> DataFrame:
        """The log's changes (at least the key) with ``after < position <= upto``."""


def key_ranges(low: int, high: int, width: int) -> Iterator[tuple[int, int, int]]:
    """(number, first key, key after the last) of the ranges of ``width`` keys that cover ``low`` to ``high``."""
    for n, a in enumerate(range(low, high + 1, width)):
        yield n, a, min(a + width, high + 1)


def snapshot_ranges(spark: SparkSession, source: Source, cfg: TableConfig, path: str, ranges, limit: int | None = None) -> int:
    """Read the ranges that are not in the chunk table below ``path`` yet, at most ``limit``; returns how many were read.

    The rows of a range are fixed by writing them (the read ends there, before the
    high position is asked), then cleaned of the window's keys and published as
    ``chunks/chunk=<n>``.  A range that was read but not published is read again.
    """
    base, done = path.rstrip("/"), 0
    for n, low_key, high_key in ranges:
        if path_exists(spark, f"{base}/chunks/chunk={n}/_SUCCESS"):
            continue
        if limit is not None and done == limit:
            break
        low = source.position()
        source.rows(low_key, high_key).select(*cfg.target_columns).write.mode("overwrite").parquet(f"{base}/read")
        high = source.position()
        inside = F.col(cfg.key).between(low_key, high_key - 1)
        touched = source.changes(low, high).filter(inside).select(cfg.key).distinct()
        (spark.read.parquet(f"{base}/read").join(touched, cfg.key, "left_anti")
            .withColumn("position", F.lit(high).cast("long")).write.mode("overwrite").parquet(f"{base}/chunks/chunk={n}"))
        done += 1
    return done


def chunk_changes(spark: SparkSession, path: str, cfg: TableConfig) -> DataFrame:
    """The chunk table as ``op='r'`` changes with their log position, to be collapsed with the log's by :data:`ORDER`."""
    types = {cfg.key: "long", **cfg.columns, **({cfg.ts_col: "timestamp"} if cfg.ts_col else {}), "position": "long"}
    rows = spark.read.schema(", ".join(f"{c} {t}" for c, t in types.items())).parquet(f"{path.rstrip('/')}/chunks")
    return rows.select(F.lit("r").alias("op"), F.lit(None).cast("long").alias("ts_ms"), F.lit(None).cast("int").alias("partition"),
                       F.lit(None).cast("long").alias("offset"), *cfg.target_columns, "position")
