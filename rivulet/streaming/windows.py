"""Event-time aggregates with watermarks (append mode: a window is emitted once it is closed)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_event_time(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Event time as TIMESTAMP (the watermark rejects TIMESTAMP_NTZ) plus the watermark."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def tumbling(df: DataFrame, ts: str, size: str, keys: list[str], delay: str) -> DataFrame:
    w = F.window(ts, size)
    return (with_event_time(df, ts, delay).groupBy(w.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n"))


def sliding(df: DataFrame, ts: str, size: str, slide: str, keys: list[str], delay: str) -> DataFrame:
    w = F.window(ts, size, slide)
    return (with_event_time(df, ts, delay).groupBy(w.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n"))


def sessions(df: DataFrame, ts: str, gap: str, keys: list[str], delay: str) -> DataFrame:
    w = F.session_window(ts, gap)
    return (with_event_time(df, ts, delay).groupBy(w.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *keys, "n"))


def dedup_within_watermark(df: DataFrame, ts: str, keys: list[str], delay: str) -> DataFrame:
    """Stateful de-duplication; state for a key is dropped once the watermark
    passes it.  Copies are told apart after the watermark only, so a late copy
    never stands in for one that is on time."""
    return with_event_time(df, ts, delay).dropDuplicatesWithinWatermark(keys)


def interval_join(left: DataFrame, right: DataFrame, key: str, lts: str, rts: str, within: str,
                  delay: str) -> DataFrame:
    """Stream-stream inner join: right event within ``within`` after the left one
    (both sides watermarked, so join state is bounded)."""
    lw = with_event_time(left, lts, delay).alias("l")
    rw = with_event_time(right, rts, delay).alias("r")
    cond = ((F.col(f"l.{key}") == F.col(f"r.{key}")) & (F.col(f"r.{rts}") >= F.col(f"l.{lts}"))
            & (F.col(f"r.{rts}") <= F.col(f"l.{lts}") + F.expr(f"INTERVAL {within}")))
    return lw.join(rw, cond, "inner")
