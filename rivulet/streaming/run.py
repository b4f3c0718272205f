"""Helpers to drive a stream to completion (tests, backfills) and to collect progress."""

from __future__ import annotations

import time
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rivulet.session import path_exists

def to_parquet_available_now(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Append a stream to Parquet, processing everything available, then stop."""
    q = (df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
         .outputMode(mode).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


class ProgressLog:
    """Per micro-batch metrics of streaming queries, appended to a table as they
    are reported: none is lost when a query runs longer than Spark's own history.

    ``batch_seconds`` is the trigger's run time, ``lag_seconds`` the time from
    the batch's start to its report, and ``checkpoint_age_seconds`` the time
    since the batch before it was reported.  Reports are written together, after
    ``flush_every`` of them or ``flush_seconds``, whichever is first, and at the end.
    """

    SCHEMA = ("query_id string, query_name string, batch_id long, num_input_rows long, input_rows_per_second double, "
              "processed_rows_per_second double, batch_seconds double, lag_seconds double, checkpoint_age_seconds double")

    def __init__(self, spark: SparkSession, path: str, flush_every: int = 50, flush_seconds: float = 60.0):
        from pyspark.sql.streaming import StreamingQueryListener

        self.spark, self.path, self.rows, self.since = spark, path, [], time.monotonic()
        log, last = self, {}

        class Listener(StreamingQueryListener):
            def onQueryStarted(self, event):
                pass

            def onQueryProgress(self, event):
                p, now = event.progress, time.time()
                began = datetime.fromisoformat(p.timestamp.replace("Z", "+00:00")).timestamp()
                row = (str(p.id), p.name, int(p.batchId), int(p.numInputRows), float(p.inputRowsPerSecond or 0.0),
                       float(p.processedRowsPerSecond or 0.0), (p.durationMs or {}).get("triggerExecution", 0) / 1000,
                       now - began, now - last.get(p.id, began))
                last[p.id] = now
                log.rows.append(row)
                if len(log.rows) >= flush_every or time.monotonic() - log.since >= flush_seconds:
                    log.flush()

            def onQueryIdle(self, event):
                pass

            def onQueryTerminated(self, event):
                log.flush()

        self.listener = Listener()
        spark.streams.addListener(self.listener)

    def flush(self) -> None:
        """Append the reports that are held to the table, as one file."""
        rows, self.rows, self.since = self.rows, [], time.monotonic()
        if rows:
            self.spark.createDataFrame(rows, self.SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def close(self) -> DataFrame:
        """Stop listening, after what is under way is written; returns the table (one row per batch)."""
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        self.spark.streams.removeListener(self.listener)
        self.flush()
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(self.path)
