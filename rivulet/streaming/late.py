"""Late-data routing: rows behind the watermark go to a side table instead of being dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.session import path_exists


def route_late(stream: DataFrame, ts: str, delay: str, on_time_path: str, late_path: str, checkpoint: str,
               trigger: dict | None = None) -> None:
    """Inside ``foreachBatch``: watermark = (latest event time of earlier
    micro-batches) - delay.  Rows older than it go to ``late_path`` with the
    watermark they missed; the rest go to ``on_time_path``.

    Each micro-batch owns the folder ``batch_id=<n>`` of both outputs and of
    the watermark table, which holds the latest event time up to and including
    that batch.  A replayed batch reads its predecessor's watermark again and
    overwrites its own folders, so it changes nothing.
    """
    seen_path = checkpoint.rstrip("/") + "_watermark"

    def folder(base: str, batch_id: int) -> str:
        return f"{base.rstrip('/')}/batch_id={batch_id}"

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = None
        if batch_id > 0 and path_exists(spark, folder(seen_path, batch_id - 1)):
            before = spark.read.schema("max_seen timestamp").parquet(folder(seen_path, batch_id - 1)).first()["max_seen"]
        rows = batch.withColumn(ts, F.col(ts).cast("timestamp")).persist()
        try:
            mark = F.lit(before).cast("timestamp") - F.expr(f"INTERVAL {delay}")
            late = F.coalesce(F.col(ts) < mark, F.lit(False))
            rows.filter(~late).write.mode("overwrite").parquet(folder(on_time_path, batch_id))
            rows.filter(late).withColumn("watermark", mark).write.mode("overwrite").parquet(folder(late_path, batch_id))
            latest = rows.agg(F.max(ts).alias("max_seen")).select(
                F.greatest("max_seen", F.lit(before).cast("timestamp")).alias("max_seen"))
            latest.coalesce(1).write.mode("overwrite").parquet(folder(seen_path, batch_id))
        finally:
            rows.unpersist()

    q = (stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
         .trigger(**(trigger or {"availableNow": True})).start())
    q.awaitTermination()
