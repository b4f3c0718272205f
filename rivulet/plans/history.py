"""Histories that are kept up as changes arrive."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.operators import cdc as C
from rivulet.operators import scd2 as H
from rivulet.operators import snapshot as S
from rivulet.plans.cdc import EVENTS_CHANGES_SQL, MERGED_SQL, SCD2_SQL, normalized, orders_target
from rivulet.plans.registry import register
from rivulet.plans.streaming import run_to_parquet
from rivulet.session import scratch_path
from rivulet.sources import changelog as L


@register("scd2_incremental", sql=SCD2_SQL)
def scd2_incremental(spark, sf):
    """The history after three deliveries: the log's even batches, then the odd ones (all late: they split
    versions that are closed already), then the odd ones again (a replay)."""
    path = scratch_path(spark, "scd2_history")
    changes = normalized(spark, sf)
    for odd in (0, 1, 1):
        H.upsert_history(spark, path, changes.filter(F.pmod("batch_id", F.lit(2)) == odd), C.ORDERS)
    return H.versions(H.read_history(spark, path, C.ORDERS), C.ORDERS)


#: Off the whole hour, so that the watermark meets no change's time exactly.
SCD2_DELAY = "90 minutes"


@register("stream_scd2", sql=f"""
SELECT order_id, customer_id, amount, status, valid_from, valid_to, "partition", "offset"
FROM ({SCD2_SQL}) v
WHERE valid_to <= (SELECT epoch_ms(max(ts_ms)) FROM ({EVENTS_CHANGES_SQL}) e) - INTERVAL {SCD2_DELAY}
""")
def stream_scd2(spark, sf):
    """Closed order versions as an append stream: each is emitted once the watermark has passed its end."""
    from rivulet.streaming.scd2 import closed_versions

    log = L.read_change_stream(spark, L.events_change_log(spark, sf))
    changes = C.normalize(C.decode(log, L.ORDER_ENVELOPE), C.ORDERS, with_event_ts=True)
    return run_to_parquet(spark, closed_versions(changes, C.ORDERS, SCD2_DELAY), "closed_versions")


class WrittenOn:
    """The orders table while the change log is applied to it: each look at the log's
    position finds one more batch, so every range is read in the middle of changes."""

    def __init__(self, spark, sf):
        self.base, self.log = orders_target(spark, sf), normalized(spark, sf)
        self.batches = [r[0] for r in self.log.select("batch_id").distinct().orderBy("batch_id").collect()]
        self.seen = 0

    def position(self) -> int:
        self.seen += 1
        return self.batches[min(self.seen, len(self.batches)) - 1]

    def rows(self, low, high):
        # the read falls between two looks at the log: half of the next batch is there already
        at = self.batches[min(self.seen, len(self.batches)) - 1]
        after = self.batches[min(self.seen, len(self.batches) - 1)]
        there = (F.col("batch_id") <= at) | ((F.col("batch_id") == after) & (F.col("offset") % 2 == 0))
        inside = F.col("order_id").between(low, high - 1)
        return C.apply_changes(self.base.filter(inside), self.log.filter(there & inside), C.ORDERS)

    def changes(self, after, upto):
        return self.log.filter((F.col("batch_id") > after) & (F.col("batch_id") <= upto))


#: Ranges of the order keys that one query reads.
SNAPSHOT_RANGES = 4


@register("cdc_chunk_snapshot", sql=MERGED_SQL)
def cdc_chunk_snapshot(spark, sf):
    """Snapshot of the orders table in key ranges while its log goes on, stopped after half of them and
    resumed by another run; chunk rows and log together give the state that all changes give."""
    path, source = scratch_path(spark, "chunk_snapshot"), WrittenOn(spark, sf)
    keys = source.base.agg(F.min("order_id"), F.max("order_id")).first()
    ranges = list(S.key_ranges(keys[0], keys[1], (keys[1] - keys[0]) // SNAPSHOT_RANGES + 1))
    S.snapshot_ranges(spark, source, C.ORDERS, path, ranges, limit=SNAPSHOT_RANGES // 2)
    S.snapshot_ranges(spark, source, C.ORDERS, path, ranges)
    log = source.log.withColumnRenamed("batch_id", "position")
    last = C.collapse(S.chunk_changes(spark, path, C.ORDERS).unionByName(log), C.ORDERS, S.ORDER)
    return last.filter("op <> 'd'").select(*C.ORDERS.target_columns)
