"""Streaming change capture: log -> decode -> normalise -> commit per micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from rivulet.operators.cdc import TableConfig, decode, normalize, split_dead_letters
from rivulet.table import VersionedTable


def upsert_batch(table: VersionedTable, cfg: TableConfig, envelope, dead_letter_path: str | None = None,
                 compact_every: int | None = None):
    """The foreachBatch callback: decode and normalise the micro-batch and
    commit it under the micro-batch id (nothing is recorded for an empty one).  The commit overwrites its
    own batch folder, so a replayed micro-batch replaces itself (exactly-once
    effect with an at-least-once source).  With ``compact_every`` the log is
    folded into a snapshot after every so many micro-batches."""
    def run(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        if compact_every and (batch_id + 1) % compact_every == 0:
            table.compact()

    def write(batch: DataFrame, batch_id: int) -> None:
        # an empty micro-batch writes nothing and records no commit (see VersionedTable.commit)
        if dead_letter_path is None:
            table.commit(normalize(decode(batch, envelope), cfg), batch_id)
            return
        # undecodable records go to the dead-letter folder of this batch (overwritten on replay)
        b = batch.persist()
        try:
            good, dead = split_dead_letters(b, envelope)
            dead.write.mode("overwrite").parquet(f"{dead_letter_path}/batch_id={batch_id}")
            table.commit(normalize(good, cfg), batch_id)
        finally:
            b.unpersist()
    return run


def start_cdc(stream: DataFrame, table: VersionedTable, cfg: TableConfig, envelope, checkpoint: str,
              trigger: dict | None = None, name: str | None = None,
              dead_letter_path: str | None = None, compact_every: int | None = None) -> StreamingQuery:
    """Start the CDC apply stream (default trigger: every 15 seconds).  Without
    ``dead_letter_path`` an undecodable record stops the query (FAILFAST)."""
    w = (stream.writeStream.foreachBatch(upsert_batch(table, cfg, envelope, dead_letter_path, compact_every))
         .option("checkpointLocation", checkpoint).outputMode("update"))
    if name:
        w = w.queryName(name)
    w = w.trigger(**(trigger or {"processingTime": "15 seconds"}))
    return w.start()
