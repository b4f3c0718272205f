"""One stream of mixed tables to several sinks, read and decoded once per micro-batch."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rivulet.functions.frames import strip_frame
from rivulet.operators.cdc import TableConfig, decode, normalize
from rivulet.table import VersionedTable


@dataclass(frozen=True)
class Route:
    """Rows of the stream for which ``chosen`` holds go to ``write(rows, batch_id)``, which must overwrite what it wrote for the id."""

    name: str
    chosen: Column
    write: Callable[[DataFrame, int], object]


def source_table() -> Column:
    """The captured table that a log record belongs to (from the envelope's source block)."""
    return F.get_json_object(strip_frame(F.col("value")).cast("string"), "$.source.table")


def table_route(name: str, cfg: TableConfig, envelope: T.StructType, table: VersionedTable) -> Route:
    """Route of one captured table into its versioned table."""
    return Route(name, F.col("_table") == name,
                 lambda rows, batch_id: table.commit(normalize(decode(rows, envelope), cfg), batch_id))


def deliver(batch: DataFrame, batch_id: int, routes: list[Route]) -> dict[str, object]:
    """Write a micro-batch to all routes; it is kept while they write, so the source is read once.

    A failure in one route fails the batch; the run that repeats it overwrites
    what the routes before it wrote, so every sink holds each batch once.
    """
    kept = batch.persist()
    try:
        return {r.name: r.write(kept.filter(r.chosen), batch_id) for r in routes}
    finally:
        kept.unpersist()


def start_fan_out(stream: DataFrame, routes: list[Route], checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Start one query that feeds all ``routes`` from one pass over the log."""
    rows = stream.withColumn("_table", source_table())
    return (rows.writeStream.foreachBatch(lambda batch, batch_id: (deliver(batch, batch_id, routes), None)[1])
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "15 seconds"})).start())
