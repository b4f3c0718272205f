"""Quality gate of a stream: a micro-batch with too many rejected rows stops the query and is not committed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from rivulet.operators.quality import Rule, rejected, split, tag


class RejectedShareTooHigh(RuntimeError):
    """Raised inside the query, which ends with it; the micro-batch is read again by the next run."""


class ObservedShares(StreamingQueryListener):
    """Rows and rejected rows of every micro-batch of one query, as its progress reports them.

    ``total_limit`` also stops the query (between micro-batches) once the share over all
    batches so far is above it: many batches just below the gate are then noticed too.
    """

    def __init__(self, spark: SparkSession, name: str, total_limit: float | None = None):
        self.spark, self.name, self.total_limit = spark, name, total_limit
        self.batches: dict[int, tuple[int, int]] = {}

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        seen = event.progress.observedMetrics.get(self.name)
        if seen is None or not seen["rows"]:
            return
        self.batches[event.progress.batchId] = (seen["rows"], seen["rejected"])
        rows, bad = map(sum, zip(*self.batches.values()))
        if self.total_limit is not None and bad > self.total_limit * rows:
            for q in self.spark.streams.active:
                if str(q.id) == str(event.progress.id):
                    q.stop()

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def start_gated(stream: DataFrame, rules: list[Rule], table: str, record_id: Column, path: str, checkpoint: str,
                max_share: float, trigger: dict | None = None, metrics: str | None = None) -> StreamingQuery:
    """Route a stream by ``rules`` into ``path/valid`` and ``path/errors``, one folder per micro-batch.

    A batch is written to ``path/staged`` first, tagged, while its rows are
    counted; only if at most ``max_share`` of them are rejected are the two sides
    published, else :class:`RejectedShareTooHigh` ends the query before anything
    of the batch is visible.  A replayed batch overwrites its own folders.  With
    ``metrics`` the counts are also observed under that name (see
    :class:`ObservedShares`).
    """
    base = path.rstrip("/")
    counts = (F.count(F.lit(1)).alias("rows"), F.count(F.when(rejected(), 1)).alias("rejected"))
    tagged = tag(stream, rules)
    if metrics:
        tagged = tagged.observe(metrics, *counts)

    def run(batch: DataFrame, batch_id: int) -> None:
        seen, staged = Observation(f"gate-{batch_id}"), f"{base}/staged"
        batch.observe(seen, *counts).write.mode("overwrite").parquet(staged)
        rows, bad = seen.get["rows"], seen.get["rejected"]
        if rows and bad > max_share * rows:
            raise RejectedShareTooHigh(f"{table}, batch {batch_id}: {bad} of {rows} rows rejected, at most {max_share:.2%} may be")
        valid, errors = split(batch.sparkSession.read.parquet(staged), table, record_id, str(batch_id))
        valid.write.mode("overwrite").parquet(f"{base}/valid/batch_id={batch_id}")
        errors.drop("batch_id").write.mode("overwrite").parquet(f"{base}/errors/batch_id={batch_id}")

    return (tagged.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "15 seconds"})).start())
