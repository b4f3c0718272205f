"""SCD type 2 kept up incrementally: changes in any order, also late ones, are merged into a stored history.

The stored history has one row per change: the change itself, whether it
``opens`` something (a new image, or a delete, which ends the version before it)
and, where it does, ``valid_to``, the time of the next change that opens
something.  A late change that falls inside a version splits it: the row before
it gets a new ``valid_to``, and the row after it may open a version that it only
repeated so far.  Repeats are kept because a later split can make them boundaries.

Only the keys that a batch touches are worked out again, and only the buckets of
the table that hold them are rewritten, some at a time: what a merge needs on
disk besides the table and the batch does not grow with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rivulet.operators.cdc import DAY_MS, ORDER_COLS, TableConfig, decode, normalize
from rivulet.operators.sequence import shift, time_chunk
from rivulet.session import folder_bytes, path_exists, remove_path, shuffles_removed

#: Folders of a stored history; a batch rewrites those that hold one of its keys.
BUCKETS = 64
#: Bytes of Parquet, stored and new, that are merged at a time (at least one bucket).
ROUND_BYTES = 128 * 1024 * 1024


def _raw_columns(cfg: TableConfig) -> list[str]:
    return [cfg.key, "op", *ORDER_COLS, cfg.ts_col, *cfg.columns]


def _as_it_is(rows: DataFrame, name: str) -> DataFrame:
    return rows


def history_rows(changes: DataFrame, cfg: TableConfig, chunk_ms: int = DAY_MS,
                 keep: Callable[[DataFrame, str], DataFrame] = _as_it_is) -> DataFrame:
    """Every change with ``opens`` and ``valid_to``; windows are cut into event-time
    chunks, so a key with a very long history is not one task.  ``keep`` may store
    rows that are read more than once."""
    key, order = cfg.key, list(ORDER_COLS)
    chunk = time_chunk(F.col("ts_ms"), chunk_ms)
    image = F.struct(*[F.col(c) for c in cfg.columns])
    gone = F.coalesce(F.col("op") == "d", F.lit(False))
    step = shift(changes.select(*_raw_columns(cfg)), key, order,
                 F.struct(image.alias("image"), F.col("op").alias("op")), "_prev", chunk)
    opens = gone | F.col("_prev").isNull() | F.coalesce(F.col("_prev.op") == "d", F.lit(False)) \
        | ~image.eqNullSafe(F.col("_prev.image"))
    marked = keep(step.withColumn("opens", opens).drop("_prev"), "marked")
    bounds = shift(marked.filter("opens"), key, order, F.col(cfg.ts_col), "valid_to", chunk, forward=True)
    return bounds.unionByName(marked.filter("NOT opens").withColumn("valid_to", F.lit(None).cast("timestamp")))


def merge_history(stored: DataFrame, changes: DataFrame, cfg: TableConfig,
                  keep: Callable[[DataFrame, str], DataFrame] = _as_it_is) -> DataFrame:
    """``stored`` (rows of :func:`history_rows`) with ``changes`` merged in.

    The result is that of :func:`history_rows` over all changes, whatever the
    order in which they came; a change that is delivered again (same key and
    order columns) counts once.  Keys without a change pass through unchanged.
    """
    raw = _raw_columns(cfg)
    touched = changes.select(cfg.key).distinct()
    rows = stored.join(touched, cfg.key, "left_semi").select(*raw).unionByName(changes.select(*raw)) \
        .dropDuplicates([cfg.key, *ORDER_COLS])
    rows = keep(rows, "rows")
    same = stored.join(touched, cfg.key, "left_anti").select(*raw, "opens", "valid_to")
    return same.unionByName(history_rows(rows, cfg, keep=keep).select(*raw, "opens", "valid_to"))


def versions(history: DataFrame, cfg: TableConfig) -> DataFrame:
    """The versions of a stored history: key, columns, valid_from, valid_to, is_current, partition, offset."""
    return history.filter(F.col("opens") & ~F.coalesce(F.col("op") == "d", F.lit(False))).select(
        cfg.key, *cfg.columns, F.col(cfg.ts_col).alias("valid_from"), "valid_to",
        F.col("valid_to").isNull().alias("is_current"), *[c for c in ORDER_COLS if c != "ts_ms"])


def read_history(spark: SparkSession, path: str, cfg: TableConfig) -> DataFrame:
    """The stored history below ``path`` with its bucket (empty if there is none yet)."""
    types = {cfg.key: "long", "op": "string", "ts_ms": "long", "partition": "int", "offset": "long",
             cfg.ts_col: "timestamp", **cfg.columns, "opens": "boolean", "valid_to": "timestamp", "bucket": "int"}
    schema = ", ".join(f"{c} {t}" for c, t in types.items())
    table = f"{path.rstrip('/')}/history"
    return spark.read.schema(schema).parquet(table) if path_exists(spark, table) else spark.createDataFrame([], schema)


def upsert_history(spark: SparkSession, path: str, changes: DataFrame, cfg: TableConfig, buckets: int = BUCKETS) -> int:
    """Merge a batch of normalised changes into the history below ``path``; returns the number of buckets rewritten.

    The batch is written first.  Then, for some of its buckets at a time, their new
    content is written next to the table and the buckets are overwritten from there:
    nothing is read and written at once, and a batch that stops half-way can simply
    be given again.  Each step's shuffle files go when it ends, and what is written
    next to the table is removed at the end.
    """
    base = path.rstrip("/")
    bucket = F.pmod(F.xxhash64(cfg.key), F.lit(buckets)).cast("int").alias("bucket")

    def keep(rows: DataFrame, name: str) -> DataFrame:
        with shuffles_removed(spark):
            rows.write.mode("overwrite").parquet(f"{base}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{base}/{name}")

    batch = keep(changes.select(*_raw_columns(cfg), bucket), "incoming")
    with shuffles_removed(spark):
        hit = sorted(r[0] for r in batch.select("bucket").distinct().collect())  # at most ``buckets`` numbers
    size = folder_bytes(spark, f"{base}/incoming") + folder_bytes(spark, f"{base}/history") * len(hit) // buckets
    rounds = min(len(hit), size // ROUND_BYTES + 1)
    for n in range(rounds):
        some = F.col("bucket").isin(hit[n::rounds])
        stored = read_history(spark, base, cfg).filter(some).drop("bucket")
        merged = keep(merge_history(stored, batch.filter(some).drop("bucket"), cfg, keep), "merged")
        with shuffles_removed(spark):
            # a bucket's rows go to several writers, in runs of event time
            (merged.select("*", bucket)
                .repartition("bucket", F.floor(F.col("ts_ms") / DAY_MS) % 8).sortWithinPartitions("bucket", cfg.key, *ORDER_COLS)
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(f"{base}/history"))
    for name in ("incoming", "rows", "marked", "merged"):
        remove_path(spark, f"{base}/{name}")
    return len(hit)


def start_history(stream: DataFrame, path: str, cfg: TableConfig, envelope, checkpoint: str,
                  trigger: dict | None = None, buckets: int = BUCKETS) -> StreamingQuery:
    """Keep the history below ``path`` up to date from a stream of log records (a replayed micro-batch changes nothing)."""
    def run(batch: DataFrame, batch_id: int) -> None:
        upsert_history(batch.sparkSession, path, normalize(decode(batch, envelope), cfg), cfg, buckets)

    return (stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "15 seconds"})).start())
