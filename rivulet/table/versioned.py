"""A table kept as its changes, partitioned by batch.

Layout below ``path``::

    log/batch_id=<n>/        the collapsed changes of commit n (a partition overwrite; a replay replaces itself)
    snapshot/upto=<n>/       the last change of every key as of n (a partition overwrite)
    expired/                 one row: the oldest id that may still be read

There is no other metadata: the state as of n is a plain keep-last-per-key job
over the newest snapshot at or before n and the batches after it, both chosen by
partition.  Snapshots keep the order columns and the tombstones of deleted keys,
so a change that arrives late meets the same rows whether the log was folded or
not.  Atomic multi-file commits, generations and concurrent writers are left to a
real table format; here one job writes a table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rivulet.operators.cdc import ORDER_COLS, TableConfig
from rivulet.session import path_exists, remove_path


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, cfg: TableConfig, event_order: bool = False):
        """``event_order``: the last change per key is chosen by event order
        (ts_ms, partition, offset) before commit order, so commits that arrive
        out of order cannot let an older change win (the "guard" option)."""
        self.spark, self.path, self.cfg = spark, path.rstrip("/"), cfg
        self.order = (*ORDER_COLS, "batch_id") if event_order else ("batch_id", *ORDER_COLS)
        self.log_path = f"{self.path}/log"
        self.snap_path = f"{self.path}/snapshot"
        self.floor_path = f"{self.path}/expired"
        types = {cfg.key: "long", **cfg.columns, **({cfg.ts_col: "timestamp"} if cfg.ts_col else {})}
        self.state_schema = ", ".join(f"{c} {t}" for c, t in types.items())
        self.row_schema = f"{self.state_schema}, op string, ts_ms long, partition int, offset long"

    # ------------------------------------------------------------ metadata
    def _floor(self) -> int | None:
        """The oldest readable id; None if nothing was expired."""
        if not path_exists(self.spark, self.floor_path):
            return None
        return self.spark.read.schema("before long").parquet(self.floor_path).first()["before"]

    def log(self) -> DataFrame:
        """All changes that may still be read, with ``batch_id`` and ``committed_at``."""
        if not path_exists(self.spark, self.log_path):
            return self.spark.createDataFrame([], f"{self.row_schema}, committed_at timestamp, batch_id long")
        rows = self.spark.read.schema(f"{self.row_schema}, committed_at timestamp, batch_id long").parquet(self.log_path)
        floor = self._floor()
        return rows if floor is None else rows.filter(F.col("batch_id") >= floor)

    def _snapshots(self) -> DataFrame | None:
        if not path_exists(self.spark, self.snap_path):
            return None
        return self.spark.read.schema(f"{self.row_schema}, batch_id long, operation string, folded_at timestamp, upto long") \
            .parquet(self.snap_path)

    def history(self) -> DataFrame:
        """One row per commit and per fold of the log, newest first."""
        rows = self.log().groupBy(F.col("batch_id").alias("snapshot_id")).agg(
            F.max("committed_at").alias("committed_at"), F.lit("append").alias("operation"),
            F.lit(None).cast("long").alias("base_snapshot"), F.count(F.lit(1)).alias("added_changes"))
        folds = self._snapshots()
        if folds is not None:
            rows = rows.unionByName(folds.groupBy(F.col("upto").alias("snapshot_id"), "operation").agg(
                F.max("folded_at").alias("committed_at"), F.max("batch_id").alias("base_snapshot"),
                F.lit(0).cast("long").alias("added_changes")))
        return rows.orderBy(F.desc("snapshot_id"), F.desc("committed_at"), "operation")

    def snapshot_ids(self) -> list[int]:
        """Readable ids, oldest first (the partitions of the log; no column is read)."""
        return [r[0] for r in self.log().select("batch_id").distinct().orderBy("batch_id").collect()]

    def resolve(self, as_of: int | None = None, ts: dt.datetime | str | None = None) -> int | None:
        """The newest id at or before an id or a commit time; None if there is none."""
        log = self.log()
        if as_of is not None:
            log = log.filter(F.col("batch_id") <= as_of)
        if ts is None:
            return log.agg(F.max("batch_id")).first()[0]
        moment = dt.datetime.fromisoformat(ts) if isinstance(ts, str) else ts
        return log.groupBy("batch_id").agg(F.max("committed_at").alias("at")) \
            .filter(F.col("at") <= F.lit(moment).cast("timestamp")).agg(F.max("batch_id")).first()[0]

    # ------------------------------------------------------------ writes
    def _write_log(self, rows: DataFrame) -> None:
        columns = [*self.cfg.target_columns, "op", *ORDER_COLS, "committed_at", "batch_id"]
        (rows.select(*columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch_id").parquet(self.log_path))

    def _collapsed(self, changes: DataFrame, *keys: str) -> DataFrame:
        w = Window.partitionBy(*keys, self.cfg.key).orderBy(*[F.col(c).desc() for c in ORDER_COLS])
        return changes.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")

    def commit(self, changes: DataFrame, batch_id: int, committed_at: dt.datetime | None = None) -> int:
        """Write one batch of normalised changes as commit ``batch_id`` (idempotent on replay).

        One job: the collapsed changes are written while an observation counts
        them.  An empty batch writes nothing and is no commit, nor is the replay
        of a batch that has expired.  Returns the number of changes kept.
        """
        from pyspark.sql import Observation
        floor = self._floor()
        if floor is not None and batch_id < floor:
            return 0
        when = committed_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        obs = Observation(f"commit_{batch_id}")
        self._write_log(self._collapsed(changes).withColumn("batch_id", F.lit(batch_id).cast("long"))
                        .withColumn("committed_at", F.lit(when).cast("timestamp"))
                        .observe(obs, F.count(F.lit(1)).alias("n")))
        return int(obs.get.get("n", 0) or 0)

    def commit_many(self, changes: DataFrame, committed_at: dt.datetime | None = None,
                    commit_time_col: str | None = None) -> None:
        """Write changes that carry a ``batch_id`` column as one commit per batch, in one job.

        ``commit_time_col`` takes each commit's time from the data (its latest
        event) instead of the wall clock, which keeps tests deterministic.  The
        collapse's shuffle on (batch_id, key) spreads every commit over all
        writer tasks, so none is written by a single task however large it is.
        """
        when = F.col(commit_time_col) if commit_time_col else F.lit(committed_at or dt.datetime.now(dt.timezone.utc))
        self._write_log(self._collapsed(changes, "batch_id").withColumn("committed_at", when.cast("timestamp")))

    # ------------------------------------------------------------ reads
    def _empty_state(self) -> DataFrame:
        return self.spark.createDataFrame([], self.state_schema)

    def _last_changes(self, upto: int | None) -> DataFrame:
        """The last change of every key, tombstones included; ``op`` is 'd' for a key that is not there.

        A change without an operation updates a row that is there and never
        inserts one, so the key's last change *with* an operation tells which.
        Both are maxima per key, so a key with most of the rows is cut to one
        row per task before the only shuffle.
        """
        columns = [*self.cfg.target_columns, "op", *ORDER_COLS, "batch_id"]
        rows, folds = self.log(), self._snapshots()
        if upto is not None:
            rows = rows.filter(F.col("batch_id") <= upto)
        if folds is not None:
            if upto is not None:
                folds = folds.filter(F.col("upto") <= upto)
            base = folds.agg(F.max("upto")).first()[0]
            if base is not None:
                rows = rows.filter(F.col("batch_id") > base).select(*columns) \
                    .unionByName(folds.filter(F.col("upto") == base).select(*columns))
        place = F.struct(*[F.col(c) for c in self.order])
        rest = [c for c in columns if c != self.cfg.key]
        last = rows.groupBy(self.cfg.key).agg(
            F.max(F.struct(place.alias("place"), *[F.col(c) for c in rest])).alias("last"),
            F.max(F.when(F.col("op").isNotNull(), F.struct(place.alias("place"), F.col("op")))).alias("told"))
        op = F.when(F.col("told.op") == "d", "d").when(F.col("told.op").isNull(), "d") \
            .otherwise(F.coalesce("last.op", F.lit("u")))
        values: dict[str, Column] = {c: F.col(f"last.{c}") for c in rest} | {"op": op}
        return last.select(self.cfg.key, *[values[c].alias(c) for c in rest])

    def _known(self, as_of: int) -> int:
        """``as_of``, if it can be read."""
        floor = self._floor()
        if floor is not None and as_of < floor:
            raise LookupError(f"id {as_of} has expired; the oldest that can be read is {floor}")
        if not path_exists(self.spark, f"{self.log_path}/batch_id={as_of}"):
            raise LookupError(f"there is no commit {as_of}")
        return as_of

    def state(self, as_of: int | None = None, ts: dt.datetime | str | None = None) -> DataFrame:
        """Table content as of a commit id or time (latest by default).

        An id that never existed or has expired, and a time before the first
        commit that can be read, raise ``LookupError``.
        """
        if as_of is not None:
            self._known(as_of)
        if ts is not None:
            as_of = self.resolve(as_of, ts)
            if as_of is None:
                raise LookupError(f"there is no commit at or before {ts}")
        return self._last_changes(as_of).filter("op <> 'd'").select(*self.cfg.target_columns)

    # ------------------------------------------------------------ maintenance
    def _fold(self, content: int, at: int, operation: str, rows_per_file: int) -> None:
        """The changes as of ``content`` become what readers from ``at`` on start from."""
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        (self._last_changes(content).withColumn("operation", F.lit(operation)).withColumn("folded_at", F.lit(now).cast("timestamp"))
             .withColumn("upto", F.lit(at).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .option("maxRecordsPerFile", rows_per_file).partitionBy("upto").parquet(self.snap_path))

    def _folded_at(self, upto: int) -> bool:
        return path_exists(self.spark, f"{self.snap_path}/upto={upto}")

    def compact(self, upto: int | None = None, target_file_rows: int = 5_000_000) -> int | None:
        """Fold the log up to ``upto`` into one snapshot (files of at most ``target_file_rows`` rows);
        readers as of ``upto`` and later start from it.  A log that is folded there already stays."""
        upto = self.resolve() if upto is None else self._known(upto)
        if upto is not None and not self._folded_at(upto):
            self._fold(upto, upto, "compact", target_file_rows)
        return upto

    def rollback(self, to: int) -> int:
        """The state as of ``to`` becomes the latest state, until further commits: it is
        written as the snapshot of the latest id, which hides the changes between."""
        latest = self.resolve()
        if self._known(to) != latest:
            self._fold(to, latest, "rollback", 5_000_000)
        return latest

    def expire(self, before: int) -> None:
        """Older ids than ``before`` are no longer readable; the state as of ``before``
        and later is unchanged.  The snapshot is written first, then the mark, and
        the folders of older batches are removed last, so a run that stops in
        between leaves a table that reads the same and can be expired again."""
        self.compact(before)
        old = [r[0] for r in self.log().filter(F.col("batch_id") < before).select("batch_id").distinct().collect()]
        folds = [r[0] for r in self._snapshots().filter(F.col("upto") < before).select("upto").distinct().collect()]
        self.spark.createDataFrame([(before,)], "before long").coalesce(1).write.mode("overwrite").parquet(self.floor_path)
        for folder in [f"{self.log_path}/batch_id={n}" for n in old] + [f"{self.snap_path}/upto={n}" for n in folds]:
            remove_path(self.spark, folder)
