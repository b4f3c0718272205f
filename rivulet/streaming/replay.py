"""Reset and replay: a stream's output is built again from the start of its log, beside the old one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rivulet.session import path_exists, remove_path


class ReplayableOutput:
    """The output of a stream as numbered runs below ``base``, each with a checkpoint of its own.

    ``base/run=<n>/data`` and ``base/run=<n>/checkpoint`` belong to run n; ``base/current``
    names the run that readers use.  A reset starts the next run from the
    beginning of the source; readers stay on the old one until the new has caught
    up, and a replay that fails leaves them there.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def current(self) -> int | None:
        """The run that readers use; None before the first."""
        if not path_exists(self.spark, f"{self.base}/current/_SUCCESS"):
            return None
        return self.spark.read.schema("run int").parquet(f"{self.base}/current").first()["run"]

    def path(self, run: int | None = None) -> str:
        """Folder of a run's data (the current one by default)."""
        run = self.current() if run is None else run
        if run is None:
            raise LookupError(f"{self.base} has no finished run")
        return f"{self.base}/run={run}/data"

    def _advance(self, run: int, start: Callable[[str, str], StreamingQuery]) -> None:
        start(self.path(run), f"{self.base}/run={run}/checkpoint").awaitTermination()

    def _publish(self, run: int) -> None:
        self.spark.range(1).select(F.lit(run).cast("int").alias("run")).coalesce(1) \
            .write.mode("overwrite").parquet(f"{self.base}/current")

    def resume(self, start: Callable[[str, str], StreamingQuery]) -> str:
        """Go on with the current run from its checkpoint (the first call starts run 0); ``start(data, checkpoint)``
        starts a query that stops by itself (availableNow)."""
        run = self.current()
        self._advance(run or 0, start)
        if run is None:
            self._publish(0)
        return self.path()

    def reset(self, start: Callable[[str, str], StreamingQuery], keep: int = 1) -> str:
        """Replay everything into a new run and switch readers to it; of the older runs the last ``keep`` stay.

        What an earlier replay that failed has left under the new run's number is removed first.
        """
        old = self.current()
        run = 0 if old is None else old + 1
        remove_path(self.spark, f"{self.base}/run={run}")
        self._advance(run, start)
        self._publish(run)
        gone = run - keep - 1
        while gone >= 0 and path_exists(self.spark, f"{self.base}/run={gone}"):
            remove_path(self.spark, f"{self.base}/run={gone}")
            gone -= 1
        return self.path(run)
