"""SCD type 2 as an append stream: a version is emitted once, when the watermark has passed its end.

Changes wait in keyed state until no earlier one can come any more; a timer at
the first of them then takes the key's changes in order, compares images and
emits the versions that new images or deletes close.  What is left in state is
a key's open version and its changes inside the watermark's delay.

A key costs a few calls to the state store per micro-batch, however many changes
it has, and a change is one string outside the JVM (its place in the order,
whether it is a delete, its image): Python orders and compares changes, and
takes no columns apart.  Changes are stored and versions returned in lots, and a
key has one timer at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from rivulet.operators.cdc import ORDER_COLS, TableConfig, parse_type

#: Keyed state with timers needs this state store.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Changes in one entry of a key's waiting list, and versions in one row on the way out, at most.
LOT = 1000
#: Images travel as JSON; times keep their microseconds.
JSON_FORMAT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def packed_change(columns: dict) -> Column:
    """A change as one string: ts_ms, partition, offset, ``d`` for a delete or ``-``, and the image as JSON."""
    def plain(name: str, kind: str) -> Column:
        # zeros compare equal whatever their sign
        return F.when(F.col(name) == 0, F.lit(0.0)).otherwise(F.col(name)).alias(name) if kind == "double" else F.col(name)

    image = F.to_json(F.struct(*[plain(c, t) for c, t in columns.items()]), JSON_FORMAT)
    gone = F.when(F.col("op") == "d", F.lit("d")).otherwise(F.lit("-"))
    return F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in ORDER_COLS], gone, image)


def _place(change: str) -> tuple:
    """Time, partition and offset of a packed change; a missing partition or offset is first."""
    ts_ms, *rest = change.split(" ", len(ORDER_COLS))[:len(ORDER_COLS)]
    return int(ts_ms), *[float("-inf") if x == "null" else int(x) for x in rest]


class ClosedVersions(StatefulProcessor):
    """Per key: lots of ``waiting`` changes, the time of its timer (``due``), and the last change
    that ``opened`` a version or ended one."""

    def __init__(self, key: str):
        self.result = Row(key, "versions")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", T.StructType([T.StructField("lot", T.StringType())]))
        self.due = handle.getValueState("due", T.StructType([T.StructField("ts_ms", T.LongType())]))
        self.opened = handle.getValueState("opened", T.StructType([T.StructField("change", T.StringType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        changes, first = (r["change"] for r in rows), None
        while lot := list(islice(changes, LOT)):
            earliest = min(int(c[:c.index(" ")]) for c in lot)
            first = earliest if first is None else min(first, earliest)
            self.waiting.appendValue(("\n".join(lot),))
        due = self.due.get()
        if due is None or first < due[0]:
            if due is not None:
                self.handle.deleteTimer(due[0])
            self._wake(first)
        return iter([])

    def _wake(self, at: int) -> None:
        self.handle.registerTimer(at)
        self.due.update((at,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        upto = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() - 1)
        waiting = {}  # a change that was delivered again replaces its first copy
        for (lot,) in self.waiting.get():
            waiting.update((_place(c), c) for c in lot.split("\n"))
        due = sorted(at for at in waiting if at[0] <= upto)
        opened, versions = self.opened.get(), []
        last = opened[0].split(" ", 4) if opened else None
        for at in due:
            change = waiting.pop(at).split(" ", 4)
            if last is not None and last[3] != "d":
                if change[3] != "d" and last[4] == change[4]:
                    continue  # the same image again
                versions.append(f'{{"from_ms": {last[0]}, "to_ms": {change[0]}, "partition": {last[1]}, '
                                f'"offset": {last[2]}, "image": {last[4]}}}')
            last = change
        if due:
            self.opened.update((" ".join(last),))
        if waiting:
            left = iter(waiting.values())
            self.waiting.put([("\n".join(lot),) for lot in iter(lambda: list(islice(left, LOT)), [])])
            self._wake(min(waiting)[0])
        else:
            self.waiting.clear()
            self.due.clear()
        for i in range(0, len(versions), LOT):
            yield self.result(*key, versions[i:i + LOT])

    def close(self) -> None:
        pass


def closed_versions(changes: DataFrame, cfg: TableConfig, delay: str) -> DataFrame:
    """Stream of the closed versions of a stream of normalised changes (with ``event_ts``):
    key, columns, valid_from, valid_to, partition, offset.

    A change later than ``delay`` behind the newest one is dropped, as the
    watermark has it; a change delivered again while it waits counts once.
    """
    changes.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    image = T.StructType([T.StructField(c, parse_type(t)) for c, t in cfg.columns.items()])
    version = T.StructType([T.StructField("from_ms", T.LongType()), T.StructField("to_ms", T.LongType()),
                            T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType()),
                            T.StructField("image", image)])
    out = T.StructType([T.StructField(cfg.key, T.LongType()), T.StructField("versions", T.ArrayType(T.StringType()))])
    rows = changes.withWatermark("event_ts", delay).select(cfg.key, packed_change(cfg.columns).alias("change"), "event_ts")
    found = rows.groupBy(cfg.key).transformWithState(
        statefulProcessor=ClosedVersions(cfg.key), outputStructType=out, outputMode="Append", timeMode="EventTime")
    # out of a generator, so that each version is parsed once
    parsed = F.transform("versions", lambda v: F.from_json(v, version, JSON_FORMAT | {"mode": "FAILFAST"}))
    return found.select(cfg.key, F.inline(parsed)).select(
        cfg.key, "image.*", F.timestamp_millis("from_ms").alias("valid_from"),
        F.timestamp_millis("to_ms").alias("valid_to"), "partition", "offset")
