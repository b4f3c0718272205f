"""Gated streams, fan-out with replays, state inspection."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from rivulet.operators import cdc as C
from rivulet.operators.quality import Rule
from rivulet.session import file_statuses, path_exists, remove_path, scratch_path
from rivulet.sources import changelog as L
from rivulet.streaming import fanout, gate, inspect
from rivulet.streaming import windows as W
from rivulet.streaming.replay import ReplayableOutput
from rivulet.streaming.run import ProgressLog, to_parquet_available_now
from rivulet.table import VersionedTable


def rules():
    return [Rule("NEG", "error", F.col("v") < 0, "negative"), Rule("BIG", "warning", F.col("v") > 100, "big")]


def test_a_bad_batch_is_not_committed(spark, tmp_dir):
    raw, ck = scratch_path(spark, "raw"), scratch_path(spark, "ck")
    metrics = gate.ObservedShares(spark, "seen")
    spark.streams.addListener(metrics)

    def land(*values):
        spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, v long").coalesce(1).write.mode("append").parquet(raw)

    def run(share=0.5):
        src = spark.readStream.schema("id long, v long").option("maxFilesPerTrigger", 1).parquet(raw)
        gate.start_gated(src, rules(), "t", F.col("id"), tmp_dir, ck, share, {"availableNow": True}, metrics="seen").awaitTermination()

    def landed():
        return sorted(r.v for r in spark.read.parquet(f"{tmp_dir}/valid").collect())

    try:
        land(1, -2, 300)
        run()
        assert landed() == [1, 300]
        land(-1, -2, 5)
        with pytest.raises(StreamingQueryException, match="RejectedShareTooHigh"):
            run()
        assert landed() == [1, 300] and not path_exists(spark, f"{tmp_dir}/valid/batch_id=1")
        errors = spark.read.parquet(f"{tmp_dir}/errors").collect()
        assert sorted(r.error_code for r in errors) == ["BIG", "NEG"]
        run(share=0.9)                     # the batch was not committed: the next run reads it again
        assert landed() == [1, 5, 300]
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        assert metrics.batches == {0: (3, 1), 1: (3, 2)}
    finally:
        spark.streams.removeListener(metrics)


def test_many_batches_just_below_the_gate_stop_the_query(spark, tmp_dir):
    metrics = gate.ObservedShares(spark, "drift", total_limit=0.3)
    spark.streams.addListener(metrics)
    try:
        src = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 10).load() \
            .select(F.col("value").alias("id"), F.when(F.col("value") % 10 < 4, -1).otherwise(1).cast("long").alias("v"))
        q = gate.start_gated(src, rules(), "t", F.col("id"), tmp_dir, scratch_path(spark, "ck"), 0.5, {"processingTime": "0 seconds"},
                             metrics="drift")
        assert q.awaitTermination(60) and q.exception() is None
    finally:
        spark.streams.removeListener(metrics)


def record(table, key, offset, ts, status, op="u"):
    env = {"op": op, "ts_ms": ts, "after": {"order_id": key, "status": status}, "source": {"table": table}}
    return (0, offset, None, bytearray(b"\x00\x00\x00\x00\x01" + json.dumps(env).encode()))


def test_fan_out_with_a_failure_and_a_replay(spark):
    log, ck = scratch_path(spark, "log"), scratch_path(spark, "ck")
    rows = [record("a", 1, 1, 10, "A1"), record("b", 1, 2, 10, "B1"), record("a", 2, 3, 10, "A2"), record("c", 9, 4, 10, "other")]
    schema = "partition int, offset long, timestamp timestamp, value binary"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(log)
    a, b = (VersionedTable(spark, scratch_path(spark, n), C.ORDERS) for n in "ab")
    to_a, to_b = fanout.table_route("a", C.ORDERS, L.ORDER_ENVELOPE, a), fanout.table_route("b", C.ORDERS, L.ORDER_ENVELOPE, b)
    broken = {"on": True}

    def sometimes(batch, batch_id):
        if broken["on"]:
            raise OSError("sink is gone")
        return to_b.write(batch, batch_id)

    def run():
        src = spark.readStream.schema(schema).parquet(log)
        fanout.start_fan_out(src, [to_a, fanout.Route("b", to_b.chosen, sometimes)], ck, {"availableNow": True}).awaitTermination()

    with pytest.raises(StreamingQueryException):
        run()                               # the first sink has the batch, the second has not
    assert a.state().count() == 2 and b.state().count() == 0
    broken["on"] = False
    run()                                   # the batch is delivered to both again
    state = lambda t: sorted((r.order_id, r.status) for r in t.state().collect())
    assert state(a) == [(1, "A1"), (2, "A2")] and state(b) == [(1, "B1")]
    assert a.snapshot_ids() == b.snapshot_ids() == [0] and a.history().first()["added_changes"] == 2


def test_state_of_a_window_and_a_dedup(spark):
    raw = scratch_path(spark, "raw")
    t0 = datetime(2024, 1, 1)
    spark.createDataFrame([(i, t0 + timedelta(minutes=10 * i)) for i in range(12)], "id long, ts timestamp").write.parquet(raw)
    src = spark.readStream.schema("id long, ts timestamp").parquet(raw)
    ck, ck2 = scratch_path(spark, "ck"), scratch_path(spark, "ck2")
    to_parquet_available_now(W.dedup_within_watermark(src, "ts", ["id"], "30 minutes"), scratch_path(spark, "o"), ck)
    s = inspect.state_summary(spark, ck).collect()
    # watermark 01:20, a key is kept until its time plus 30 minutes: ids 6 (expires 01:30) to 11
    assert sum(r.keys for r in s) == sum(r.rows for r in s) == 6
    assert min(r.first_expiry for r in s) == t0 + timedelta(minutes=90) and {r.operator_name for r in s} == {"dedupeWithinWatermark"}
    to_parquet_available_now(W.tumbling(src, "ts", "1 hour", [], "30 minutes"), scratch_path(spark, "o2"), ck2)
    s = inspect.state_summary(spark, ck2).collect()
    assert sum(r.keys for r in s) == 1 and s[0].operator_name == "stateStoreSave" and s[0].first_expiry is None
    assert inspect.state_rows(spark, ck2).first()["value"]["count"] == 6


def test_reset_keeps_the_old_run_until_the_new_one_is_done(spark, tmp_dir):
    src = scratch_path(spark, "src")
    spark.range(5).write.parquet(src)
    out = ReplayableOutput(spark, tmp_dir)
    with pytest.raises(LookupError):
        out.path()

    def start(add=0, fail=False):
        def run(data, checkpoint):
            rows = spark.readStream.schema("id long").parquet(src).select((F.col("id") + add).alias("id"))
            if fail:
                rows = rows.select(F.raise_error(F.lit("broken")).cast("long").alias("id"))
            return rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(data)
        return run

    read = lambda: sorted(r.id for r in spark.read.parquet(out.path()).collect())
    out.resume(start())
    spark.range(5, 7).write.mode("append").parquet(src)
    out.resume(start())                       # goes on: nothing twice
    assert read() == list(range(7)) and out.current() == 0
    with pytest.raises(StreamingQueryException):
        out.reset(start(10, fail=True))
    assert read() == list(range(7))
    out.reset(start(10))
    assert read() == list(range(10, 17)) and out.current() == 1 and path_exists(spark, f"{tmp_dir}/run=0")
    out.reset(start(20))
    assert read() == list(range(20, 27)) and not path_exists(spark, f"{tmp_dir}/run=0") and path_exists(spark, f"{tmp_dir}/run=1")


def test_progress_is_written_together(spark, tmp_dir):
    src = scratch_path(spark, "src")
    for i in range(4):
        spark.range(i, i + 1).coalesce(1).write.mode("append").parquet(src)
    log = ProgressLog(spark, tmp_dir, flush_every=100)
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(src)
    to_parquet_available_now(stream, scratch_path(spark, "o"), scratch_path(spark, "c"))
    rows = log.close()
    assert rows.where("num_input_rows = 1").count() == 4
    assert len(file_statuses(spark, tmp_dir)) <= 2


def test_files_that_are_gone_stop_or_not(spark):
    """fail_on_data_loss decides what a listed file that was removed does to the stream."""
    for tolerant in (False, True):
        log, out = scratch_path(spark, "log"), scratch_path(spark, "o")
        spark.createDataFrame([record("a", 1, 1, 10, "x")], "partition int, offset long, timestamp timestamp, value binary") \
            .coalesce(1).write.parquet(log)
        src = L.read_change_stream(spark, log, fail_on_data_loss=not tolerant)
        seen = []

        def lose(batch, batch_id, log=log):
            for name, _, _ in file_statuses(spark, log):
                remove_path(spark, name)
            seen.append(batch.count())

        q = src.writeStream.foreachBatch(lose).option("checkpointLocation", scratch_path(spark, "c")).trigger(availableNow=True).start()
        if tolerant:
            q.awaitTermination()
            assert seen == [0]
        else:
            with pytest.raises(StreamingQueryException):
                q.awaitTermination()


def test_topic_options():
    kafka = {"kafka.bootstrap.servers": "b:9092", "subscribe": "t"}
    assert L.kafka_options(kafka, {0: 5}) == {**kafka, "kafka.isolation.level": "read_committed",
                                             "startingOffsets": '{"t": {"0": 5}}', "failOnDataLoss": "true"}
    bounded = L.kafka_options({**kafka, "kafka.isolation.level": "read_uncommitted"}, "earliest", {1: 9}, fail_on_data_loss=False)
    assert bounded["endingOffsets"] == '{"t": {"1": 9}}' and bounded["includeHeaders"] == "true"
    assert bounded["failOnDataLoss"] == "false" and bounded["kafka.isolation.level"] == "read_uncommitted"
