"""Streaming: two log files in two triggers, restart from the checkpoint, replay idempotence."""

from pyspark.sql import functions as F

from rivulet.operators import cdc as C
from rivulet.session import scratch_path
from rivulet.sources import changelog as L
from rivulet.sources.tables import table
from rivulet.streaming.cdc import start_cdc
from rivulet.table import VersionedTable

SF = "/root/testdata/sf0.001"


def test_stream_then_restart(spark):
    changes = L.events_changes(table(spark, SF, "events"))
    recs = L.envelope_records(changes)
    log = scratch_path(spark, "log")
    ids = sorted(r[0] for r in recs.select("batch_id").distinct().collect())
    half = ids[len(ids) // 2]
    recs.filter(F.col("batch_id") <= half).coalesce(1).write.partitionBy("batch_id").parquet(log)
    vt = VersionedTable(spark, scratch_path(spark, "vt"), C.ORDERS, event_order=True)
    ck = scratch_path(spark, "ck")

    def run():
        q = start_cdc(L.read_change_stream(spark, log, max_files_per_trigger=1), vt, C.ORDERS, L.ORDER_ENVELOPE,
                      ck, trigger={"availableNow": True})
        q.awaitTermination()

    run()
    first = vt.resolve()
    recs.filter(F.col("batch_id") > half).coalesce(1).write.mode("append").partitionBy("batch_id").parquet(log)
    run()                                   # restart: only the new files are read
    assert vt.resolve() > first
    expected = C.merge(vt._empty_state(), C.collapse(
        C.normalize(C.decode(recs, L.ORDER_ENVELOPE), C.ORDERS), C.ORDERS), C.ORDERS)
    assert sorted(vt.state().collect()) == sorted(expected.collect())
    n_commits = vt.history().count()
    run()                                   # nothing new: no commit
    assert vt.history().count() == n_commits


def test_stream_dead_letters(spark):
    import json
    rows = [(0, 1, None, None, bytearray(b"\x00\x00\x00\x00\x01" + json.dumps(
                {"op": "c", "ts_ms": 1000, "after": {"order_id": 1, "amount": 1.0, "status": "A"}}).encode()), 0),
            (0, 2, None, None, bytearray(b"\x00\x00\x00\x00\x01{broken"), 0)]
    log = scratch_path(spark, "dl_log")
    spark.createDataFrame(rows, L.LOG_SCHEMA).write.partitionBy("batch_id").parquet(log)
    vt = VersionedTable(spark, scratch_path(spark, "dl_vt"), C.ORDERS)
    dead = scratch_path(spark, "dead")
    q = start_cdc(L.read_change_stream(spark, log), vt, C.ORDERS, L.ORDER_ENVELOPE, scratch_path(spark, "dl_ck"),
                  trigger={"availableNow": True}, dead_letter_path=dead)
    q.awaitTermination()
    assert vt.state().count() == 1
    d = spark.read.parquet(dead).collect()
    assert len(d) == 1 and d[0]["cause"] == "UNPARSEABLE" and d[0]["offset"] == 2


def test_dedup_hot_copies(spark):
    from rivulet.plans.streaming import EVENTS_SCHEMA
    from rivulet.streaming.run import to_parquet_available_now
    from rivulet.streaming.windows import dedup_within_watermark
    ev = table(spark, SF, "events")
    hot = ev.filter("event_id = 1")
    src = scratch_path(spark, "hot_src")
    copies = hot.withColumn("_r", F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("_r")  # 500 copies of one record
    ev.unionByName(copies).write.parquet(src)
    out = scratch_path(spark, "hot_out")
    d = dedup_within_watermark(spark.readStream.schema(EVENTS_SCHEMA).parquet(src), "ts", ["event_id"], "1 hour")
    to_parquet_available_now(d, out, scratch_path(spark, "hot_ck"))
    got = spark.read.parquet(out)
    assert got.count() == ev.count() and got.filter("event_id = 1").count() == 1


def test_a_late_copy_does_not_hide_the_one_on_time(spark):
    from rivulet.streaming.run import to_parquet_available_now
    from rivulet.streaming.windows import dedup_within_watermark
    src, out, ck = (scratch_path(spark, x) for x in ("dd_src", "dd_out", "dd_ck"))
    schema = "id long, ts timestamp"

    def deliver(rows):
        frame = spark.createDataFrame(rows, "id long, t string").select("id", F.to_timestamp("t").alias("ts"))
        frame.coalesce(1).write.mode("append").parquet(src)
        to_parquet_available_now(dedup_within_watermark(spark.readStream.schema(schema).parquet(src), "ts", ["id"], "1 hour"),
                                 out, ck)

    deliver([(9, "2024-01-01 12:00:00")])
    deliver([(1, "2024-01-01 01:00:00"), (1, "2024-01-01 12:30:00"), (1, "2024-01-01 12:30:00")])
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 9]


def test_a_replayed_batch_changes_nothing_in_late_routing(spark):
    from rivulet.session import _file_system
    from rivulet.streaming.late import route_late
    src, on_time, late, ck = (scratch_path(spark, x) for x in ("lr_src", "lr_on", "lr_late", "lr_ck"))

    def deliver(rows):
        spark.createDataFrame(rows, "id long, t string").select("id", F.to_timestamp("t").alias("ts")) \
            .coalesce(1).write.mode("append").parquet(src)

    def run():
        route_late(spark.readStream.schema("id long, ts timestamp").parquet(src), "ts", "10 minutes", on_time, late, ck)

    def rows():
        return [sorted(r.id for r in spark.read.parquet(p).collect()) for p in (on_time, late)]

    deliver([(1, "2024-01-01 12:00:00")])
    run()
    deliver([(2, "2024-01-01 12:30:00"), (3, "2024-01-01 11:00:00")])
    run()
    assert rows() == [[1, 2], [3]]
    fs, path = _file_system(spark, f"{ck}/commits/1")          # the last batch was not committed: it runs again
    assert fs.delete(path, False)
    run()
    assert rows() == [[1, 2], [3]]
