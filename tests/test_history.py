"""Histories kept up incrementally: any order of delivery, late splits, deletes, replays, restarts."""

import random
import time

import pytest
from pyspark.sql import functions as F

from rivulet.operators import cdc as C
from rivulet.operators import scd2 as H
from rivulet.session import file_statuses, scratch_path
from rivulet.sources import changelog as L
from rivulet.streaming.run import to_parquet_available_now
from rivulet.streaming.scd2 import closed_versions

CH = ("op string, ts_ms long, partition int, offset long, order_id long, customer_id long, "
      "amount decimal(12,2), status string, ts timestamp")


def changes(spark, rows):
    df = spark.createDataFrame([(op, t * 1000, 0, o, k) for op, t, o, k, _ in rows],
                               "op string, ts_ms long, partition int, offset long, order_id long")
    status = spark.createDataFrame([(o, s) for _, _, o, _, s in rows], "offset long, status string")
    return df.join(status, "offset").select(
        "op", "ts_ms", "partition", "offset", "order_id", F.lit(1).cast("long").alias("customer_id"),
        F.lit("1.00").cast("decimal(12,2)").alias("amount"), "status", F.timestamp_millis("ts_ms").alias("ts"))


def spans(spark, path):
    rows = H.versions(H.read_history(spark, path, C.ORDERS), C.ORDERS).withColumn("a", F.unix_seconds("valid_from")) \
        .withColumn("b", F.unix_seconds("valid_to")).collect()
    return sorted((r.order_id, r.status, r.a, r.b) for r in rows)


def test_a_late_change_splits_and_a_delete_ends(spark, tmp_dir):
    H.upsert_history(spark, tmp_dir, changes(spark, [("c", 10, 1, 1, "A"), ("u", 20, 2, 1, "A"), ("u", 40, 3, 1, "B"),
                                                     ("c", 10, 4, 2, "X")]), C.ORDERS, buckets=4)
    assert spans(spark, tmp_dir) == [(1, "A", 10, 40), (1, "B", 40, None), (2, "X", 10, None)]
    # the late B falls inside A, whose repeat at 20 opens a version of its own
    H.upsert_history(spark, tmp_dir, changes(spark, [("u", 15, 5, 1, "B")]), C.ORDERS, buckets=4)
    assert spans(spark, tmp_dir) == [(1, "A", 10, 15), (1, "A", 20, 40), (1, "B", 15, 20), (1, "B", 40, None), (2, "X", 10, None)]
    # a late delete leaves a gap; the last one closes the open version
    late = changes(spark, [("d", 17, 6, 1, None), ("d", 50, 7, 2, None)])
    H.upsert_history(spark, tmp_dir, late, C.ORDERS, buckets=4)
    want = [(1, "A", 10, 15), (1, "A", 20, 40), (1, "B", 15, 17), (1, "B", 40, None), (2, "X", 10, 50)]
    assert spans(spark, tmp_dir) == want
    H.upsert_history(spark, tmp_dir, late, C.ORDERS, buckets=4)  # given again
    assert spans(spark, tmp_dir) == want
    assert H.upsert_history(spark, tmp_dir, late.where("false"), C.ORDERS, buckets=4) == 0


def test_only_touched_buckets_are_rewritten(spark, tmp_dir):
    H.upsert_history(spark, tmp_dir, changes(spark, [("c", 10, k, k, "A") for k in range(40)]), C.ORDERS, buckets=8)
    before = set(file_statuses(spark, f"{tmp_dir}/history"))
    assert H.upsert_history(spark, tmp_dir, changes(spark, [("u", 20, 99, 7, "B")]), C.ORDERS, buckets=8) == 1
    after = set(file_statuses(spark, f"{tmp_dir}/history"))
    assert len({n.split("/bucket=")[1].split("/")[0] for n, _, _ in after - before}) == 1
    assert len(spans(spark, tmp_dir)) == 41


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_batches_equals_one_history(spark, tmp_dir, seed):
    rng = random.Random(seed)
    rows = [(rng.choice("cuud"), rng.randrange(60), o, rng.randrange(6), rng.choice("AB")) for o in range(120)]
    whole = changes(spark, rows).cache()
    want = sorted(map(tuple, C.scd2_history(whole, C.ORDERS).collect()), key=repr)
    rng.shuffle(rows)
    for lot in (rows[:30], rows[30:80], rows[60:]):
        H.upsert_history(spark, tmp_dir, whole.where(F.col("offset").isin([r[2] for r in lot])), C.ORDERS, buckets=3)
    got = H.versions(H.read_history(spark, tmp_dir, C.ORDERS), C.ORDERS)
    assert sorted(map(tuple, got.collect()), key=repr) == want


def write_log(spark, path, rows, name):
    env = [{"op": op, "ts_ms": t * 1000, "after": None if op == "d" else {"order_id": k, "status": s},
            "before": {"order_id": k} if op == "d" else None} for op, t, _, k, s in rows]
    import json
    log = [(0, r[2], None, None, bytearray(b"\x00\x00\x00\x00\x01" + json.dumps(e).encode()), 0) for r, e in zip(rows, env)]
    spark.createDataFrame(log, L.LOG_SCHEMA).drop("batch_id").coalesce(1).write.mode("append").parquet(path)


def test_history_stream_restarts(spark, tmp_dir):
    log, ck = scratch_path(spark, "log"), scratch_path(spark, "ck")
    first = [("c", 10, 1, 1, "A"), ("u", 40, 2, 1, "B")]
    later = [("u", 20, 3, 1, "C"), ("d", 60, 4, 1, None)]
    for lot in (first, later):
        write_log(spark, log, lot, "x")
        H.start_history(L.read_change_stream(spark, log), tmp_dir, C.ORDERS, L.ORDER_ENVELOPE, ck,
                        {"availableNow": True}, buckets=2).awaitTermination()
    assert spans(spark, tmp_dir) == [(1, "A", 10, 20), (1, "B", 40, 60), (1, "C", 20, 40)]


def test_closed_versions_are_emitted_once_across_a_restart(spark):
    """Out of order inside the delay, late beyond it, a delete, a repeat; the second run continues from state."""
    log, ck, out = (scratch_path(spark, n) for n in ("log", "ck", "out"))

    def run():
        src = L.read_change_stream(spark, log)
        ch = C.normalize(C.decode(src, L.ORDER_ENVELOPE), C.ORDERS, with_event_ts=True)
        to_parquet_available_now(closed_versions(ch, C.ORDERS, "10 seconds"), out, ck)
        rows = spark.read.parquet(out).collect()
        return sorted((r.order_id, r.status, int(r.valid_from.timestamp()), int(r.valid_to.timestamp())) for r in rows)

    write_log(spark, log, [("u", 20, 2, 1, "B"), ("c", 10, 1, 1, "A"), ("u", 25, 3, 1, "B"), ("c", 100, 4, 2, "X")], "a")
    first = run()
    assert first == [(1, "A", 10, 20)]
    # order 1 changes again; a change before the watermark (90) is dropped; order 2 is deleted
    write_log(spark, log, [("u", 120, 6, 1, "C"), ("u", 30, 5, 1, "LATE"), ("d", 130, 7, 2, None), ("c", 200, 8, 3, "Z")], "b")
    assert run() == [(1, "A", 10, 20), (1, "B", 20, 120), (2, "X", 100, 130)]
    assert run() == [(1, "A", 10, 20), (1, "B", 20, 120), (2, "X", 100, 130)]


def closed_by_stream(spark, log_rows, cfg, schema, delay="10 seconds"):
    """What the stream of closed versions emits for change rows with ``event_ts``, and the query."""
    src, ck, out = (scratch_path(spark, n) for n in ("src", "ck", "out"))
    spark.createDataFrame(log_rows, schema).write.parquet(src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    stream = stream.withColumn("event_ts", F.timestamp_millis("ts_ms"))
    q = to_parquet_available_now(closed_versions(stream, cfg, delay), out, ck)
    return spark.read.parquet(out), q


def test_a_key_costs_a_few_state_calls_however_many_changes_it_has(spark):
    """2,500 changes of one key, some delivered twice: one timer and a row of state per lot, not per change."""
    cfg = C.TableConfig("t", "id", {"v": "string"})
    rows = [("u", 10 ** 6 + i * 1000, 0, i, 7, "AB"[i // 2 % 2]) for i in range(2500)]
    out, q = closed_by_stream(spark, rows + rows[::50], cfg, "op string, ts_ms long, partition int, offset long, id long, v string")
    timers = [int(op["customMetrics"]["numRegisteredTimers"]) for p in q.recentProgress for op in p["stateOperators"]]
    state = [int(op["numRowsTotal"]) for p in q.recentProgress for op in p["stateOperators"]]
    assert max(timers) == 1 and max(state) < 50
    # the last ten seconds wait: a version that ends before them is closed
    got = sorted((r.v, r.valid_from.timestamp() - 1000, r.valid_to.timestamp() - 1000, r.offset) for r in out.collect())
    assert got == sorted(("AB"[i // 2 % 2], float(i), i + 2.0, i) for i in range(0, 2488, 2) if i + 2 < 2489)


def test_images_of_closed_versions_come_back_as_they_were(spark):
    """Strings that look like separators, NULLs, zeros of both signs, NaN and times with microseconds."""
    from datetime import date, datetime
    from decimal import Decimal

    cfg = C.TableConfig("t", "id", {"s": "string", "x": "double", "a": "decimal(12,2)", "n": "long", "b": "boolean",
                                    "at": "timestamp", "on": "date", "raw": "binary"})
    image = ('a "b"\n{c} \\ d e', 0.1 + 0.2, Decimal("-12345678.90"), 2 ** 62, True,
             datetime(2024, 2, 3, 4, 5, 6, 789012), date(1969, 12, 31), bytearray(b"\x00\xff\n "))
    empty, nan = (None,) * 8, ("", float("nan"), *[None] * 6)
    zeros = [("z", z, *[None] * 6) for z in (0.0, -0.0)]
    lots = [image, image, empty, empty, nan, nan, *zeros, image]
    rows = [("u", 1000 * (i + 1), None, i, 1, *x) for i, x in enumerate(lots)] + [("c", 10 ** 6, None, 99, 2, *empty)]
    out, _ = closed_by_stream(spark, rows, cfg, "op string, ts_ms long, partition int, offset long, id long, s string, x double, "
                              "a decimal(12,2), n long, b boolean, at timestamp, on date, raw binary")
    got = {r.offset: r for r in out.collect()}
    assert sorted(got) == [0, 2, 4, 6] and all(r.partition is None for r in got.values())
    assert tuple(got[0][c] for c in cfg.columns) == image and tuple(got[2][c] for c in cfg.columns) == empty
    assert got[4].s == "" and got[4].x != got[4].x and got[4].a is None
    assert [(r.valid_from.timestamp(), r.valid_to.timestamp()) for _, r in sorted(got.items())] == [(1, 3), (3, 5), (5, 7), (7, 9)]


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


@pytest.mark.parametrize("at_once", [1, 2 ** 30])
def test_a_merge_leaves_only_the_table_on_disk(spark, tmp_dir, monkeypatch, at_once):
    """Shuffle files and staged rows go; buckets merged one by one give what all at once give."""
    monkeypatch.setattr(H, "ROUND_BYTES", at_once, raising=False)
    rng = random.Random(7)
    rows = [(rng.choice("cuud"), rng.randrange(60), o, rng.randrange(40), rng.choice("AB")) for o in range(200)]
    whole = changes(spark, rows).cache()
    want = sorted(map(tuple, C.scd2_history(whole, C.ORDERS).collect()), key=repr)
    before = shuffle_files(spark)
    for odd in (0, 1, 1):
        assert H.upsert_history(spark, tmp_dir, whole.where(F.col("offset") % 2 == odd), C.ORDERS, buckets=5) == 5
    left = {n.split(tmp_dir)[1].split("/")[1] for n, _, _ in file_statuses(spark, tmp_dir)}
    until = time.monotonic() + 20  # executors remove files a moment later
    while shuffle_files(spark) - before and time.monotonic() < until:
        time.sleep(0.2)
    assert left == {"history"} and shuffle_files(spark) <= before
    got = H.versions(H.read_history(spark, tmp_dir, C.ORDERS), C.ORDERS)
    assert sorted(map(tuple, got.collect()), key=repr) == want
