"""CDC operators: edge cases of normalise / collapse / merge, SCD2, versioned table."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rivulet.operators import cdc as C
from rivulet.sources import changelog as L
from rivulet.table import VersionedTable

CH = ("op string, ts_ms long, partition int, offset long, order_id long, customer_id long, "
      "amount decimal(12,2), status string, ts timestamp")
TARGET = "order_id long, customer_id long, amount decimal(12,2), status string, ts timestamp"


def changes(spark, rows):
    return spark.createDataFrame(
        [(op, t, p, o, k, c, Decimal(a) if a is not None else None, s, None) for op, t, p, o, k, c, a, s in rows], CH)


def target(spark, rows):
    return spark.createDataFrame([(k, c, Decimal(a), s, None) for k, c, a, s in rows], TARGET)


def as_dict(df):
    return {r["order_id"]: (r["customer_id"], r["status"]) for r in df.collect()}


def seed(spark):
    # the reference's seed orders
    return target(spark, [(1, 1, "120.50", "CREATED"), (2, 1, "89.90", "PAID"), (3, 2, "45.00", "CREATED"),
                          (4, 3, "320.00", "SHIPPED")])


def test_demo_change_script(spark):
    ch = changes(spark, [("c", 10, 0, 1, 5, 4, "199.99", "CREATED"),
                         ("u", 11, 0, 2, 1, 1, "120.50", "PAID"),
                         ("d", 12, 0, 3, 3, None, None, None)])
    out = as_dict(C.apply_changes(seed(spark), ch, C.ORDERS))
    assert out == {1: (1, "PAID"), 2: (1, "PAID"), 4: (3, "SHIPPED"), 5: (4, "CREATED")}


def test_null_op_updates_only_matched(spark):
    ch = changes(spark, [(None, 10, 0, 1, 1, 9, "1.00", "X"), (None, 10, 0, 2, 77, 9, "1.00", "X")])
    out = as_dict(C.apply_changes(seed(spark), ch, C.ORDERS))
    assert out[1] == (9, "X") and 77 not in out


def test_delete_without_insert_and_reinsert(spark):
    ch = changes(spark, [("d", 10, 0, 1, 99, None, None, None),          # delete of an unknown key: nothing
                         ("c", 10, 0, 2, 50, 1, "1.00", "A"), ("d", 11, 0, 3, 50, None, None, None),  # insert+delete
                         ("d", 10, 1, 4, 2, None, None, None), ("c", 12, 1, 5, 2, 7, "2.00", "B")])   # delete, re-insert
    out = as_dict(C.apply_changes(seed(spark), ch, C.ORDERS))
    assert 99 not in out and 50 not in out and out[2] == (7, "B")


def test_collapse_total_order_and_permutation(spark):
    rows = [("u", 10, 0, 5, 1, 1, "1.00", "a"), ("u", 10, 1, 1, 1, 1, "1.00", "b"), ("u", 10, 1, 2, 1, 1, "1.00", "c")]
    a = C.collapse(changes(spark, rows), C.ORDERS).first()["status"]
    b = C.collapse(changes(spark, rows[::-1]).repartition(3), C.ORDERS).first()["status"]
    assert a == b == "c"


def test_soft_delete(spark):
    ch = changes(spark, [("d", 10, 0, 1, 3, 2, "45.00", "CREATED")])
    out = {r["order_id"]: r["is_deleted"] for r in C.merge(seed(spark), C.collapse(ch, C.ORDERS), C.ORDERS,
                                                              soft_delete=True).collect()}
    assert out[3] is True and out[1] is False


def test_guard_keeps_newer_row(spark):
    t = seed(spark).withColumn("ts_ms", F.lit(100).cast("long"))
    ch = changes(spark, [("u", 50, 0, 1, 1, 9, "1.00", "OLD")])
    out = C.merge(t, C.collapse(ch, C.ORDERS), C.ORDERS, guard=True).filter("order_id = 1").first()
    assert out["status"] == "CREATED"


def framed_log(spark, envelopes):
    rows = [(0, i, None, None, bytearray(b"\x00\x00\x00\x00\x01" + json.dumps(e).encode()) if e is not None else None, 0)
            for i, e in enumerate(envelopes)]
    return spark.createDataFrame(rows, L.LOG_SCHEMA)


def test_decode_normalise_null_key_and_seconds(spark):
    env = [{"op": "c", "ts_ms": 1716206400123, "after": {"order_id": 1, "amount": 1.5, "status": "C"}},
           {"op": "u", "ts_ms": 1716206400999, "before": {"order_id": None}, "after": {"order_id": None}}]
    n = C.normalize(C.decode(framed_log(spark, env), L.ORDER_ENVELOPE), C.ORDERS).collect()
    assert len(n) == 1 and n[0]["amount"] == Decimal("1.50")
    assert n[0]["ts"].microsecond == 0 and n[0]["ts"].second == 0


def test_dead_letters(spark):
    log = framed_log(spark, [{"op": "c", "ts_ms": 1, "after": {"order_id": 1}}, None])
    bad = spark.createDataFrame([(0, 9, None, None, bytearray(b"\x00\x00\x00\x00\x01{not json"), 0),
                                 (0, 10, None, None, bytearray(b"\x00\x00"), 0)], L.LOG_SCHEMA)
    good, dead = C.split_dead_letters(log.union(bad), L.ORDER_ENVELOPE)
    assert good.count() == 1
    assert sorted(r["cause"] for r in dead.collect()) == ["NULL_VALUE", "SHORT_FRAME", "UNPARSEABLE"]


def test_scd2_intervals_do_not_overlap(spark):
    rows = [("c", 0, 0, 1, 1, 1, "1.00", "A"), ("u", 3600000, 0, 2, 1, 1, "1.00", "A"),   # no-op update
            ("u", 7200000, 0, 3, 1, 1, "2.00", "B"), ("d", 10800000, 0, 4, 1, None, None, None),
            ("c", 14400000, 0, 5, 1, 1, "3.00", "C")]
    ch = changes(spark, rows).withColumn("ts", F.timestamp_seconds(F.col("ts_ms") / 1000))
    v = C.scd2_history(ch, C.ORDERS).orderBy("valid_from").collect()
    assert [r["status"] for r in v] == ["A", "B", "C"]
    assert v[0]["valid_to"] == v[1]["valid_from"]
    assert v[1]["valid_to"] is not None and v[1]["is_current"] is False
    assert v[2]["is_current"] is True


def test_versioned_table_batches_equal_one_collapse(spark, tmp_dir):
    rows = [("c", i * 10, i % 2, i, i % 5, 1, f"{i}.00", f"s{i}") for i in range(20)] + \
           [("d", 500, 0, 100, 3, None, None, None)]
    ch = changes(spark, rows).withColumn("batch_id", (F.col("offset") / 25).cast("long") +
                                         (F.col("ts_ms") / 60).cast("long"))
    vt = VersionedTable(spark, tmp_dir, C.ORDERS)
    vt.commit_many(ch, commit_time_col="ts_ms")
    once = C.merge(spark.createDataFrame([], TARGET), C.collapse(ch, C.ORDERS), C.ORDERS)
    assert sorted(vt.state().collect()) == sorted(once.collect())
    # replaying a commit changes nothing
    last = vt.resolve()
    vt.commit(ch.filter(F.col("batch_id") == last).drop("batch_id"), last)
    assert sorted(vt.state().collect()) == sorted(once.collect())
    # time travel, rollback and compaction
    first = vt.snapshot_ids()[0]
    early = sorted(vt.state(as_of=first).collect())
    vt.compact()
    assert sorted(vt.state().collect()) == sorted(once.collect())
    vt.rollback(first)
    assert sorted(vt.state().collect()) == early
    # expiry: older ids disappear from the listing, the latest state is unchanged
    ids = vt.snapshot_ids()
    latest_state = sorted(vt.state().collect())
    vt.expire(ids[2])
    assert min(vt.snapshot_ids()) == ids[2]
    assert sorted(vt.state().collect()) == latest_state


def test_empty_batch_and_empty_table(spark, tmp_dir):
    vt = VersionedTable(spark, tmp_dir, C.ORDERS)
    assert vt.state().count() == 0 and vt.snapshot_ids() == []
    assert vt.commit(changes(spark, []), 7) == 0          # empty micro-batch: nothing recorded
    assert vt.snapshot_ids() == []
    assert vt.commit(changes(spark, [("c", 1, 0, 1, 1, 1, "1.00", "A")]), 8) == 1
    assert vt.snapshot_ids() == [8] and vt.state().count() == 1


def test_update_with_null_after_image(spark):
    env = [{"op": "c", "ts_ms": 1000, "after": {"order_id": 1, "amount": 2.0, "status": "A"}},
           {"op": "u", "ts_ms": 2000, "before": {"order_id": 1}, "after": None}]
    n = C.normalize(C.decode(framed_log(spark, env), L.ORDER_ENVELOPE), C.ORDERS)
    out = C.apply_changes(spark.createDataFrame([], TARGET), n, C.ORDERS).collect()
    # the update without an after image keeps the key and overwrites the columns with NULL
    assert len(out) == 1 and out[0]["status"] is None and out[0]["order_id"] == 1


def commit(vt, spark, batch, *rows):
    vt.commit(changes(spark, [(op, t, 0, o, k, 1, "1.00", s) for op, t, o, k, s in rows]), batch)


def statuses(vt, **kw):
    return sorted((r["order_id"], r["status"]) for r in vt.state(**kw).collect())


def test_rollback_stays_when_the_stream_goes_on(spark, tmp_dir):
    vt = VersionedTable(spark, tmp_dir, C.ORDERS)
    commit(vt, spark, 1, ("c", 10, 1, 1, "good"))
    commit(vt, spark, 2, ("u", 20, 2, 1, "BAD"), ("c", 20, 3, 2, "BAD"))
    vt.rollback(1)
    assert statuses(vt) == [(1, "good")]
    commit(vt, spark, 2, ("u", 20, 2, 1, "BAD"), ("c", 20, 3, 2, "BAD"))     # the rolled-back batch is replayed
    commit(vt, spark, 3, ("c", 30, 4, 3, "new"))
    assert statuses(vt) == [(1, "good"), (3, "new")] and statuses(vt, as_of=1) == [(1, "good")]


def test_replay_after_expire_loses_nothing(spark, tmp_dir):
    vt = VersionedTable(spark, tmp_dir, C.ORDERS)
    commit(vt, spark, 1, ("c", 10, 1, 1, "a"))
    commit(vt, spark, 2, ("c", 20, 2, 2, "b"))
    commit(vt, spark, 3, ("c", 30, 3, 3, "c"))
    vt.expire(2)
    commit(vt, spark, 2, ("c", 20, 2, 2, "b"))
    commit(vt, spark, 1, ("c", 10, 1, 1, "a"))
    assert statuses(vt) == [(1, "a"), (2, "b"), (3, "c")] and statuses(vt, as_of=2) == [(1, "a"), (2, "b")]
    assert vt.snapshot_ids() == [2, 3]
    for unknown in (1, 99):  # an expired id and one that never was
        with pytest.raises(LookupError):
            vt.state(as_of=unknown)


def test_event_order_with_and_without_compaction(spark, tmp_dir):
    found = []
    for compacted in (False, True):
        vt = VersionedTable(spark, f"{tmp_dir}/{compacted}", C.ORDERS, event_order=True)
        commit(vt, spark, 1, ("c", 100, 1, 1, "newest"), ("c", 50, 2, 2, "x"), ("d", 90, 3, 2, "x"), (None, 10, 9, 5, "?"))
        if compacted:
            vt.compact()
        commit(vt, spark, 2, ("u", 60, 4, 1, "older"), ("u", 70, 5, 2, "older"), (None, 200, 6, 1, "none"), (None, 200, 7, 9, "none"))
        if compacted:
            vt.compact()
        commit(vt, spark, 3, ("u", 95, 8, 1, "late"))
        found.append(statuses(vt))
    # an update without an operation meets the row that is there; one without a row does nothing
    assert found == [[(1, "none")], [(1, "none")]]


def test_guard_breaks_ties_by_partition_and_offset(spark):
    t = seed(spark).withColumns({"ts_ms": F.lit(100).cast("long"), "partition": F.lit(0), "offset": F.lit(5).cast("long")})
    ch = changes(spark, [("u", 100, 0, 6, 1, 9, "1.00", "NEWER"), ("u", 100, 0, 4, 2, 9, "1.00", "OLDER")])
    out = as_dict(C.merge(t, C.collapse(ch, C.ORDERS), C.ORDERS, guard=True))
    assert out[1] == (9, "NEWER") and out[2] == (1, "PAID")


def test_the_log_is_written_once(spark):
    sf = "/root/testdata/sf0.001"
    first = spark.read.schema(L.LOG_SCHEMA).parquet(L.events_change_log(spark, sf))
    n = first.count()
    path = L.events_change_log(spark, sf)
    second = spark.read.schema(L.LOG_SCHEMA).parquet(path)
    from rivulet.session import file_statuses
    before = file_statuses(spark, path)
    assert L.events_change_log(spark, sf) == path and file_statuses(spark, path) == before
    assert first.count() == second.count() == n > 0


def test_a_published_folder_that_was_removed_is_built_again(spark):
    from rivulet.session import _file_system, published, scratch_path
    name = scratch_path(spark, "p").rsplit("/", 1)[-1]
    build = lambda folder: spark.range(3).write.parquet(folder)
    first = published(spark, name, build)
    assert published(spark, name, build) == first
    fs, path = _file_system(spark, first)
    assert fs.delete(path, True)
    again = published(spark, name, build)
    assert again != first and published(spark, name, build) == again and spark.read.parquet(again).count() == 3


def test_a_record_is_parsed_once(spark):
    rows = [(0, 1, None, bytearray(b"\x00\x00\x00\x00\x01" + text)) for text in (
        b'{"op": "c", "ts_ms": 1, "after": {"order_id": 5, "status": "NEW"}}', b'{"op": "u", "ts_ms": 2}')] + [(0, 2, None, None)]
    log = spark.createDataFrame(rows, "partition int, offset long, timestamp timestamp, value binary")
    changes = C.normalize(C.decode(log, L.ORDER_ENVELOPE), C.ORDERS)
    assert [(r.op, r.order_id, r.status) for r in changes.collect()] == [("c", 5, "NEW")]  # no key, no row
    assert changes._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
