"""Streaming queries.  Each one runs its stream to completion with an
``availableNow`` trigger into a Parquet sink in the shared folder (a fresh
checkpoint per run) and returns the batch read of what the stream wrote."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.operators import cdc as C
from rivulet.operators import joins as J
from rivulet.plans import lake
from rivulet.plans.cdc import CUSTOMERS_CFG, CUSTOMERS_ENVELOPE, EVENTS_CHANGES_SQL, customers_log
from rivulet.plans.registry import register
from rivulet.plans.table import FULL_STATE_SQL, log_changes
from rivulet.session import scratch_path
from rivulet.sources import changelog as L
from rivulet.sources import tables as TB
from rivulet.streaming import windows as W
from rivulet.streaming.cdc import start_cdc
from rivulet.streaming.run import ProgressLog, to_parquet_available_now
from rivulet.table import VersionedTable

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])

DELAY = "10 minutes"


def events_stream(spark, sf):
    """The events table as a file stream (a glob on the folder; a single file path cannot be streamed)."""
    return spark.readStream.schema(EVENTS_SCHEMA).option("pathGlobFilter", "events.parquet").parquet(sf)


def run_to_parquet(spark, df, name):
    out, ck = scratch_path(spark, f"{name}_out"), scratch_path(spark, f"{name}_ckpt")
    to_parquet_available_now(df, out, ck)
    return spark.read.parquet(out)


def streamed_table(spark, sf, name="orders_stream"):
    """Run the CDC stream over the change log, one log file per micro-batch."""
    vt = VersionedTable(spark, scratch_path(spark, name), C.ORDERS, event_order=True)
    # rate limit: at most one file per broker partition per trigger, so the log
    # is replayed as a sequence of micro-batches (the result does not depend on
    # how files are grouped: the table keeps the last change in event order)
    src = L.read_change_stream(spark, L.events_change_log(spark, sf), max_files_per_trigger=L.PARTITIONS)
    q = start_cdc(src, vt, C.ORDERS, L.ORDER_ENVELOPE, scratch_path(spark, f"{name}_ckpt"),
                  trigger={"availableNow": True}, name=None)
    q.awaitTermination()
    return vt, q


@register("cdc_stream_scan", sql=f"""
SELECT "partition", "offset", CAST(event_time AS TIMESTAMP) AS "timestamp", CAST(order_id AS VARCHAR) AS record_key
FROM ({EVENTS_CHANGES_SQL}) e
""")
def cdc_stream_scan(spark, sf):
    src = L.read_change_stream(spark, L.events_change_log(spark, sf), max_files_per_trigger=2 * L.PARTITIONS)
    df = src.select("partition", "offset", "timestamp", F.col("key").cast("string").alias("record_key"))
    return run_to_parquet(spark, df, "log_scan")


@register("cdc_stream_merge", sql=FULL_STATE_SQL)
def cdc_stream_merge(spark, sf):
    """Streaming CDC: every micro-batch is decoded, collapsed and committed; the result is the latest state."""
    vt, _ = streamed_table(spark, sf)
    return vt.state()


@register("stream_progress", sql="""
SELECT CAST(sum(1) AS BIGINT) AS num_input_rows, true AS consecutive, true AS timed FROM events
""")
def stream_progress(spark, sf):
    """Per micro-batch metrics of the CDC stream, from the progress table: all rows
    are accounted for, batch ids are consecutive from 0, every batch has its times."""
    log = ProgressLog(spark, scratch_path(spark, "progress"))
    _, q = streamed_table(spark, sf, "orders_stream_progress")
    rows = log.close().filter(F.col("query_id") == str(q.id)).filter("num_input_rows > 0")
    return rows.agg(F.sum("num_input_rows").alias("num_input_rows"),
                    ((F.min("batch_id") == 0) & (F.max("batch_id") + 1 == F.count_distinct("batch_id"))).alias("consecutive"),
                    F.bool_and((F.col("batch_seconds") > 0) & (F.col("lag_seconds") >= 0)).alias("timed"))


@register("cdc_backfill", sql=f"""
SELECT 'match' AS status, CAST(count(*) AS BIGINT) AS keys FROM ({FULL_STATE_SQL}) s
""")
def cdc_backfill(spark, sf):
    """Replay the whole log in batch into a fresh staging table, then reconcile it with the streamed table."""
    staging = VersionedTable(spark, scratch_path(spark, "orders_staging"), C.ORDERS)
    staging.commit_many(log_changes(spark, sf), commit_time_col="ts")
    live, _ = streamed_table(spark, sf, "orders_live")
    r = J.reconcile_keys(staging.state(), live.state(), "order_id", ["customer_id", "amount", "status", "ts"])
    return r.groupBy("status").agg(F.count(F.lit(1)).alias("keys"))


# Microsecond event times survive the text round trip (the default JSON format keeps milliseconds).
JSON_OPTS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
TEXT_LOG_SQL = "SELECT event_id, ts, user_id, event_type, value, props FROM events"


def text_log(spark, sf) -> str:
    """The events as a text log: one JSON document per line."""
    path = scratch_path(spark, "events_text_log")
    ev = TB.table(spark, sf, "events")
    ev.select(F.to_json(F.struct(*ev.columns), JSON_OPTS).alias("value")).write.text(path)
    return path


@register("text_log_parse", sql=TEXT_LOG_SQL)
def text_log_parse(spark, sf):
    """Text-valued log: cast the value to a string and parse it with the event schema."""
    raw = spark.read.text(text_log(spark, sf))
    return raw.select(F.from_json(F.col("value").cast("string"), EVENTS_SCHEMA, JSON_OPTS).alias("e")).select("e.*")


@register("stream_bronze_append", sql=TEXT_LOG_SQL)
def stream_bronze_append(spark, sf):
    """Stream the text log, parse it and append it to a Parquet bronze folder."""
    raw = spark.readStream.text(text_log(spark, sf))
    parsed = raw.select(F.from_json("value", EVENTS_SCHEMA, JSON_OPTS).alias("e")).select("e.*")
    return run_to_parquet(spark, parsed, "bronze_events")


CLOSED = f"(SELECT max(ts) FROM events) - INTERVAL {DELAY}"


@register("stream_tumbling", sql=f"""
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, event_type,
       CAST(count(*) AS BIGINT) AS n
FROM events GROUP BY 1, 2, 3 HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= {CLOSED}
""")
def stream_tumbling(spark, sf):
    return run_to_parquet(spark, W.tumbling(events_stream(spark, sf), "ts", "1 hour", ["event_type"], DELAY),
                          "tumbling")


@register("stream_sliding", sql=f"""
WITH w AS (SELECT time_bucket(INTERVAL 15 MINUTE, ts) - k * INTERVAL 15 MINUTE AS window_start, event_type
           FROM events, range(0, 4) t(k))
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type, CAST(count(*) AS BIGINT) AS n
FROM w GROUP BY 1, 2, 3 HAVING window_start + INTERVAL 1 HOUR <= {CLOSED}
""")
def stream_sliding(spark, sf):
    return run_to_parquet(spark, W.sliding(events_stream(spark, sf), "ts", "1 hour", "15 minutes", ["event_type"],
                                           DELAY), "sliding")


@register("stream_session", sql=f"""
WITH s AS (SELECT event_type, ts,
                  CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS new
           FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts)),
g AS (SELECT *, sum(new) OVER (PARTITION BY event_type ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM s)
SELECT min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, event_type, CAST(count(*) AS BIGINT) AS n
FROM g GROUP BY event_type, sid HAVING max(ts) + INTERVAL 30 MINUTE <= {CLOSED}
""")
def stream_session(spark, sf):
    return run_to_parquet(spark, W.sessions(events_stream(spark, sf), "ts", "30 minutes", ["event_type"], DELAY),
                          "session")


def events_with_replay(spark, sf) -> str:
    """Events plus re-delivered copies of every 50th event (at-least-once source), as two folders."""
    path = scratch_path(spark, "events_replayed")
    ev = TB.table(spark, sf, "events")
    ev.write.parquet(f"{path}/part=0")
    ev.filter(F.col("event_id") % 50 == 0).write.parquet(f"{path}/part=1")
    return path


@register("stream_dedup", sql="SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, user_id, event_type FROM events")
def stream_dedup(spark, sf):
    src = spark.readStream.schema(EVENTS_SCHEMA).parquet(events_with_replay(spark, sf) + "/*")
    d = W.dedup_within_watermark(src, "ts", ["event_id"], "1 hour").select("event_id", "ts", "user_id", "event_type")
    return run_to_parquet(spark, d, "dedup")


@register("stream_interval_join", sql="""
SELECT v.event_id AS view_id, p.event_id AS purchase_id, v.user_id, CAST(v.ts AS TIMESTAMP) AS view_ts,
       CAST(p.ts AS TIMESTAMP) AS purchase_ts
FROM events v JOIN events p ON v.user_id = p.user_id AND p.ts >= v.ts AND p.ts <= v.ts + INTERVAL 1 HOUR
WHERE v.event_type = 'view' AND p.event_type = 'purchase'
""")
def stream_interval_join(spark, sf):
    """Views followed by a purchase of the same user within one hour (stream-stream join)."""
    views = events_stream(spark, sf).filter(F.col("event_type") == "view")
    buys = events_stream(spark, sf).filter(F.col("event_type") == "purchase")
    j = W.interval_join(views, buys, "user_id", "ts", "ts", "1 hour", "1 hour").select(
        F.col("l.event_id").alias("view_id"), F.col("r.event_id").alias("purchase_id"), F.col("l.user_id"),
        F.col("l.ts").alias("view_ts"), F.col("r.ts").alias("purchase_ts"))
    return run_to_parquet(spark, j, "interval_join")


LATE_SHIFT_HOURS = 3


@register("late_rows", sql=f"""
SELECT event_id, CAST(ts - INTERVAL {LATE_SHIFT_HOURS} HOUR AS TIMESTAMP) AS ts,
       CAST((SELECT max(ts) FROM events) - INTERVAL {DELAY} AS TIMESTAMP) AS watermark
FROM events WHERE event_id % 50 = 0 AND ts - INTERVAL {LATE_SHIFT_HOURS} HOUR < (SELECT max(ts) FROM events) - INTERVAL {DELAY}
""")
def late_rows(spark, sf):
    """Late rows are kept, not lost: rows older than the watermark of the
    batches before them go to a side table.  The second log file re-sends every
    50th event three hours late."""
    from rivulet.streaming.late import route_late
    path = scratch_path(spark, "events_late")
    ev = TB.table(spark, sf, "events")
    on_time, late = scratch_path(spark, "on_time"), scratch_path(spark, "late")
    ckpt = scratch_path(spark, "late_ckpt")

    def run():
        src = spark.readStream.schema(EVENTS_SCHEMA).parquet(path)
        route_late(src, "ts", DELAY, on_time, late, ckpt)

    ev.write.parquet(path)                    # first delivery: one micro-batch
    run()
    (ev.filter(F.col("event_id") % 50 == 0)   # re-sent three hours late, picked up after a restart
       .withColumn("ts", F.col("ts") - F.expr(f"INTERVAL {LATE_SHIFT_HOURS} HOURS"))
       .write.mode("append").parquet(path))
    run()
    return spark.read.parquet(late).select("event_id", "ts", "watermark")


@register("state_inspection", sql="""
WITH newest AS (SELECT max(ts) - INTERVAL 1 HOUR AS mark FROM events)
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT event_id) AS BIGINT) AS keys,
       CAST(min(ts) + INTERVAL 1 HOUR AS TIMESTAMP) AS first_expiry, CAST(max(ts) + INTERVAL 1 HOUR AS TIMESTAMP) AS last_expiry,
       true AS in_many_partitions, 'dedupeWithinWatermark' AS operator_name
FROM events, newest WHERE ts + INTERVAL 1 HOUR > mark
""")
def state_inspection(spark, sf):
    """What the de-duplication stream still remembers when it stops: the events younger than the watermark allows to forget."""
    from rivulet.streaming.inspect import state_summary

    src = spark.readStream.schema(EVENTS_SCHEMA).parquet(events_with_replay(spark, sf) + "/*")
    out, ck = scratch_path(spark, "dedup_out"), scratch_path(spark, "dedup_ckpt")
    to_parquet_available_now(W.dedup_within_watermark(src, "ts", ["event_id"], "1 hour"), out, ck)
    return state_summary(spark, ck).groupBy("operator_name").agg(
        F.sum("rows").alias("rows"), F.sum("keys").alias("keys"), F.min("first_expiry").alias("first_expiry"),
        F.max("last_expiry").alias("last_expiry"), (F.count_distinct("partition_id") > 1).alias("in_many_partitions"))


@register("cdc_fan_out", sql=f"""
SELECT 'orders' AS tbl, order_id AS key, status AS label, CAST(NULL AS BIGINT) AS last_order_id FROM ({FULL_STATE_SQL}) s
UNION ALL
SELECT 'customers', c_custkey, c_mktsegment,
       (SELECT arg_max(o_orderkey, struct_pack(t := epoch_ms(o_orderdate), k := o_orderkey)) FROM orders WHERE o_custkey = c_custkey)
FROM customer
""")
def cdc_fan_out(spark, sf):
    """One log that holds two captured tables, read once per micro-batch and fed to a table each."""
    from rivulet.streaming.fanout import start_fan_out, table_route

    log = scratch_path(spark, "mixed_log")
    orders = spark.read.schema(L.LOG_SCHEMA).parquet(L.events_change_log(spark, sf))
    orders.select("partition", "offset", "timestamp", "value").unionByName(customers_log(spark, sf)).write.parquet(log)
    schema = T.StructType([f for f in L.LOG_SCHEMA if f.name in ("partition", "offset", "timestamp", "value")])
    to_orders = VersionedTable(spark, scratch_path(spark, "fan_orders"), C.ORDERS, event_order=True)
    to_customers = VersionedTable(spark, scratch_path(spark, "fan_customers"), CUSTOMERS_CFG, event_order=True)
    start_fan_out(spark.readStream.schema(schema).option("maxFilesPerTrigger", 8).parquet(log),
                  [table_route("orders", C.ORDERS, L.ORDER_ENVELOPE, to_orders),
                   table_route("customers", CUSTOMERS_CFG, CUSTOMERS_ENVELOPE, to_customers)],
                  scratch_path(spark, "fan_ckpt"), {"availableNow": True}).awaitTermination()
    return to_orders.state().select(F.lit("orders").alias("tbl"), F.col("order_id").alias("key"), F.col("status").alias("label"),
                                    F.lit(None).cast("long").alias("last_order_id")) \
        .unionByName(to_customers.state().select(F.lit("customers").alias("tbl"), F.col("customer_id").alias("key"),
                                                 F.col("segment").alias("label"), "last_order_id"))


#: Rejected share at which the gated stream stops; the landed orders stay below it.
STREAM_GATE = 0.25


@register("stream_gate", sql=f"""
SELECT order_id, customer_id, order_timestamp, status FROM ({lake.RAW_ORDERS_SQL}) r
WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND order_timestamp <> '{lake.BAD_DATE}'
  AND status NOT IN ('UNKNOWN', 'RETURNED')
""")
def stream_gate(spark, sf):
    """A gated stream of raw orders: the first delivery lands, the second, half of it broken, stops the query uncommitted."""
    from pyspark.errors import StreamingQueryException
    from rivulet.operators.rules import order_rules
    from rivulet.streaming.gate import start_gated

    raw, path, ck = (scratch_path(spark, n) for n in ("gated_raw", "gated", "gated_ckpt"))
    orders = lake.raw_orders(spark, sf)

    def run():
        src = spark.readStream.schema(orders.schema).parquet(raw)
        start_gated(src, order_rules(), "orders", F.col("order_id"), path, ck, STREAM_GATE, {"availableNow": True}).awaitTermination()

    orders.write.parquet(raw)
    run()
    broken = F.when(F.col("order_id").cast("long") % 2 == 0, F.lit("BROKEN")).otherwise(F.col("status"))
    orders.withColumn("status", broken).write.mode("append").parquet(raw)
    try:
        run()
    except StreamingQueryException as e:
        if "RejectedShareTooHigh" not in str(e):
            raise
    return spark.read.schema(orders.schema).parquet(f"{path}/valid").select(*orders.columns)


@register("cdc_reset_replay", sql=FULL_STATE_SQL)
def cdc_reset_replay(spark, sf):
    """The streamed orders table after a reset: a replay that fails leaves readers on the first run, the next one
    builds the table again from the start of the log, with a checkpoint of its own."""
    from rivulet.streaming.replay import ReplayableOutput

    out = ReplayableOutput(spark, scratch_path(spark, "orders_runs"))
    log = L.events_change_log(spark, sf)

    def start(data, checkpoint):
        src = L.read_change_stream(spark, log, max_files_per_trigger=4 * L.PARTITIONS)
        return start_cdc(src, VersionedTable(spark, data, C.ORDERS, event_order=True), C.ORDERS, L.ORDER_ENVELOPE, checkpoint,
                         trigger={"availableNow": True})

    def fails(data, checkpoint):
        raise ConnectionError("the log can't be reached")

    first = out.resume(start)
    try:
        out.reset(fails)
    except ConnectionError:
        assert out.path() == first
    return VersionedTable(spark, out.reset(start), C.ORDERS, event_order=True).state()
