"""Change-data-capture queries over the events change log."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.functions.frames import add_frame, frame_schema_id, strip_frame, strip_frame_lenient
from rivulet.operators import cdc as C
from rivulet.plans.registry import register
from rivulet.plans.sqlparts import STATUS_SQL
from rivulet.sources import changelog as L
from rivulet.sources import tables as T

# ---------------------------------------------------------------- SQL twins

EVENTS_CHANGES_SQL = """
SELECT user_id AS order_id,
       CASE event_type WHEN 'signup' THEN 'c' WHEN 'purchase' THEN 'r' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
       CAST(floor(epoch_ms(ts) / 3600000) * 3600000 AS BIGINT) AS ts_ms,
       CAST(user_id % 4 AS INTEGER) AS "partition", event_id AS "offset", ts AS event_time,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS customer_id,
       value AS amount, event_type AS status,
       CASE WHEN user_id % 2 = 0 THEN 'EUR' ELSE 'USD' END AS currency,
       CAST(floor((CAST(ts AS DATE) - DATE '1970-01-01') / 3) AS BIGINT) AS batch_id
FROM events
"""

NORMALIZED_SQL = f"""
SELECT op, ts_ms, "partition", "offset", order_id,
       CASE WHEN op <> 'd' THEN customer_id END AS customer_id,
       CASE WHEN op <> 'd' THEN CAST(amount AS DECIMAL(12,2)) END AS amount,
       CASE WHEN op <> 'd' THEN status END AS status,
       epoch_ms(ts_ms) AS ts, batch_id
FROM ({EVENTS_CHANGES_SQL}) e
"""

COLLAPSED_SQL = f"""
SELECT * FROM ({NORMALIZED_SQL}) n
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY ts_ms DESC, "partition" DESC, "offset" DESC) = 1
"""

ORDERS_TARGET_SQL = f"""
SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_totalprice AS DECIMAL(12,2)) AS amount,
       {STATUS_SQL} AS status, CAST(o_orderdate AS TIMESTAMP) AS ts
FROM orders
"""

MERGED_SQL = f"""
WITH t AS ({ORDERS_TARGET_SQL}), s AS ({COLLAPSED_SQL})
SELECT t.order_id, t.customer_id, t.amount, t.status, t.ts FROM t
WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.order_id = t.order_id)
UNION ALL
SELECT s.order_id, s.customer_id, s.amount, s.status, s.ts FROM s
WHERE s.op <> 'd' OR (s.op IS NULL AND EXISTS (SELECT 1 FROM t WHERE t.order_id = s.order_id))
"""


# ---------------------------------------------------------------- helpers

def change_log(spark, sf):
    return L.read_change_batch(spark, L.events_change_log(spark, sf))


def decoded(spark, sf):
    return C.decode(change_log(spark, sf), L.ORDER_ENVELOPE)


def normalized(spark, sf):
    return C.normalize(decoded(spark, sf), C.ORDERS)


def orders_target(spark, sf):
    o = T.orders(spark, sf)
    return o.select("order_id", "customer_id", F.col("amount").cast("decimal(12,2)").alias("amount"),
                    "status", F.col("order_timestamp").cast("timestamp").alias("ts"))


# ---------------------------------------------------------------- queries

@register("cdc_batch_scan", sql=f"""
SELECT "partition", "offset", CAST(event_time AS TIMESTAMP) AS "timestamp",
       CAST(order_id AS VARCHAR) AS record_key, batch_id
FROM ({EVENTS_CHANGES_SQL}) e
""")
def cdc_batch_scan(spark, sf):
    log = change_log(spark, sf)
    return log.select("partition", "offset", "timestamp", F.col("key").cast("string").alias("record_key"), "batch_id")


@register("frame_strip", sql=f"""
SELECT "offset", CAST(1 AS BIGINT) AS schema_id, true AS has_payload, CAST(123 AS INTEGER) AS first_byte,
       -5 AS strict_delta, -5 AS lenient_delta
FROM ({EVENTS_CHANGES_SQL}) e
UNION ALL SELECT CAST(-1 AS BIGINT), NULL, false, NULL, NULL, NULL
UNION ALL SELECT CAST(-2 AS BIGINT), NULL, false, NULL, NULL, 0
UNION ALL SELECT CAST(-3 AS BIGINT), CAST(1 AS BIGINT), false, NULL, NULL, -5
UNION ALL SELECT CAST(-4 AS BIGINT), CAST(1 AS BIGINT), true, CAST(123 AS INTEGER), -5, -5
""")
def frame_strip(spark, sf):
    """Frame stripping over every log record plus the edge frames NULL, 0, 5 and 6 bytes.

    ``*_delta`` = stripped length minus record length under the stream rule
    (payload only when longer than the frame) and the notebook rule (drop 5
    bytes when at least 5 are present, else keep)."""
    log = change_log(spark, sf).select("offset", "value")
    edges = spark.createDataFrame(
        [(-1, None), (-2, bytearray(b"")), (-3, bytearray(b"\x00\x00\x00\x00\x01")),
         (-4, bytearray(b"\x00\x00\x00\x00\x01{"))], "offset long, value binary")
    v = F.col("value")
    strict, lenient = strip_frame(v), strip_frame_lenient(v)
    return log.unionByName(edges).select(
        "offset", frame_schema_id(v).alias("schema_id"), strict.isNotNull().alias("has_payload"),
        F.when(F.length(strict) > 0, F.ascii(F.substring(strict, 1, 1).cast("string"))).alias("first_byte"),
        (F.length(strict) - F.length(v)).alias("strict_delta"),
        (F.length(lenient) - F.length(v)).alias("lenient_delta"))


@register("cdc_decode", sql=f"""
SELECT "partition", "offset", op, ts_ms,
       CASE WHEN op IN ('u','d') THEN order_id END AS before_order_id,
       CASE WHEN op <> 'd' THEN order_id END AS after_order_id,
       CASE WHEN op <> 'd' THEN amount END AS after_amount,
       CASE WHEN op <> 'd' THEN status END AS after_status,
       ts_ms AS source_ts_ms, 'orders' AS source_table, 'tx-' || CAST(batch_id AS VARCHAR) AS tx_id
FROM ({EVENTS_CHANGES_SQL}) e
""")
def cdc_decode(spark, sf):
    d = decoded(spark, sf)
    return d.select("partition", "offset", F.col("r.op").alias("op"), F.col("r.ts_ms").alias("ts_ms"),
                    F.col("r.before.order_id").alias("before_order_id"),
                    F.col("r.after.order_id").alias("after_order_id"),
                    F.col("r.after.amount").alias("after_amount"),
                    F.col("r.after.status").alias("after_status"),
                    F.col("r.source.ts_ms").alias("source_ts_ms"),
                    F.col("r.source.table").alias("source_table"),
                    F.col("r.transaction.id").alias("tx_id"))


@register("cdc_normalize", sql=NORMALIZED_SQL)
def cdc_normalize(spark, sf):
    return normalized(spark, sf)


@register("cdc_collapse", sql=COLLAPSED_SQL)
def cdc_collapse(spark, sf):
    return C.collapse(normalized(spark, sf), C.ORDERS)


@register("cdc_merge", sql=MERGED_SQL)
def cdc_merge(spark, sf):
    """Existing orders table + every change of the log, merged (MERGE semantics)."""
    return C.apply_changes(orders_target(spark, sf), normalized(spark, sf), C.ORDERS)


@register("scd1", sql=MERGED_SQL)
def scd1(spark, sf):
    """SCD type 1 = overwrite in place = the MERGE of D6."""
    return C.merge(orders_target(spark, sf), C.collapse(normalized(spark, sf), C.ORDERS), C.ORDERS)


@register("cdc_soft_delete", sql=f"""
WITH t AS ({ORDERS_TARGET_SQL}),
s AS (SELECT op, order_id, customer_id, CAST(amount AS DECIMAL(12,2)) AS amount, status, epoch_ms(ts_ms) AS ts
      FROM ({EVENTS_CHANGES_SQL}) e
      QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY ts_ms DESC, "partition" DESC, "offset" DESC) = 1)
SELECT t.order_id, t.customer_id, t.amount, t.status, t.ts, false AS is_deleted FROM t
WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.order_id = t.order_id)
UNION ALL
SELECT s.order_id, s.customer_id, s.amount, s.status, s.ts, s.op = 'd' AS is_deleted FROM s
""")
def cdc_soft_delete(spark, sf):
    """Deletes kept as ``is_deleted = true`` rows carrying the last image."""
    ch = C.normalize(decoded(spark, sf), C.ORDERS, soft_delete=True)
    return C.merge(orders_target(spark, sf), C.collapse(ch, C.ORDERS), C.ORDERS, soft_delete=True)


@register("cdc_dedup", sql=f"""
SELECT order_id, ts_ms, op, arg_min("partition", struct_pack(p := "partition", o := "offset")) AS "partition",
       arg_min("offset", struct_pack(p := "partition", o := "offset")) AS "offset",
       arg_min(customer_id, struct_pack(p := "partition", o := "offset")) AS customer_id,
       arg_min(amount, struct_pack(p := "partition", o := "offset")) AS amount,
       arg_min(status, struct_pack(p := "partition", o := "offset")) AS status,
       arg_min(ts, struct_pack(p := "partition", o := "offset")) AS ts,
       arg_min(batch_id, struct_pack(p := "partition", o := "offset")) AS batch_id
FROM ({NORMALIZED_SQL}) n GROUP BY order_id, ts_ms, op
""")
def cdc_dedup(spark, sf):
    """De-duplicate by (key, source ts, op) over the log plus a replay of it
    (at-least-once delivery re-sends records with the same offsets)."""
    n = normalized(spark, sf)
    return C.dedup(n.unionByName(n), C.ORDERS)


@register("cdc_flatten", sql=f"""
SELECT op, op = 'r' AS is_snapshot, ts_ms AS source_ts_ms, 'erp' AS src_db, 'orders' AS src_table,
       'tx-' || CAST(batch_id AS VARCHAR) AS tx_id, order_id, customer_id, amount, status, currency,
       event_time AS order_ts, epoch_ms(ts_ms) AS created_at, event_time AS updated_at,
       "partition", "offset"
FROM ({EVENTS_CHANGES_SQL}) e
""")
def cdc_flatten(spark, sf):
    f = C.flatten(decoded(spark, sf), ["customer_id", "amount", "status", "currency", "order_ts",
                                       "created_at", "updated_at"], "order_id")
    return (f.withColumn("order_ts", F.to_timestamp("order_ts"))
             .withColumn("created_at", F.to_timestamp("created_at"))
             .withColumn("updated_at", F.to_timestamp("updated_at")))


@register("cdc_dead_letter", sql=f"""
WITH c AS (SELECT "partition", "offset", op, CASE
    WHEN "offset" % 89 = 0 THEN 'NULL_VALUE' WHEN "offset" % 83 = 0 THEN 'SHORT_FRAME'
    WHEN "offset" % 97 = 0 THEN 'UNPARSEABLE' WHEN "offset" % 79 = 0 THEN 'NOT_A_CHANGE' END AS cause
  FROM ({EVENTS_CHANGES_SQL}) e)
SELECT "partition", "offset", cause, CASE WHEN cause IS NULL THEN 'good' ELSE 'dead' END AS route,
       CASE WHEN cause IS NULL THEN op END AS op FROM c
""")
def cdc_dead_letter(spark, sf):
    """PERMISSIVE decode with dead-letter routing.  One fault of each cause is
    injected by offset: no value, less than a frame, a truncated payload, a
    heartbeat (a record without an operation); every record ends on exactly one side."""
    log = change_log(spark, sf)
    at, v = F.col("offset"), F.col("value")
    heartbeat = F.concat(F.substring(v, 1, 5), F.encode(F.lit('{"ts_ms": 1}'), "UTF-8"))
    log = log.withColumn("value", F.when(at % 89 == 0, F.lit(None)).when(at % 83 == 0, F.substring(v, 1, 3))
                         .when(at % 97 == 0, F.substring(v, 1, 20)).when(at % 79 == 0, heartbeat).otherwise(v))
    good, dead = C.split_dead_letters(log, L.ORDER_ENVELOPE)
    g = good.select("partition", "offset", F.lit(None).cast("string").alias("cause"),
                    F.lit("good").alias("route"), F.col("r.op").alias("op"))
    d = dead.select("partition", "offset", "cause", F.lit("dead").alias("route"), F.lit(None).cast("string").alias("op"))
    return g.unionByName(d)


# customers captured as a second table: snapshot rows + one update per order
CUSTOMERS_CFG = C.TableConfig("customers", "customer_id",
                              {"name": "string", "segment": "string", "last_order_id": "long"}, ts_col=None)
CUSTOMERS_ENVELOPE = C.envelope_schema(C.row_image_schema({"customer_id": "long", **CUSTOMERS_CFG.columns}))
CUSTOMERS_SCHEMA_ID = 2


def customers_log(spark, sf):
    """Change log of the customers: snapshot rows, then one update per order."""
    c = T.table(spark, sf, "customer")
    o = T.table(spark, sf, "orders")
    snap = c.select(F.col("c_custkey").alias("customer_id"), F.lit("r").alias("op"), F.lit(0).cast("long").alias("ts_ms"),
                    (F.col("c_custkey") % 4).cast("int").alias("partition"), F.lit(-1).cast("long").alias("offset"),
                    F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"),
                    F.lit(None).cast("long").alias("last_order_id"))
    upd = (o.join(c, o.o_custkey == c.c_custkey, "inner")
             .select(F.col("o_custkey").alias("customer_id"), F.lit("u").alias("op"),
                     F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("ts_ms"),
                     (F.col("o_custkey") % 4).cast("int").alias("partition"), F.col("o_orderkey").alias("offset"),
                     F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"),
                     F.col("o_orderkey").alias("last_order_id")))
    image = F.struct("customer_id", "name", "segment", "last_order_id")
    envelope = F.struct("op", "ts_ms", image.alias("after"), F.struct(F.lit("customers").alias("table")).alias("source"))
    return snap.unionByName(upd).select("partition", "offset", F.timestamp_millis("ts_ms").alias("timestamp"),
                                        add_frame(F.encode(F.to_json(envelope), "UTF-8"), CUSTOMERS_SCHEMA_ID).alias("value"))


@register("cdc_customers", sql="""
WITH ch AS (
  SELECT c_custkey AS customer_id, 'r' AS op, CAST(0 AS BIGINT) AS ts_ms, CAST(c_custkey % 4 AS INTEGER) AS p,
         CAST(-1 AS BIGINT) AS o, c_name AS name, c_mktsegment AS segment, CAST(NULL AS BIGINT) AS last_order_id
  FROM customer
  UNION ALL
  SELECT o.o_custkey, 'u', epoch_ms(o.o_orderdate), CAST(o.o_custkey % 4 AS INTEGER), o.o_orderkey,
         c.c_name, c.c_mktsegment, o.o_orderkey
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)
SELECT customer_id, name, segment, last_order_id FROM ch
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY ts_ms DESC, p DESC, o DESC) = 1
""")
def cdc_customers(spark, sf):
    """Multi-table capture: a log of a second table (customers: snapshot rows, then
    one update per order) through decode, normalise, collapse and merge, driven by its own config."""
    changes = C.normalize(C.decode(customers_log(spark, sf), CUSTOMERS_ENVELOPE), CUSTOMERS_CFG)
    empty = spark.createDataFrame([], C.row_image_schema({"customer_id": "long", **CUSTOMERS_CFG.columns}))
    return C.apply_changes(empty, changes, CUSTOMERS_CFG)


@register("cdc_resnapshot", sql=f"""
WITH snap AS (
  SELECT 'r' AS op, CAST(0 AS BIGINT) AS ts_ms, CAST(-1 AS INTEGER) AS "partition",
         o_orderkey AS "offset", o_orderkey AS order_id, o_custkey AS customer_id,
         CAST(o_totalprice AS DECIMAL(12,2)) AS amount, {STATUS_SQL} AS status
  FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'),
live AS (SELECT op, ts_ms, "partition", "offset", order_id, customer_id, amount, status FROM ({NORMALIZED_SQL}) n),
allc AS (SELECT * FROM snap UNION ALL SELECT * FROM live)
SELECT order_id, customer_id, amount, status, op FROM allc
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY ts_ms DESC, "partition" DESC, "offset" DESC) = 1
""")
def cdc_resnapshot(spark, sf, since: str = "1998-01-01", snapshot_ts_ms: int = 0):
    """Incremental snapshot: re-read a time slice of the source table (orders
    placed since ``since``) as op='r' rows stamped at ``snapshot_ts_ms`` and
    merge them with the live changes; a later live change of a key wins."""
    live = normalized(spark, sf)
    snap = C.resnapshot(T.orders(spark, sf), C.ORDERS, snapshot_ts_ms,
                        F.col("order_timestamp") >= F.lit(since).cast("timestamp_ntz"))
    allc = snap.unionByName(live.select("op", "ts_ms", "partition", "offset", "order_id", "customer_id",
                                        "amount", "status"))
    return C.collapse(allc, C.ORDERS).select("order_id", "customer_id", "amount", "status", "op")


SCD2_SQL = f"""
WITH n AS ({NORMALIZED_SQL}),
s AS (SELECT *, lag(struct_pack(customer_id, amount, status)) OVER w AS prev_img, lag(op) OVER w AS prev_op
      FROM n WINDOW w AS (PARTITION BY order_id ORDER BY ts_ms, "partition", "offset")),
k AS (SELECT * FROM s WHERE op = 'd' OR prev_op IS NULL OR prev_op = 'd'
        OR struct_pack(customer_id, amount, status) IS DISTINCT FROM prev_img),
v AS (SELECT *, lead(ts) OVER (PARTITION BY order_id ORDER BY ts_ms, "partition", "offset") AS valid_to FROM k)
SELECT order_id, customer_id, amount, status, ts AS valid_from, valid_to, valid_to IS NULL AS is_current,
       "partition", "offset"
FROM v WHERE op <> 'd'
"""


@register("scd2_history", sql=SCD2_SQL)
def scd2_history(spark, sf):
    return C.scd2_history(normalized(spark, sf), C.ORDERS)


@register("scd2_lookup", sql=f"""
WITH v AS ({SCD2_SQL}),
f AS (SELECT event_id, user_id AS order_id, CAST(ts AS TIMESTAMP) AS t FROM events)
SELECT f.event_id, f.order_id, f.t AS event_time,
       CASE WHEN y.valid_to IS NULL OR f.t < y.valid_to THEN y.status END AS status,
       CASE WHEN y.valid_to IS NULL OR f.t < y.valid_to THEN y.amount END AS amount
FROM f LEFT JOIN LATERAL (
  SELECT * FROM v WHERE v.order_id = f.order_id AND v.valid_from <= f.t
  ORDER BY v.valid_from DESC, v."partition" DESC, v."offset" DESC LIMIT 1) y ON true
""")
def scd2_lookup(spark, sf):
    """Each event joined to the order version valid at its (exact) time."""
    versions = C.scd2_history(normalized(spark, sf), C.ORDERS)
    ev = T.table(spark, sf, "events").select("event_id", F.col("user_id").alias("order_id"),
                                             F.col("ts").cast("timestamp").alias("event_time"))
    return C.as_of_lookup(ev, versions, "order_id", "event_time", ["status", "amount"],
                          tie_break=["partition", "offset"])
