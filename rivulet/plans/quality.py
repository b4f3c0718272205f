"""Data-quality, reconciliation and governance queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.functions.hashing import md5_prefix_int
from rivulet.operators import gold as G
from rivulet.operators import joins as J
from rivulet.operators import quality as Q
from rivulet.operators import silver as S
from rivulet.operators.profile import exact_percentiles
from rivulet.operators.rules import EMAIL_RE, customer_rules, item_rules, order_rules
from rivulet.plans import lake
from rivulet.plans.cdc import MERGED_SQL, ORDERS_TARGET_SQL, cdc_merge, orders_target
from rivulet.plans.gold import fact
from rivulet.plans.lake import RAW_CUSTOMERS_SQL, RAW_ITEMS_SQL, RAW_ORDERS_SQL
from rivulet.plans.registry import register
from rivulet.plans.silver import bronze
from rivulet.plans.sqlparts import FACT_SQL
from rivulet.session import scratch_path
from rivulet.sources import tables as T

GATE_THRESHOLD = 0.05


def _routed(raw, rules, name, record):
    """Router of one landed dataset: every error row names the file that its row came from."""
    payload = [c for c in raw.columns if c != "source_file"]
    valid, errors = Q.split(Q.tag(raw, rules), name, record, lake.CTX.batch_id, F.col("source_file"), payload)
    return valid.drop("source_file"), errors


def routed_items(spark, sf):
    typed = S.typed_items(bronze(spark, sf, "order_items", source_file="source_file"), keep=("source_file",))
    rid = F.concat_ws("-", F.col("order_id").cast("string"), F.col("product_id").cast("string"))
    return _routed(typed, item_rules(), "order_items", rid)


def routed_orders(spark, sf):
    return _routed(bronze(spark, sf, "orders", source_file="source_file"), order_rules(), "orders", F.col("order_id"))


def routed_customers(spark, sf):
    raw = bronze(spark, sf, "customers", "json", source_file="source_file")
    return _routed(raw, customer_rules(), "customers", F.col("customer_id"))


TYPED_ITEMS_SQL = f"""
SELECT TRY_CAST(order_id AS BIGINT) AS order_id, TRY_CAST(product_id AS BIGINT) AS product_id,
       TRY_CAST(quantity AS DECIMAL(12,2)) AS quantity, TRY_CAST(unit_price AS DECIMAL(12,2)) AS unit_price,
       CAST(TRY_CAST(quantity AS DECIMAL(12,2)) * TRY_CAST(unit_price AS DECIMAL(12,2)) AS DECIMAL(18,4)) AS line_total
FROM ({RAW_ITEMS_SQL}) i
"""

ERRORS_SQL = f"""
SELECT 'order_items' AS source_table, CAST(order_id AS VARCHAR) || '-' || CAST(product_id AS VARCHAR) AS record_id,
       e.code AS error_code, 'error' AS severity, e.msg AS error_message, '{lake.CTX.batch_id}' AS batch_id
FROM ({TYPED_ITEMS_SQL}) i, (VALUES
  ('ITEM_KEY_NULL', 'order_id and product_id are required'),
  ('QTY_NOT_POSITIVE', 'quantity must be > 0'),
  ('PRICE_NEGATIVE', 'unit_price must be >= 0')) e(code, msg)
WHERE (e.code = 'ITEM_KEY_NULL' AND (order_id IS NULL OR product_id IS NULL))
   OR (e.code = 'QTY_NOT_POSITIVE' AND (quantity IS NULL OR quantity <= 0))
   OR (e.code = 'PRICE_NEGATIVE' AND (unit_price IS NULL OR unit_price < 0))
UNION ALL
SELECT 'orders', order_id, e.code, 'error', e.msg, '{lake.CTX.batch_id}'
FROM ({RAW_ORDERS_SQL}) o, (VALUES
  ('ORDER_KEY_NULL', 'order_id is required'), ('CUSTOMER_KEY_NULL', 'customer_id is required'),
  ('BAD_DATE', 'order_timestamp is not a valid timestamp'), ('BAD_STATUS', 'status outside the catalogue')) e(code, msg)
WHERE (e.code = 'ORDER_KEY_NULL' AND order_id IS NULL)
   OR (e.code = 'CUSTOMER_KEY_NULL' AND customer_id IS NULL)
   OR (e.code = 'BAD_DATE' AND order_timestamp IS NOT NULL
       AND try_strptime(order_timestamp, '%Y-%m-%dT%H:%M:%SZ') IS NULL)
   OR (e.code = 'BAD_STATUS' AND NOT coalesce(upper(trim(status)) IN ('CREATED', 'PAID', 'SHIPPED', 'DELIVERED', 'CANCELLED', 'REFUNDED'), false))
UNION ALL
SELECT 'customers', customer_id, 'BAD_EMAIL', 'warning', 'email has no valid format; masked and kept',
       '{lake.CTX.batch_id}'
FROM ({RAW_CUSTOMERS_SQL}) c WHERE NOT coalesce(regexp_matches(email, '{EMAIL_RE}'), false)
"""


@register("dq_route", sql=f"""
SELECT * FROM ({TYPED_ITEMS_SQL}) i
WHERE order_id IS NOT NULL AND product_id IS NOT NULL AND quantity > 0 AND unit_price >= 0
""")
def dq_route(spark, sf):
    """Valid order items after the one-pass router (bad rows go to the error table)."""
    valid, _errors = routed_items(spark, sf)
    return valid


def all_errors(spark, sf) -> DataFrame:
    parts = [routed_items(spark, sf)[1], routed_orders(spark, sf)[1], routed_customers(spark, sf)[1]]
    return reduce(DataFrame.unionByName, parts)


@register("dq_errors", sql=f"""
SELECT e.*, 'bronze/' || source_table || '/ingestion_date={lake.INGESTION_DATE}' AS source_file FROM ({ERRORS_SQL}) e
""")
def dq_errors(spark, sf):
    """The error table (one row per broken rule) with the landed folder of each row's file; raw payload and
    load time are left out of the comparison, and so is the file's own name, which Spark makes up."""
    folder = F.regexp_extract("source_file", r"(bronze/[^/]+/[^/]+)/[^/]+$", 1)
    return all_errors(spark, sf).drop("raw_payload", "created_at").withColumn("source_file", folder)


@register("dq_summary", sql=f"""
SELECT source_table, error_code, CAST(count(*) AS BIGINT) AS total_errors FROM ({ERRORS_SQL}) e
GROUP BY 1, 2 ORDER BY total_errors DESC, source_table, error_code
""")
def dq_summary(spark, sf):
    return (all_errors(spark, sf).groupBy("source_table", "error_code")
            .agg(F.count(F.lit(1)).alias("total_errors"))
            .orderBy(F.desc("total_errors"), "source_table", "error_code"))


def _suite(df, rules, name):
    return Q.suite(Q.tag(df, rules), name, GATE_THRESHOLD)


GATE_SQL = f"""
SELECT 'order_items' AS suite, CAST(count(*) AS BIGINT) AS rows,
       CAST(count(*) FILTER (WHERE NOT (order_id IS NOT NULL AND product_id IS NOT NULL AND quantity > 0
            AND unit_price >= 0)) AS BIGINT) AS rejected
FROM ({TYPED_ITEMS_SQL}) i
UNION ALL
SELECT 'orders', count(*), count(*) FILTER (WHERE order_id IS NULL OR customer_id IS NULL
       OR (order_timestamp IS NOT NULL AND try_strptime(order_timestamp, '%Y-%m-%dT%H:%M:%SZ') IS NULL)
       OR NOT coalesce(upper(trim(status)) IN ('CREATED', 'PAID', 'SHIPPED', 'DELIVERED', 'CANCELLED', 'REFUNDED'), false))
FROM ({RAW_ORDERS_SQL}) o
UNION ALL
SELECT 'customers', count(*), 0 FROM ({RAW_CUSTOMERS_SQL}) c
"""


@register("dq_gate", sql=f"""
SELECT suite, rows, rejected, round(rejected / rows, 6) AS reject_ratio, CAST({GATE_THRESHOLD} AS DOUBLE) AS threshold,
       rejected / rows <= {GATE_THRESHOLD} AS passed
FROM ({GATE_SQL}) g
""")
def dq_gate(spark, sf):
    """Verdict per suite; ``rivulet.operators.quality.gate`` raises on it before gold is written."""
    parts = [_suite(S.typed_items(bronze(spark, sf, "order_items")), item_rules(), "order_items"),
             _suite(bronze(spark, sf, "orders"), order_rules(), "orders"),
             _suite(bronze(spark, sf, "customers", "json"), customer_rules(), "customers")]
    return reduce(DataFrame.unionByName, parts)


@register("dq_ratios", sql=f"""
SELECT 'orders' AS table_name, CAST(count(*) AS BIGINT) AS rows,
       round(count(customer_id) / count(*), 6) AS completeness,
       round(count(try_strptime(order_timestamp, '%Y-%m-%dT%H:%M:%SZ')) / count(*), 6) AS validity,
       max(try_strptime(order_timestamp, '%Y-%m-%dT%H:%M:%SZ')) AS freshest
FROM ({RAW_ORDERS_SQL}) o
""")
def dq_ratios(spark, sf):
    """Completeness (customer key present), validity (timestamp parses) and freshness (latest order)."""
    o = bronze(spark, sf, "orders")
    ts = F.try_to_timestamp(F.col("order_timestamp"))
    return o.agg(F.count(F.lit(1)).alias("rows"),
                 F.round(F.count("customer_id") / F.count(F.lit(1)), 6).alias("completeness"),
                 F.round(F.count(ts) / F.count(F.lit(1)), 6).alias("validity"),
                 F.max(ts).alias("freshest")).select(F.lit("orders").alias("table_name"), "*")


EXPECTED_FACT_COLUMNS = ["product_id", "order_id", "quantity", "unit_price", "customer_id", "order_timestamp",
                         "status", "name", "category", "price", "revenue"]


@register("contract_checks", sql=f"""
WITH f AS ({FACT_SQL}),
typed AS ({TYPED_ITEMS_SQL}),
clean(check_name, detail) AS (
  SELECT 'expected_columns', CAST(0 AS BIGINT)
  UNION ALL SELECT 'unique_keys', (SELECT CAST(count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT)
                                   FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))
  UNION ALL SELECT 'sales_consistent', CAST(0 AS BIGINT)
  UNION ALL SELECT 'invalid_in_errors', CAST(0 AS BIGINT)
  UNION ALL SELECT 'gold_not_empty', (SELECT CAST(count(*) AS BIGINT) FROM f)),
broken(check_name, detail) AS (
  SELECT 'expected_columns', CAST(1 AS BIGINT)
  UNION ALL SELECT 'unique_keys', (SELECT CAST(count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT) FROM lineitem)
  UNION ALL SELECT 'sales_consistent', (SELECT CAST(count(DISTINCT (strftime(order_timestamp, '%Y-%m'), category)) AS BIGINT)
    FROM f WHERE status = 'SHIPPED')
  UNION ALL SELECT 'invalid_in_errors', (SELECT CAST(count(*) AS BIGINT) FROM typed
    WHERE (quantity IS NULL OR quantity <= 0) AND order_id IS NOT NULL AND product_id IS NOT NULL AND unit_price >= 0)
  UNION ALL SELECT 'gold_not_empty', CAST(0 AS BIGINT))
SELECT 'clean' AS run, check_name, CASE check_name WHEN 'gold_not_empty' THEN detail > 0 ELSE detail = 0 END AS passed, detail
FROM clean
UNION ALL
SELECT 'broken', check_name, CASE check_name WHEN 'gold_not_empty' THEN detail > 0 ELSE detail = 0 END, detail FROM broken
""")
def contract_checks(spark, sf):
    """The five contract checks on written tables, once as they are and once with
    one failure injected for each check (a column dropped, keys not
    de-duplicated, shipped sales missing from the fact, errors of one rule lost, no gold rows).
    Where a table is as it should be, or a column or all rows were taken away, the
    count is a fixed case, and the SQL twin states it as a number."""
    from rivulet.plans.silver import silver_keep_last

    def stored(df, name):
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    f = stored(fact(spark, sf), "contract_fact")
    mart = stored(G.sales_by_month(f), "contract_mart")
    lines = stored(silver_keep_last(spark, sf), "contract_lines")
    items = S.typed_items(bronze(spark, sf, "order_items"))
    _, errors = Q.route(items, item_rules(), "order_items", F.concat_ws("-", "order_id", "product_id"), lake.CTX.batch_id)
    errors = stored(errors, "contract_errors")
    bad = Q.tag(items, item_rules()).filter(F.exists("_violations", lambda v: v["severity"] == "error"))
    clean = contract_verdicts(f, mart, lines, ["l_orderkey", "l_linenumber"], bad, errors)
    broken = contract_verdicts(f.drop("category").where("false"), mart, T.table(spark, sf, "lineitem"),
                               ["l_orderkey", "l_linenumber"], bad, errors.filter("error_code <> 'QTY_NOT_POSITIVE'"),
                               sales=f.filter("status <> 'SHIPPED'"))
    return clean.select(F.lit("clean").alias("run"), "*").unionByName(broken.select(F.lit("broken").alias("run"), "*"))


def contract_verdicts(gold: DataFrame, mart: DataFrame, keyed: DataFrame, keys: list[str], bad: DataFrame,
                      errors: DataFrame, sales: DataFrame | None = None) -> DataFrame:
    """One row per check: name, whether it passed, and what it counted (columns
    missing, repeated keys, months and categories whose totals differ, rejected
    rows without an error row, gold rows)."""
    spark = gold.sparkSession
    missing = len(set(EXPECTED_FACT_COLUMNS) - set(gold.columns))
    expected = spark.range(1).select(F.lit("expected_columns").alias("check_name"), F.lit(missing).cast("long").alias("detail"))
    unique = keyed.agg((F.count(F.lit(1)) - F.count_distinct(*keys)).alias("detail")) \
        .select(F.lit("unique_keys").alias("check_name"), "detail")
    again = G.sales_by_month(sales if sales is not None else gold).select("sales_month", "category", F.col("revenue").alias("r"))
    both = mart.join(again, mart["sales_month"].eqNullSafe(again["sales_month"]) & mart["category"].eqNullSafe(again["category"]),
                     "full_outer")
    consistent = both.agg(F.count_if(~F.col("revenue").eqNullSafe(F.col("r"))).alias("detail")) \
        .select(F.lit("sales_consistent").alias("check_name"), "detail")
    known = errors.filter("severity = 'error'").groupBy("raw_payload").agg(F.lit(True).alias("met"))
    payload = F.to_json(F.struct(*[c for c in bad.columns if c != "_violations"]))
    lost = bad.withColumn("raw_payload", payload).join(known, "raw_payload", "left_anti") \
        .agg(F.count(F.lit(1)).alias("detail")).select(F.lit("invalid_in_errors").alias("check_name"), "detail")
    rows = gold.agg(F.count(F.lit(1)).alias("detail")).select(F.lit("gold_not_empty").alias("check_name"), "detail")
    found = reduce(DataFrame.unionByName, [expected, unique, consistent, lost, rows])
    return found.select("check_name", F.when(F.col("check_name") == "gold_not_empty", F.col("detail") > 0)
                        .otherwise(F.col("detail") == 0).alias("passed"), "detail")


@register("job_metrics", sql=f"""
SELECT 'silver_order_items' AS job, CAST(count(*) AS BIGINT) AS read,
       CAST(count(*) FILTER (WHERE ok) AS BIGINT) AS written, CAST(count(*) FILTER (WHERE NOT ok) AS BIGINT) AS rejected,
       CAST(count(*) - count(DISTINCT (order_id, product_id)) AS BIGINT) AS duplicates,
       CAST(count(*) FILTER (WHERE order_id IS NULL OR product_id IS NULL) AS BIGINT) AS null_keys
FROM (SELECT *, coalesce(order_id IS NOT NULL AND product_id IS NOT NULL AND quantity > 0 AND unit_price >= 0, false)
      AS ok FROM ({TYPED_ITEMS_SQL}) i) t
""")
def job_metrics(spark, sf):
    """Counters of the silver order-items job in one aggregate pass over the tagged rows."""
    typed = S.typed_items(bronze(spark, sf, "order_items"))
    tagged = Q.tag(typed, item_rules())
    bad = F.exists("_violations", lambda v: v["severity"] == "error")
    return tagged.agg(
        F.count(F.lit(1)).alias("read"), F.count(F.when(~bad, 1)).alias("written"),
        F.count(F.when(bad, 1)).alias("rejected"),
        (F.count(F.lit(1)) - F.count_distinct("order_id", "product_id")).alias("duplicates"),
        F.count(F.when(F.col("order_id").isNull() | F.col("product_id").isNull(), 1)).alias("null_keys"),
    ).select(F.lit("silver_order_items").alias("job"), "*")


KEYS = {"lineitem": ["l_orderkey", "l_linenumber"], "orders": ["o_orderkey"], "customer": ["c_custkey"],
        "part": ["p_partkey"], "events": ["event_id"]}


@register("key_uniqueness", sql=" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS rows, "
    f"CAST(count(DISTINCT ({', '.join(k)})) AS BIGINT) AS distinct_keys, "
    f"CAST(count(*) - count(DISTINCT ({', '.join(k)})) AS BIGINT) AS duplicates FROM {t}" for t, k in KEYS.items()))
def key_uniqueness(spark, sf):
    parts = [T.table(spark, sf, t).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(*k).alias("distinct_keys"))
             .select(F.lit(t).alias("table_name"), "rows", "distinct_keys",
                     (F.col("rows") - F.col("distinct_keys")).alias("duplicates")) for t, k in KEYS.items()]
    return reduce(DataFrame.unionByName, parts)


@register("orphan_rows", sql="""
SELECT 'lineitem' AS source_table, CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS record_id,
       l_partkey AS missing_key
FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 10 <> 0)
UNION ALL
SELECT 'orders', CAST(o_orderkey AS VARCHAR), o_custkey
FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 0)
""")
def orphan_rows(spark, sf):
    """Foreign keys without a parent.  The driver data has none, so the parents
    lose the keys with key % 10 = 0 first (fault injection)."""
    part = T.table(spark, sf, "part").filter(F.col("p_partkey") % 10 != 0)
    cust = T.table(spark, sf, "customer").filter(F.col("c_custkey") % 10 != 0)
    li = J.orphans(T.table(spark, sf, "lineitem"), part, "l_partkey", "p_partkey").select(
        F.lit("lineitem").alias("source_table"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("record_id"),
        F.col("l_partkey").alias("missing_key"))
    o = J.orphans(T.table(spark, sf, "orders"), cust, "o_custkey", "c_custkey").select(
        F.lit("orders").alias("source_table"), F.col("o_orderkey").cast("string").alias("record_id"),
        F.col("o_custkey").alias("missing_key"))
    return li.unionByName(o)


@register("recon_keys", sql=f"""
WITH s AS ({ORDERS_TARGET_SQL}), t AS ({MERGED_SQL})
SELECT CASE WHEN t.order_id IS NULL THEN 'missing_in_target' WHEN s.order_id IS NULL THEN 'extra_in_target'
            WHEN s.customer_id IS NOT DISTINCT FROM t.customer_id AND s.amount IS NOT DISTINCT FROM t.amount
                 AND s.status IS NOT DISTINCT FROM t.status THEN 'match' ELSE 'changed' END AS status,
       CAST(count(*) AS BIGINT) AS keys
FROM s FULL OUTER JOIN t ON s.order_id = t.order_id GROUP BY 1
""")
def recon_keys(spark, sf):
    """Source orders against the CDC-merged table: keys per reconciliation status."""
    r = J.reconcile_keys(orders_target(spark, sf), cdc_merge(spark, sf), "order_id",
                         ["customer_id", "amount", "status"])
    return r.groupBy("status").agg(F.count(F.lit(1)).alias("keys"))


@register("recon_tree", sql=f"""
WITH s AS ({ORDERS_TARGET_SQL}), t AS ({MERGED_SQL})
SELECT coalesce(s.order_id, t.order_id) AS order_id,
       CASE WHEN t.order_id IS NULL THEN 'missing_in_target' WHEN s.order_id IS NULL THEN 'extra_in_target' ELSE 'changed' END AS status
FROM s FULL OUTER JOIN t ON s.order_id = t.order_id
WHERE s.order_id IS NULL OR t.order_id IS NULL OR s.customer_id IS DISTINCT FROM t.customer_id
   OR s.amount IS DISTINCT FROM t.amount OR s.status IS DISTINCT FROM t.status
""")
def recon_tree(spark, sf):
    """The keys that differ between the source orders and the CDC-merged table, found by descending into unequal key ranges only."""
    from rivulet.operators.recon_tree import reconcile_tree

    keys, _ = reconcile_tree(spark, orders_target(spark, sf), cdc_merge(spark, sf), "order_id", ["customer_id", "amount", "status"])
    return keys


def _totals(df, side):
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum("amount").cast("decimal(38,2)").alias("amount_sum"),
                  F.sum(md5_prefix_int("order_id", "customer_id", "amount", "status")).alias("hash_total")
                  ).select(F.lit(side).alias("side"), "*")


@register("recon_totals", sql=f"""
WITH s AS ({ORDERS_TARGET_SQL}), t AS ({MERGED_SQL}),
tot AS (
  SELECT 'source' AS side, CAST(count(*) AS BIGINT) AS rows, CAST(sum(amount) AS DECIMAL(38,2)) AS amount_sum,
    CAST(sum(CAST(('0x' || substr(md5(concat_ws('~', CAST(order_id AS VARCHAR), CAST(customer_id AS VARCHAR),
      CAST(amount AS VARCHAR), status)), 1, 8)) AS BIGINT)) AS BIGINT) AS hash_total FROM s
  UNION ALL
  SELECT 'target', count(*), sum(amount),
    sum(CAST(('0x' || substr(md5(concat_ws('~', CAST(order_id AS VARCHAR), CAST(customer_id AS VARCHAR),
      CAST(amount AS VARCHAR), status)), 1, 8)) AS BIGINT)) FROM t)
SELECT side, rows, amount_sum, CAST(hash_total AS BIGINT) AS hash_total,
       round(abs(rows - (SELECT rows FROM tot WHERE side = 'source')) / (SELECT rows FROM tot WHERE side = 'source'), 6)
         AS drift_ratio,
       abs(rows - (SELECT rows FROM tot WHERE side = 'source')) / (SELECT rows FROM tot WHERE side = 'source') <= 0.001
         AS within_tolerance
FROM tot
""")
def recon_totals(spark, sf):
    """Counts, sums and an order-free hash total per side, with the row drift against 0.1 %."""
    tot = _totals(orders_target(spark, sf), "source").unionByName(_totals(cdc_merge(spark, sf), "target"))
    # two rows in total: the source count is spread to both with a window
    j = tot.withColumn("src_rows", F.max(F.when(F.col("side") == "source", F.col("rows")))
                       .over(Window.partitionBy(F.lit(1))))
    drift = F.abs(F.col("rows") - F.col("src_rows")) / F.col("src_rows")
    return j.select("side", "rows", "amount_sum", "hash_total", F.round(drift, 6).alias("drift_ratio"),
                    (drift <= 0.001).alias("within_tolerance"))


BATCH_MS = 15 * 60 * 1000
TARGET_MS = 10 * 60 * 1000


@register("latency_p95", sql=f"""
SELECT event_type, CAST(quantile_disc(lat, 0.95) AS BIGINT) AS p95_latency_ms, CAST({TARGET_MS} AS BIGINT) AS target_ms,
       quantile_disc(lat, 0.95) <= {TARGET_MS} AS met
FROM (SELECT event_type, (floor((epoch_us(ts) // 1000) / {BATCH_MS}) + 1) * {BATCH_MS} - (epoch_us(ts) // 1000) AS lat
      FROM events) e
GROUP BY event_type
""")
def latency_p95(spark, sf):
    """Event-to-landing latency P95 per event type against the 10 minute target.
    Landing time = end of the 15 minute micro-batch that picks the event up."""
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    e = T.table(spark, sf, "events").select("event_type",
                                           ((F.floor(ms / BATCH_MS) + 1) * BATCH_MS - ms).alias("lat"))
    p95 = exact_percentiles(e, "lat", [0.95], ("event_type",))
    return p95.select("event_type", F.col("value").cast("long").alias("p95_latency_ms")).select(
        "event_type", "p95_latency_ms", F.lit(TARGET_MS).cast("long").alias("target_ms"),
        (F.col("p95_latency_ms") <= TARGET_MS).alias("met"))


@register("salted_join", sql=f"""
SELECT o.o_orderstatus AS o_orderstatus, CAST(count(*) AS BIGINT) AS lines,
       CAST(sum(CAST(l.l_quantity AS DECIMAL(12,2)) * CAST(l.l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(38,4)) AS revenue
FROM (SELECT l_quantity, l_extendedprice,
             CASE WHEN l_returnflag = 'R' THEN (SELECT min(o_orderkey) FROM orders) ELSE l_orderkey END AS l_orderkey
      FROM lineitem) l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1
""")
def salted_join(spark, sf):
    """lineitem ⋈ orders, returned lines moved to one order so that it holds a
    large share of all lines; that key is salted over 16 tasks."""
    orders = T.table(spark, sf, "orders")
    first = orders.agg(F.min("o_orderkey").alias("_first"))
    li = T.table(spark, sf, "lineitem").join(F.broadcast(first)).select(
        F.when(F.col("l_returnflag") == "R", F.col("_first")).otherwise(F.col("l_orderkey")).alias("l_orderkey"),
        "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    o = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    j = J.salted_join(li, o, "l_orderkey", salts=16, min_share=0.01)
    return j.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(G.money(F.col("l_quantity")) * G.money(F.col("l_extendedprice"))).cast(G.TOTAL_TYPE).alias("revenue"))
