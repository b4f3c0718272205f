"""Table layer queries: DDL and writes, catalog scans, time travel, maintenance."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.operators import cdc as C
from rivulet.plans.cdc import EVENTS_CHANGES_SQL
from rivulet.plans.gold import fact
from rivulet.plans.registry import register
from rivulet.plans.sqlparts import FACT_SQL
from rivulet.session import published, scratch_path
from rivulet.sinks import compaction as CO
from rivulet.sinks import tables as K
from rivulet.sinks.retention import drop_old_days
from rivulet.sources import catalog as CAT
from rivulet.sources import changelog as L
from rivulet.sources import tables as T
from rivulet.table import VersionedTable


def log_changes(spark, sf):
    """Normalised changes of the events log, with their batch id."""
    log = spark.read.schema(L.LOG_SCHEMA).parquet(L.events_change_log(spark, sf))
    return C.normalize(C.decode(log, L.ORDER_ENVELOPE), C.ORDERS)


def built_table(spark, sf) -> VersionedTable:
    """A fresh versioned orders table with one commit per log batch."""
    vt = VersionedTable(spark, scratch_path(spark, "orders_vt"), C.ORDERS)
    # commit time of a batch = its latest change (deterministic, unlike the wall clock)
    vt.commit_many(log_changes(spark, sf), commit_time_col="ts")
    return vt


TABLE_LAYOUT_VERSION = 3


def shared_table(spark, sf) -> VersionedTable:
    """The versioned orders table built once per change log and shared folder,
    for the read-only queries (time travel, history, diffs); maintenance
    queries build their own copy with :func:`built_table`."""
    log = L.events_change_log(spark, sf)
    name = f"orders-v{TABLE_LAYOUT_VERSION}-{log.rstrip('/').rsplit('/', 1)[-1]}"
    path = published(spark, name, lambda folder: VersionedTable(spark, folder, C.ORDERS).commit_many(
        log_changes(spark, sf), commit_time_col="ts"))
    return VersionedTable(spark, path, C.ORDERS)


def _nth_snapshot(vt: VersionedTable, n: int) -> int:
    """The id of the (n+1)-th snapshot; IndexError if there are fewer."""
    return vt.snapshot_ids()[n]


BATCHES_SQL = f"(SELECT DISTINCT batch_id FROM ({EVENTS_CHANGES_SQL}) b ORDER BY batch_id LIMIT 1 OFFSET {{n}})"


def state_sql(upto_sql: str) -> str:
    return f"""
SELECT order_id, CASE WHEN op <> 'd' THEN customer_id END AS customer_id,
       CASE WHEN op <> 'd' THEN CAST(amount AS DECIMAL(12,2)) END AS amount,
       CASE WHEN op <> 'd' THEN status END AS status, epoch_ms(ts_ms) AS ts
FROM ({EVENTS_CHANGES_SQL}) e WHERE batch_id <= {upto_sql}
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY batch_id DESC, ts_ms DESC, "partition" DESC, "offset" DESC) = 1
    AND op <> 'd'
"""


@register("time_travel_snapshot", sql=state_sql(BATCHES_SQL.format(n=5)))
def time_travel_snapshot(spark, sf):
    """State of the versioned orders table as of its 6th snapshot."""
    vt = shared_table(spark, sf)
    return vt.state(as_of=_nth_snapshot(vt, 5))


AS_OF_TS = "2024-01-15 00:00:00"


@register("time_travel_timestamp", sql=f"""
SELECT * FROM ({state_sql(f"(SELECT max(batch_id) FROM (SELECT batch_id, max(epoch_ms(ts_ms)) AS c FROM ({EVENTS_CHANGES_SQL}) e GROUP BY 1) h WHERE c <= TIMESTAMP '{AS_OF_TS}')")}) s
WHERE status = 'purchase'
""")
def time_travel_timestamp(spark, sf):
    """Orders as of a point in time (latest commit at or before it), filtered on status."""
    vt = shared_table(spark, sf)
    return vt.state(ts=AS_OF_TS).filter(F.col("status") == "purchase")


@register("table_history", sql=f"""
SELECT batch_id AS snapshot_id, max(epoch_ms(ts_ms)) AS committed_at, 'append' AS operation,
       CAST(NULL AS BIGINT) AS base_snapshot, CAST(count(DISTINCT order_id) AS BIGINT) AS added_changes
FROM ({EVENTS_CHANGES_SQL}) e GROUP BY batch_id ORDER BY snapshot_id DESC
""")
def table_history(spark, sf):
    """Commit history of the versioned table, newest first (one commit per log batch;
    ``added_changes`` = keys changed in the commit)."""
    return shared_table(spark, sf).history()


FULL_STATE_SQL = state_sql(f"(SELECT max(batch_id) FROM ({EVENTS_CHANGES_SQL}) z)")


@register("compact", sql=FULL_STATE_SQL)
def compact(spark, sf):
    """Fold the whole log into one snapshot; the read-back equals the state before."""
    vt = built_table(spark, sf)
    vt.compact()
    return vt.state()


@register("expire_snapshots", sql=FULL_STATE_SQL)
def expire_snapshots(spark, sf):
    """Expire everything before the 6th snapshot; the latest state is unchanged."""
    vt = built_table(spark, sf)
    vt.expire(_nth_snapshot(vt, 5))
    return vt.state()


@register("rollback", sql=state_sql(BATCHES_SQL.format(n=3)))
def rollback(spark, sf):
    """Roll back to the 4th snapshot: the new latest state equals that snapshot."""
    vt = built_table(spark, sf)
    vt.rollback(_nth_snapshot(vt, 3))
    return vt.state()


RETAIN_DAYS = 12


@register("retention", sql=f"""
SELECT CAST(event_time AS DATE) AS day, CAST(count(*) AS BIGINT) AS changes FROM ({EVENTS_CHANGES_SQL}) e
WHERE CAST(event_time AS DATE) > (SELECT max(CAST(event_time AS DATE)) FROM ({EVENTS_CHANGES_SQL}) m) - {RETAIN_DAYS}
GROUP BY 1
""")
def retention(spark, sf):
    """A change log laid out by day, cut to the last RETAIN_DAYS days: old day folders go, the kept ones are not touched."""
    log = spark.read.schema(L.LOG_SCHEMA).parquet(L.events_change_log(spark, sf))
    path = scratch_path(spark, "log_by_day")
    log.withColumn("day", F.to_date("timestamp")).repartition("day", F.col("offset") % 4).write.partitionBy("day").parquet(path)
    drop_old_days(spark, path, "day", RETAIN_DAYS)
    return spark.read.parquet(path).groupBy("day").agg(F.count(F.lit(1)).alias("changes"))


@register("create_or_replace", sql=f"""
SELECT strftime(order_timestamp, '%Y-%m') AS sales_month, category, CAST(SUM(revenue) AS DECIMAL(38,4)) AS revenue
FROM ({FACT_SQL}) f GROUP BY 1, 2
""")
def create_or_replace(spark, sf):
    """Write the monthly mart twice with create-or-replace and read it back from the catalog."""
    from rivulet.operators.gold import sales_by_month
    name = K.unique_table_name(spark, "gold", "sales_by_month")
    mart = sales_by_month(fact(spark, sf))
    K.write_table(mart, name)
    K.write_table(mart, name)  # a rerun replaces, never appends
    return CAT.scan_table(spark, name)


@register("scan_catalog_table", sql="SELECT * FROM part")
def scan_catalog_table(spark, sf):
    name = K.unique_table_name(spark, "silver", "part")
    K.write_table(T.table(spark, sf, "part"), name)
    return spark.table(name)


@register("scan_name_or_path", sql="SELECT * FROM supplier")
def scan_name_or_path(spark, sf):
    """A name that is not in the catalog falls back to the path."""
    return CAT.load_table(spark, "lh.erp.not_registered", f"{sf.rstrip('/')}/supplier.parquet")


SEED_ROWS = [(7369, "SMITH", "CLERK", "1980-12-17", 800.00), (7499, "ALLEN", "SALESMAN", "1981-02-20", 1600.00),
             (7521, "WARD", "SALESMAN", "1981-02-22", 1250.00)]


@register("ensure_seeded", sql="""
SELECT s_suppkey AS empno, s_name AS ename, 'SUPPLIER' AS job, s_acctbal AS sal FROM supplier
""")
def ensure_seeded(spark, sf):
    """Create the table from seed rows only when it is missing; an existing table is kept as is."""
    name = K.unique_table_name(spark, "demo", "emp")
    sup = T.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("empno"), F.col("s_name").alias("ename"),
                                                F.lit("SUPPLIER").alias("job"), F.col("s_acctbal").alias("sal"))
    K.write_table(sup, name)  # the table exists already
    seed = spark.createDataFrame([(r[0], r[1], r[2], r[4]) for r in SEED_ROWS],
                                 "empno long, ename string, job string, sal double")
    K.ensure_seeded(spark, name, seed)  # no-op: it exists
    return spark.table(name)


@register("export_json", sql="""
SELECT event_type, CAST(count(*) AS BIGINT) AS events FROM events GROUP BY 1
""")
def export_json(spark, sf):
    """Aggregate first, then export the few result rows as one JSON file and read it back."""
    from rivulet.sinks.files import export_json as ej
    agg = T.table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))
    path = ej(agg, scratch_path(spark, "export_json"))
    return spark.read.schema("event_type string, events long").json(path)


LINEITEM_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity",
                  "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


@register("export_sample", sql=f"""
SELECT * FROM lineitem ORDER BY {", ".join(LINEITEM_ORDER)} LIMIT 100
""")
def export_sample(spark, sf):
    """Deterministic 100-row sample (ordered by key) exported to one Parquet file."""
    from rivulet.sinks.files import export_sample as es
    # every column in the order: the 100 rows do not depend on partitioning
    path = es(T.table(spark, sf, "lineitem"), 100, scratch_path(spark, "export_sample"), LINEITEM_ORDER)
    return spark.read.parquet(path)


@register("schema_evolution", sql="""
SELECT p_partkey, p_name, p_type, CAST(NULL AS VARCHAR) AS p_comment FROM part WHERE p_partkey % 2 = 0
UNION ALL
SELECT p_partkey, p_name, p_type, 'added:' || p_brand FROM part WHERE p_partkey % 2 = 1
""")
def schema_evolution(spark, sf):
    """Add a column to an existing table without rewriting it, then append rows that carry it."""
    name = K.unique_table_name(spark, "silver", "parts_evolving")
    p = T.table(spark, sf, "part")
    K.write_table(p.filter(F.col("p_partkey") % 2 == 0).select("p_partkey", "p_name", "p_type"), name)
    K.add_column(spark, name, "p_comment", "string")
    newer = p.filter(F.col("p_partkey") % 2 == 1).select("p_partkey", "p_name", "p_type",
                                                         F.concat(F.lit("added:"), "p_brand").alias("p_comment"))
    newer.write.mode("append").insertInto(name)
    return spark.table(name)


@register("partition_days", sql="""
SELECT CAST(o_orderdate AS DATE) AS order_day, strftime(o_orderdate, '%Y-%m') AS order_month,
       CAST(count(*) AS BIGINT) AS orders
FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY 1, 2
""")
def partition_days(spark, sf):
    """Orders laid out by month with a derived day column; the read filters on
    the month partition (pruning) and on the day inside the kept months."""
    path = scratch_path(spark, "orders_by_month")
    o = T.table(spark, sf, "orders").withColumn("order_day", F.to_date("o_orderdate")) \
        .withColumn("order_month", F.date_format("o_orderdate", "yyyy-MM"))
    K.write_partitioned(o, path, ["order_month"], spread=2)
    back = (spark.read.parquet(path).filter(F.col("order_month") >= F.lit("1998-01"))
            .filter(F.col("order_day") >= F.lit("1998-01-01").cast("date")))
    return back.groupBy("order_day", "order_month").agg(F.count(F.lit(1)).alias("orders"))


@register("file_profile", sql=f"""
SELECT batch_id, true AS has_files, true AS all_sized FROM ({EVENTS_CHANGES_SQL}) e GROUP BY batch_id
""")
def file_profile(spark, sf):
    """Per batch folder of the change log, from the file listing alone: whether
    it has files and none is empty (:func:`file_sizes` gives count and mean size)."""
    return file_sizes(spark, L.events_change_log(spark, sf)).select(
        "batch_id", (F.col("files") > 0).alias("has_files"), (F.col("smallest_bytes") > 0).alias("all_sized"))


def file_sizes(spark, path: str):
    """Files, mean and smallest size per batch folder, from Spark's listing; no row is read."""
    return CO.size_profile(CO.list_files(spark, path)).select(
        F.regexp_extract("folder", "batch_id=(-?[0-9]+)", 1).cast("long").alias("batch_id"), "files", "mean_bytes", "smallest_bytes")


#: Files of the day folders that one query compacts, and the sizes in bytes that make it pack them.
SMALL_WRITERS, PACK_TARGET, PACK_SMALL = 24, 200_000, 100_000


@register("compact_files", sql=f"""
SELECT CAST(event_time AS DATE) AS day, CAST(count(*) AS BIGINT) AS changes, CAST(sum(user_id) AS BIGINT) AS user_sum,
       true AS fewer_files, true AS in_bounds
FROM (SELECT order_id AS user_id, event_time FROM ({EVENTS_CHANGES_SQL}) e) x GROUP BY 1
""")
def compact_files(spark, sf):
    """A folder of many small files per day packed by bytes: same rows, fewer files, none larger than a bin may be."""
    path = scratch_path(spark, "many_files")
    ev = T.table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    ev.repartition(SMALL_WRITERS, "event_id").write.partitionBy("day").parquet(path)
    day = F.to_date(F.regexp_extract("folder", "day=([0-9-]+)", 1)).alias("day")
    profile = lambda: CO.size_profile(CO.list_files(spark, path)).select(day, "files", "largest_bytes")
    kept = scratch_path(spark, "profile_before")
    profile().write.parquet(kept)
    CO.compact_files(spark, path, ["day"], PACK_TARGET, PACK_SMALL)
    before = spark.read.parquet(kept).select("day", F.col("files").alias("before"))
    rows = spark.read.parquet(path).groupBy("day").agg(F.count(F.lit(1)).alias("changes"), F.sum("user_id").alias("user_sum"))
    return rows.join(before, "day").join(profile(), "day").select(
        "day", "changes", "user_sum", (F.col("files") < F.col("before")).alias("fewer_files"),
        (F.col("largest_bytes") <= PACK_TARGET + PACK_SMALL).alias("in_bounds"))


@register("snapshot_diff", sql=f"""
WITH a AS ({state_sql(BATCHES_SQL.format(n=3))}), b AS ({state_sql(BATCHES_SQL.format(n=5))})
SELECT 'removed' AS change, * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) x
UNION ALL
SELECT 'added', * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) y
""")
def snapshot_diff(spark, sf):
    """Rows removed and added between the 4th and 6th snapshots (exceptAll both ways)."""
    vt = shared_table(spark, sf)
    a, b = vt.state(as_of=_nth_snapshot(vt, 3)), vt.state(as_of=_nth_snapshot(vt, 5))
    return (a.exceptAll(b).select(F.lit("removed").alias("change"), "*")
            .unionByName(b.exceptAll(a).select(F.lit("added").alias("change"), "*")))
