"""Runnable jobs: the daily medallion run and the CDC apply stream."""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rivulet.context import DailyRun
from rivulet.operators import cdc as C
from rivulet.operators import gold as G
from rivulet.operators import quality as Q
from rivulet.operators import rules as R
from rivulet.operators import silver as S
from rivulet.session import scratch_path
from rivulet.sinks.tables import write_table
from rivulet.sources import changelog as L
from rivulet.sources.files import read_bronze
from rivulet.streaming.cdc import start_cdc
from rivulet.table import VersionedTable


#: Columns of the raw datasets, all read as strings.
RAW_COLUMNS = {
    "customers": ("customer_id", "first_name", "last_name", "email", "phone", "country", "created_at"),
    "products": ("product_id", "name", "category", "price"),
    "orders": ("order_id", "customer_id", "order_timestamp", "status"),
    "order_items": ("order_id", "product_id", "quantity", "unit_price"),
}
KEYS = {"customers": ["customer_id"], "products": ["product_id"], "orders": ["order_id"],
        "order_items": ["order_id", "product_id"]}
RULES = {"customers": R.customer_rules, "products": R.product_rules, "orders": R.order_rules, "order_items": R.item_rules}
GATE_THRESHOLD = 0.05


def _to_silver(spark: SparkSession, base: str, name: str, columns: tuple[str, ...], run: DailyRun, id_type: str):
    """(valid rows, error rows, verdict, metrics) of one raw dataset, which is parsed and tagged once."""
    started = time.monotonic()
    fmt = "json" if name == "customers" else "csv"
    raw = read_bronze(spark, base, name, run.ingestion_date, fmt, ", ".join(f"{c} string" for c in columns),
                      source_file="source_file", arrival="arrival")
    if name == "order_items":
        raw = S.typed_items(raw, id_type, keep=("source_file", "arrival"))
    observed, counters = Q.observe_job(Q.tag(raw, RULES[name]()), name, KEYS[name])
    path = scratch_path(spark, f"tagged_{name}")
    observed.write.parquet(path)
    tagged = spark.read.parquet(path)
    payload = [c for c in raw.columns if c not in ("source_file", "arrival")]
    record = F.concat_ws("-", *[F.col(c).cast("string") for c in KEYS[name]])
    valid, errors = Q.split(tagged, name, record, run.batch_id, F.col("source_file"), payload)
    valid = valid.drop("source_file")
    # the last by business time where the rows have one, then the one that was landed last
    if name == "customers":
        rows = S.silver_customers(valid, "arrival")
    elif name == "orders":
        typed = S.typed_orders(valid, id_type=id_type, keep=("arrival",))
        rows = S.keep_last(typed, KEYS[name], [F.col("order_timestamp").desc_nulls_last(), F.col("arrival").desc()])
    else:
        rows = S.keep_last(valid, KEYS[name], [F.col("arrival").desc()])
    write_table(rows.drop("arrival"), f"silver.{name}")
    seen = counters.get
    written = spark.table(f"silver.{name}").count()
    metrics = (f"silver_{name}", run.batch_id, seen["read"], written, seen["rejected"],
               seen["read"] - seen["rejected"] - written, seen["null_keys"], time.monotonic() - started, "SUCCESS")
    return errors, Q.suite(tagged, name, GATE_THRESHOLD), metrics


def run_medallion(spark: SparkSession, base: str, run: DailyRun, gate: bool = True, id_type: str = "string",
                  columns: dict[str, tuple[str, ...]] | None = None) -> dict:
    """bronze (landed files of the run's day) -> silver (typed, masked, one row per
    key, bad rows in ``silver.data_quality_errors`` with their source file,
    counters in ``silver.job_metrics``) -> gold (fact, marts).

    ``columns`` replaces the raw columns of a dataset.  Each raw dataset is
    parsed once; the fact is written once and read back for the marts.  With
    ``gate`` the run stops before gold when a dataset's rejected share is too high.
    """
    names = {**RAW_COLUMNS, **(columns or {})}
    errors, verdicts, metrics = zip(*(_to_silver(spark, base, n, c, run, id_type) for n, c in names.items()))
    write_table(reduce(DataFrame.unionByName, errors), "silver.data_quality_errors")
    write_table(spark.createDataFrame(list(metrics), "job string, batch_id string, read long, written long, rejected long, "
                                      "duplicates long, null_keys long, duration_seconds double, status string"),
                "silver.job_metrics")
    if gate:
        Q.gate(reduce(DataFrame.unionByName, verdicts))
    prod = spark.table("silver.products").withColumn("product_id", F.col("product_id").try_cast(id_type))
    fact = G.fact_sales(spark.table("silver.order_items"), spark.table("silver.orders").drop("order_date"), prod)
    write_table(fact, "gold.fact_sales")
    fact = spark.table("gold.fact_sales")
    write_table(G.sales_by_month(fact), "gold.sales_by_month")
    write_table(G.customer_lifetime_value(fact), "gold.customer_lifetime_value")
    write_table(prod, "gold.dim_product")
    write_table(spark.table("silver.customers"), "gold.dim_customer")
    return {"batch_id": run.batch_id, "gold_tables": 5}


def run_cdc(spark: SparkSession, log_path: str, table_path: str, checkpoint: str,
            trigger: dict | None = None, kafka: dict | None = None, compact_every: int = 100) -> StreamingQuery:
    """Start the CDC stream: change log (or Kafka) -> versioned orders table, every 15 s by
    default; the log is folded into a snapshot every ``compact_every`` micro-batches."""
    vt = VersionedTable(spark, table_path, C.ORDERS, event_order=True)
    src = L.read_change_stream(spark, log_path, kafka=kafka)
    return start_cdc(src, vt, C.ORDERS, L.ORDER_ENVELOPE, checkpoint, trigger, name="cdc_orders",
                     compact_every=compact_every)
