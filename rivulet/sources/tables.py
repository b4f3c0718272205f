"""Driver tables and the role map that turns them into the pipeline's entities.

The pipelines work on customers / products / orders / order_items and on a
change log; the driver ships TPC-H-like tables.  Every role below is a pure
projection (plus a lookup of the 25-row ``nation`` table) so Catalyst prunes
columns and pushes filters straight into the Parquet scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Order status letters of the driver data and their pipeline names.
STATUS_BY_LETTER = {"O": "CREATED", "P": "PAID", "F": "SHIPPED"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _status(letter):
    expr = None
    for k, v in STATUS_BY_LETTER.items():
        expr = (F.when(letter == k, F.lit(v)) if expr is None else expr.when(letter == k, F.lit(v)))
    return expr.otherwise(letter)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer_id, name, email, phone, country (country via the 25-row nation table)."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey"), F.col("n_name").alias("country"))
    # nation has a fixed size (25 rows by the TPC-H definition): broadcasting it is bounded.
    return (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left")
             .select(F.col("c_custkey").alias("customer_id"),
                     F.col("c_name").alias("name"),
                     F.concat(F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))),
                              F.lit("@example.com")).alias("email"),
                     F.concat(F.lit("+1555"), F.lpad(F.col("c_custkey").cast("string"), 7, "0")).alias("phone"),
                     F.col("country"),
                     F.col("c_mktsegment").alias("segment")))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"),
                    F.col("p_type").alias("category"), F.col("p_retailprice").alias("price"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
                    F.col("o_orderdate").alias("order_timestamp"), _status(F.col("o_orderstatus")).alias("status"),
                    F.col("o_totalprice").alias("amount"))


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
                     F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("unit_price"))


def orders_for_profiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target-table shape the exploration notebook profiles (with currency and order_ts)."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
                    F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
                    _status(F.col("o_orderstatus")).alias("status"),
                    F.when(F.col("o_orderkey") % 3 == 0, F.lit("EUR")).otherwise(F.lit("USD")).alias("currency"),
                    F.col("o_orderdate").alias("order_ts"))


def integer_range(spark: SparkSession, n: int, partitions: int | None = None) -> DataFrame:
    """``id`` from 0 to n-1, generated in parallel (the smoke-test source)."""
    return spark.range(0, n, numPartitions=partitions)
