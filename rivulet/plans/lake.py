"""Bronze landing of the driver tables (shared by the silver and quality queries).

The driver data is clean, so the landing injects the documented faults into
the raw files: bad dates (o_orderkey % 83 = 0), unknown status (% 79),
a valid (% 73, REFUNDED) and an invalid one (% 71, RETURNED), NULL customer key (% 101), negative quantity (l_partkey % 97), negative price
(l_partkey % 89), e-mail without '@' (c_custkey % 13).  Every row is landed;
the faults only change values.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.context import DailyRun
from rivulet.session import content_token, published
from rivulet.sinks.files import land_raw
from rivulet.sources import tables as T

LAYOUT_VERSION = "2"
INGESTION_DATE = "2026-05-20"
SECOND_DATE = "2026-05-21"
CTX = DailyRun.for_day(INGESTION_DATE)
CTX2 = DailyRun.for_day(SECOND_DATE)
BAD_DATE = "2026-13-40"
ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"

CUSTOMER_SCHEMA = "customer_id string, name string, email string, phone string, country string, segment string"


def raw_customers(spark, sf):
    c = T.customers(spark, sf)
    email = F.when(F.col("customer_id") % 13 == 0, F.replace(F.col("email"), F.lit("@"), F.lit(""))) \
             .otherwise(F.col("email"))
    return c.select(F.col("customer_id").cast("string").alias("customer_id"), "name", email.alias("email"),
                    "phone", "country", "segment")


def raw_products(spark, sf):
    p = T.products(spark, sf)
    return p.select(*[F.col(c).cast("string").alias(c) for c in p.columns])


def raw_orders(spark, sf):
    o = T.orders(spark, sf)
    k = F.col("order_id")
    return o.select(k.cast("string").alias("order_id"),
                    F.when(k % 101 == 0, F.lit(None)).otherwise(F.col("customer_id")).cast("string").alias("customer_id"),
                    F.when(k % 83 == 0, F.lit(BAD_DATE)).otherwise(F.date_format("order_timestamp", ISO))
                     .alias("order_timestamp"),
                    F.when(k % 79 == 0, F.lit("UNKNOWN")).when(k % 73 == 0, F.lit("REFUNDED"))
                     .when(k % 71 == 0, F.lit("RETURNED")).otherwise(F.col("status")).alias("status"))


def raw_items(spark, sf):
    i = T.order_items(spark, sf)
    pk = F.col("product_id")
    return i.select(F.col("order_id").cast("string").alias("order_id"), pk.cast("string").alias("product_id"),
                    F.when(pk % 97 == 0, -F.col("quantity")).otherwise(F.col("quantity")).cast("string").alias("quantity"),
                    F.when(pk % 89 == 0, -F.col("unit_price")).otherwise(F.col("unit_price")).cast("string")
                     .alias("unit_price"))


def landed(spark, sf) -> str:
    """The lake root with the four datasets, landed once for the input files as they are now."""
    def land(base):
        land_raw(raw_customers(spark, sf), base, "customers", CTX, fmt="json")
        land_raw(raw_products(spark, sf), base, "products", CTX)
        land_raw(raw_orders(spark, sf), base, "orders", CTX)
        land_raw(raw_orders(spark, sf), base, "orders", CTX2)  # re-delivery on the next day
        land_raw(raw_items(spark, sf), base, "order_items", CTX)

    tables = ("customer", "nation", "orders", "lineitem", "part")
    token = "-".join(content_token(spark, LAYOUT_VERSION, path=f"{sf.rstrip('/')}/{t}.parquet")[:6] for t in tables)
    return published(spark, f"lake-{token}", land)


# ---------------------------------------------------------------- SQL twins of the raw files

RAW_CUSTOMERS_SQL = """
SELECT CAST(c.c_custkey AS VARCHAR) AS customer_id, c.c_name AS name,
       CASE WHEN c.c_custkey % 13 = 0 THEN replace(lower(replace(c.c_name, '#', '.')) || '@example.com', '@', '')
            ELSE lower(replace(c.c_name, '#', '.')) || '@example.com' END AS email,
       '+1555' || lpad(CAST(c.c_custkey AS VARCHAR), 7, '0') AS phone, n.n_name AS country, c.c_mktsegment AS segment
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
"""

RAW_PRODUCTS_SQL = """
SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name, p_type AS category,
       CAST(p_retailprice AS VARCHAR) AS price FROM part
"""

RAW_ORDERS_SQL = """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
       CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
       CASE WHEN o_orderkey % 83 = 0 THEN '2026-13-40' ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END
         AS order_timestamp,
       CASE WHEN o_orderkey % 79 = 0 THEN 'UNKNOWN' WHEN o_orderkey % 73 = 0 THEN 'REFUNDED'
            WHEN o_orderkey % 71 = 0 THEN 'RETURNED' ELSE CASE o_orderstatus WHEN 'O' THEN 'CREATED'
            WHEN 'P' THEN 'PAID' WHEN 'F' THEN 'SHIPPED' ELSE o_orderstatus END END AS status
FROM orders
"""

RAW_ITEMS_SQL = """
SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS product_id,
       CAST(CASE WHEN l_partkey % 97 = 0 THEN -l_quantity ELSE l_quantity END AS VARCHAR) AS quantity,
       CAST(CASE WHEN l_partkey % 89 = 0 THEN -l_extendedprice ELSE l_extendedprice END AS VARCHAR) AS unit_price
FROM lineitem
"""
