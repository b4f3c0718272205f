"""Exploration and profiling queries (notebook-style analysis of a table)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.functions.text import first_words, preview_chars, word_count
from rivulet.operators import profile as P
from rivulet.plans.gold import fact
from rivulet.plans.registry import register
from rivulet.plans.sqlparts import CUSTOMERS_SQL, FACT_SQL, PROFILE_ORDERS_SQL
from rivulet.sources import tables as T

COUNTED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@register("row_counts", sql=" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM {t}" for t in COUNTED))
def row_counts(spark, sf):
    parts = [T.table(spark, sf, t).agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(t).alias("table_name"), "row_count") for t in COUNTED]
    return reduce(DataFrame.unionByName, parts)


@register("profile_counts", sql=f"""
SELECT 'status' AS dimension, status AS value, CAST(count(*) AS BIGINT) AS count FROM ({PROFILE_ORDERS_SQL}) o GROUP BY status
UNION ALL
SELECT 'currency', currency, CAST(count(*) AS BIGINT) FROM ({PROFILE_ORDERS_SQL}) o GROUP BY currency
""")
def profile_counts(spark, sf):
    return P.profile_counts(T.orders_for_profiling(spark, sf))


@register("numeric_profile", sql="""
SELECT CAST(count(value) AS BIGINT) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS sd,
       min(value) AS mn, quantile_disc(value, 0.25) AS p25, quantile_disc(value, 0.5) AS p50,
       quantile_disc(value, 0.75) AS p75, max(value) AS mx
FROM events
""")
def numeric_profile(spark, sf):
    """Profile of events.value with exact percentiles."""
    return P.numeric_profile(T.table(spark, sf, "events"), "value")


@register("null_profile", sql=f"""
SELECT CAST(count(*) FILTER (WHERE order_id IS NULL) AS BIGINT) AS order_id,
       CAST(count(*) FILTER (WHERE customer_id IS NULL) AS BIGINT) AS customer_id,
       CAST(count(*) FILTER (WHERE product_id IS NULL) AS BIGINT) AS product_id,
       CAST(count(*) FILTER (WHERE name IS NULL) AS BIGINT) AS name,
       CAST(count(*) FILTER (WHERE category IS NULL) AS BIGINT) AS category,
       CAST(count(*) FILTER (WHERE revenue IS NULL) AS BIGINT) AS revenue,
       CAST(count(*) FILTER (WHERE status IS NULL) AS BIGINT) AS status
FROM ({FACT_SQL}) f
""")
def null_profile(spark, sf):
    return P.null_profile(fact(spark, sf).select("order_id", "customer_id", "product_id", "name", "category",
                                                 "revenue", "status"))


@register("top_customers", sql=f"""
SELECT customer_id, CAST(count(*) AS BIGINT) AS orders, CAST(sum(amount) AS DECIMAL(22,2)) AS total_amount
FROM ({PROFILE_ORDERS_SQL}) o GROUP BY customer_id ORDER BY total_amount DESC, customer_id LIMIT 10
""")
def top_customers(spark, sf):
    return P.top_by(T.orders_for_profiling(spark, sf), "customer_id", "amount", 10)


@register("daily_activity", sql=f"""
SELECT CAST(order_ts AS DATE) AS order_date, CAST(count(*) AS BIGINT) AS orders,
       CAST(sum(amount) AS DECIMAL(22,2)) AS amount_sum
FROM ({PROFILE_ORDERS_SQL}) o GROUP BY 1
""")
def daily_activity(spark, sf):
    return P.daily_activity(T.orders_for_profiling(spark, sf), "order_ts", "amount")


@register("range_parity", sql="""
SELECT CAST(l_orderkey % 2 AS BIGINT) AS parity, CAST(count(*) AS BIGINT) AS count FROM lineitem GROUP BY 1
""")
def range_parity(spark, sf):
    """Count per parity, ordered by parity, over the lineitem order keys."""
    ids = T.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"))
    return ids.groupBy((F.col("id") % 2).alias("parity")).agg(F.count(F.lit(1)).alias("count")).orderBy("parity")


# The documented order-status catalogue (six states).
STATUS_CATALOGUE = [("CREATED", "order placed"), ("PAID", "payment received"), ("SHIPPED", "handed to carrier"),
                    ("DELIVERED", "received by customer"), ("CANCELLED", "cancelled"), ("REFUNDED", "money returned")]


@register("inline_rows", sql=f"""
WITH cat(status, description) AS (VALUES ('CREATED', 'order placed'), ('PAID', 'payment received'),
  ('SHIPPED', 'handed to carrier'), ('DELIVERED', 'received by customer'), ('CANCELLED', 'cancelled'),
  ('REFUNDED', 'money returned'))
SELECT cat.status, cat.description, CAST(count(o.order_id) AS BIGINT) AS orders
FROM cat LEFT JOIN ({PROFILE_ORDERS_SQL}) o ON o.status = cat.status GROUP BY cat.status, cat.description
""")
def inline_rows(spark, sf):
    """Inline rows with a typed schema (the status catalogue) used as a lookup over orders."""
    cat = spark.createDataFrame(STATUS_CATALOGUE, "status string, description string")
    counts = T.orders_for_profiling(spark, sf).groupBy("status").agg(F.count(F.lit(1)).alias("orders"))
    return (cat.join(counts, "status", "left")
               .select("status", "description", F.coalesce("orders", F.lit(0)).cast("long").alias("orders")))


@register("text_preview", sql=r"""
SELECT doc_id, substr(text, 1, 120) AS preview,
       regexp_replace(regexp_extract(text, '^\s*((?:\S+\s+){0,19}\S+)', 1), '\s+', ' ', 'g') AS first_words,
       CAST(length(text) AS INTEGER) AS n_chars,
       CAST(len(regexp_extract_all(text, '\S+')) AS INTEGER) AS n_words
FROM documents
""")
def text_preview(spark, sf):
    """Summary of every document: first 120 characters, first 20 words, length and word count of the whole text."""
    d = T.table(spark, sf, "documents")
    return d.select("doc_id", preview_chars(F.col("text"), 120).alias("preview"),
                    first_words(F.col("text"), 20).alias("first_words"),
                    F.length("text").alias("n_chars"), word_count(F.col("text")).alias("n_words"))


@register("validation_counts", sql=f"""
SELECT 'rows_customers' AS check_name, CAST(count(*) AS BIGINT) AS row_count, CAST(1 AS BIGINT) AS expected_min,
       count(*) >= 1 AS passed FROM ({CUSTOMERS_SQL}) c
UNION ALL
SELECT 'rows_fact_sales', CAST(count(*) AS BIGINT), CAST(1 AS BIGINT), count(*) >= 1 FROM ({FACT_SQL}) f
""")
def validation_counts(spark, sf):
    """The two post-load validation counts, evaluated against an expected minimum."""
    c = T.customers(spark, sf).agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit("rows_customers").alias("check_name"), "row_count")
    f = fact(spark, sf).agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit("rows_fact_sales").alias("check_name"), "row_count")
    return (c.unionByName(f).withColumn("expected_min", F.lit(1).cast("long"))
             .withColumn("passed", F.col("row_count") >= F.col("expected_min")))
