"""Gold layer queries (star schema over the driver tables)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.operators import gold as G
from rivulet.plans.registry import register
from rivulet.plans.sqlparts import CUSTOMERS_SQL, FACT_SQL
from rivulet.sources import tables as T


def fact(spark, sf):
    orders = T.orders(spark, sf).drop("amount")
    return G.fact_sales(T.order_items(spark, sf), orders, T.products(spark, sf))


@register("gold_fact_sales", sql=FACT_SQL)
def gold_fact_sales(spark, sf):
    return fact(spark, sf)


@register("gold_sales_by_month", sql=f"""
SELECT strftime(order_timestamp, '%Y-%m') AS sales_month, category,
       CAST(SUM(revenue) AS DECIMAL(38,4)) AS revenue
FROM ({FACT_SQL}) f GROUP BY 1, 2
""")
def gold_sales_by_month(spark, sf):
    return G.sales_by_month(fact(spark, sf))


@register("gold_customer_ltv", sql=f"""
SELECT customer_id, CAST(SUM(revenue) AS DECIMAL(38,4)) AS lifetime_value
FROM ({FACT_SQL}) f GROUP BY customer_id
""")
def gold_customer_ltv(spark, sf):
    return G.customer_lifetime_value(fact(spark, sf))


@register("gold_customer_ltv_country", sql=f"""
SELECT c.customer_id, c.country, CAST(COALESCE(x.total_orders, 0) AS BIGINT) AS total_orders,
       CAST(COALESCE(x.lifetime_value, 0) AS DECIMAL(38,4)) AS lifetime_value
FROM ({CUSTOMERS_SQL}) c LEFT JOIN (
    SELECT customer_id, COUNT(DISTINCT order_id) AS total_orders, SUM(revenue) AS lifetime_value
    FROM ({FACT_SQL}) f GROUP BY customer_id) x ON c.customer_id = x.customer_id
""")
def gold_customer_ltv_country(spark, sf):
    return G.customer_mart(fact(spark, sf), T.customers(spark, sf))


@register("gold_top_products", sql=f"""
SELECT product_id, name AS product_name, category,
       CAST(SUM(CAST(quantity AS DECIMAL(12,2))) AS DECIMAL(38,4)) AS total_quantity,
       CAST(SUM(revenue) AS DECIMAL(38,4)) AS total_revenue
FROM ({FACT_SQL}) f GROUP BY product_id, name, category
ORDER BY total_revenue DESC, product_id LIMIT 10
""")
def gold_top_products(spark, sf):
    # Top-k is the feature: TakeOrderedAndProject keeps k rows per task, then merges.
    return (G.top_products(fact(spark, sf))
            .orderBy(F.col("total_revenue").desc(), F.col("product_id")).limit(10))


@register("gold_star", sql=f"""
SELECT c.country, f.category, CAST(year(f.order_timestamp) AS INTEGER) AS sales_year,
       CAST(COUNT(*) AS BIGINT) AS lines, CAST(SUM(f.revenue) AS DECIMAL(38,4)) AS revenue
FROM ({FACT_SQL}) f LEFT JOIN ({CUSTOMERS_SQL}) c ON f.customer_id = c.customer_id
GROUP BY 1, 2, 3
""")
def gold_star(spark, sf):
    cust = T.customers(spark, sf).select("customer_id", "country")
    star = fact(spark, sf).join(cust, "customer_id", "left")
    return (star.groupBy("country", "category", F.year("order_timestamp").cast("int").alias("sales_year"))
                .agg(F.count(F.lit(1)).alias("lines"), F.sum("revenue").cast(G.TOTAL_TYPE).alias("revenue")))


@register("revenue_by_month", sql=f"""
SELECT sales_month, CAST(SUM(revenue) AS DECIMAL(38,4)) AS revenue FROM (
  SELECT strftime(order_timestamp, '%Y-%m') AS sales_month, category, SUM(revenue) AS revenue
  FROM ({FACT_SQL}) f GROUP BY 1, 2) m GROUP BY sales_month
""")
def revenue_by_month(spark, sf):
    mart = G.sales_by_month(fact(spark, sf))
    return mart.groupBy("sales_month").agg(F.sum("revenue").cast(G.TOTAL_TYPE).alias("revenue"))


@register("product_rank_by_month", sql=f"""
SELECT sales_month, product_id, revenue, rank FROM (
  SELECT sales_month, product_id, revenue,
         CAST(row_number() OVER (PARTITION BY sales_month ORDER BY revenue DESC, product_id) AS INTEGER) AS rank
  FROM (SELECT strftime(order_timestamp, '%Y-%m') AS sales_month, product_id,
               CAST(SUM(revenue) AS DECIMAL(38,4)) AS revenue
        FROM ({FACT_SQL}) f GROUP BY 1, 2) m) r
""")
def product_rank_by_month(spark, sf):
    """Every product's rank in every month."""
    return G.product_rank_by_month(fact(spark, sf))


@register("category_trend", sql=f"""
SELECT sales_month, category, revenue, prev_revenue,
       CAST(revenue - prev_revenue AS DECIMAL(38,4)) AS change FROM (
  SELECT sales_month, category, revenue,
         lag(revenue) OVER (PARTITION BY category ORDER BY sales_month) AS prev_revenue
  FROM (SELECT strftime(order_timestamp, '%Y-%m') AS sales_month, category,
               CAST(SUM(revenue) AS DECIMAL(38,4)) AS revenue
        FROM ({FACT_SQL}) f GROUP BY 1, 2) m) t
""")
def category_trend(spark, sf):
    return G.category_trend(G.sales_by_month(fact(spark, sf)))
