"""Star-schema gold layer: fact, marts and rankings.

Money is carried as DECIMAL so sums are exact and independent of the order in
which partitions are combined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

REVENUE_TYPE = "decimal(18,4)"
TOTAL_TYPE = "decimal(38,4)"


def money(c, scale: int = 2):
    return c.cast(f"decimal(12,{scale})")


def fact_sales(order_items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """order_items ⋈ orders ⟕ products, plus ``revenue = quantity * unit_price``.

    No strategy is forced: AQE broadcasts a side only when its runtime size is
    under the threshold and keeps the shuffle join otherwise.
    """
    return (order_items.join(orders, "order_id", "inner")
            .join(products, "product_id", "left")
            .withColumn("revenue", (money(F.col("quantity")) * money(F.col("unit_price"))).cast(REVENUE_TYPE)))


def sales_by_month(fact: DataFrame) -> DataFrame:
    return (fact.groupBy(F.date_format("order_timestamp", "yyyy-MM").alias("sales_month"), "category")
                .agg(F.sum("revenue").cast(TOTAL_TYPE).alias("revenue")))


def customer_lifetime_value(fact: DataFrame) -> DataFrame:
    """Revenue per customer.  The reference's left join to the key-only customer
    projection adds no row on a unique key, so it is left out of the plan."""
    return fact.groupBy("customer_id").agg(F.sum("revenue").cast(TOTAL_TYPE).alias("lifetime_value"))


def customer_mart(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """customer_id, country, total_orders, lifetime_value (customers without orders kept).

    Aggregated per customer before the join, so the join sees one row per
    customer on each side.  count(DISTINCT order_id) is made skew-proof by
    first de-duplicating (customer_id, order_id) with a partial aggregate.
    """
    per_order = (fact.groupBy("customer_id", "order_id")
                     .agg(F.sum("revenue").alias("rev")))
    per_cust = (per_order.groupBy("customer_id")
                .agg(F.count("order_id").alias("total_orders"),
                     F.sum("rev").cast(TOTAL_TYPE).alias("lifetime_value")))
    return (customers.select("customer_id", "country")
            .join(per_cust, "customer_id", "left")
            .select("customer_id", "country",
                    F.coalesce(F.col("total_orders"), F.lit(0)).cast("long").alias("total_orders"),
                    F.coalesce(F.col("lifetime_value"), F.lit(0).cast(TOTAL_TYPE)).alias("lifetime_value")))


def top_products(fact: DataFrame) -> DataFrame:
    """Per product: total quantity and revenue (the ranking is a separate top-k)."""
    return (fact.groupBy("product_id", F.col("name").alias("product_name"), "category")
                .agg(F.sum(money(F.col("quantity"))).cast(TOTAL_TYPE).alias("total_quantity"),
                     F.sum("revenue").cast(TOTAL_TYPE).alias("total_revenue")))


def product_rank_by_month(fact: DataFrame, k: int | None = None) -> DataFrame:
    """Rank products by revenue inside each month (ties broken by product_id).

    The monthly totals are aggregated first, so the window only sorts one row
    per (month, product), never raw sales rows.
    """
    monthly = (fact.groupBy(F.date_format("order_timestamp", "yyyy-MM").alias("sales_month"), "product_id")
                   .agg(F.sum("revenue").cast(TOTAL_TYPE).alias("revenue")))
    w = Window.partitionBy("sales_month").orderBy(F.col("revenue").desc(), F.col("product_id").asc())
    ranked = monthly.withColumn("rank", F.row_number().over(w))
    if k is not None:
        ranked = ranked.filter(F.col("rank") <= k)
    return ranked


def category_trend(sales_month: DataFrame) -> DataFrame:
    """Month-over-month revenue change per category (``lag`` over the monthly mart)."""
    w = Window.partitionBy("category").orderBy("sales_month")
    return (sales_month.withColumn("prev_revenue", F.lag("revenue").over(w))
            .withColumn("change", (F.col("revenue") - F.col("prev_revenue")).cast(TOTAL_TYPE)))
