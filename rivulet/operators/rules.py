"""Rules of the sales datasets (see :mod:`rivulet.operators.quality`)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.operators.quality import Rule
from rivulet.operators.silver import norm

# The documented order states, and the e-mail format.
STATUSES = ("CREATED", "PAID", "SHIPPED", "DELIVERED", "CANCELLED", "REFUNDED")
EMAIL_RE = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"


def item_rules() -> list[Rule]:
    """For typed order items."""
    q, p = F.col("quantity"), F.col("unit_price")
    return [
        Rule("ITEM_KEY_NULL", "error", F.col("order_id").isNull() | F.col("product_id").isNull(),
             "order_id and product_id are required"),
        Rule("QTY_NOT_POSITIVE", "error", q.isNull() | (q <= 0), "quantity must be > 0"),
        Rule("PRICE_NEGATIVE", "error", p.isNull() | (p < 0), "unit_price must be >= 0"),
    ]


def order_rules() -> list[Rule]:
    """For raw orders (all strings)."""
    raw_ts = F.col("order_timestamp")
    return [
        Rule("ORDER_KEY_NULL", "error", F.col("order_id").isNull(), "order_id is required"),
        Rule("CUSTOMER_KEY_NULL", "error", F.col("customer_id").isNull(), "customer_id is required"),
        Rule("BAD_DATE", "error", raw_ts.isNotNull() & F.try_to_timestamp(raw_ts).isNull(),
             "order_timestamp is not a valid timestamp"),
        Rule("BAD_STATUS", "error", ~F.coalesce(norm(F.col("status")).isin(*STATUSES), F.lit(False)),
             "status outside the catalogue"),
    ]


def customer_rules() -> list[Rule]:
    return [
        Rule("CUSTOMER_ID_NULL", "error", F.col("customer_id").isNull(), "customer_id is required"),
        Rule("BAD_EMAIL", "warning", ~F.coalesce(F.col("email").rlike(EMAIL_RE), F.lit(False)),
             "email has no valid format; masked and kept"),
    ]


def product_rules() -> list[Rule]:
    """For raw products (all strings)."""
    price = F.col("price").try_cast("decimal(12,2)")
    return [
        Rule("PRODUCT_KEY_NULL", "error", F.col("product_id").isNull(), "product_id is required"),
        Rule("PRICE_NEGATIVE", "error", price.isNull() | (price < 0), "price must be >= 0"),
    ]
