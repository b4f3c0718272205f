"""Gold layer on the reference's sample rows (hand-computed results)."""

from decimal import Decimal

from rivulet.operators import gold as G


def sample(spark):
    customers = spark.createDataFrame([("C001", "US"), ("C002", "US")], "customer_id string, country string")
    products = spark.createDataFrame([("P001", "Keyboard", "Accessories", "49.9"), ("P002", "Mouse", "Accessories", "24.9")],
                                     "product_id string, name string, category string, price string")
    orders = spark.createDataFrame([("O001", "C001", "2026-05-20T12:00:00Z", "PAID"),
                                    ("O002", "C002", "2026-05-20T13:00:00Z", "PAID")],
                                   "order_id string, customer_id string, order_timestamp string, status string")
    items = spark.createDataFrame([("O001", "P001", "1", "49.9"), ("O002", "P002", "2", "24.9")],
                                  "order_id string, product_id string, quantity string, unit_price string")
    return customers, products, orders, items


def test_fact_and_marts(spark):
    customers, products, orders, items = sample(spark)
    fact = G.fact_sales(items, orders, products)
    rev = {r["order_id"]: r["revenue"] for r in fact.collect()}
    assert rev == {"O001": Decimal("49.9000"), "O002": Decimal("49.8000")}
    m = G.sales_by_month(fact).collect()
    assert [(r["sales_month"], r["category"], r["revenue"]) for r in m] == [("2026-05", "Accessories", Decimal("99.7000"))]
    ltv = {r["customer_id"]: r["lifetime_value"] for r in G.customer_lifetime_value(fact).collect()}
    assert ltv == {"C001": Decimal("49.9000"), "C002": Decimal("49.8000")}
    mart = {r["customer_id"]: (r["total_orders"], r["lifetime_value"]) for r in G.customer_mart(fact, customers).collect()}
    assert mart == {"C001": (1, Decimal("49.9000")), "C002": (1, Decimal("49.8000"))}


def test_unknown_product_kept(spark):
    customers, products, orders, items = sample(spark)
    items = items.union(spark.createDataFrame([("O001", "P999", "1", "5")], items.schema))
    fact = G.fact_sales(items, orders, products)
    unknown = fact.filter("product_id = 'P999'").collect()
    assert len(unknown) == 1 and unknown[0]["category"] is None
