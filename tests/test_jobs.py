"""The daily medallion run on the reference's sample rows, end to end through files and tables."""

import json
from decimal import Decimal

import pytest

from rivulet.context import DailyRun
from rivulet.jobs import run_medallion
from rivulet.sources.schemas import normalize_schema_text, value_schema


# The sample files.
CUSTOMERS = """[
  {
    "customer_id": "C001",
    "first_name": "Ana",
    "last_name": "Lopez",
    "email": "ana@example.com",
    "phone": "+15550001",
    "country": "US",
    "created_at": "2026-05-20T10:00:00Z"
  },
  {
    "customer_id": "C002",
    "first_name": "Luis",
    "last_name": "Perez",
    "email": "luis@example.com",
    "phone": "+15550002",
    "country": "US",
    "created_at": "2026-05-20T11:00:00Z"
  }
]"""
FILES = {
    "customers": CUSTOMERS,
    "products": "product_id,name,category,price\nP001,Keyboard,Accessories,49.9\nP002,Mouse,Accessories,24.9\n",
    "orders": "order_id,customer_id,order_timestamp,status\nO001,C001,2026-05-20T12:00:00Z,PAID\n"
              "O002,C002,2026-05-20T13:00:00Z,PAID\n",
    "order_items": "order_id,product_id,quantity,unit_price\nO001,P001,1,49.9\nO002,P002,2,24.9\n",
}


def land(spark, base, files):
    for name, text in files.items():
        spark.createDataFrame([(text.rstrip("\n"),)], "value string").coalesce(1).write.mode("append") \
            .text(f"{base}/bronze/{name}/ingestion_date=2026-05-20")


def rows(spark, table, *columns):
    return sorted(map(tuple, spark.table(table).select(*columns).collect()))


def test_medallion_on_the_sample_files(spark, tmp_dir):
    land(spark, tmp_dir, FILES)
    assert run_medallion(spark, tmp_dir, DailyRun.for_day("2026-05-20")) == {"batch_id": "batch_20260520", "gold_tables": 5}
    assert rows(spark, "gold.sales_by_month", "sales_month", "category", "revenue") == [("2026-05", "Accessories", Decimal("99.7000"))]
    assert rows(spark, "gold.customer_lifetime_value", "customer_id", "lifetime_value") == [
        ("C001", Decimal("49.9000")), ("C002", Decimal("49.8000"))]
    assert rows(spark, "silver.customers", "customer_id", "first_name", "last_name", "created_at", "email_masked", "phone_masked") == [
        ("C001", "Ana", "Lopez", "2026-05-20T10:00:00Z", "an***", "+1***"),
        ("C002", "Luis", "Perez", "2026-05-20T11:00:00Z", "lu***", "+1***")]
    assert spark.table("silver.data_quality_errors").count() == 0
    counted = rows(spark, "silver.job_metrics", "job", "read", "written", "rejected", "duplicates", "null_keys", "status")
    assert counted == [(f"silver_{n}", 2, 2, 0, 0, 0, "SUCCESS") for n in ("customers", "order_items", "orders", "products")]
    assert spark.table("silver.job_metrics").where("duration_seconds > 0").count() == 4


def test_bad_and_repeated_rows(spark, tmp_dir):
    land(spark, tmp_dir, FILES)
    land(spark, tmp_dir, {
        "customers": CUSTOMERS.replace("2026-05-20T10", "2026-05-21T10").replace("Ana", "Anna").replace("luis@", "luis"),
        "products": "product_id,name,category,price\nP003,Cable,Accessories,-1\n",
        "orders": "order_id,customer_id,order_timestamp,status\nO001,C001,2026-05-20T15:00:00Z,REFUNDED\n"
                  "O003,C001,2026-05-20T15:00:00Z,RETURNED\n,C001,2026-13-40,PAID\n",
        "order_items": "order_id,product_id,quantity,unit_price\nO001,P001,0,49.9\nO001,P001,1,49.9\n"})
    run_medallion(spark, tmp_dir, DailyRun.for_day("2026-05-20"), gate=False)
    found = spark.table("silver.data_quality_errors")
    assert sorted((r.source_table, r.error_code) for r in found.collect()) == [
        ("customers", "BAD_EMAIL"), ("order_items", "QTY_NOT_POSITIVE"), ("orders", "BAD_DATE"), ("orders", "BAD_STATUS"),
        ("orders", "ORDER_KEY_NULL"), ("products", "PRICE_NEGATIVE")]
    assert found.where("source_file LIKE '%ingestion_date=2026-05-20%'").count() == 6
    assert rows(spark, "silver.orders", "order_id", "status") == [("O001", "REFUNDED"), ("O002", "PAID")]
    assert ("C001", "Anna") in rows(spark, "silver.customers", "customer_id", "first_name")
    assert rows(spark, "silver.job_metrics", "job", "read", "written", "rejected", "duplicates")[2] == ("silver_orders", 5, 2, 2, 1)
    with pytest.raises(RuntimeError, match="orders"):
        run_medallion(spark, tmp_dir, DailyRun.for_day("2026-05-20"))


def test_the_row_that_was_landed_last_stays(spark, tmp_dir):
    """Repeated items, products and orders of a day: of one file the later line, of two files the later file."""
    land(spark, tmp_dir, {**FILES, "order_items": "order_id,product_id,quantity,unit_price\nO001,P001,1,49.9\nO001,P001,5,49.9\n"
                                                  "O002,P002,2,24.9\n",
                          "products": "product_id,name,category,price\nP001,Keyboard,Accessories,49.9\nP002,Mouse,Accessories,24.9\n"
                                      "P002,Mouse,Accessories,19.9\n"})
    land(spark, tmp_dir, {"order_items": "order_id,product_id,quantity,unit_price\nO002,P002,1,24.9\n",
                          "orders": "order_id,customer_id,order_timestamp,status\nO001,C001,2026-05-20T12:00:00Z,CANCELLED\n"})
    run_medallion(spark, tmp_dir, DailyRun.for_day("2026-05-20"), gate=False)
    assert rows(spark, "silver.order_items", "order_id", "quantity") == [("O001", Decimal("5.00")), ("O002", Decimal("1.00"))]
    assert rows(spark, "silver.products", "product_id", "price")[1][1] in ("19.9", Decimal("19.90"))
    assert rows(spark, "silver.orders", "order_id", "status")[0] == ("O001", "CANCELLED")
    assert {(j, n) for j, n in rows(spark, "silver.job_metrics", "job", "duplicates")} >= {
        ("silver_order_items", 2), ("silver_products", 1), ("silver_orders", 1)}
    assert "arrival" not in spark.table("silver.order_items").columns


def test_value_schema_lookup():
    schema = {"type": "struct", "fields": [{"name": "op", "type": "string", "nullable": True, "metadata": {}}]}
    doubly = json.dumps(json.dumps(schema))
    assert json.loads(normalize_schema_text(doubly)) == schema
    reg = {"erp.orders-value": {"1": json.dumps(schema), "2": doubly}}
    assert value_schema(reg, "erp.orders").fieldNames() == ["op"]
