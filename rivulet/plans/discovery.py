"""Schemas found in the raw lake, and schemas that change along the change log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.functions.frames import add_frame
from rivulet.operators.cdc import row_image_schema
from rivulet.plans import lake
from rivulet.plans.cdc import EVENTS_CHANGES_SQL
from rivulet.plans.registry import register
from rivulet.sources import changelog as L
from rivulet.sources import discovery as D
from rivulet.sources import schemas as SC
from rivulet.sources.tables import table

#: What the datasets are expected to hold: some columns too many, some too few, some of another type.
EXPECTED = {
    "customers": {"customer_id": "bigint", "name": "string", "email": "string", "phone": "string", "country": "string",
                  "segment": "string", "created_at": "timestamp"},
    "products": {"product_id": "bigint", "name": "string", "category": "string", "price": "double"},
    "orders": {"order_id": "bigint", "customer_id": "string", "order_timestamp": "timestamp", "status": "string",
               "extra": "string"},
    "order_items": {"order_id": "bigint", "quantity": "bigint", "unit_price": "double"},
}
_RAW_SQL = {"customers": (lake.RAW_CUSTOMERS_SQL, "customer_id name email phone country segment"),
            "products": (lake.RAW_PRODUCTS_SQL, "product_id name category price"),
            "orders": (lake.RAW_ORDERS_SQL, "order_id customer_id order_timestamp status"),
            "order_items": (lake.RAW_ITEMS_SQL, "order_id product_id quantity unit_price")}


def _sql() -> str:
    values = " UNION ALL ".join(
        f"SELECT '{d}' AS dataset, '{c}' AS col, CAST({c} AS VARCHAR) AS v FROM ({raw}) t" for d, (raw, cols) in _RAW_SQL.items()
        for c in cols.split())
    expected = ", ".join(f"('{d}', '{c}', '{t}')" for d, cols in EXPECTED.items() for c, t in cols.items())
    return f"""
WITH classed AS (
  SELECT DISTINCT dataset, col, CASE
    WHEN dataset = 'customers' AND v IS NOT NULL THEN 'string'   -- JSON strings stay strings
    WHEN v IS NULL OR v = '' THEN NULL
    WHEN regexp_full_match(v, '[+-]?[0-9]{{1,18}}') THEN 'bigint'
    WHEN regexp_full_match(v, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN 'double'
    WHEN lower(v) IN ('true', 'false') THEN 'boolean'
    WHEN regexp_full_match(v, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AND try_cast(v AS DATE) IS NOT NULL THEN 'date'
    WHEN regexp_full_match(v, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}[T ][0-9:]{{8}}(\\.[0-9]+)?(Z|[+-][0-9]{{2}}:?[0-9]{{2}})?')
         AND try_cast(v AS TIMESTAMPTZ) IS NOT NULL THEN 'timestamp'
    ELSE 'string' END AS class
  FROM ({values}) u),
found AS (
  SELECT dataset, col, CASE
    WHEN count(class) = 0 THEN 'void' WHEN count(class) = 1 THEN min(class)
    WHEN bool_and(class IN ('bigint', 'double')) THEN 'double'
    WHEN bool_and(class IN ('date', 'timestamp')) THEN 'timestamp' ELSE 'string' END AS found
  FROM classed GROUP BY ALL),
expected(dataset, col, expected) AS (VALUES {expected})
SELECT dataset, col AS "column", CASE WHEN expected IS NULL THEN 'added' WHEN found IS NULL THEN 'missing'
       ELSE 'type_changed' END AS change, expected, found
FROM found FULL JOIN expected USING (dataset, col)
WHERE expected IS NULL OR found IS NULL OR (found <> expected AND found <> 'void')
"""


@register("schema_drift", sql=_sql())
def schema_drift(spark, sf):
    """Differences between the schemas found in the landed files (JSON and CSV, every value classified) and the expected ones."""
    base = lake.landed(spark, sf)

    def found(dataset: str) -> DataFrame:
        path = f"{base}/bronze/{dataset}"
        rows = D.discover_json(spark, path) if dataset == "customers" else D.discover_csv(spark, path)
        return rows.select(F.lit(dataset).alias("dataset"), "column", "type")

    expected = spark.createDataFrame([(d, c, t) for d, cols in EXPECTED.items() for c, t in cols.items()],
                                     "dataset string, column string, type string")
    return D.drift(reduce(DataFrame.unionByName, map(found, EXPECTED)), expected)


#: Three generations of one record: narrower numbers, then a renamed amount, then a new currency.
WRITERS = {11: row_image_schema({"order_id": "int", "amount": "double", "status": "string"}),
           12: row_image_schema({"order_id": "long", "total": "double", "status": "string"}),
           13: row_image_schema({"order_id": "long", "total": "double", "status": "string", "currency": "string"})}
READER = SC.ReaderSchema(row_image_schema({"order_id": "long", "total": "double", "status": "string", "currency": "string"}),
                         {"currency": "EUR"}, {"total": ("amount",)})
#: The day of the month at which the writer moves to the next generation.
CHANGED_ON = (11, 21)


@register("schema_generations", sql=f"""
SELECT order_id, amount AS total, status, CASE WHEN gen = 13 THEN currency ELSE 'EUR' END AS currency, gen AS schema_id, "offset"
FROM (SELECT *, CAST(CASE WHEN day(event_time) < {CHANGED_ON[0]} THEN 11 WHEN day(event_time) < {CHANGED_ON[1]} THEN 12 ELSE 13 END AS BIGINT) AS gen
      FROM ({EVENTS_CHANGES_SQL}) e) g
""")
def schema_generations(spark, sf):
    """One log written with three schemas in turn, decoded in one pass into the newest reader's fields."""
    ch = L.events_changes(table(spark, sf, "events"))
    day = F.dayofmonth("event_time")
    record = F.when(day < CHANGED_ON[0], F.to_json(F.struct("order_id", "amount", "status"))) \
        .when(day < CHANGED_ON[1], F.to_json(F.struct("order_id", F.col("amount").alias("total"), "status"))) \
        .otherwise(F.to_json(F.struct("order_id", F.col("amount").alias("total"), "status", "currency")))
    framed = F.when(day < CHANGED_ON[0], add_frame(F.encode(record, "UTF-8"), 11)) \
        .when(day < CHANGED_ON[1], add_frame(F.encode(record, "UTF-8"), 12)).otherwise(add_frame(F.encode(record, "UTF-8"), 13))
    log = ch.select("partition", "offset", F.col("event_time").alias("timestamp"), framed.alias("value"))
    return SC.decode_versions(log, WRITERS, READER).drop("partition", "timestamp")
