"""Bronze landing and silver-layer queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.functions.hashing import surrogate_key as sk
from rivulet.functions.masks import column_policy_mask, mask_email, mask_phone, pseudonym
from rivulet.functions.time import batch_id_for_date
from rivulet.operators import silver as S
from rivulet.plans import lake
from rivulet.plans.cdc import NORMALIZED_SQL, normalized
from rivulet.plans.lake import (CUSTOMER_SCHEMA, RAW_CUSTOMERS_SQL, RAW_ITEMS_SQL, RAW_ORDERS_SQL,
                                RAW_PRODUCTS_SQL)
from rivulet.plans.registry import register
from rivulet.plans.sqlparts import CUSTOMERS_SQL
from rivulet.sources import files as FS
from rivulet.sources import tables as T

ORDERS_RAW_SCHEMA = "order_id string, customer_id string, order_timestamp string, status string"


def bronze(spark, sf, dataset, fmt="csv", schema=None, day=lake.INGESTION_DATE, **marks):
    base = lake.landed(spark, sf)
    if fmt == "json":
        schema = schema or CUSTOMER_SCHEMA
    return FS.read_bronze(spark, base, dataset, day, fmt, schema, **marks)


@register("scan_json_multiline", sql=RAW_CUSTOMERS_SQL)
def scan_json_multiline(spark, sf):
    return bronze(spark, sf, "customers", "json")


@register("scan_csv_strings", sql=RAW_PRODUCTS_SQL)
def scan_csv_strings(spark, sf):
    return bronze(spark, sf, "products")


@register("scan_bronze_partition", sql=RAW_ORDERS_SQL)
def scan_bronze_partition(spark, sf):
    """One day of orders out of two landed days (pruned to the day folder)."""
    return bronze(spark, sf, "orders")


@register("bronze_roundtrip", sql=RAW_ITEMS_SQL)
def bronze_roundtrip(spark, sf):
    return bronze(spark, sf, "order_items")


@register("bronze_audit", sql=f"""
SELECT 'orders' AS dataset, DATE '{lake.INGESTION_DATE}' AS ingestion_date, '{lake.CTX.batch_id}' AS batch_id,
       'erp' AS source_system, CAST(count(*) AS BIGINT) AS row_count, true AS all_have_file FROM orders
UNION ALL
SELECT 'orders', DATE '{lake.SECOND_DATE}', '{lake.CTX2.batch_id}', 'erp', CAST(count(*) AS BIGINT), true FROM orders
""")
def bronze_audit(spark, sf):
    """Audit columns added at read time: source file, ingestion date, batch id,
    source system (and a load timestamp, left out of the comparison)."""
    base = lake.landed(spark, sf)
    raw = spark.read.option("header", True).csv(f"{base}/bronze/orders")
    df = S.add_audit_columns(raw, batch_id_for_date(F.col("ingestion_date")), "erp")
    return (df.groupBy(F.lit("orders").alias("dataset"), "ingestion_date", "batch_id", "source_system")
              .agg(F.count(F.lit(1)).alias("row_count"),
                   F.bool_and(F.col("source_file").isNotNull()).alias("all_have_file")))


@register("cdc_audit", sql=f"""
SELECT order_id, customer_id, amount, status, ts, op AS cdc_op, CAST("partition" AS VARCHAR) || ':' || CAST("offset" AS VARCHAR) AS cdc_position,
       epoch_ms(ts_ms) AS event_ts, CAST(batch_id AS VARCHAR) AS batch_id, 'erp' AS source_system, true AS stamped
FROM ({NORMALIZED_SQL}) n
""")
def cdc_audit(spark, sf):
    """Captured changes with their audit columns (the load time is only checked to be there)."""
    rows = S.add_cdc_audit_columns(normalized(spark, sf), F.col("batch_id").cast("string"), "erp")
    return rows.withColumn("stamped", F.col("ingestion_ts") <= F.current_timestamp()).drop("ingestion_ts")


@register("silver_customers", sql=f"""
SELECT customer_id, name, email, phone, country, segment,
       substr(email, 1, 2) || '***' AS email_masked, substr(phone, 1, 2) || '***' AS phone_masked
FROM ({RAW_CUSTOMERS_SQL}) c
""")
def silver_customers(spark, sf):
    return S.silver_customers(bronze(spark, sf, "customers", "json"))


@register("silver_customers_policy", sql=f"""
SELECT customer_id, name, country, segment,
       regexp_replace(email, '^(.)[^@]*', '\\1***') AS email_masked,
       substr(phone, 1, 4) || '*****' || right(phone, 3) AS phone_masked
FROM ({RAW_CUSTOMERS_SQL}) c
""")
def silver_customers_policy(spark, sf):
    """Silver customers under the privacy policy: masked forms only, raw PII dropped."""
    c = S.silver_customers(bronze(spark, sf, "customers", "json"))
    return (c.withColumn("email_masked", mask_email(F.col("email")))
             .withColumn("phone_masked", mask_phone(F.col("phone")))
             .drop("email", "phone"))


LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@register("silver_keep_last", sql="""
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST,
  l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_quantity NULLS FIRST, l_extendedprice NULLS FIRST,
  l_discount NULLS FIRST, l_tax NULLS FIRST, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST) = 1
""")
def silver_keep_last(spark, sf):
    """De-duplicate lineitem on (l_orderkey, l_linenumber), keeping the latest shipment."""
    li = T.table(spark, sf, "lineitem")
    return S.keep_last(li, ["l_orderkey", "l_linenumber"], [F.col("l_shipdate").desc_nulls_last()])


@register("silver_normalized", sql=f"""
SELECT TRY_CAST(product_id AS BIGINT) AS product_id, name, upper(trim(category)) AS category,
       TRY_CAST(price AS DECIMAL(10,2)) AS price
FROM ({RAW_PRODUCTS_SQL}) p
""")
def silver_normalized(spark, sf):
    p = bronze(spark, sf, "products")
    return p.select(F.col("product_id").try_cast("long").alias("product_id"), "name",
                    S.norm(F.col("category")).alias("category"),
                    F.col("price").try_cast("decimal(10,2)").alias("price"))


@register("typed_silver_items", sql=f"""
SELECT TRY_CAST(order_id AS BIGINT) AS order_id, TRY_CAST(product_id AS BIGINT) AS product_id,
       TRY_CAST(quantity AS DECIMAL(12,2)) AS quantity, TRY_CAST(unit_price AS DECIMAL(12,2)) AS unit_price,
       CAST(TRY_CAST(quantity AS DECIMAL(12,2)) * TRY_CAST(unit_price AS DECIMAL(12,2)) AS DECIMAL(18,4)) AS line_total
FROM ({RAW_ITEMS_SQL}) i
""")
def typed_silver_items(spark, sf):
    return S.typed_items(bronze(spark, sf, "order_items"))


@register("typed_silver_orders", sql=f"""
SELECT TRY_CAST(order_id AS BIGINT) AS order_id, TRY_CAST(customer_id AS BIGINT) AS customer_id,
       try_strptime(order_timestamp, '%Y-%m-%dT%H:%M:%SZ') AS order_timestamp, upper(trim(status)) AS status,
       CAST(try_strptime(order_timestamp, '%Y-%m-%dT%H:%M:%SZ') AS DATE) AS order_date
FROM ({RAW_ORDERS_SQL}) o
""")
def typed_silver_orders(spark, sf):
    return S.typed_orders(bronze(spark, sf, "orders"))


# Documented column names -> coded names.
RENAME = {"product_name": "name", "order_status": "status", "order_date": "order_timestamp"}


@register("standardize_names", sql="""
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_timestamp, o_orderstatus AS status
FROM orders
""")
def standardize_names(spark, sf):
    """Raw headers in mixed styles -> snake_case, then the documented->coded rename map."""
    o = T.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("Order ID"), F.col("o_custkey").alias("customerId"),
        F.col("o_orderdate").alias("Order_Date"), F.col("o_orderstatus").alias("ORDER STATUS"))
    return S.standardize_names(o, {**RENAME, "order_i_d": "order_id"})


@register("surrogate_key", sql="""
SELECT l_orderkey, l_linenumber, l_shipdate,
       sha256(concat_ws('~', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR))) AS line_sk
FROM lineitem
""")
def surrogate_key(spark, sf):
    li = T.table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_shipdate",
                     sk(F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("line_sk"))


@register("pii_mask", sql=f"""
SELECT customer_id, regexp_replace(email, '^(.)[^@]*', '\\1***') AS email_masked,
       substr(phone, 1, 4) || '*****' || right(phone, 3) AS phone_masked,
       substr(email, 1, 2) || '***' AS email_prefix
FROM ({CUSTOMERS_SQL}) c
""")
def pii_mask(spark, sf):
    c = T.customers(spark, sf)
    from rivulet.functions.masks import mask_prefix
    return c.select("customer_id", mask_email(F.col("email")).alias("email_masked"),
                    mask_phone(F.col("phone")).alias("phone_masked"),
                    mask_prefix(F.col("email")).alias("email_prefix"))


SALT = "rivulet-demo-salt"


@register("pii_token", sql=f"""
SELECT customer_id, sha256('{SALT}' || email) AS email_token, sha256('{SALT}' || phone) AS phone_token
FROM ({CUSTOMERS_SQL}) c
""")
def pii_token(spark, sf):
    c = T.customers(spark, sf)
    return c.select("customer_id", pseudonym(F.col("email"), SALT).alias("email_token"),
                    pseudonym(F.col("phone"), SALT).alias("phone_token"))


# Column policy per role (column -> rule).
COLUMN_POLICY = {
    "analyst": {"name": "clear", "email": "email", "phone": "phone", "country": "clear"},
    "support": {"name": "clear", "email": "clear", "phone": "clear", "country": "clear"},
    "partner": {"name": "token", "email": "drop", "phone": "drop", "country": "clear"},
}


def apply_column_policy(df, role: str, salt: str = SALT):
    rules = COLUMN_POLICY[role]
    return df.select(*[column_policy_mask(F.col(c), rules.get(c, "clear"), salt).alias(c) for c in df.columns])


@register("column_policy", sql=f"""
SELECT customer_id, name, regexp_replace(email, '^(.)[^@]*', '\\1***') AS email,
       substr(phone, 1, 4) || '*****' || right(phone, 3) AS phone, country
FROM ({CUSTOMERS_SQL}) c
""")
def column_policy(spark, sf):
    """Customers as the ``analyst`` role sees them."""
    c = T.customers(spark, sf).select("customer_id", "name", "email", "phone", "country")
    return apply_column_policy(c, "analyst")


# Row policy per role (allowed regions).
ROW_POLICY = {"emea": ["EUROPE", "MIDDLE EAST", "AFRICA"], "americas": ["AMERICA"], "apac": ["ASIA"]}


@register("row_policy", sql="""
SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id, r.r_name AS region, o.o_totalprice AS amount
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey WHERE r.r_name IN ('EUROPE', 'MIDDLE EAST', 'AFRICA')
""")
def row_policy(spark, sf, role: str = "emea"):
    """Orders visible to a role: the role's regions, applied as a filter on the
    customer's region (nation and region are fixed 25- and 5-row tables)."""
    n = T.table(spark, sf, "nation")
    r = T.table(spark, sf, "region")
    geo = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select("n_nationkey", F.col("r_name").alias("region"))
    geo = geo.filter(F.col("region").isin(ROW_POLICY[role]))
    c = T.table(spark, sf, "customer").join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey")) \
        .select(F.col("c_custkey").alias("customer_id"), "region")
    o = T.table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"),
                                            F.col("o_custkey").alias("customer_id"),
                                            F.col("o_totalprice").alias("amount"))
    return o.join(c, "customer_id").select("order_id", "customer_id", "region", "amount")


@register("batch_id_column", sql="""
SELECT o_orderkey AS order_id, 'batch_' || strftime(o_orderdate, '%Y%m%d') AS batch_id FROM orders
""")
def batch_id_column(spark, sf):
    o = T.table(spark, sf, "orders")
    return o.select(F.col("o_orderkey").alias("order_id"), batch_id_for_date(F.col("o_orderdate")).alias("batch_id"))
