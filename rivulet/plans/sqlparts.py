"""SQL fragments shared by the oracle queries (DuckDB dialect).

They restate the role map of ``rivulet.sources.tables`` in SQL.
"""

STATUS_SQL = ("CASE o_orderstatus WHEN 'O' THEN 'CREATED' WHEN 'P' THEN 'PAID' "
              "WHEN 'F' THEN 'SHIPPED' ELSE o_orderstatus END")

FACT_SQL = f"""
SELECT l.l_partkey AS product_id, l.l_orderkey AS order_id, l.l_quantity AS quantity,
       l.l_extendedprice AS unit_price, o.o_custkey AS customer_id, o.o_orderdate AS order_timestamp,
       {STATUS_SQL} AS status, p.p_name AS name, p.p_type AS category, p.p_retailprice AS price,
       CAST(CAST(l.l_quantity AS DECIMAL(12,2)) * CAST(l.l_extendedprice AS DECIMAL(12,2)) AS DECIMAL(18,4)) AS revenue
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN part p ON l.l_partkey = p.p_partkey
"""

CUSTOMERS_SQL = """
SELECT c.c_custkey AS customer_id, c.c_name AS name,
       lower(replace(c.c_name, '#', '.')) || '@example.com' AS email,
       '+1555' || lpad(CAST(c.c_custkey AS VARCHAR), 7, '0') AS phone,
       n.n_name AS country, c.c_mktsegment AS segment
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
"""

PROFILE_ORDERS_SQL = f"""
SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_totalprice AS DECIMAL(12,2)) AS amount,
       {STATUS_SQL} AS status, CASE WHEN o_orderkey % 3 = 0 THEN 'EUR' ELSE 'USD' END AS currency,
       o_orderdate AS order_ts
FROM orders
"""
