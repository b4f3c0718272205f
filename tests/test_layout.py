"""Layouts: bucketed tables join without a shuffle; partitioned reads prune; sources and sinks helpers."""

from pyspark.sql import functions as F

from rivulet.sinks.files import preview
from rivulet.sinks.tables import ensure_table, unique_table_name, write_bucketed
from rivulet.sources.catalog import list_namespaces, list_tables, load_table
from rivulet.sources.tables import integer_range, table

SF = "/root/testdata/sf0.001"


def test_bucketed_join_has_no_exchange(spark):
    li = table(spark, SF, "lineitem").select(F.col("l_orderkey").alias("k"), "l_quantity")
    o = table(spark, SF, "orders").select(F.col("o_orderkey").alias("k"), "o_orderstatus")
    a, b = unique_table_name(spark, "gold", "li_b"), unique_table_name(spark, "gold", "o_b")
    write_bucketed(li, a, "k", 8)
    write_bucketed(o, b, "k", 8)
    thresholds = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k) for k in thresholds}
    for k in thresholds:
        spark.conf.set(k, "-1")
    try:
        j = spark.table(a).join(spark.table(b), "k")
        plan = j._jdf.queryExecution().executedPlan().toString() if hasattr(j, "_jdf") else ""
        assert j.count() == li.join(o, "k").count()
        if plan:
            assert "Exchange hashpartitioning" not in plan
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_smoke_range_and_preview(spark):
    df = integer_range(spark, 100_000)
    assert df.count() == 100_000
    schema, rows = preview(df.withColumn("parity", F.col("id") % 2), 5)
    assert schema == "struct<id:bigint,parity:bigint>" and len(rows) == 5


def test_catalog_helpers(spark):
    name = unique_table_name(spark, "erp", "orders_t")
    ensure_table(spark, name, "order_id BIGINT, amount DECIMAL(12,2), ts_day DATE", ["ts_day"])
    assert "erp" in list_namespaces(spark)
    assert name.split(".")[1] in list_tables(spark, "erp")
    assert load_table(spark, name).count() == 0
    try:
        load_table(spark, "nope.nothing", "/nonexistent/path")
        raise AssertionError("expected an error")
    except RuntimeError as e:
        assert "by name or by path" in str(e)


def test_upsert_table(spark):
    from rivulet.sinks.tables import upsert_table, write_table
    name = unique_table_name(spark, "silver", "cust_up")
    write_table(spark.createDataFrame([("1", "a"), ("2", "b")], "customer_id string, v string"), name)
    upsert_table(spark.createDataFrame([("2", "B"), ("3", "c")], "customer_id string, v string"), name, "customer_id")
    assert sorted(tuple(r) for r in spark.table(name).collect()) == [("1", "a"), ("2", "B"), ("3", "c")]


def test_progress_listener(spark):
    from rivulet.session import scratch_path
    from rivulet.streaming.run import ProgressLog, to_parquet_available_now
    src_dir = scratch_path(spark, "src")
    table(spark, SF, "region").write.parquet(src_dir)
    log = ProgressLog(spark, scratch_path(spark, "progress"))
    try:
        to_parquet_available_now(spark.readStream.schema("r_regionkey int, r_name string").parquet(src_dir),
                                 scratch_path(spark, "out"), scratch_path(spark, "ck"))
    finally:
        rows = log.close().collect()
    assert sum(r["num_input_rows"] for r in rows) == 5
