"""Compaction by bytes, and reconciliation by key ranges."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from rivulet.operators.joins import reconcile_keys
from rivulet.operators.recon_tree import reconcile_tree
from rivulet.session import file_statuses
from rivulet.sinks import compaction as CO
from rivulet.sinks.retention import drop_old_days


def test_bins_hold_bounded_bytes(spark):
    rng = random.Random(1)
    rows = [(f"d{i % 3}/f{i:03}", f"d{i % 3}", rng.choice([5, 40, 90, 300])) for i in range(90)] + [("one/f", "one", 5), ("big/f", "big", 500)]
    packed = CO.pack_files(spark.createDataFrame(rows, "file string, folder string, bytes long"), 200, 100).collect()
    assert {r.file for r in packed} == {f for f, d, _ in rows if d not in ("one", "big")}
    bins = {}
    for r in packed:
        bins.setdefault((r.folder, r.bin), []).append(r.bytes)
    assert all(len(b) == 1 and b[0] >= 100 for (_, n), b in bins.items() if n < 0)
    assert all(sum(b) < 300 and max(b) < 100 for (_, n), b in bins.items() if n >= 0)
    for d in ("d0", "d1", "d2"):  # all but a folder's last bin are as full as the next file lets them be
        full = [sum(b) for (f, n), b in sorted(bins.items()) if f == d and n >= 0]
        assert all(x > 100 for x in full[:-1])


def test_only_crowded_folders_are_rewritten(spark, tmp_dir):
    df = spark.range(4000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"), (F.col("id") % 2).cast("int").alias("day"))
    df.where("day = 0").repartition(12).write.partitionBy("day").parquet(tmp_dir)
    df.where("day = 1").coalesce(1).write.mode("append").partitionBy("day").parquet(tmp_dir)
    before = {r.file: r.bytes for r in CO.list_files(spark, tmp_dir).collect()}
    assert CO.compact_files(spark, tmp_dir, ["day"], target_bytes=40_000, small_bytes=30_000) > 1
    after = {r.file: r.bytes for r in CO.list_files(spark, tmp_dir).collect()}
    assert {f for f in before if "day=1" in f} == {f for f in after if "day=1" in f}
    assert not {f for f in before if "day=0" in f} & set(after)
    assert 1 < sum("day=0" in f for f in after) < 12
    assert spark.read.parquet(tmp_dir).select(df.columns).exceptAll(df).count() == 0 and spark.read.parquet(tmp_dir).count() == 4000
    assert CO.compact_files(spark, tmp_dir, ["day"], target_bytes=1, small_bytes=1) == 0


def test_tree_finds_what_a_full_join_finds(spark):
    a = spark.range(3000).select("id", (F.col("id") * 7).alias("v"), F.when(F.col("id") % 5 > 0, F.lit("x")).alias("w"))
    b = a.where("id <> 17").withColumn("v", F.when(F.col("id") == 1234, 0).otherwise(F.col("v"))) \
        .withColumn("w", F.when(F.col("id") == 2000, F.lit("x")).otherwise(F.col("w"))) \
        .unionByName(spark.createDataFrame([(5000, 1, None), (None, 2, "n")], "id long, v long, w string"))
    keys, levels = reconcile_tree(spark, a, b, "id", ["v", "w"])
    want = reconcile_keys(a, b, "id", ["v", "w"]).where("status <> 'match'")
    assert sorted(map(tuple, keys.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    report = sorted(map(tuple, levels.collect()))
    assert [r[1] for r in report] == [64, 4096, 1 << 20] and report[0][3] < 6001 and report[2][3] <= 12 and report[2][2] == 5
    keys, levels = reconcile_tree(spark, a, a, "id", ["v", "w"])
    assert keys.count() == 0 and {(r.unequal, r.rows) for r in levels.collect()} == {(0, 0)}


def test_retention_drops_whole_days_only(spark, tmp_dir):
    df = spark.range(300).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 10).cast("int")).alias("day"))
    df.repartition(3).write.partitionBy("day").parquet(tmp_dir)
    before = set(file_statuses(spark, tmp_dir))
    assert [str(d) for d in drop_old_days(spark, tmp_dir, "day", 7)] == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert set(file_statuses(spark, tmp_dir)) < before              # kept files are the same files
    assert spark.read.parquet(tmp_dir).agg(F.min("day")).first()[0].isoformat() == "2024-01-04"
    assert drop_old_days(spark, tmp_dir, "day", 7) == []
    assert drop_old_days(spark, tmp_dir, "day", 2, newest=date(2024, 1, 7)) == [date(2024, 1, 4), date(2024, 1, 5)]


def test_mart_export_and_jdbc_refusal(spark, tmp_dir, monkeypatch):
    from rivulet.sources import jdbc

    df = spark.createDataFrame([("2024-01", "a", 1), ("2024-02", "b", 2)], "month string, k string, n int")
    jdbc.export_mart(df, f"{tmp_dir}/mart", partition_by=["month"])
    jdbc.export_mart(df, f"{tmp_dir}/mart", partition_by=["month"])      # a rerun replaces
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_dir}/mart").select(*df.columns).collect())) == sorted(map(tuple, df.collect()))
    assert spark.read.parquet(f"{tmp_dir}/mart/month=2024-02").count() == 1
    monkeypatch.setattr(jdbc, "table_exists", lambda *a: False)
    with pytest.raises(LookupError, match="no table t"):
        jdbc.write_jdbc(df, "jdbc:none:", "t", {}, create_if_missing=False)
