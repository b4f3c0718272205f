"""Salted joins and upserts."""

import pytest
from pyspark.sql import functions as F

from rivulet.operators.joins import hot_keys, salted_join
from rivulet.sinks.tables import unique_table_name, upsert_table


def frames(spark):
    big = spark.range(1000).select(F.when(F.col("id") < 600, 1).when(F.col("id") < 700, F.lit(None)).otherwise(F.col("id"))
                                   .alias("k"), F.col("id").alias("b"))
    small = spark.createDataFrame([(1, "hot"), (800, "x"), (5000, "unmatched"), (None, "null")], "k long, s string")
    return big, small


@pytest.mark.parametrize("how", ["inner", "left"])
def test_equals_the_plain_join(spark, how):
    big, small = frames(spark)
    assert [r.k for r in hot_keys(big, "k", 0.1).collect()] == [1]
    want = sorted(map(str, big.join(small, "k", how).select("k", "b", "s").collect()))
    assert sorted(map(str, salted_join(big, small, "k", 8, 0.1, how).select("k", "b", "s").collect())) == want


@pytest.mark.parametrize("how", ["right", "outer", "left_anti"])
def test_other_joins_are_refused(spark, how):
    with pytest.raises(ValueError):
        salted_join(*frames(spark), "k", how=how)


def test_upsert_keeps_the_last_row_of_a_repeated_key(spark):
    name = unique_table_name(spark, "silver", "upserted")
    rows = lambda *r: spark.createDataFrame(list(r), "id long, v string, at long")
    upsert_table(rows((1, "a", 1), (2, "b", 1)), name, "id", ["at"])
    upsert_table(rows((2, "old", 2), (2, "new", 3), (3, "c", 1)), name, "id", ["at"])
    assert sorted(map(tuple, spark.table(name).collect())) == [(1, "a", 1), (2, "new", 3), (3, "c", 1)]


def test_json_arrays_and_single_records(spark, tmp_dir):
    from rivulet.sinks.files import store_json_records, write_json_arrays
    df = spark.range(25).select("id", F.when(F.col("id") % 2 == 0, F.lit('quote " and\nline')).alias("text"))
    write_json_arrays(df.repartition(3), f"{tmp_dir}/arrays")
    back = spark.read.option("multiLine", True).schema("id long, text string").json(f"{tmp_dir}/arrays")
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    write_json_arrays(df.where("false"), f"{tmp_dir}/none")
    store_json_records(df, f"{tmp_dir}/records", "id")
    assert spark.read.json(f"{tmp_dir}/records").count() == 25
