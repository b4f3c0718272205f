"""Distributed exact percentiles equal percentile_disc."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rivulet.operators.profile import exact_percentiles, numeric_profile

PS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.95, 1.0]


def builtin(df, col):
    r = df.select(*[F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY {col})").alias(f"p{i}")
                    for i, p in enumerate(PS)]).first()
    return [r[f"p{i}"] for i in range(len(PS))]


def values(df, col, ps=PS):
    found = {r.p: r.value for r in exact_percentiles(df, col, ps).collect()}
    return [found[p] for p in ps]


def test_equals_percentile_disc(spark):
    rnd = random.Random(3)
    vals = [round(rnd.lognormvariate(3, 2), 2) for _ in range(20_000)] + [5.0] * 7000 + [None] * 50
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    assert values(df, "v") == builtin(df, "v")


def test_infinite_and_missing_numbers(spark):
    vals = [float(i) for i in range(20_001)] + [float("inf")] * 3 + [float("-inf")] * 2 + [float("nan")] * 4
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = values(df, "v", [0.0, 0.5, 0.9997, 1.0])
    assert got[0] == float("-inf") and got[1] == 10_002.0 and got[2] == float("inf") and got[3] != got[3]


def test_decimals_beyond_double_precision(spark):
    exact = [Decimal(f"12345678901234567890.{i:010d}") for i in range(1, 102)]
    df = spark.createDataFrame([(v,) for v in exact], "v decimal(38,10)")
    assert values(df, "v", [0.0, 0.5, 1.0]) == [exact[0], exact[50], exact[100]]


def test_groups(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7 % 1009).alias("v"))
    got = {(r.g, r.p): r.value for r in exact_percentiles(df, "v", [0.5, 0.95], ("g",)).collect()}
    want = df.groupBy("g").agg(*[F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY v)").alias(str(p)) for p in (0.5, 0.95)])
    assert got == {(r["g"], p): r[str(p)] for r in want.collect() for p in (0.5, 0.95)}


@pytest.mark.parametrize("rows", [5000, 0])
def test_profile(spark, rows):
    df = spark.range(rows).select((F.col("id") % 977 * 1.5).alias("x"))
    r = numeric_profile(df, "x").first()
    assert (r.n, r.mn, r.mx) == ((rows, 0.0, 976 * 1.5) if rows else (0, None, None))
    assert [r.p25, r.p50, r.p75] == (builtin(df, "x")[2:5] if rows else [None] * 3)
