"""Table exploration: counts, numeric profile, NULL profile, top-k, daily activity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.session import scratch_path


def counts_by(df: DataFrame, col: str) -> DataFrame:
    """Rows per value of ``col``, most frequent first (ties by value)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), F.col(col))


def profile_counts(df: DataFrame, dims=("status", "currency")) -> DataFrame:
    """Counts per value for each of ``dims`` that the table has (column-presence gate)."""
    present = [d for d in dims if d in df.columns]
    if not present:
        return df.sparkSession.createDataFrame([], "dimension string, value string, count long")
    parts = [df.groupBy(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value"))
               .agg(F.count(F.lit(1)).alias("count")) for d in present]
    return reduce(DataFrame.unionByName, parts)


def numeric_profile(df: DataFrame, col: str) -> DataFrame:
    """count, mean, stddev, min, 25/50/75 % and max of one column, one row.

    The percentiles are exact and discrete (see :func:`exact_percentiles`).
    Not ``summary()``: its percentiles are approximate and its output is strings.
    """
    c = F.col(col)
    points = {0.25: "p25", 0.5: "p50", 0.75: "p75"}
    found = exact_percentiles(df, col, list(points))
    wide = found.agg(*[F.max(F.when(F.col("p") == p, F.col("value"))).alias(name) for p, name in points.items()])
    rest = df.agg(F.count(c).alias("n"), F.round(F.avg(c), 6).alias("mean"), F.round(F.stddev_samp(c), 6).alias("sd"),
                  F.min(c).alias("mn"), F.max(c).alias("mx"))
    # one row on either side
    return rest.join(F.broadcast(wide)).select("n", "mean", "sd", "mn", "p25", "p50", "p75", "mx")


def null_profile(df: DataFrame) -> DataFrame:
    """NULL count of every column in one pass (one row, one column per input column)."""
    return df.agg(*[F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(c) for c in df.columns])


def top_by(df: DataFrame, key: str, measure: str, k: int = 10) -> DataFrame:
    """Orders and total ``measure`` per ``key``; the k largest totals (ties by key)."""
    agg = df.groupBy(key).agg(F.count(F.lit(1)).alias("orders"), F.sum(measure).alias("total_amount"))
    return agg.orderBy(F.desc("total_amount"), F.col(key)).limit(k)


def daily_activity(df: DataFrame, ts: str, measure: str) -> DataFrame:
    return (df.groupBy(F.to_date(ts).alias("order_date"))
              .agg(F.count(F.lit(1)).alias("orders"), F.sum(measure).alias("amount_sum"))
              .orderBy("order_date"))


def exact_percentiles(df: DataFrame, col: str, ps: list[float], by: tuple[str, ...] = ()) -> DataFrame:
    """(by..., p, value): exact discrete percentiles, per group if ``by`` is given.

    Same definition as ``percentile_disc``: the value at 1-based position
    max(1, ceil(p * n)) in sorted order; NaN sorts last; a group without values
    has no row.  The column is reduced to (value, count) pairs with partial
    aggregation and range-partitioned; the counts of whole partitions give each
    partition's first position, and a running count inside it finds the value.
    No task holds all distinct values and nothing reaches the driver.  The pairs
    are written to the shared folder when this is called, before the result is asked.
    """
    by = list(by)
    spark = df.sparkSession
    pairs = df.filter(F.col(col).isNotNull()).groupBy(*by, F.col(col).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    # written once: the partition numbers must not change between the two reads
    path = scratch_path(spark, "percentiles")
    pairs.repartitionByRange(*by, "v").withColumn("part", F.spark_partition_id()).write.parquet(path)
    pairs = spark.read.parquet(path)
    sums = pairs.groupBy(*by, "part").agg(F.sum("c").alias("s"))
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    sums = sums.select(*by, "part", (F.sum("s").over(group.orderBy("part")) - F.col("s")).alias("before"),
                       F.sum("s").over(group).alias("n"))
    inside = Window.partitionBy("part", *by).orderBy("v")
    placed = pairs.join(sums, ["part", *by]).withColumn("until", F.col("before") + F.sum("c").over(inside))
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in ps]))
    at = F.greatest(F.lit(1), F.ceil(F.col("p") * F.col("n")))
    return placed.withColumn("p", wanted).filter((at <= F.col("until")) & (at > F.col("until") - F.col("c"))) \
        .select(*by, "p", F.col("v").alias("value"))
