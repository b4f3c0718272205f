"""Reconciliation by a tree of key-hash ranges: totals are compared per range, and only unequal ranges are entered.

Every level halves the key hashes into finer ranges; a range whose row counts and
hash totals agree on both sides is done, whatever it holds.  Rows move only for
the ranges that are unequal at the last level, so two tables that differ in a few
keys cost one scan of totals and a join of a few ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.operators.joins import reconcile_keys
from rivulet.session import scratch_path

#: Bits of the key's hash that each level adds.
LEVEL_BITS = (6, 6, 8)


def _range(bits: int) -> Column:
    """The first ``bits`` bits of the key's hash."""
    return F.shiftrightunsigned("_h", 64 - bits)


def _signed(df: DataFrame, key: str, compare: list[str], spark: SparkSession, name: str) -> DataFrame:
    """(key, _h, _v): the key's hash and the whole row's, written once; every level reads these numbers only."""
    path = scratch_path(spark, name)
    df.select(F.col(key), F.xxhash64(key).alias("_h"), F.xxhash64(key, *compare).alias("_v")).write.parquet(path)
    return spark.read.parquet(path)


def _unequal(source: DataFrame, target: DataFrame, bits: int) -> DataFrame:
    """(_r, rows): ranges in which the sides differ, and the rows that both hold there."""
    def totals(df: DataFrame, side: str) -> DataFrame:
        return df.groupBy(_range(bits).alias("_r")).agg(
            F.count(F.lit(1)).alias(f"n_{side}"), F.bit_xor("_v").alias(f"x_{side}"),
            F.sum(F.col("_v").cast("decimal(38,0)")).alias(f"s_{side}"))

    both = totals(source, "a").join(totals(target, "b"), "_r", "full")
    same = F.struct("n_a", "x_a", "s_a").eqNullSafe(F.struct("n_b", "x_b", "s_b"))
    return both.filter(~same).select("_r", (F.coalesce("n_a", F.lit(0)) + F.coalesce("n_b", F.lit(0))).alias("rows"))


def reconcile_tree(spark: SparkSession, source: DataFrame, target: DataFrame, key: str, compare: list[str],
                   level_bits: tuple[int, ...] = LEVEL_BITS) -> tuple[DataFrame, DataFrame]:
    """((key, status) of every key that differs, (level, ranges, unequal, rows) of the descent).

    ``status`` is ``changed``, ``missing_in_target`` or ``extra_in_target``, as
    :func:`rivulet.operators.joins.reconcile_keys` has it; NULL keys are one key.
    ``rows`` are those of the unequal ranges, and at the last level the rows that
    are compared.  Two different ranges pass as equal only if a count, an
    exclusive or and a sum of 64-bit hashes all agree.
    """
    a, b = _signed(source, key, compare, spark, "source-hashes"), _signed(target, key, compare, spark, "target-hashes")
    depth, report, ranges = 0, [], None
    for level, more in enumerate(level_bits):
        depth += more
        if ranges is not None:  # only rows of ranges that are unequal so far
            known = ranges.select("_r")
            a, b = (x.withColumn("_r", _range(depth - more)).join(known, "_r", "left_semi").drop("_r") for x in (a, b))
        path = scratch_path(spark, f"unequal-{level}")
        _unequal(a, b, depth).write.parquet(path)
        ranges = spark.read.parquet(path)
        report.append(ranges.agg(F.lit(level).alias("level"), F.lit(1 << depth).cast("long").alias("ranges"),
                                 F.count(F.lit(1)).alias("unequal"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")))
    left = ranges.select("_r")

    def inside(df: DataFrame) -> DataFrame:
        return df.withColumn("_h", F.xxhash64(key)).withColumn("_r", _range(depth)).join(left, "_r", "left_semi")

    keys = reconcile_keys(inside(source), inside(target), key, compare).filter("status <> 'match'")
    out = report[0]
    for r in report[1:]:
        out = out.unionByName(r)
    return keys, out
