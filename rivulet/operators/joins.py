"""Join helpers: orphan detection, reconciliation, skew salting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose foreign key has no parent (left anti join)."""
    return child.join(parent.select(F.col(parent_key).alias("_pk")), F.col(child_key) == F.col("_pk"), "left_anti")


def reconcile_keys(source: DataFrame, target: DataFrame, key: str, compare: list[str]) -> DataFrame:
    """Full outer join on the key; each key is ``match``, ``changed``,
    ``missing_in_target`` or ``extra_in_target`` (values compared NULL-safe)."""
    s = source.select(F.col(key).alias("_k"), F.struct(*compare).alias("_s"))
    t = target.select(F.col(key).alias("_k2"), F.struct(*compare).alias("_t"))
    j = s.join(t, s._k.eqNullSafe(t._k2), "full_outer")
    status = (F.when(F.col("_k2").isNull(), F.lit("missing_in_target"))
               .when(F.col("_k").isNull(), F.lit("extra_in_target"))
               .when(F.col("_s").eqNullSafe(F.col("_t")), F.lit("match"))
               .otherwise(F.lit("changed")))
    return j.select(F.coalesce("_k", "_k2").alias(key), status.alias("status"))


def hot_keys(df: DataFrame, key: str, min_share: float) -> DataFrame:
    """Keys holding at least ``min_share`` of the rows.  At most 1/min_share
    keys can qualify, so the result has a proven size bound."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("_all"))
    return counts.join(F.broadcast(total), F.col("_n") >= F.col("_all") * min_share).select(key)


def salted_join(big: DataFrame, small: DataFrame, key: str, salts: int = 16, min_share: float = 0.01,
                how: str = "inner") -> DataFrame:
    """Equi-join (``inner`` or ``left``) that spreads hot keys of ``big`` over ``salts`` tasks.

    Only keys holding at least ``min_share`` of ``big`` are salted: their big
    rows get a salt from a hash of the row, their small rows are replicated
    once per salt; every other key keeps salt 0 and is joined as usual.  The
    hot-key list has at most 1/min_share rows, which is why it may be
    broadcast.  Joins that keep unmatched rows of ``small`` are refused: a
    replicated row would count as unmatched for every salt it does not meet.
    """
    if how not in ("inner", "left", "left_outer", "leftouter"):
        raise ValueError(f"salted_join supports inner and left joins, not {how!r}")
    hot = F.broadcast(hot_keys(big, key, min_share).withColumn("_hot", F.lit(True)))
    b = (big.join(hot, key, "left")
            .withColumn("_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(*big.columns), F.lit(salts)))
                                  .otherwise(F.lit(0)).cast("int"))
            .drop("_hot"))
    s = (small.join(hot, key, "left")
              .withColumn("_salt", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1)))
                                               .otherwise(F.array(F.lit(0)))))
              .drop("_hot"))
    return b.join(s, [key, "_salt"], how).drop("_salt")
