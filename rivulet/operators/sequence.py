"""Per-key sequence steps that stay parallel when one key is huge.

``lag``/``lead`` and "last non-null so far" over ``Window.partitionBy(key)``
put every row of a key into one task.  Here the key's rows are cut into
contiguous chunks of its order (a time bucket of the leading order column),
the window runs per (key, chunk), and the value that crosses a chunk edge is
carried over from the chunk's edge rows (one row per chunk), so a key holding a
third of the data is spread over its chunks.  Rows meet the carried values by
key and chunk, as the windows dealt them: they are not shuffled a second time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def time_chunk(ts_ms: Column, chunk_ms: int) -> Column:
    return F.floor(ts_ms / F.lit(chunk_ms)).cast("long")


#: Chunk of rows without a time; like NULL it comes before all others.
NO_CHUNK = -(2 ** 63)


def _chunked(df: DataFrame, chunk: Column) -> DataFrame:
    return df.withColumn("_c", F.coalesce(chunk, F.lit(NO_CHUNK)))


def _carry(edges: DataFrame, key: str, value: str, forward: bool, skip_nulls: bool = False) -> DataFrame:
    """Per (key, chunk): the edge value of the previous (or next) chunk."""
    if skip_nulls:
        we = Window.partitionBy(key).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
        c = F.last(value, ignorenulls=True).over(we)
    else:
        we = Window.partitionBy(key).orderBy("_c")
        c = (F.lead if forward else F.lag)(value).over(we)
    return edges.select(key, "_c", c.alias("_carry"))


def _join_carry(rows: DataFrame, carry: DataFrame, key: str) -> DataFrame:
    """Attach the carried value by key and chunk."""
    c = carry.select(F.col(key).alias("_ck"), F.col("_c").alias("_cc"), "_carry")
    return rows.join(c, (rows[key] == c["_ck"]) & (rows["_c"] == c["_cc"]), "left").drop("_ck", "_cc")


def shift(df: DataFrame, key: str, order: list[str], value: Column, out: str, chunk: Column,
          forward: bool = False) -> DataFrame:
    """``out`` = previous (``forward=False``) or next value of ``value`` among the
    rows of the same key in ``order``.  ``chunk`` must be non-decreasing in
    ``order``, NULL first."""
    w = Window.partitionBy(key, "_c").orderBy(*[F.col(c) for c in order])
    step = F.lead if forward else F.lag
    d = (_chunked(df, chunk).withColumn("_v", value)
           .withColumn("_inner", step("_v").over(w))
           .withColumn("_first", F.lag(F.lit(1)).over(w).isNull())
           .withColumn("_last", F.lead(F.lit(1)).over(w).isNull()))
    # the value a neighbouring chunk needs: first row's value (for lead), last row's (for lag)
    edges = d.filter(F.col("_first") if forward else F.col("_last")).select(key, "_c", F.col("_v").alias("_e"))
    d = _join_carry(d, _carry(edges, key, "_e", forward), key)
    at_edge = F.col("_last") if forward else F.col("_first")
    return (d.withColumn(out, F.when(at_edge, F.col("_carry")).otherwise(F.col("_inner")))
             .drop("_c", "_v", "_inner", "_first", "_last", "_carry"))


def last_non_null(df: DataFrame, key: str, order: list[str], value: str, out: str, chunk: Column) -> DataFrame:
    """``out`` = the last non-NULL ``value`` at or before each row (same key, in ``order``)."""
    w = Window.partitionBy(key, "_c").orderBy(*[F.col(c) for c in order])
    d = (_chunked(df, chunk)
           .withColumn("_inner", F.last(value, ignorenulls=True).over(
               w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
           .withColumn("_last", F.lead(F.lit(1)).over(w).isNull()))
    edges = d.filter("_last").select(key, "_c", F.col("_inner").alias("_e"))
    d = _join_carry(d, _carry(edges, key, "_e", False, skip_nulls=True), key)
    return d.withColumn(out, F.coalesce(F.col("_inner"), F.col("_carry"))).drop("_c", "_inner", "_last", "_carry")
