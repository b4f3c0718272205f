"""Packing into length buckets chosen by dynamic programming.

The histogram of all lengths, on a grid whose size does not depend on the
data, goes to the driver; dynamic programming picks the bucket bounds with the
least padding.  The grid tells every length up to ``EXACT_LENGTHS`` apart and puts a
longer one less than 1/1024 above itself.  Rounded up, the best bounds of the real
histogram are still bounds, of at most 1 + 1/1024 times their padded length, and the
bounds chosen are no worse: the total is within 0.1 % of the least one, and it is
the least one where no length exceeds ``EXACT_LENGTHS``.  Inside a bucket the documents stand in a seeded order and are
cut into batches of as many rows as the token budget holds at the bucket's
length.  Places in that order come from counts per hash cell, so that a bucket
that holds most documents is spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rivulet.llm.common import staged
from rivulet.llm.mixing import WORD, order_key

BUCKETS = 8
BATCH_TOKENS = 16_384
SEED = 29
CELL_DIGITS = 3
#: Lengths up to this are told apart; longer ones share a grid of as many steps for each power of two.
EXACT_LENGTHS = 2_048


def on_grid(length: Column, exact: int = EXACT_LENGTHS) -> Column:
    """The smallest length of the grid that is not below ``length``."""
    # one bit more than the exact lengths need costs one bit of resolution
    step = F.pow(F.lit(2.0), F.greatest(F.lit(0), F.length(F.bin(length - 1)) - (exact - 1).bit_length()))
    return (F.ceil(length / step) * step).cast("long")


def bounds(histogram: list[tuple[int, int]], buckets: int = BUCKETS) -> list[int]:
    """Bucket bounds with the least total padded length, from (length, count) pairs.

    Of equally good choices: the fewest buckets, then the smallest earlier bounds.
    """
    import numpy as np

    if not histogram:
        return []
    histogram = sorted(histogram)
    lengths = np.array([x[0] for x in histogram], np.int64)
    counts = np.cumsum([x[1] for x in histogram])
    n = len(lengths)
    cost, choices = lengths * counts, []
    best, used = int(cost[-1]), 1
    for k in range(2, min(buckets, n) + 1):
        new, choice = np.full(n, np.iinfo(np.int64).max), np.zeros(n, np.int64)
        for j in range(k - 1, n):
            total = cost[k - 2:j] + lengths[j] * (counts[j] - counts[k - 2:j])
            choice[j] = k - 2 + int(total.argmin())
            new[j] = total[choice[j] - (k - 2)]
        cost = new
        choices.append(choice)
        if int(cost[-1]) < best:
            best, used = int(cost[-1]), k
    out, j = [int(lengths[-1])], n - 1
    for choice in reversed(choices[:used - 1]):
        j = int(choice[j])
        out.append(int(lengths[j]))
    return out[::-1]


def pack(spark: SparkSession, docs: DataFrame, buckets: int = BUCKETS, batch_tokens: int = BATCH_TOKENS, seed: int = SEED,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_tokens`` (words and one end), ``bucket``
    (the length its batch is padded to), ``batch`` (number within the bucket,
    from 0) and ``place`` (row of the batch, from 0).

    A batch holds ``batch_tokens // bucket`` rows, at least one.  A NULL or
    empty text has one token; rows that repeat id and text take places side by
    side; an empty table gives an empty result.
    """
    tokens = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long") + 1
    own = staged(spark, docs.select(F.col(id_col).alias("id"), tokens.alias("n"),
                                    order_key(seed, F.lit(0), F.col(id_col), F.col(text_col)).alias("key"))
                 .withColumn("grid", on_grid(F.col("n"))), "lengths")
    # the grid bounds the rows: EXACT_LENGTHS and half as many for each further power of two
    edges = bounds([tuple(r) for r in own.groupBy("grid").count().collect()], buckets)
    bucket = F.lit(None).cast("long")
    for edge in reversed(edges):
        bucket = F.when(F.col("grid") <= edge, F.lit(edge).cast("long")).otherwise(bucket)
    placed = own.select("id", "n", "key", bucket.alias("bucket"), F.substring("key", 1, CELL_DIGITS).alias("cell"))
    before = F.sum("c").over(Window.partitionBy("bucket").orderBy("cell")) - F.col("c")
    cells = placed.groupBy("bucket", "cell").agg(F.count("*").alias("c")).select("bucket", "cell", before.alias("before"))
    rank = F.col("before") + F.row_number().over(Window.partitionBy("bucket", "cell").orderBy("key", "id")) - 1
    size = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(batch_tokens) / F.col("bucket")))
    return placed.join(cells, ["bucket", "cell"]).withColumns({"rank": rank.cast("long"), "size": size}) \
        .select(F.col("id").alias(id_col), F.col("n").alias("n_tokens"), "bucket",
                F.floor(F.col("rank") / F.col("size")).alias("batch"), (F.col("rank") % F.col("size")).alias("place"))
