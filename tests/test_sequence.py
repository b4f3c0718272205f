"""Chunked per-key steps equal plain per-key windows (hot key included)."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from rivulet.operators.sequence import last_non_null, shift, time_chunk


def data(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        k = 0 if rnd.random() < 0.4 else rnd.randrange(20)          # key 0 holds ~40 % of rows
        v = None if rnd.random() < 0.3 else rnd.randrange(1000)
        rows.append((k, rnd.randrange(0, 50_000), i, v))
    return spark.createDataFrame(rows, "k long, t long, o long, v long")


def test_shift_matches_window(spark):
    df = data(spark)
    w = Window.partitionBy("k").orderBy("t", "o")
    want = df.select("o", F.lag("v").over(w).alias("p"), F.lead("v").over(w).alias("n"))
    got = shift(shift(df, "k", ["t", "o"], F.col("v"), "p", time_chunk(F.col("t"), 1000)),
                "k", ["t", "o"], F.col("v"), "n", time_chunk(F.col("t"), 1000), forward=True).select("o", "p", "n")
    assert sorted(want.collect()) == sorted(got.collect())


def test_last_non_null_matches_window(spark):
    df = data(spark)
    w = Window.partitionBy("k").orderBy("t", "o").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("o", F.last("v", ignorenulls=True).over(w).alias("x"))
    got = last_non_null(df, "k", ["t", "o"], "v", "x", time_chunk(F.col("t"), 700)).select("o", "x")
    assert sorted(want.collect()) == sorted(got.collect())


def test_scd2_chunked_equals_plain(spark):
    from rivulet.operators import cdc as C
    rnd = random.Random(5)
    rows = []
    for i in range(2000):
        k = 0 if rnd.random() < 0.5 else rnd.randrange(10)
        op = rnd.choice(["c", "u", "u", "d"])
        rows.append((op, rnd.randrange(0, 10) * 86_400_000 + rnd.randrange(5) * 3_600_000, i % 3, i, k,
                     None if op == "d" else rnd.randrange(3), None, None if op == "d" else rnd.choice("AB")))
    ch = spark.createDataFrame(rows, "op string, ts_ms long, partition int, offset long, order_id long, "
                                     "customer_id long, amount decimal(12,2), status string") \
        .withColumn("ts", F.timestamp_millis("ts_ms"))
    # changes without a time come first and form a chunk of their own
    ch = ch.withColumn("ts_ms", F.when(F.col("offset") % 9 > 0, F.col("ts_ms"))).withColumn("ts", F.timestamp_millis("ts_ms"))
    whole = C.scd2_history(ch, C.ORDERS, chunk_ms=10 ** 15)
    chunked = C.scd2_history(ch, C.ORDERS, chunk_ms=86_400_000)

    def key(r):
        return tuple("" if v is None else str(v) for v in r)
    rows = sorted(whole.collect(), key=key)
    assert rows == sorted(chunked.collect(), key=key) == sorted(plain_history(ch).collect(), key=key)


def plain_history(ch):
    """Versions by plain per-key windows."""
    w = Window.partitionBy("order_id").orderBy("ts_ms", "partition", "offset")
    img = F.struct("customer_id", "amount", "status")
    d = F.col("op") == "d"
    step = ch.withColumn("p", F.lag(F.struct(img.alias("i"), F.col("op").alias("o"))).over(w))
    kept = step.filter(d | F.col("p").isNull() | (F.col("p.o") == "d") | ~img.eqNullSafe(F.col("p.i")))
    out = kept.withColumn("valid_to", F.lead("ts").over(w)).filter(~d)
    return out.select("order_id", "customer_id", "amount", "status", F.col("ts").alias("valid_from"), "valid_to",
                      F.col("valid_to").isNull().alias("is_current"), "partition", "offset")
