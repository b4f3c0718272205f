from __future__ import annotations

import random
from itertools import combinations

from pyspark.sql import functions as F

from rivulet.llm.packing import BATCH_TOKENS, bounds, on_grid, pack
from tests.llm.conftest import DOCS


def padded(hist, edges):
    return sum(n * min(e for e in edges if e >= x) for x, n in hist)


def test_bounds_are_optimal():
    rng = random.Random(7)
    for _ in range(60):
        hist = [(x, rng.randint(1, 9)) for x in sorted(rng.sample(range(1, 60), rng.randint(1, 9)))]
        for k in (1, 2, 3, 5):
            got = bounds(hist, k)
            lengths = [x for x, _ in hist]
            best = min(padded(hist, (*c, lengths[-1])) for n in range(k) for c in combinations(lengths[:-1], n))
            assert padded(hist, got) == best and len(got) <= k and got == sorted(set(got)) and got[-1] == lengths[-1]
    assert bounds([]) == [] and bounds([(5, 3)]) == [5]


def test_grid(spark):
    values = [1, 2, 2047, 2048, 2049, 2050, 4096, 4097, 5001, 123_457, (1 << 40) + 1]
    rows = spark.createDataFrame([(v,) for v in values], "n long").select("n", on_grid(F.col("n")).alias("g")).collect()
    for r in rows:
        step = 1 << max(0, (r.n - 1).bit_length() - 11)
        assert r.g == -(-r.n // step) * step and r.n <= r.g <= r.n * (1 + 1 / 1024)


def check(rows, n):
    assert len(rows) == n
    batches = {}
    for r in rows:
        assert r.n_tokens <= r.bucket
        batches.setdefault((r.bucket, r.batch), []).append(r.place)
    full = {}
    for (bucket, batch), places in batches.items():
        size = max(1, BATCH_TOKENS // bucket)
        assert sorted(places) == list(range(len(places))) and len(places) <= size
        full.setdefault(bucket, []).append((batch, len(places) == size))
    for found in full.values():  # only the last batch of a bucket may have room
        found.sort()
        assert [b for b, _ in found] == list(range(len(found))) and all(f for _, f in found[:-1])


def test_batches(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = pack(spark, docs).collect()
    check(rows, docs.count())
    assert sorted(map(tuple, rows)) == sorted(map(tuple, pack(spark, docs.repartition(7)).collect()))


def test_edge_cases(spark, docs, clashing, empty):
    for frame in (docs, clashing):
        rows = pack(spark, frame).collect()
        check(rows, len(DOCS))
        assert [r.n_tokens for r in rows if r.doc_id in (3, 4, 5)] == [1, 1, 1]
    assert pack(spark, empty).count() == 0
    copies = spark.range(5000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("same few words").alias("text"))
    check(pack(spark, copies).collect(), 5000)
