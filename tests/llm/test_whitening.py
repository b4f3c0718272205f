"""Whitening against exact integer sums and an eigendecomposition of the covariance."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from rivulet.llm.whitening import fit, whiten

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, components=32):
    """{(position, component): (n, deviation, |whitened|, explained)} of usable (id, vector) rows."""
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in rows]
    n, s = len(x), [sum(c) for c in zip(*x)]
    away = [sum((n * c - t) ** 2 for c, t in zip(v, s)) for v in x]
    a = np.array([[float(Fraction(n * c - t, n)) for c, t in zip(v, s)] for v in x])
    values, axes = np.linalg.eigh(a.T @ a / n)
    values, axes = values[::-1], axes[:, ::-1]
    keep = [i for i in range(len(values)) if values[i] > values[0] * 1e-12][:components]
    z = a @ axes[:, keep] / np.sqrt(values[keep])
    return [(n, away[i], np.abs(z[i]), values[keep] / values.sum()) for i in range(n)]


def compare(spark, vectors, dim, components=32, tolerance=1e-6):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], SCHEMA).repartition(3)
    got = {}
    for r in whiten(spark, df, components=components).collect():
        got.setdefault(r.vec_id, []).append(r)
        assert r.identity_error <= 1e-4
    want = brute([[float(np.float32(c)) for c in v] for v in vectors], components)
    for i, (n, away, z, explained) in enumerate(want):
        rows = sorted(got[i], key=lambda r: r.component)
        assert [r.component for r in rows] == list(range(1, len(z) + 1))
        assert all(r.n == n and int(r.deviation) == away for r in rows)
        assert np.allclose([abs(r.whitened) for r in rows], z, rtol=tolerance, atol=tolerance)
        assert np.allclose([r.explained for r in rows], explained, rtol=1e-4)
    return got


def test_equals_eigendecomposition(spark):
    rng = np.random.default_rng(5)
    mix = rng.normal(size=(6, 6)) * np.array([9, 4, 2, 1, 0.5, 0.2])
    compare(spark, (rng.normal(size=(300, 6)) @ mix + 3).tolist(), 6)
    compare(spark, (rng.normal(size=(300, 6)) @ mix).tolist(), 6, components=3)


def test_badly_conditioned_and_constant_directions(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(400, 3))
    wide = np.stack([base[:, 0] * 30000, base[:, 0] * 30000 + base[:, 1], base[:, 2] * 0.5, np.full(400, 7.0),
                     base[:, 2] * 0.5], axis=1)
    got = compare(spark, wide.tolist(), 5, tolerance=1e-3)
    assert len(got[0]) == 3  # the constant and the repeated dimension add none


def test_signs_agree_and_rows_are_whole(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    out = whiten(spark, df)
    total = df.count()
    assert out.count() == 32 * total
    z = np.array([[r.whitened for r in sorted(rs, key=lambda r: r.component)] for rs in _by_id(out).values()])
    assert np.abs(z.T @ z / total - np.eye(32)).max() < 1e-9
    vectors = [r.embedding for r in df.orderBy("vec_id").collect()]
    want = brute(vectors)
    rows = _by_id(out)
    for i, v in zip(sorted(rows), want):
        assert int(rows[i][0].deviation) == v[1]
        assert np.allclose(np.abs([r.whitened for r in sorted(rows[i], key=lambda r: r.component)]), v[2], atol=1e-6)


def _by_id(out):
    rows = {}
    for r in out.collect():
        rows.setdefault(r.vec_id, []).append(r)
    return rows


def test_cases(spark):
    inf, nan = float("inf"), float("nan")
    rng = random.Random(2)
    good = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(40)]
    odd = [(100, None), (101, [1.0, None, 2.0, 3.0]), (102, [1.0, nan, 2.0, 3.0]), (103, [1.0, 2.0, inf, 0.0]),
           (104, []), (105, [1.0, 2.0]), (None, good[0][1]), (7, good[7][1])]
    df = spark.createDataFrame(good + odd, SCHEMA).withColumns({c: F.lit("mine") for c in ("id", "v", "n", "component", "whitened")})
    out = whiten(spark, df)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = out.collect()
    assert len(rows) == 42 * 4 and {r.n for r in rows} == {42}
    assert sum(r.vec_id is None for r in rows) == 4 and sum(r.vec_id == 7 for r in rows) == 8
    assert not {r.vec_id for r in rows} & set(range(100, 106))
    none = spark.createDataFrame(odd[:5], SCHEMA)
    assert whiten(spark, none).count() == 0 and whiten(spark, none.where("false")).count() == 0
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], SCHEMA)
    assert whiten(spark, same).count() == 0 and fit(spark, same).trace == 0
    few = compare(spark, [[1.0, 2.0, 3.0, 4.0], [2.0, 1.0, 0.0, 9.0], [0.5, 0.25, 4.0, 1.0]], 4)
    assert len(few[0]) == 2  # three rows span two directions
    ints = spark.createDataFrame([(1, [1, 2]), (2, [3, 1]), (3, [0, 0])], "vec_id long, embedding array<int>")
    assert whiten(spark, ints).count() == 6


def test_sums_beyond_64_bits_are_exact(spark):
    vectors = [[1e13, 0.0], [-3e13, 5.0], [2e13, 1.0]]
    rows = whiten(spark, spark.createDataFrame(list(enumerate(vectors)), SCHEMA)).collect()
    want = brute([[float(np.float32(c)) for c in v] for v in vectors])
    assert {(r.vec_id, int(r.deviation)) for r in rows} == {(i, w[1]) for i, w in enumerate(want)}
    assert max(w[1] for w in want) > 2 ** 63
    with pytest.raises(Exception, match="too large"):
        whiten(spark, spark.createDataFrame([(1, [1e30]), (2, [0.0])], SCHEMA)).count()
