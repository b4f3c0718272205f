from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from rivulet.llm import ann
from rivulet.llm.ann import encode, estimates, inner, nearest, rotation, search_cell

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k, asks=lambda i: i % 20 == 0):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for i, q in good:
        if asks(i):
            near = sorted((-float(inner(q[None], v[None])[0]), j) for j, v in good if j != i and len(v) == len(q))[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(near)]
    return sorted(out)


def run(spark, rows, k=20, **kw):
    frame = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r) for r in nearest(frame, F.col("vec_id") % 20 == 0, k, **kw).collect())


def test_rotation_keeps_inner_products():
    r = rotation(24)
    assert np.allclose(r @ r.T, np.eye(24)) and (rotation(24) == r).all()


def test_estimates_are_within_their_bound():
    rng = np.random.default_rng(3)
    v, q = rng.standard_normal((3000, 64)), rng.standard_normal((40, 64))
    bits, length, agreement = encode(v, rotation(64))
    guess, spread = estimates(q @ rotation(64), bits, length, agreement, 64)
    error = np.abs(guess - q @ v.T) / (spread[None, :] * np.linalg.norm(q, axis=1)[:, None])
    assert (error < 3).mean() > 0.995 and 0.8 < np.sqrt((error ** 2).mean()) < 1.2


def test_recall_on_all_vectors(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    ids = np.array([r.vec_id for r in rows])
    v = np.array([r.embedding for r in rows], np.float32).astype(float)
    asks = ids % 20 == 0
    q, n, _ = search_cell(v[asks], ids[asks], v, ids, 20, rotation(v.shape[1]))
    all_ = v[asks] @ v.T
    all_[ids[asks][:, None] == ids[None, :]] = -np.inf
    want = {(i, j) for i, row in zip(ids[asks], ids[np.argsort(-all_, axis=1)[:, :20]]) for j in row}
    assert len(want & set(zip(ids[asks][q], n))) / len(want) >= 0.99


@pytest.mark.parametrize("blocks", [(16_384, 1_024), (64, 7)])
def test_whole_table(spark, blocks, monkeypatch):
    monkeypatch.setattr(ann, "ROWS_PER_BLOCK", blocks[0])
    monkeypatch.setattr(ann, "QUERIES_PER_BLOCK", blocks[1])
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    assert run(spark, rows) == brute(rows, 20)


def test_edge_cases(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.standard_normal(8)]) for i in range(30)]
    rows += [(i, rows[3][1]) for i in range(100, 140)]  # copies tie
    rows += [(200, None), (220, []), (240, [0.0] * 8), (260, [1.0, None] * 4), (280, [float("nan")] * 8),
             (300, [float("inf")] + [1.0] * 7), (None, [1.0] * 8), (320, [1.0, 2.0, 3.0]), (340, [2.0, 0.0, 1.0])]
    assert run(spark, rows, 5) == brute(rows, 5)
    assert run(spark, rows + rows[:25], 5) == brute(rows + rows[:25], 5)
    assert run(spark, []) == [] and run(spark, [(20, [1.0, 2.0])]) == [] and run(spark, [(1, [1.0]), (2, [2.0])]) == []
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("id", "vec", "dim", "score", "rank", "q", "r")})
    assert nearest(frame, F.col("vec_id") % 20 == 0, 5).count() == len(brute(rows, 5))
