"""Nearest neighbours by inner product over randomly rotated one-bit codes.

Every vector is rotated by one random orthogonal matrix and kept as the signs
of its coordinates plus correction scalars: its length and the inner product
of its direction with its own code.  A query's inner product with a code,
divided by that scalar, estimates the inner product with the vector, with an
error that follows from what the code leaves over.  Queries stand against all
rows in blocks; in a cell of one query block and one row block the best
estimates are scored exactly, and so is every row whose estimate plus error
bound reaches the k-th best exact score.  The cells' best rows are merged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

ROWS_PER_BLOCK = 16_384
QUERIES_PER_BLOCK = 1_024
#: Standard deviations of the estimate's error that the bound covers.
ERROR_DEVIATIONS = 3.0
SEED = 20_11


def rotation(dim: int, seed: int = SEED):
    """A random orthogonal matrix, equal on every machine."""
    import numpy as np

    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(vectors, rotate):
    """(packed sign bits, length, code agreement) of the rows of ``vectors``."""
    import numpy as np

    turned = vectors @ rotate
    length = np.sqrt((vectors * vectors).sum(axis=1))
    agreement = np.abs(turned).sum(axis=1) / (np.sqrt(vectors.shape[1]) * length)
    return np.packbits(turned > 0, axis=1), length, agreement


def estimates(turned_queries, bits, length, agreement, dim: int):
    """(estimate, deviation) of the inner products of queries with coded vectors.

    ``deviation`` is the standard deviation of the estimate's error for a
    query of length 1: what the code leaves over points in a random direction.
    """
    import numpy as np

    signs = np.unpackbits(bits, axis=1, count=dim).astype(np.float32) * 2 - 1
    dots = turned_queries.astype(np.float32) @ signs.T / np.float32(np.sqrt(dim))
    spread = np.sqrt(np.maximum(1 - agreement ** 2, 0) / max(dim - 1, 1)) / agreement
    return dots * (length / agreement).astype(np.float32), (length * spread).astype(np.float32)


def inner(a, b):
    """Row-wise inner products in double precision, coordinates added in order."""
    import numpy as np

    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        total += a[:, j] * b[:, j]
    return total


def search_cell(queries, query_ids, vectors, ids, k: int, rotate, deviations: float = ERROR_DEVIATIONS):
    """(query's place in the block, id, score) of the k best rows of a block for each query of a block."""
    import numpy as np

    dim = vectors.shape[1]
    bits, length, agreement = encode(vectors, rotate)
    turned = queries @ rotate
    reach = (deviations * np.sqrt((queries * queries).sum(axis=1))).astype(np.float32)
    own_q, own_v, own_s = [], [], []
    for at in range(0, len(queries), 128):
        sl = slice(at, min(at + 128, len(queries)))
        guess, spread = estimates(turned[sl], bits, length, agreement, dim)
        guess[query_ids[sl, None] == ids[None, :]] = -np.inf
        first = min(4 * k, len(ids))
        top = np.argpartition(-guess, first - 1, axis=1)[:, :first]
        rows = np.repeat(np.arange(sl.start, sl.stop), first)
        exact = inner(queries[rows], vectors[top.ravel()]).reshape(-1, first)
        exact[np.take_along_axis(guess, top, 1) == -np.inf] = -np.inf
        floor = np.partition(exact, max(first - k, 0), axis=1)[:, max(first - k, 0)]
        # estimates are single precision; the slack covers their rounding
        near = guess + spread[None, :] * reach[sl, None] >= (floor - 1e-5 * (1 + np.abs(floor)))[:, None]
        near &= guess > -np.inf
        for q in range(near.shape[0]):
            pick = np.flatnonzero(near[q])
            score = inner(np.broadcast_to(queries[at + q], (len(pick), dim)), vectors[pick])
            best = np.lexsort((ids[pick], -score))[:k]
            own_q.append(np.full(len(best), at + q))
            own_v.append(ids[pick][best])
            own_s.append(score[best])
    return np.concatenate(own_q), np.concatenate(own_v), np.concatenate(own_s)


def usable(vec) -> F.Column:
    """A vector that is there, not empty, all finite and not zero."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vec.isNotNull() & (F.size(vec) > 0) & finite & F.exists(vec, lambda x: x != 0)


def nearest(vectors: DataFrame, is_query: F.Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
            deviations: float = ERROR_DEVIATIONS) -> DataFrame:
    """query_id, rank (from 1), the neighbour's id and score: the ``k`` rows of
    largest inner product for each query row, its own id left out.

    Nearest first, ties to the smaller id; fewer rows if there are fewer
    candidates.  Each row of a repeated id is a candidate, and each such query
    row has a result of its own.  Rows with a NULL id, or a vector that is NULL, zero or holds
    NULL or non-finite numbers, take no part; vectors of another length than
    the query are no candidates; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"),
                          F.coalesce(is_query, F.lit(False)).alias("asks")) \
        .where(F.col("id").isNotNull() & usable(F.col("vec"))) \
        .withColumns({"dim": F.size("vec"), "place": F.monotonically_increasing_id()})
    n, asking = rows.agg(F.count("*"), F.count_if("asks")).first()
    row_blocks, query_blocks = -(-n // ROWS_PER_BLOCK) or 1, -(-asking // QUERIES_PER_BLOCK) or 1

    # each row goes to one block, also if its id is very common, then to the cells of that block with all of the other side
    def blocks(count):
        return F.pmod(F.xxhash64("place"), F.lit(count)).cast("int")

    def all_of(count):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    cells = rows.select("id", "place", "vec", "dim", F.lit(False).alias("asks"), blocks(row_blocks).alias("r"),
                        all_of(query_blocks).alias("q")) \
        .unionAll(rows.where("asks").select("id", "place", "vec", "dim", F.lit(True), all_of(row_blocks).alias("r"),
                                            blocks(query_blocks).alias("q")))

    def run(key, table):
        import numpy as np
        import pyarrow as pa

        dim = key[0].as_py()
        asks = table.column("asks").to_numpy(zero_copy_only=False).astype(bool)
        ids, places = table.column("id").to_numpy(), table.column("place").to_numpy()
        flat = table.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        if asks.any() and not asks.all():
            order = np.argsort(ids[~asks], kind="stable")
            q, v, s = search_cell(flat[asks], ids[asks], flat[~asks][order], ids[~asks][order], k, rotation(dim), deviations)
        else:
            q, v, s = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        return pa.table({"query_id": pa.array(ids[asks][q], pa.int64()), "query": pa.array(places[asks][q], pa.int64()),
                         "vec_id": pa.array(v, pa.int64()), "score": pa.array(s, pa.float64())})

    made = "query_id long, query long, vec_id long, score double"

    if n == 0:
        found = spark.createDataFrame([], made)
    else:
        found = cells.groupBy("dim", "r", "q").applyInArrow(run, made)
    rank = F.row_number().over(Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id"))
    return found.where("score IS NOT NULL").withColumn("rank", rank).where(F.col("rank") <= k) \
        .select("query_id", "rank", F.col("vec_id").alias(id_col), "score")
