"""Whitening of vectors by shifted CholeskyQR.

The centred rows A are orthogonalised by repeated Gram passes: every pass is one
scan in which each task solves its rows against the triangular factors found so
far, Q = A / R1 / R2 ..., and adds up its part of Q'Q; Spark sums the parts, and
the driver gets one number per pair of dimensions.  The first Gram matrix is
shifted before its Cholesky factorisation, so that it succeeds for rows of any
condition; later ones are shifted only where the factorisation fails.  The passes
end when Q'Q is the identity.  The composed R = ... R2 R1 has the singular values
and right singular vectors of A, so an SVD of R gives the components without ever
taking an eigenvalue of the squared matrix.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.common import staged

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Gram passes at most; three are enough for rows of any condition that doubles hold.
PASSES = 6
#: Rows that a task solves or projects at once.
BLOCK = 4096


class Whitener(NamedTuple):
    """What the passes leave: a few numbers per dimension, whatever the rows."""

    dim: int
    n: int
    sums: list  # exact sum of each dimension, Python integers
    axes: object  # (components, dim): unit rows
    values: object  # eigenvalues, falling
    trace: float


def grid(values):
    """``floor(64 c) + 1000000`` of each entry, exact, as 64-bit integers."""
    import numpy as np

    scaled = np.floor(values * float(SCALE))
    if len(scaled) and np.abs(scaled).max() > 2.0 ** 52:
        raise ArithmeticError("an entry is too large for the integer grid")
    return scaled.astype(np.int64) + OFFSET


def usable(col, dim: int):
    """(row numbers, matrix of doubles) of the vectors of an Arrow list column
    that have ``dim`` entries, none of them null or non-finite."""
    import numpy as np
    import pyarrow.compute as pc

    rows = np.flatnonzero(pc.fill_null(pc.equal(pc.list_value_length(col), dim), False).to_numpy(zero_copy_only=False))
    flat = col.take(rows).flatten()
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), dim)
    ok = np.isfinite(values).all(axis=1)
    return rows[ok], values[ok]


def centred(x, n: int, sums: list):
    """(n x - S, the same over n): exact integers while they fit 64 bits, and centred doubles."""
    import numpy as np

    if n * (int(np.abs(x).max()) if x.size else 0) + max(map(abs, sums), default=0) < 2 ** 62:
        exact = n * x - np.array(sums, np.int64)
    else:
        exact = n * x.astype(object) - np.array(sums, object)
    return exact, exact.astype(np.float64) / n


def solve(rows, factors: list):
    """``rows`` solved against each upper triangular factor in turn: Q = rows / R1 / R2 ..."""
    import numpy as np

    for r in factors:
        q = np.empty_like(rows)
        for j in range(r.shape[0]):
            q[:, j] = (rows[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
        rows = q
    return rows


def _column_sums(vectors: DataFrame) -> DataFrame:
    """(dim, pos, n, s): exact sums over the usable vectors of each length, one row per position."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        held: dict[int, list] = {}
        for batch in batches:
            col = batch.column(0)
            for dim in pc.unique(pc.list_value_length(col).drop_null()).to_pylist():
                rows, values = usable(col, dim)
                if dim and len(rows):
                    x, (n, s) = grid(values), held.get(dim, (0, 0))
                    held[dim] = [n + len(x), s + x.sum(axis=0).astype(object)]
        for dim, (n, s) in held.items():
            yield pa.RecordBatch.from_pydict({"dim": [dim] * dim, "pos": list(range(dim)), "n": [n] * dim,
                                              "s": pa.array([int(v) for v in s], pa.decimal128(38, 0))},
                                             schema=pa.schema([("dim", pa.int32()), ("pos", pa.int32()), ("n", pa.int64()),
                                                               ("s", pa.decimal128(38, 0))]))

    return vectors.mapInArrow(run, "dim int, pos int, n long, s decimal(38,0)") \
        .groupBy("dim", "pos").agg(F.sum("n").alias("n"), F.sum("s").cast("decimal(38,0)").alias("s"))


def _gram(vectors: DataFrame, dim: int, n: int, sums: list, factors: list, axes=None):
    """Q'Q over all usable rows (of the projections on ``axes``, if given), as a matrix on the driver."""
    import numpy as np

    width = dim if axes is None else len(axes)

    def run(batches):
        import pyarrow as pa

        total = np.zeros((width, width))
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                _, values = usable(batch.column(0).slice(at, BLOCK), dim)
                a = centred(grid(values), n, sums)[1]
                q = solve(a, factors) if axes is None else a @ axes.T
                total += q.T @ q
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], names=["part"])

    summed = vectors.mapInArrow(run, "part array<double>").select(F.posexplode("part").alias("pos", "v")) \
        .groupBy("pos").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(width * width)
    for r in summed:
        out[r.pos] = r.v
    return (out.reshape(width, width) + out.reshape(width, width).T) / 2


def cholesky(gram, n: int, shifted: bool):
    """Upper triangular R with R'R = ``gram``, plus a shift if asked for or if it isn't definite enough."""
    import numpy as np

    d = len(gram)
    shift = 11 * (n * d + d * (d + 1)) * np.finfo(float).eps / 2 * np.linalg.norm(gram, 2)
    for s in (shift,) if shifted else (0.0, shift):
        try:
            return np.linalg.cholesky(gram + s * np.eye(d)).T
        except np.linalg.LinAlgError:
            continue
    raise ArithmeticError("the shifted Gram matrix isn't definite")


def fit(spark: SparkSession, df: DataFrame, vec_col: str = "embedding", components: int = COMPONENTS) -> Whitener | None:
    """The components of all usable vectors; None if there is no vector.

    Vectors of the most frequent length take part (of equally frequent ones, the
    shortest).  Directions in which the rows don't vary, up to rounding, are no
    components, so there may be fewer than asked for.
    """
    import numpy as np

    vectors = df.select(F.col(vec_col).alias("v"))
    totals = staged(spark, _column_sums(vectors), "column-sums")
    top = totals.groupBy("dim").agg(F.max("n").alias("n")).orderBy(F.desc("n"), "dim").first()
    if top is None:
        return None
    dim, n = top.dim, top.n
    sums = [int(r.s) for r in totals.where(F.col("dim") == dim).orderBy("pos").collect()]
    factors: list = []
    trace = None
    for step in range(PASSES):
        gram = _gram(vectors, dim, n, sums, factors)
        if trace is None:
            trace = float(np.trace(gram)) / n
            if trace == 0:
                return Whitener(dim, n, sums, np.zeros((0, dim)), np.zeros(0), 0.0)
        elif np.abs(gram - np.eye(dim)).max() < 1e-13:
            break
        factors.append(cholesky(gram, n, shifted=step == 0))
    r = np.eye(dim)
    for f in factors:
        r = f @ r
    _, sigma, axes = np.linalg.svd(r)
    keep = np.flatnonzero(sigma > sigma[0] * max(n, dim) * np.finfo(float).eps)[:components]
    axes = axes[keep]
    axes *= np.sign(axes[np.arange(len(keep)), np.abs(axes).argmax(axis=1)])[:, None]
    return Whitener(dim, n, sums, axes, sigma[keep] ** 2 / n, trace)


def identity_error(spark: SparkSession, df: DataFrame, model: Whitener, vec_col: str = "embedding") -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity (0 without components)."""
    import numpy as np

    k = len(model.values)
    if not k:
        return 0.0
    gram = _gram(df.select(F.col(vec_col).alias("v")), model.dim, model.n, model.sums, [],
                 model.axes / np.sqrt(model.values)[:, None])
    return float(np.abs(gram / model.n - np.eye(k)).max())


def whiten(spark: SparkSession, df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: ``id_col``, ``component`` (from 1, by falling variance), ``n``,
    ``deviation`` (sum of (n x - S)^2, exact, DECIMAL), ``whitened``, ``explained`` and ``identity_error``.

    Vectors that are NULL, hold a NULL or non-finite entry, or differ in length
    from the most frequent one give no rows; neither do vectors without any
    variance, nor an empty table.  NULL and repeated ids are carried as they
    are; repeated rows count each time; other columns are not read.
    """
    import numpy as np

    model = fit(spark, df, vec_col, components)
    error = identity_error(spark, df, model, vec_col) if model else 0.0
    source = df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v"))
    kind = source.schema["id"].dataType.simpleString()
    schema = f"id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if model is None or not len(model.values):
        return spark.createDataFrame([], schema).withColumnRenamed("id", id_col)
    scaled, explained = model.axes / np.sqrt(model.values)[:, None], model.values / model.trace
    k = len(explained)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                rows, values = usable(part.column(1), model.dim)
                exact, a = centred(grid(values), model.n, model.sums)
                if exact.dtype != object and len(exact) and float((a * model.n).__pow__(2).sum(axis=1).max()) > 2.0 ** 62:
                    exact = exact.astype(object)
                away = [int(v) for v in (exact * exact).sum(axis=1)]
                m = len(rows)
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(np.repeat(rows, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n, np.int64)),
                    pa.array(away, pa.decimal128(38, 0)).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array((a @ scaled.T).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)
