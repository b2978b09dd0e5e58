"""Whitening of embeddings by shifted CholeskyQR.

The centred rows A of the fit list (n rows, one per distinct vector) are never gathered. A pass sums
their Gram matrix, a table of dimensions x dimensions numbers; its Cholesky factor R, taken with a small
shift that makes it exist whatever the rank, turns the rows into A R^-1 by triangular solves in the next
pass. Repeated, the rows become orthonormal, and A = Q (R_k ... R_1). What the last Gram matrix still differs from
the identity goes into the product as its square root, which also covers directions in which the rows do
not vary at all. The singular values and right vectors of that small product are those of A, found without
squaring its condition number.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import materialize, prepare

SCALE = 256
COMPONENTS = 4
PASSES = 6
ORTHONORMAL = 1e-12
_WIDE = 2**62
_LONG = 2**63 - 1


def integer_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``(vec_id, x)``: the vectors without null and non-finite entries, as integers."""
    whole = F.forall(
        "embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf"))
    )
    x = F.transform("embedding", lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("bigint"))
    return vectors.where(whole).select(F.col("vec_id").cast("bigint").alias("vec_id"), x.alias("x"))


def fit_list(rows: DataFrame) -> DataFrame:
    """Each distinct vector once; copies are dropped before the shuffle already."""
    return rows.select("x").distinct()


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - S``, exact: 64-bit integers where they are sure to fit, else Python's."""
    far = max(int(x.max()), -int(x.min()), 1)
    if n * far + max(map(abs, sums)) >= _WIDE:
        return x.astype(object) * n - np.array(sums, dtype=object)
    return x * n - np.array(sums, dtype=np.int64)


def solved(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """``rows`` times the inverses of the upper triangular ``factors``, one after the other."""
    for r in factors:
        out = np.empty_like(rows)
        for j in range(len(r)):
            out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
        rows = out
    return rows


def _slots(parts: DataFrame) -> dict[int, object]:
    summed = parts.groupBy("slot").agg(F.sum("part").alias("part"))
    return {r["slot"]: r["part"] for r in summed.collect()}  # as many as the matrix has entries


def _summed(df: DataFrame, width: int, own) -> np.ndarray:
    """Sums over all rows of the arrays ``own`` makes of batches of rows, ``width`` numbers long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                total += own(_rows(batch))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width), pa.int32()), pa.array(total)], names=["slot", "part"]
        )

    found = _slots(df.mapInArrow(run, "slot int, part double"))
    return np.array([found.get(i, 0.0) for i in range(width)])


def moments(fit: DataFrame, dimensions: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sums of their entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dimensions + 1, dtype=object)
        for batch in batches:
            if batch.num_rows:
                x = _rows(batch)
                wide = max(int(x.max()), -int(x.min())) * batch.num_rows >= _WIDE
                total[:dimensions] += (x.astype(object) if wide else x).sum(axis=0).astype(object)
                total[dimensions] += batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(dimensions + 1), pa.int32()),
                pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0)),
            ],
            names=["slot", "part"],
        )

    found = _slots(fit.mapInArrow(run, "slot int, part decimal(38,0)"))
    return int(found[dimensions]), [int(found[i]) for i in range(dimensions)]


def shifted_factor(gram: np.ndarray, n: int) -> np.ndarray:
    """Upper triangular factor of the Gram matrix of ``n`` rows, shifted beyond its rounding errors."""
    d = len(gram)
    shift = 11 * (n * d + d * (d + 1)) * np.finfo(float).eps / 2 * np.trace(gram)
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift *= 10


def components_of(
    fit: DataFrame, n: int, sums: list[int], passes: int = PASSES
) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (rows) of the covariance of the fit list."""
    d = len(sums)
    upper = np.triu_indices(d)

    def gram(factors: list[np.ndarray]) -> np.ndarray:
        def own(x: np.ndarray) -> np.ndarray:
            q = solved(deviations(x, n, sums).astype(np.float64) / n, factors)
            return (q.T @ q)[upper]

        g = np.zeros((d, d))
        g[upper] = _summed(fit, len(upper[0]), own)
        return np.triu(g) + np.triu(g, 1).T

    factors: list[np.ndarray] = []
    product = np.eye(d)
    while True:
        g = gram(factors)
        if not g.any():  # nothing varies
            return np.zeros(d), np.eye(d)
        values, vectors = np.linalg.eigh(g)
        flat = values <= values[-1] * d * np.finfo(float).eps  # no rows in these directions
        if len(factors) == passes or (factors and np.abs(values[~flat] - 1).max() <= ORTHONORMAL):
            break
        # The first factor is shifted for a rank that is not known, later ones where it is short.
        r = shifted_factor(g, n) if not factors or values[0] < 0.5 else np.linalg.cholesky(g).T
        factors.append(r)
        product = r @ product
    root = np.sqrt(values.clip(min=0.0))[:, None] * vectors.T
    _, sigma, right = np.linalg.svd(root @ product)
    return sigma * sigma / n, right


def whiten(
    vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE
) -> tuple[DataFrame, dict[str, object]]:
    """``(vec_id, deviation, whitened)`` of every row, and what was fitted.

    ``whitened`` has one number per component, null for a component along which nothing varies;
    ``deviation`` is null if it does not fit a long. Vectors that are null, empty or hold null or
    non-finite entries give no rows, nor do those of another length than the most common one (the
    longer of equally common ones). Repeated rows and null ids are rows like others. No rows give no
    rows; a single distinct vector has eigenvalues 0. An entry whose integer is beyond a long counts as the
    nearest long.
    """
    spark = vectors.sparkSession
    prepare(spark)
    rows = materialize(integer_vectors(vectors, scale).where(F.size("x") > 0))
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n"))
    common = lengths.orderBy(F.col("n").desc(), F.col("d").desc()).first()
    schema = "vec_id bigint, deviation bigint, whitened array<double>"
    if common is None:
        return spark.createDataFrame([], schema), {"n": 0, "explained": [], "identity_error": None}
    d = common["d"]
    rows = rows.where(F.size("x") == d)
    fit = materialize(fit_list(rows))
    n, sums = moments(fit, d)
    values, directions = components_of(fit, n, sums)
    trace = float(values.sum())
    count = min(components, d)
    used = values[:count] > values[0] * d * np.finfo(float).eps
    scaled = np.zeros((d, count))
    scaled[:, used] = directions[:count][used].T / np.sqrt(values[:count][used])
    pairs = np.triu_indices(count)

    def own(x: np.ndarray) -> np.ndarray:
        z = (deviations(x, n, sums).astype(np.float64) / n) @ scaled
        return np.concatenate([z.sum(axis=0), (z.T @ z)[pairs]])

    total = _summed(fit, count + len(pairs[0]), own) / n
    mean = total[:count]
    covariance = total[count:] - mean[pairs[0]] * mean[pairs[1]]
    both = used[pairs[0]] & used[pairs[1]]
    error = np.abs(covariance - (pairs[0] == pairs[1]))[both]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            away = deviations(_rows(batch), n, sums)
            z = (away.astype(np.float64) / n) @ scaled
            far = int(np.abs(away).max())
            exact = away if far * far * d <= _LONG else away.astype(object)
            squares = (exact * exact).sum(axis=1)
            if exact.dtype == object:
                squares = [int(s) if s <= _LONG else None for s in squares]
            listed = [[float(v) if u else None for v, u in zip(one, used)] for one in z]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(squares, pa.int64()), pa.array(listed, pa.list_(pa.float64()))],
                names=["vec_id", "deviation", "whitened"],
            )

    fitted = {
        "n": n,
        "sums": sums,
        "eigenvalues": values[:count].tolist(),
        "components": directions[:count].tolist(),
        "explained": [float(v) / trace if trace else None for v in values[:count]],
        "identity_error": float(error.max()) if len(error) else None,
    }
    return rows.mapInArrow(run, schema), fitted


def digest(whitened: DataFrame, fitted: dict[str, object]) -> DataFrame:
    """A row per vector and component."""
    each = whitened.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    share = [F.lit(e).cast("double") for e in fitted["explained"]] or [F.lit(None).cast("double")]
    return each.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(fitted["n"]).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(F.array(*share), F.col("at")).alias("explained"),
        F.lit(fitted["identity_error"]).cast("double").alias("identity_error"),
    )
