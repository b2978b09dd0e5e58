"""Centroid clustering of integer vectors with Ptolemaic lower bounds from cached pivot distances.

Ptolemy's inequality bounds the distance of a vector x from a centroid c by four distances to two pivots:
|d(x,p) d(c,q) - d(x,q) d(c,p)| / d(p,q) <= d(x,c). The pivots are fixed, so a vector's distances to
them are computed once and stored with it; those of the few centroids are new in every round. Each
centroid uses the pairs whose first pivot is the one nearest to it, where the bound is tightest. The centroid of
the smallest bound is measured exactly; the others only if their bound, lowered by more than
rounding can have raised it, does not exceed that distance. Exact distances are sums of integers, so the
result is that of comparing everything. A round is one pass over the stored vectors; its sums are
integers as well, so neither the order of rows nor a repeated task changes them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from math import isqrt, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import materialize, prepare

CLUSTERS = 8
ROUNDS = 10
DIMENSIONS = 64
SCALE = 1024
PAIRS = 3  # pivot pairs tried per centroid
SAFE = 1 << 27  # components up to this: squared distances fit into 64 bits
SLACK = 2.0**-46
_LONG = 2**63 - 1


def kept_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """``(vec_id, x)``: vectors of exactly ``dimensions`` finite components, as integers."""
    whole = F.forall(
        "embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf"))
    )
    x = F.transform("embedding", lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("bigint"))
    return vectors.where((F.size("embedding") == dimensions) & whole).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), x.alias("x")
    )


def starts(kept: DataFrame, clusters: int = CLUSTERS) -> list[list[int]]:
    """The vectors whose id hashes lowest, in the order of the hashes; ids that are null come last."""
    code = F.sha2(F.concat(F.lit("3:"), F.col("vec_id").cast("string")), 256)
    first = kept.select(code.alias("code"), "x").orderBy(F.col("code").asc_nulls_last(), "x").limit(clusters)
    return [list(r["x"]) for r in first.collect()]


def _distance(a: list[int], b: list[int]) -> float:
    """Correctly rounded Euclidean distance, also of components beyond 64 bits when squared."""
    squared = sum((x - y) ** 2 for x, y in zip(a, b))
    return sqrt(squared) if squared < 1 << 53 else float(isqrt(squared << 20)) / 1024


def squared_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` from ``c`` (a row or as many rows)."""
    away = x - c
    return (away * away).sum(axis=1)


def _integers(values: np.ndarray) -> np.ndarray:
    """64-bit integers where their squares fit, Python's integers otherwise."""
    return values if max(int(values.max()), -int(values.min())) <= SAFE else values.astype(object)


@dataclass
class Bounds:
    """Pivot distances of the centroids of a round, as the bound needs them."""

    p: np.ndarray  # (centroid, pair): number of the first pivot
    q: np.ndarray
    to_p: np.ndarray
    to_q: np.ndarray
    apart: np.ndarray

    @classmethod
    def of(cls, centroids: list[list[int]], pivots: list[list[int]], pairs: int = PAIRS) -> Bounds:
        to = np.array([[_distance(c, p) for p in pivots] for c in centroids])
        apart = np.array([[_distance(p, q) for q in pivots] for p in pivots])
        p = np.repeat(to.argmin(axis=1)[:, None], pairs, axis=1)
        q = np.argsort(-apart[p[:, 0]], axis=1, kind="stable")[:, :pairs]  # the pivots farthest from p
        q = np.concatenate([q, np.repeat(q[:, :1], pairs - q.shape[1], axis=1)], axis=1)
        rows = np.arange(len(centroids))[:, None]
        return cls(p, q, to[rows, p], to[rows, q], apart[p, q])

    def below(self, away: np.ndarray) -> np.ndarray:
        """Lower bounds of the distances of vectors with pivot distances ``away`` to all centroids."""
        left = away[:, self.p] * self.to_q
        right = away[:, self.q] * self.to_p
        with np.errstate(divide="ignore", invalid="ignore"):
            bound = (np.abs(left - right) - SLACK * (left + right)) / self.apart
        return np.where(self.apart > 0, bound, 0.0).max(axis=2).clip(min=0.0)


def nearest(
    x: np.ndarray, away: np.ndarray, centroids: np.ndarray, bounds: Bounds
) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of the nearest centroid (the smaller of equals), squared distance, distances computed."""
    below = bounds.below(away)
    best = below.argmin(axis=1)
    least = squared_distances(x, centroids[best])
    limit = least.astype(np.float64) * (1 + SLACK)
    open_ = below * below * (1 - SLACK) <= limit[:, None]
    open_[np.arange(len(x)), best] = False
    computed = len(x)
    for j in range(len(centroids)):
        at = np.nonzero(open_[:, j])[0]
        if len(at):
            computed += len(at)
            d = squared_distances(x[at], centroids[j])
            closer = (d < least[at]) | ((d == least[at]) & (j < best[at]))
            least[at[closer]] = d[closer]
            best[at[closer]] = j
    return best, least, computed


def _rows(batch: pa.RecordBatch, column: str) -> np.ndarray:
    flat = batch.column(column).flatten().to_numpy()
    return flat.reshape(batch.num_rows, -1)


def _with_pivots(kept: DataFrame, pivots: list[list[int]]) -> DataFrame:
    """Every vector with its distances to the pivots."""
    at = np.array(pivots, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _rows(batch, "x")
            wide = max(int(f(y)) * s for y in (at, x) for f, s in ((np.max, 1), (np.min, -1))) > SAFE
            own, pivot = (x.astype(object), at.astype(object)) if wide else (x, at)
            away = np.sqrt(np.stack([squared_distances(own, p).astype(np.float64) for p in pivot], axis=1))
            lists = pa.ListArray.from_arrays(
                np.arange(0, away.size + 1, len(pivot), dtype=np.int32), away.ravel()
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("x"), lists], names=["vec_id", "x", "away"]
            )

    return kept.mapInArrow(run, "vec_id bigint, x array<bigint>, away array<double>")


def _assignments(
    batches: Iterator[pa.RecordBatch], centroids: list[list[int]], pivots: list[list[int]], pairs: int
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, int]]:
    bounds = Bounds.of(centroids, pivots, pairs)
    at = np.array(centroids, dtype=object)
    narrow = all(-SAFE <= c <= SAFE for one in centroids for c in one)
    for batch in batches:
        if batch.num_rows:
            x = _integers(_rows(batch, "x"))
            if x.dtype == object or not narrow:
                x, c = x.astype(object), at
            else:
                c = at.astype(np.int64)
            yield batch, x, *nearest(x, _rows(batch, "away"), c, bounds)


def _round(stored: DataFrame, centroids: list[list[int]], pivots: list[list[int]], pairs: int):
    """Members and sums of every cluster, and the number of distances computed."""
    dimensions = len(centroids[0])
    width = dimensions + 2  # a cluster's sums, then its members and distances

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centroids), width), dtype=object)
        for _, x, cluster, _, computed in _assignments(batches, centroids, pivots, pairs):
            for j in np.unique(cluster):
                own = x[cluster == j]
                total[j, :dimensions] += own.sum(axis=0).astype(object)
                total[j, dimensions] += len(own)
            total[0, dimensions + 1] += computed
        flat = [(i, Decimal(int(s))) for i, s in enumerate(total.ravel()) if s]
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in flat], pa.int32()), pa.array([s for _, s in flat], pa.decimal128(38, 0))],
            names=["slot", "part"],
        )

    parts = stored.mapInArrow(run, "slot int, part decimal(38,0)")
    summed = parts.groupBy("slot").agg(F.sum("part").cast("decimal(38,0)").alias("part"))
    total = np.zeros(len(centroids) * width, dtype=object)
    for r in summed.collect():  # clusters x dimensions numbers
        total[r["slot"]] = int(r["part"])
    total = total.reshape(len(centroids), width)
    return total[:, :dimensions], total[:, dimensions], total[0, dimensions + 1]


def moved(centroids: list[list[int]], sums: np.ndarray, members: np.ndarray) -> list[list[int]]:
    """Floors of the mean components; centroids without members stay."""
    return [[int(s) // int(n) for s in one] if n else c for c, one, n in zip(centroids, sums, members)]


def cluster(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    pairs: int = PAIRS,
) -> tuple[DataFrame, list[list[int]], list[float]]:
    """``(vec_id, cluster, distance)`` of the kept vectors, the centroids, and per round the share of
    all distances that was computed exactly.

    Rounds that would change nothing are left out. Vectors of another length, or with null or
    non-finite components, give no rows; repeated rows and null ids are vectors like others (a null id is
    the last to be a start). With fewer vectors than clusters every vector is a start. No vectors give no
    rows. Numbers beyond a long: a component counts as the nearest long, a distance is null.
    """
    spark = vectors.sparkSession
    prepare(spark)
    kept = materialize(kept_vectors(vectors, dimensions, scale))
    centroids = starts(kept, clusters)
    schema = "vec_id bigint, cluster int, distance bigint"
    if not centroids:
        return spark.createDataFrame([], schema), [], []
    pivots = [list(c) for c in centroids]
    stored = materialize(_with_pivots(kept, pivots))
    shares = []
    for _ in range(rounds):
        sums, members, computed = _round(stored, centroids, pivots, pairs)
        shares.append(int(computed) / (int(members.sum()) * len(centroids)))
        before, centroids = centroids, moved(centroids, sums, members)
        if centroids == before:
            break
    final = [list(c) for c in centroids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, best, least, _ in _assignments(batches, final, pivots, pairs):
            own = [int(d) if d <= _LONG else None for d in least] if least.dtype == object else least
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(best, pa.int32()), pa.array(own, pa.int64())],
                names=["vec_id", "cluster", "distance"],
            )

    return stored.mapInArrow(run, schema), final, shares


def digest(assigned: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """The assignments with the inertia of their cluster and of all, and their centroid's digest."""
    stored = materialize(assigned)
    sums = stored.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia"), F.bool_or(F.isnull("distance")).alias("open")
    )
    found = {r["cluster"]: None if r["open"] else int(r["inertia"]) for r in sums.collect()}  # one per cluster
    of = [found.get(j, 0) for j in range(len(centroids))]
    whole = None if None in of else sum(of)
    long = lambda n: F.lit(n if n is not None and n <= _LONG else None).cast("bigint")
    code = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    at = lambda values: F.get(F.array(*values), F.col("cluster")) if values else F.lit(None)
    return stored.select(
        "vec_id",
        "cluster",
        "distance",
        at([long(n) for n in of]).cast("bigint").alias("cluster_inertia"),
        long(whole).alias("inertia"),
        at([F.lit(c) for c in code]).cast("string").alias("centroid_sha256"),
    )
