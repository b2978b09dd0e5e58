"""K-means clusters of aircraft by speed and altitude."""

from __future__ import annotations

import math

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEATURES = ["speed_kmh", "altitude"]
ROWS_PER_PARTITION = 200_000


def _spread(df: DataFrame) -> tuple[int, float]:
    spread = df.agg(
        F.count(F.lit(1)).alias("n"), sum(F.var_pop(c) for c in FEATURES).alias("v")
    ).first()
    return spread["n"], math.sqrt(1e-4 * (spread["v"] or 0.0) / len(FEATURES))


def stop_distance(df: DataFrame) -> float:
    """The fit of ``df`` ends when no centre moves farther than this."""
    return _spread(df)[1]


def centres(
    df: DataFrame, *, k: int = 3, seed: int = 42, key: str = "icao24", max_iter: int = 300
) -> list[tuple[float, ...]]:
    """At most ``k`` centres, counted up by speed, then altitude; none without rows.

    The features are used unscaled. The fit stops when the centres move less than 1 %
    of the features' mean spread. The starting centres depend on how rows are laid out,
    so for the fit the layout is made to follow from the rows alone (the number of
    partitions from their count).
    """
    rows, tolerance = _spread(df)
    if not rows:
        return []
    partitions = 1 + rows // ROWS_PER_PARTITION
    ordered = (
        df.select(key, *FEATURES).repartition(partitions, key).sortWithinPartitions(key, *FEATURES)
    )
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="_features")
    estimator = KMeans(k=k, seed=seed, maxIter=max_iter, tol=tolerance, featuresCol="_features")
    model = estimator.fit(assembler.transform(ordered).select("_features"))
    return sorted(tuple(float(x) for x in center) for center in model.clusterCenters())


def _squared_distance(centre: tuple[float, ...]) -> Column:
    return sum((F.pow(F.col(c) - x, 2) for c, x in zip(FEATURES, centre)), F.lit(0.0))


def assign(df: DataFrame, found: list[tuple[float, ...]]) -> DataFrame:
    """``df`` with the number of the nearest centre; the lower number between equals."""
    if not found:
        return df.withColumn("cluster", F.lit(0))
    distances = F.array(*[_squared_distance(centre) for centre in found])
    nearest = F.array_position(distances, F.array_min(distances)) - 1
    return df.withColumn("cluster", nearest.cast("int"))


def cluster(df: DataFrame, **options) -> DataFrame:
    """``df`` with a ``cluster`` number; ``options`` are those of ``centres``."""
    return assign(df, centres(df, **options))


def cluster_sizes(clustered: DataFrame) -> DataFrame:
    return clustered.groupBy("cluster").agg(F.count(F.lit(1)).alias("aircraft"))
