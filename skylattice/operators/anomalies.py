"""Isolation-forest anomalies (Liu, Ting and Zhou, 2008).

Every tree draws its own sample from all rows: a hash of (key, tree, seed) lets a row
through for a tree with a probability that gives about four samples' worth, and the
rows of the smallest hashes are the sample. That is one narrow pass whatever the size,
some thousand rows per tree are shuffled, and each tree is grown in its own group. The
forest (some hundred KB, bounded by trees x sample size) is broadcast and rows are
scored in Arrow batches.
Samples and splits derive from hashes of the row key and the seed, so the forest does
not depend on partitioning, task order or retries.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from ..sources.storage import materialize
from .quantiles import exact_quantiles

FEATURES = ["speed_kmh", "altitude", "vertical_rate"]
#: Rows a tree is grown on, unless told otherwise.
SAMPLE_ROWS = 256
#: Rows let through per sampled row; a shortfall is then out of reach.
SURPLUS = 4
REASON = "IsolationForest anomaly"  # fixed value
FLAG = -1.0  # fixed value: the stored score is the outlier label

_TREE = "tree int, feature array<int>, threshold array<double>, length array<double>"
_HASH_RANGE = 2**31 - 1


def _deal(df: DataFrame, key: str, rows: int, size: int, trees: int, seed: int) -> DataFrame:
    """(tree, features) rows: for each tree ``size`` rows of all, without repeats."""
    hashed = df.select(key, *[F.coalesce(c, F.lit(0.0)).alias(c) for c in FEATURES])
    cut = min(_HASH_RANGE, -(-SURPLUS * size * _HASH_RANGE // rows))
    draw = lambda tree: F.pmod(F.xxhash64(F.col(key), tree, F.lit(seed)), F.lit(_HASH_RANGE))
    through = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda tree: draw(tree) < cut)
    per_tree = hashed.withColumn("tree", F.explode(through))
    order = Window.partitionBy("tree").orderBy("_draw", key)
    return (
        per_tree.withColumn("_draw", draw(F.col("tree")))
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= size)
        .select("tree", "_rank", key, *FEATURES)
    )


def _grower(depth: int, seed: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    # Nested functions travel to the executors by value, so these need no installed
    # package there beyond numpy and pandas.
    columns = list(FEATURES)

    def mean_path(n: int) -> float:
        """Mean depth of an unsuccessful search among n points."""
        if n <= 1:
            return 0.0
        if n == 2:
            return 1.0
        return 2.0 * (np.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n

    def grow(sample: pd.DataFrame) -> pd.DataFrame:
        sample = sample.sort_values("_rank")
        tree = int(sample["tree"].iloc[0])
        points = sample[columns].to_numpy(dtype="float64")
        rng = np.random.default_rng([seed, tree])
        # Complete binary tree in an array; below an early leaf every path keeps its length.
        feature = np.zeros(2**depth - 1, dtype="int32")
        threshold = np.full(2**depth - 1, np.inf)
        length = np.zeros(2**depth)
        pending = [(0, 0, np.arange(len(points)))]
        while pending:
            node, level, members = pending.pop()
            inside = points[members]
            usable = np.flatnonzero(np.ptp(inside, axis=0) > 0) if len(members) > 1 else []
            if level == depth or len(usable) == 0:
                first = (node + 1) * 2 ** (depth - level) - 2**depth
                length[first : first + 2 ** (depth - level)] = level + mean_path(len(members))
                continue
            chosen = int(rng.choice(usable))
            values = inside[:, chosen]
            cut = rng.uniform(values.min(), values.max())
            feature[node], threshold[node] = chosen, cut
            right = values > cut
            pending.append((2 * node + 2, level + 1, members[right]))
            pending.append((2 * node + 1, level + 1, members[~right]))
        grown = {"tree": tree, "feature": feature, "threshold": threshold, "length": length}
        return pd.DataFrame({name: [value] for name, value in grown.items()})

    return grow


def _scorer(forest, depth: int, normal_path: float):
    @F.pandas_udf("double")
    def score(speed: pd.Series, altitude: pd.Series, rate: pd.Series) -> pd.Series:
        feature, threshold, length = forest.value
        points = np.column_stack([speed, altitude, rate]).astype("float64")
        rows = np.arange(len(points))
        total = np.zeros(len(points))
        for t in range(len(feature)):
            node = np.zeros(len(points), dtype="int64")
            for _ in range(depth):
                node = 2 * node + 1 + (points[rows, feature[t][node]] > threshold[t][node])
            total += length[t][node - (2**depth - 1)]
        return pd.Series(-np.exp2(-total / len(feature) / normal_path))

    return score


def _average_path(n: int) -> float:
    if n <= 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + float(np.euler_gamma)) - 2.0 * (n - 1.0) / n


def isolation_scores(
    df: DataFrame,
    *,
    rows: int,
    trees: int = 50,
    seed: int = 42,
    key: str = "icao24",
    sample_rows: int = SAMPLE_ROWS,
    held: list[Broadcast] | None = None,
    grown_trees: list[Row] | None = None,
) -> DataFrame:
    """``df`` with ``isolation_score`` in (-1, 0); the lower, the more isolated.

    ``key`` must be unique, ``rows`` is the row count of ``df``. Each tree is grown on
    ``sample_rows`` rows, or on all where there are fewer. The broadcast forest is added to
    ``held``, for the caller to release once the scores are stored, and its trees to ``grown_trees``.
    """
    size = min(sample_rows, rows)
    depth = max(1, math.ceil(math.log2(max(size, 2))))
    samples = _deal(df, key, rows, size, trees, seed).drop(key)
    grown = samples.groupBy("tree").applyInPandas(_grower(depth, seed), _TREE)
    forest = sorted(grown.collect(), key=lambda t: t["tree"])  # one bounded row per tree
    arrays = tuple(
        np.array([t[part] for t in forest]) for part in ("feature", "threshold", "length")
    )
    if grown_trees is not None:
        grown_trees.extend(forest)
    shared = df.sparkSession.sparkContext.broadcast(arrays)
    if held is not None:
        held.append(shared)
    score = _scorer(shared, depth, _average_path(size))
    features = [F.coalesce(c, F.lit(0.0)) for c in FEATURES]
    return df.withColumn("isolation_score", score(*features))


def flag_outliers(scored: DataFrame, *, contamination: float = 0.05) -> DataFrame:
    """Rows scored below the ``contamination`` quantile, labelled as in the stored log.

    ``scored`` is read more than once, so it should be stored or persisted.
    """
    limit = exact_quantiles(scored, "isolation_score", [contamination])[0]
    outliers = scored.where(F.col("isolation_score") < limit)
    return outliers.drop("isolation_score").withColumns(
        {"anomaly_score": F.lit(FLAG), "reason": F.lit(REASON)}
    )


def stored_scores(
    df: DataFrame,
    *,
    trees: int = 50,
    seed: int = 42,
    key: str = "icao24",
    sample_rows: int = SAMPLE_ROWS,
    grown_trees: list[Row] | None = None,
) -> DataFrame:
    """``df`` with its isolation scores, stored in the shared folder.

    ``df`` itself is read three times (count, sample, scores): store it beforehand if it
    is costly to compute.
    """
    rows = df.count()
    if rows == 0:
        return df.withColumn("isolation_score", F.lit(None).cast("double"))
    held: list[Broadcast] = []
    options = {"trees": trees, "seed": seed, "key": key, "sample_rows": sample_rows, "grown_trees": grown_trees}
    scored = materialize(isolation_scores(df, rows=rows, held=held, **options))
    for forest in held:
        forest.destroy()
    return scored


def walked_scores(df: DataFrame, forest: Sequence[Row], *, size: int) -> DataFrame:
    """``df`` with ``walked_score``: the same trees walked by array functions, for checks.

    ``size`` is the number of rows each tree was grown on.
    """
    trees = [{part: list(t[part]) for part in ("feature", "threshold", "length")} for t in forest]
    kind = "array<struct<feature:array<int>, threshold:array<double>, length:array<double>>>"
    stored = F.from_json(F.lit(json.dumps(trees)), kind)  # a constant of bounded size
    inner = len(trees[0]["feature"]) if trees else 0
    levels = F.sequence(F.lit(1), F.lit((inner + 1).bit_length() - 1))
    point = F.array(*[F.coalesce(c, F.lit(0.0)).cast("double") for c in FEATURES])

    def length(tree: Column) -> Column:
        def step(node: Column, _: Column) -> Column:
            beyond = F.get(point, F.get(tree["feature"], node)) > F.get(tree["threshold"], node)
            return 2 * node + 1 + beyond.cast("int")

        return F.get(tree["length"], F.aggregate(levels, F.lit(0), step) - inner)

    total = F.aggregate(stored, F.lit(0.0), lambda sum_, tree: sum_ + length(tree))
    path = total / max(1, len(trees)) / _average_path(size)
    return df.withColumn("walked_score", -F.pow(F.lit(2.0), -path))


def anomalies(df: DataFrame, *, contamination: float = 0.05, **options) -> DataFrame:
    """The most isolated share of ``df``; ``options`` are those of ``stored_scores``."""
    return flag_outliers(stored_scores(df, **options), contamination=contamination)
