"""One row per key, latest rows and top rows, all with explicit tie-breakers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key in the given order.

    Spark limits the rank to 1 before the shuffle already, so at most one row per key
    and map task is moved: a key holding a large share of all rows is not a hot group.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def _newest_first(df: DataFrame, time: str, keys: Sequence[str]) -> list[Column]:
    order = [F.col(time).desc()]
    if "batch_id" in df.columns:
        order.append(F.col("batch_id").desc())
    rest = [c for c in df.columns if c not in {time, "batch_id", *keys}]
    return order + [F.col(c).asc_nulls_last() for c in rest]


def latest(df: DataFrame, key: str, *, time: str = "timestamp") -> DataFrame:
    """Newest row of each key; a later batch wins between equal times."""
    return one_per_key(df, [key], _newest_first(df, time, [key]))


def upsert_view(df: DataFrame, keys: Sequence[str] = ("icao24", "timestamp")) -> DataFrame:
    """Last write per primary key; rows without a complete key cannot be stored."""
    keyed = df.dropna(subset=list(keys))
    order = [F.col("batch_id").desc()] if "batch_id" in df.columns else []
    rest = [c for c in df.columns if c not in {"batch_id", *keys}]
    return one_per_key(keyed, keys, order + [F.col(c).asc_nulls_last() for c in rest])


def recent(df: DataFrame, order: Sequence[Column], limit: int) -> DataFrame:
    """First rows in ``order``, without a full sort."""
    return df.orderBy(*order).limit(limit)


def top(df: DataFrame, column: str, n: int, *, tie: str) -> DataFrame:
    """Rows with the ``n`` greatest values; rows without a value never rank."""
    ranked = df.where(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double")))
    return ranked.orderBy(F.col(column).desc(), F.col(tie)).limit(n)
