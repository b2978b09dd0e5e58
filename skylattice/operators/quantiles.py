"""Exact quantiles of a column of any size, by one algorithm at every size.

The wanted ranks are located by refining histograms: each pass counts the values of the
still interesting intervals in equal-width bins (at most ``BINS`` groups per interval,
summed map-side), keeps the bin that holds the rank and narrows the interval to the
values really present in it. An interval is finished when all its values are equal, so
repeated values end it early. Infinite values are counted, never binned, and no task or
the driver holds more than the bins.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 4096


@dataclass
class _Search:
    """The value at ``rank`` (0-based) lies in [low, high], ``below`` values lie under low."""

    rank: int
    low: float
    high: float
    below: int = 0

    @property
    def found(self) -> bool:
        return self.low == self.high


def exact_quantiles(
    df: DataFrame, column: str, probabilities: Sequence[float]
) -> list[float | None]:
    """Quantiles with linear interpolation between neighbouring ranks; null and NaN ignored.

    ``df`` is read several times, so it should be stored or cheap to recompute.
    """
    values = df.select(F.col(column).cast("double").alias("v"))
    values = values.where("v is not null and not isnan(v)")
    infinite = math.inf
    finite = F.when(F.abs("v") < infinite, F.col("v"))
    span = values.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("v") == -infinite).alias("lowest"),
        F.count(finite).alias("finite"),
        F.min(finite).alias("low"),
        F.max(finite).alias("high"),
    ).first()
    n = span["n"]
    if not n:
        return [None] * len(probabilities)
    positions = [p * (n - 1) for p in probabilities]
    ranks = sorted({r for x in positions for r in (int(x), min(int(x) + 1, n - 1))})
    ends = span["lowest"], span["lowest"] + span["finite"]
    at = {r: -infinite if r < ends[0] else infinite for r in ranks if not ends[0] <= r < ends[1]}
    inside = [r - ends[0] for r in ranks if ends[0] <= r < ends[1]]
    found = _select(values.where(F.abs("v") < infinite), inside, span["low"], span["high"])
    at |= {r + ends[0]: value for r, value in found.items()}
    return [_between(at[int(x)], at[min(int(x) + 1, n - 1)], x - int(x)) for x in positions]


def _between(low: float, high: float, part: float) -> float:
    if part == 0 or low == high:
        return low
    step = high - low
    # Neighbours further apart than the greatest number: weighed one by one.
    return low + part * step if step < math.inf else (1 - part) * low + part * high


def _select(values: DataFrame, ranks: Sequence[int], low: float, high: float) -> dict[int, float]:
    searches = [_Search(rank, low, high) for rank in ranks]
    while not all(s.found for s in searches):
        intervals = sorted({(s.low, s.high) for s in searches if not s.found})
        histograms = _histograms(values, intervals)
        for s in searches:
            if not s.found:
                _narrow(s, histograms[intervals.index((s.low, s.high))])
    return {s.rank: s.low for s in searches}


def _bin(v: Column, low: float, high: float) -> Column:
    """Bin of a value in [low, high]: the two ends never share one, so every pass narrows."""
    if high - low < math.inf:
        share = (v - low) / (high - low)
    else:
        share = (v / 2 - low / 2) / (high / 2 - low / 2)
    return F.least(F.floor(share * BINS), F.lit(BINS - 1))


def _histograms(values: DataFrame, intervals: Sequence[tuple[float, float]]) -> dict[int, list]:
    """Per interval its filled bins in order: count, smallest and greatest value."""
    v = F.col("v")
    # Intervals are equal or disjoint, so a value belongs to one of them at most.
    place = F.coalesce(
        *[
            F.when(
                v.between(low, high),
                F.struct(F.lit(i).alias("interval"), _bin(v, low, high).alias("bin")),
            )
            for i, (low, high) in enumerate(intervals)
        ]
    )
    binned = values.select("v", place.alias("at")).where("at is not null")
    rows = (
        binned.groupBy("at.interval", "at.bin")
        .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        .collect()  # at most BINS rows per interval, whatever the size of the data
    )
    histograms: dict[int, list] = {}
    for row in sorted(rows, key=lambda r: (r["interval"], r["bin"])):
        histograms.setdefault(row["interval"], []).append(row)
    return histograms


def _narrow(search: _Search, histogram: list) -> None:
    below = search.below
    for row in histogram:
        if search.rank < below + row["n"]:
            if (row["low"], row["high"]) == (search.low, search.high):
                raise RuntimeError("a pass did not narrow its interval")
            search.low, search.high, search.below = row["low"], row["high"], below
            return
        below += row["n"]
    raise RuntimeError("the input changed between two passes")
