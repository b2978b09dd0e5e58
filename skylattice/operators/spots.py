"""Airports in reach counted by region, beside the flights: no cells are shuffled.

All airports are broadcast once (24 bytes each, sorted by grid cell), so a flight stays in its task. The
flights of some batches are taken together by cell; those of one cell are compared with the airports of
the 3 x 3 cells around it as one block of numbers, and sums by region are taken along its rows. The
comparison is that of the join, in the same double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Airports that are broadcast at most, and compared with one flight at most on average.
MAX_SPOTS = 2_000_000
MAX_COMPARED = 10_000
#: Flights taken together, and numbers of a block.
_TOGETHER, _BLOCK = 200_000, 500_000
_SUMS = "array<struct<iso_region: string, airports: bigint, base_capacity: bigint>>"


def broadcast_spots(placed: DataFrame, cell: tuple[str, str]) -> Broadcast:
    """Airports with a cell, a position, ``iso_region`` and ``base_capacity``, for ``region_sums``."""
    table = placed.select(*cell, "ap_lat", "ap_lon", "iso_region", "base_capacity").toArrow()
    row, column, lat, lon, capacity = (
        table[name].to_numpy() for name in (*cell, "ap_lat", "ap_lon", "base_capacity")
    )
    names = table["iso_region"].combine_chunks().dictionary_encode(null_encoding="encode")
    region = names.indices.to_numpy()
    order = np.lexsort((capacity, region, column, row))
    at = np.column_stack([row, column])[order]
    first = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]).any(axis=1)]) if len(at) else np.zeros(0, dtype=int)
    ends = np.r_[first[1:], len(at)]
    where = {(int(i), int(j)): (int(a), int(b)) for (i, j), a, b in zip(at[first], first, ends)}
    content = {
        "where": where,
        "lat": lat[order],
        "lon": lon[order],
        "region": region[order].astype("int32"),
        "capacity": capacity[order],
        "names": names.dictionary.to_pylist(),
    }
    return placed.sparkSession.sparkContext.broadcast(content)


def region_sums(spots: Broadcast, radius: float, width: float):
    """Column function of latitude and longitude: number and capacity of the airports in reach by region.

    Null where no airport is in reach. ``width`` is that of the cells.
    """
    together, block = _TOGETHER, _BLOCK

    # Nested functions travel to the executors by value, so these need no installed
    # package there beyond numpy and Arrow.
    def around(spot, i: int, j: int):
        """Airports of the cells around one, by region and capacity."""
        found = [spot["where"].get((i + a, j + b)) for a in (-1, 0, 1) for b in (-1, 0, 1)]
        parts = [np.arange(*part) for part in found if part]
        if not parts:
            return None
        at = np.concatenate(parts)
        region, capacity = spot["region"][at], spot["capacity"][at]
        order = np.lexsort((capacity, region))
        at, region, capacity = at[order], region[order], capacity[order]
        kinds = np.flatnonzero(np.r_[True, (region[1:] != region[:-1]) | (capacity[1:] != capacity[:-1])])
        regions = np.flatnonzero(np.r_[True, region[kinds][1:] != region[kinds][:-1]])
        return spot["lat"][at], spot["lon"][at], kinds, capacity[kinds], regions, region[kinds][regions]

    def counted(lat, lon, near):
        """(row, region, airports, capacity) of flights of one cell, rows in order."""
        ap_lat, ap_lon, kinds, capacity, regions, names = near
        away = lat[:, None] - ap_lat
        close = np.abs(away, out=away) < radius
        np.subtract(lon[:, None], ap_lon, out=away)
        close &= np.abs(away, out=away) < radius
        n = np.add.reduceat(close.view("uint8"), kinds, axis=1, dtype="int64")
        airports = np.add.reduceat(n, regions, axis=1)
        places = np.add.reduceat(n * capacity, regions, axis=1)
        row, column = np.nonzero(airports)
        return row, names[column], airports[row, column], places[row, column]

    def sums(lat, lon):
        spot = spots.value
        found = []
        with np.errstate(invalid="ignore"):
            usable = (np.abs(lat) < 2.0**53 * radius) & (np.abs(lon) < 2.0**53 * radius)  # not so for NaN
        rows = np.flatnonzero(usable)
        i, j = np.floor(lat[rows] / width).astype("int64"), np.floor(lon[rows] / width).astype("int64")
        order = np.lexsort((j, i))
        rows, i, j = rows[order], i[order], j[order]
        starts = np.flatnonzero(np.r_[True, (i[1:] != i[:-1]) | (j[1:] != j[:-1])]) if len(rows) else []
        for start, end in zip(starts, [*starts[1:], len(rows)]):
            near = around(spot, int(i[start]), int(j[start]))
            if near is None:
                continue
            step = max(1, block // len(near[0]))
            for low in range(start, end, step):
                some = rows[low : min(low + step, end)]
                row, region, airports, places = counted(lat[some], lon[some], near)
                found.append((some[row], region, airports, places))
        if not found:
            return pa.nulls(len(lat), kind)
        row, region, airports, places = (np.concatenate(part) for part in zip(*found))
        order = np.argsort(row, kind="stable")
        lengths = np.bincount(row, minlength=len(lat))
        offsets = np.r_[0, np.cumsum(lengths)].astype("int32")
        names = pa.array(spot["names"], pa.string()).take(pa.array(region[order]))
        entries = pa.StructArray.from_arrays(
            [names, pa.array(airports[order]), pa.array(places[order])], fields=list(kind.value_type)
        )
        return pa.ListArray.from_arrays(pa.array(offsets), entries, type=kind, mask=pa.array(lengths == 0))

    kind = pa.list_(
        pa.struct([("iso_region", pa.string()), ("airports", pa.int64()), ("base_capacity", pa.int64())])
    )

    def number(values):
        return values.cast("float64").fill_null(float("nan")).to_numpy(zero_copy_only=False)

    def each(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        held, size = [], 0
        for lat, lon in batches:
            held.append((number(lat), number(lon)))
            size += len(lat)
            if size >= together:
                yield sums(*(np.concatenate(part) for part in zip(*held)))
                held, size = [], 0
        if held:
            yield sums(*(np.concatenate(part) for part in zip(*held)))

    return F.arrow_udf(each, _SUMS)
