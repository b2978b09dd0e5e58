"""Flights to nearby airports: a band join done as an equi-join on grid cells.

``|a - b| < r`` on both axes puts the two points in the same or in neighbouring cells
of a grid of width ``r``. Each airport is therefore copied to its 3 x 3 cells, each
flight stays in exactly one, and the band condition is kept as a residual filter: no
pair is lost or doubled, and Spark plans a hash join instead of a nested loop.

The airports of a cell are packed into one row, so a flight meets one row of the join and its pairs are
listed from the packed array: neighbours in memory, compared in generated code, with the flight's own
columns computed once and not once per pair (as they are inside the loop of a join with many matches). Only
where a cell holds more than ``MAX_PACKED`` airports they stay rows, so that no row grows without bound.

The flights, the large side, are not moved while the airport cells fit in a broadcast;
that is checked by measuring the reference table. Beyond the limit both sides are
shuffled on the cell, and adaptive skew handling splits cells that hold very many
flights (it splits by ranges of map output, so copies of one row are split as well).

Sums over the pairs need no row per pair. ``counted_join`` counts: the cells are split into ``parts``
a side; airports whose cell lies within reach of every point of a flight's cell are summed there by
region beforehand, and only those in the cells at the rim are compared one by one. ``parts`` grows
with the square root of the density, so the rows per flight do, too, not with the number of airports.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import flight
from ..sources.storage import materialize
from .spots import MAX_COMPARED, MAX_SPOTS, broadcast_spots, region_sums

CELLS_PER_AIRPORT = 9
#: Limit on the measured size of the replicated airports for them to be broadcast.
MAX_BROADCAST_BYTES = 256 * 1024 * 1024
#: Airports of one cell that are packed into a row.
MAX_PACKED = 100_000
#: Airports in reach from which flights are compared in their tasks (``spots``): a join moves fewer rows below.
DENSE = 30
_ROW_BYTES = 96  # fixed part of a hashed row: header, keys, two doubles, offsets
_FARTHEST = 2.0**53  # in cells; numbers beyond have no fraction left
_CELL = ("_cell_lat", "_cell_lon")
_NEAR, _AIRPORT = "_near", "_airport"
#: Parts of a cell's side: the width whose airports are summed, and the factors it is summed in.
_PARTS = {2: (), 3: (3,), 4: (5,), 6: (3, 3), 9: (3, 5), 15: (3, 3, 3), 24: (3, 3, 5), 42: (3, 3, 3, 3)}


def _width(radius: float, parts: int = 1) -> float:
    # A hair wider than the radius, so that rounding in the division cannot put two
    # points less than one radius apart two cells (``parts`` + 1 of its parts) away from each other.
    return radius * (1 + 1e-9) / parts


def _cells(lat, lon, radius: float, parts: int = 1):
    width = _width(radius, parts)
    return F.floor(lat / width), F.floor(lon / width)


def replicated_bytes(airports: DataFrame) -> int:
    """Measured size of the airport cells: one small aggregation over the table."""
    sizes = [_bytes(field) for field in airports.schema.fields]
    row = airports.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(sum(sizes, F.lit(0))), F.lit(0)).alias("b")
    ).first()
    return CELLS_PER_AIRPORT * (row["n"] * _ROW_BYTES + row["b"])


def _bytes(field: T.StructField):
    """Size of a value, whatever column the table brings along."""
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0))
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(value))), F.lit(0))
    return F.lit(8)


def fits_broadcast(airports: DataFrame, limit: int = MAX_BROADCAST_BYTES) -> bool:
    return replicated_bytes(airports) <= limit


def _placed(radius: float):
    return (F.abs("ap_lat") < _FARTHEST * radius) & (F.abs("ap_lon") < _FARTHEST * radius)


def airport_cells(airports: DataFrame, *, radius: float = 1.0) -> DataFrame:
    """Airports with a position, once per cell that can hold a flight in reach.

    A position that is not finite, or too far out to have a cell, is near nothing.
    """
    lat, lon = _cells(F.col("ap_lat"), F.col("ap_lon"), radius)
    around = [
        F.struct((lat + i).alias(_CELL[0]), (lon + j).alias(_CELL[1]))
        for i in (-1, 0, 1)
        for j in (-1, 0, 1)
    ]
    return (
        airports.where(_placed(radius))
        .withColumn("_cell", F.explode(F.array(*around)))
        .select("*", "_cell.*")
        .drop("_cell")
    )


def packed(airports: DataFrame, *, radius: float = 1.0) -> bool:
    """Whether the airports of every cell, as ``airport_cells`` has them, fit one row."""
    lat, lon = _cells(F.col("ap_lat"), F.col("ap_lon"), radius)
    counts = airports.where(_placed(radius)).groupBy(lat.alias("i"), lon.alias("j")).agg(F.count(F.lit(1)).alias("n"))
    return CELLS_PER_AIRPORT * (counts.agg(F.max("n")).first()[0] or 0) <= MAX_PACKED


def packed_cells(airports: DataFrame, *, radius: float = 1.0) -> DataFrame:
    """``airport_cells`` with one row per cell, its airports in an array."""
    entry = F.struct(*[F.col(f"`{name}`") for name in airports.columns])
    # Grouped by one struct, so that a shuffled join deals the cells out itself: only then hot ones are split.
    grouped = airport_cells(airports, radius=radius).groupBy(F.struct(*_CELL).alias("_cell"))
    return grouped.agg(F.collect_list(entry).alias(_NEAR)).select("_cell.*", _NEAR)


def prepared_cells(airports: DataFrame, *, radius: float = 1.0) -> DataFrame:
    """The airports' side of ``airport_join``."""
    return (packed_cells if packed(airports, radius=radius) else airport_cells)(airports, radius=radius)


def airport_join(
    flights: DataFrame,
    airports: DataFrame,
    *,
    radius: float = 1.0,
    small: bool | None = None,
    cells: DataFrame | None = None,
) -> DataFrame:
    """Every flight with every airport less than ``radius`` degrees away on both axes.

    A flight near n airports gives n rows, one near none gives one row with nulls.
    Distances do not wrap at the date line. ``small`` tells the outcome of
    ``fits_broadcast`` where the caller has measured the airports already, ``cells`` gives their
    ``prepared_cells`` where they are stored.
    """
    if small is None:
        small = fits_broadcast(airports)
    right = prepared_cells(airports, radius=radius) if cells is None else cells
    listed = _NEAR not in right.columns
    right = F.broadcast(right) if small else right.hint("merge")
    lat, lon = _cells(F.col("latitude"), F.col("longitude"), radius)
    left = flights.withColumns({"_lat": lat, "_lon": lon})
    near = (left["_lat"] == right[_CELL[0]]) & (left["_lon"] == right[_CELL[1]])

    def close(airport) -> Column:
        return (F.abs(left["latitude"] - airport["ap_lat"]) < radius) & (
            F.abs(left["longitude"] - airport["ap_lon"]) < radius
        )

    if listed:
        return left.join(right, near & close(right), "left").drop("_lat", "_lon", *_CELL)
    met = left.join(right, near, "left")
    # Looked for up to the first one in reach; a flight without any lists nothing, which is one null.
    met = met.withColumn(_NEAR, F.when(F.exists(_NEAR, close), F.col(_NEAR)))
    pairs = met.select(*[left[f"`{name}`"] for name in flights.columns], F.explode_outer(_NEAR).alias(_AIRPORT))
    airport = F.col(_AIRPORT)
    pairs = pairs.where(airport.isNull() | close(airport))
    return pairs.select(*[F.col(f"`{name}`") for name in flights.columns], f"{_AIRPORT}.*")


@dataclass(frozen=True)
class CountedCells:
    """Airports ready for ``counted_join``: rows by cell, with a position where they must be compared."""

    rows: DataFrame
    radius: float
    parts: int
    small: bool
    spots: Broadcast | None = None  # all airports, where flights are compared with them in their tasks


def _density(airports: DataFrame, radius: float) -> tuple[int, float]:
    """Number of airports, and how many an airport has in reach of itself, about."""
    lat, lon = _cells(F.col("ap_lat"), F.col("ap_lon"), radius)
    counts = airports.where(_placed(radius)).groupBy(lat.alias("i"), lon.alias("j")).agg(F.count(F.lit(1)).alias("n"))
    row = counts.agg(F.sum("n").alias("n"), F.sum(F.col("n").cast("double") * F.col("n")).alias("pairs")).first()
    return (row["n"], 4 * row["pairs"] / row["n"]) if row["n"] else (0, 0.0)


def _around(df: DataFrame, steps, value: str, stride: int = 1) -> DataFrame:
    moved = F.explode(F.array(*[F.col(value) + step * stride for step in steps]))
    return df.withColumn(value, moved)


def _capacities(airports: DataFrame, radius: float, parts: int) -> DataFrame:
    """Airports with a position: cell, region and base capacity of each."""
    lat, lon = _cells(F.col("ap_lat"), F.col("ap_lon"), radius, parts)
    return airports.where(_placed(radius)).select(
        lat.alias(_CELL[0]),
        lon.alias(_CELL[1]),
        "ap_lat",
        "ap_lon",
        "iso_region",
        F.lit(1).cast("bigint").alias("airports"),
        flight.base_capacity(F.col("type")).cast("bigint").alias("base_capacity"),
    )


def counted_cells(airports: DataFrame, *, radius: float = 1.0, parts: int | None = None) -> CountedCells:
    """Airports by the cells they are in reach of: number and capacity, by region.

    With p parts to a side, an airport at most p - 2 cells away on both axes is in reach of every point
    of a cell, one more than p cells away of none. Sums over the first are taken in steps of 3 or 5 cells,
    so no step multiplies the rows by more.
    """
    n, density = _density(airports, radius)
    spots = None
    if parts is None:
        parts = max([p for p in _PARTS if 2 * p * p <= density], default=1)
        if density >= DENSE and n <= MAX_SPOTS and CELLS_PER_AIRPORT / 4 * density <= MAX_COMPARED:
            spots = broadcast_spots(_capacities(airports, radius, 1), _CELL)
    placed = _capacities(airports, radius, parts)
    reach = range(-parts, parts + 1)
    rim = [(i, j) for i in reach for j in reach if max(abs(i), abs(j)) >= parts - 1]
    if parts == 1:
        small = fits_broadcast(airports)
    else:
        small = n * (len(rim) + (2 * parts - 3) ** 2) * (_ROW_BYTES + 32) <= MAX_BROADCAST_BYTES
    around = [F.struct((F.col(_CELL[0]) + i).alias("i"), (F.col(_CELL[1]) + j).alias("j")) for i, j in rim]
    rows = placed.withColumn("_at", F.explode(F.array(*around))).withColumns(
        {_CELL[0]: F.col("_at.i"), _CELL[1]: F.col("_at.j")}
    ).drop("_at")
    if parts > 1:
        keys = [*_CELL, "iso_region"]
        sums = [F.sum(c).alias(c) for c in ("airports", "base_capacity")]
        inner = placed.groupBy(*keys).agg(*sums)
        for axis in _CELL:
            stride = 1
            for factor in _PARTS[parts]:
                half = factor // 2
                inner = _around(inner, range(-half, half + 1), axis, stride).groupBy(*keys).agg(*sums)
                stride *= factor
        nowhere = F.lit(None).cast("double")
        rows = rows.unionByName(inner.withColumns({"ap_lat": nowhere, "ap_lon": nowhere}))
    return CountedCells(rows, radius, parts, small, spots)


def stored_cells(cells: CountedCells) -> CountedCells:
    """The same cells from files, for callers that join more than once."""
    return cells if cells.spots else replace(cells, rows=materialize(cells.rows))


def counted_join(flights: DataFrame, cells: CountedCells) -> DataFrame:
    """Every flight with the airports of ``airport_join`` in groups of one region.

    A row has ``iso_region``, the number of ``airports`` it stands for, and the sum of their
    ``base_capacity``. There may be several rows of a region; a flight near no airport has one row, which counts once.
    """
    if cells.spots:
        sums = region_sums(cells.spots, cells.radius, _width(cells.radius))
        met = flights.withColumn(_NEAR, sums(F.col("latitude").cast("double"), F.col("longitude").cast("double")))
        own = [F.col(f"`{name}`") for name in flights.columns]
        return _with_alone(met.select(*own, F.explode_outer(_NEAR).alias(_AIRPORT)).select(*own, f"{_AIRPORT}.*"))
    right = F.broadcast(cells.rows) if cells.small else cells.rows.hint("merge")
    lat, lon = _cells(F.col("latitude"), F.col("longitude"), cells.radius, cells.parts)
    left = flights.withColumns({"_lat": lat, "_lon": lon})
    close = (F.abs(left["latitude"] - right["ap_lat"]) < cells.radius) & (
        F.abs(left["longitude"] - right["ap_lon"]) < cells.radius
    )
    if cells.parts > 1:
        close = right["ap_lat"].isNull() | close
    near = (left["_lat"] == right[_CELL[0]]) & (left["_lon"] == right[_CELL[1]]) & close
    counted = left.join(right, near, "left").drop("_lat", "_lon", *_CELL, "ap_lat", "ap_lon")
    return _with_alone(counted)


def _with_alone(counted: DataFrame) -> DataFrame:
    """A flight near no airport counts once."""
    alone = flight.base_capacity(F.lit(None).cast("string")).cast("bigint")
    return counted.withColumns(
        {"airports": F.coalesce("airports", F.lit(1).cast("bigint")), "base_capacity": F.coalesce("base_capacity", alone)}
    )
