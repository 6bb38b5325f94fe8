"""Grid and map expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The continental radar grid (columns, step and upper left corner in degrees).
GRID_COLUMNS, GRID_ROWS, GRID_STEP, GRID_WEST, GRID_NORTH = 7000, 3500, 0.01, -130.0, 55.0
# The continental equal-area projection on the GRS 80 ellipsoid.
AXIS, FLATTENING = 6378137.0, 1 / 298.257222101
PARALLELS, ORIGIN = (29.5, 45.5), (23.0, -96.0)


def cell_row(cell: Column) -> Column:
    return F.floor(cell / GRID_COLUMNS).cast("bigint")


def cell_column(cell: Column) -> Column:
    return F.pmod(cell, F.lit(GRID_COLUMNS)).cast("bigint")


def cell_lat(cell: Column) -> Column:
    """Latitude of a cell's centre."""
    return GRID_NORTH - (cell_row(cell) + 0.5) * GRID_STEP


def cell_lon(cell: Column) -> Column:
    return GRID_WEST + (cell_column(cell) + 0.5) * GRID_STEP


def cell_at(lat: Column, lon: Column) -> Column:
    """The cell that holds a point, null outside of the grid."""
    row, col = F.floor((GRID_NORTH - lat) / GRID_STEP), F.floor((lon - GRID_WEST) / GRID_STEP)
    return F.when((row >= 0) & (row < GRID_ROWS) & (col >= 0) & (col < GRID_COLUMNS), (row * GRID_COLUMNS + col).cast("bigint"))


def cell_km2(lat: Column) -> Column:
    """Area of a cell at a latitude, by the cosine rule."""
    return F.pow(F.lit(111.32 * GRID_STEP), 2) * F.cos(F.radians(lat))


def _q(sin_lat, e: float, log):
    return (1 - e * e) * (sin_lat / (1 - (e * sin_lat) * (e * sin_lat)) - log((1 - e * sin_lat) / (1 + e * sin_lat)) / (2 * e))


def equal_area_xy(lat: Column, lon: Column) -> tuple[Column, Column]:
    """Metres east and north of the projection's origin (conic equal-area, two standard parallels)."""
    e = math.sqrt(2 * FLATTENING - FLATTENING**2)
    p1, p2, p0 = (math.radians(x) for x in (*PARALLELS, ORIGIN[0]))
    m = [math.cos(p) / math.sqrt(1 - (e * math.sin(p)) ** 2) for p in (p1, p2)]
    q1, q2, q0 = (_q(math.sin(p), e, math.log) for p in (p1, p2, p0))
    n = (m[0] ** 2 - m[1] ** 2) / (q2 - q1)
    c = m[0] ** 2 + n * q1
    rho0 = AXIS * math.sqrt(c - n * q0) / n
    rho = AXIS * F.sqrt(c - n * _q(F.sin(F.radians(lat)), e, F.log)) / n
    theta = n * F.radians(lon - ORIGIN[1])
    return rho * F.sin(theta), rho0 - rho * F.cos(theta)


def ring_area(ring: Column) -> Column:
    """Signed area of a closed ring array<struct<x, y>> (counter-clockwise is positive)."""
    pairs = F.transform(F.sequence(F.lit(1), F.size(ring) - 1), lambda i: F.get(ring, i - 1)["x"] * F.get(ring, i)["y"] - F.get(ring, i)["x"] * F.get(ring, i - 1)["y"])
    return F.aggregate(pairs, F.lit(0.0), lambda a, x: a + x) / 2


def projected(rings: Column) -> Column:
    """Rings array<array<struct<x, y>>> of longitudes and latitudes in metres of the equal-area projection, vertex by vertex."""

    def point(p: Column) -> Column:
        x, y = equal_area_xy(p["y"], p["x"])
        return F.struct(x.alias("x"), y.alias("y"))

    return F.transform(rings, lambda ring: F.transform(ring, point))
