"""Radius join on great-circle distance, blocked on a latitude-band grid.

Spark has no spatial join; a plain theta join would be planned as a
nested loop.  Build rows have one cell of a grid; a probe row goes to each
cell that its circle can touch, so every qualifying pair shares exactly one
cell.  The join is then an equi-join on ``(band, cell)`` followed by the exact
haversine filter.

Grid (r miles, theta = r / R, s cells of r a side):
* band = floor((lat + 90) / h), h = s * degrees(theta), at least 1e-4;
* in band b, w(b) is the largest longitude gap that a point of the band and one within
  r of it can have, taken at the largest |lat| of the two; the cell count is
  n(b) = floor(360 / (s * w(b))), or one around the poles.  Cells are 360 / n(b)
  wide, so the ring closes exactly at the antimeridian.
With s = 2 a circle touches four cells on average, with s = 1 it would be nine.

A cell (and blocking key) that holds very many rows is dealt out in block pairs
(``joins.dealt_join``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placekit.functions.geo import EARTH_RADIUS_MILES, haversine_miles
from placekit.operators.joins import BLOCK_ROWS
from placekit.operators.name_blocks import blocked_join
from placekit.session import materialize

_MARGIN = 1 + 1e-9
SIDE = 2


def folded(lat: Column, lon: Column) -> tuple[Column, Column]:
    """The same point of the sphere with a latitude within -90..90: the
    haversine formula takes any angle, so a row with a latitude out of range
    still has its partners."""
    turn = F.pmod(lat, F.lit(360.0))
    over = F.abs(lat) > 90.0
    back = over & (turn > 90.0) & (turn < 270.0)
    return (F.when(back, F.lit(180.0) - turn).when(over & (turn >= 270.0), turn - 360.0)
             .when(over, turn).otherwise(lat),
            F.when(back, lon + 180.0).otherwise(lon))


class Grid:
    """The grid of a radius; its methods add columns, so that each step is
    computed once per row."""

    def __init__(self, radius_miles: float, side: float = SIDE):
        theta = max(float(radius_miles), 1e-9) / EARTH_RADIUS_MILES
        self.reach = max(math.degrees(theta), 1e-4) * _MARGIN
        self.h = self.reach * side
        self.side = side
        self.sin_half = math.sin(min(theta, math.pi) / 2)

    def _points(self, df: DataFrame, lat: Column, lon: Column) -> DataFrame:
        lat, lon = folded(lat, lon)
        return df.withColumn("_lat", lat + F.lit(90.0)).withColumn("_lon", lon + F.lit(180.0))

    def _cells(self, df: DataFrame) -> DataFrame:
        """Add the gap ``_w`` and the cell count ``_n`` of ``_band``."""
        low = F.col("_band").cast("double") * F.lit(self.h) - F.lit(90.0 + self.reach)
        high = low + F.lit(self.h + 2 * self.reach)
        most = F.least(F.greatest(F.abs(low), F.abs(high)), F.lit(90.0))
        df = df.withColumn("_cos", F.cos(F.radians(most)))
        ring = F.col("_cos") <= F.lit(self.sin_half)
        gap = F.degrees(F.lit(2.0) * F.asin(F.lit(self.sin_half) / F.col("_cos"))) * F.lit(_MARGIN)
        df = df.withColumn("_w", F.when(ring, F.lit(360.0)).otherwise(gap))
        return df.withColumn("_n", F.greatest(F.lit(1), F.floor(F.lit(360.0 / self.side) / F.col("_w")).cast("int")))

    @staticmethod
    def _cell(lon: Column) -> Column:
        return F.floor(lon * F.col("_n").cast("double") / F.lit(360.0)).cast("int")

    def home(self, df: DataFrame, lat: Column, lon: Column) -> DataFrame:
        """Add ``_band`` and ``_cell`` of each row."""
        df = self._points(df, lat, lon).withColumn("_band", F.floor(F.col("_lat") / F.lit(self.h)).cast("int"))
        df = self._cells(df).withColumn("_cell", F.pmod(self._cell(F.col("_lon")), F.col("_n")))
        return df.drop("_lat", "_lon", "_cos", "_w", "_n")

    def touched(self, df: DataFrame, lat: Column, lon: Column) -> DataFrame:
        """A row for each ``(_band, _cell)`` that the circle round the row touches."""
        band = lambda x: F.floor(x / F.lit(self.h)).cast("int")
        df = self._points(df, lat, lon)
        df = df.withColumn("_band", F.explode(F.sequence(
            band(F.col("_lat") - F.lit(self.reach)), band(F.col("_lat") + F.lit(self.reach)))))
        df = self._cells(df)
        first, last = (self._cell(F.col("_lon") + F.lit(sign) * F.col("_w")) for sign in (-1.0, 1.0))
        # a ring of few cells is touched as a whole, each cell once
        last = F.least(last, first + F.col("_n") - 1)
        df = df.withColumn("_cell", F.explode(F.sequence(first, last)))
        return df.withColumn("_cell", F.pmod("_cell", "_n")).drop("_lat", "_lon", "_cos", "_w", "_n")


def radius_join(build: DataFrame, probe: DataFrame, radius_miles: float,
                build_coords=("latitude", "longitude"),
                probe_coords=("latitude", "longitude"),
                distance_col: str = "distance_miles", blocking=None,
                block: int = BLOCK_ROWS, side: float = SIDE) -> DataFrame:
    """All (build, probe) pairs within ``radius_miles`` (both coordinates non-null).

    Column names of the two sides must not collide.  ``probe`` is the side that
    is copied to the cells it touches; pass the smaller side there.  An optional
    ``blocking`` (see ``name_blocks``) narrows each cell by further keys.
    """
    grid = Grid(radius_miles, side)
    blat, blon = (F.col(c) for c in build_coords)
    plat, plon = (F.col(c) for c in probe_coords)
    # written once: the count pass and the join read them
    b = grid.home(materialize(build.filter(blat.isNotNull() & blon.isNotNull())), blat, blon)
    p = grid.touched(materialize(probe.filter(plat.isNotNull() & plon.isNotNull())), plat, plon)
    keys = ["_band", "_cell"]
    pairs = blocked_join(b, p, keys, blocking, block).drop(*keys)
    pairs = pairs.withColumn(distance_col, haversine_miles(blat, blon, plat, plon))
    return pairs.filter(F.col(distance_col) <= F.lit(float(radius_miles)))
