"""Grid definitions and grid arithmetic."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from floegrid.functions.projection import EPSG3411, EPSG3413, PolarCrs


@dataclass(frozen=True)
class Grid:
    """North-up raster grid: upper-left corner, cell size and shape."""
    crs: str
    west: float
    north: float
    res_x: float
    res_y: float
    width: int
    height: int

    @property
    def n_cells(self) -> int:
        return self.width * self.height

    @property
    def polar(self) -> PolarCrs | None:
        return {"EPSG:3413": EPSG3413, "EPSG:3411": EPSG3411}.get(self.crs)

    @property
    def bounds(self) -> tuple[float, float, float, float]:
        return (self.west, self.north - self.height * self.res_y,
                self.west + self.width * self.res_x, self.north)


# The target and source grids.
ARCTIC_10KM = Grid("EPSG:3413", -3850000.0, 5850000.0, 10000.0, 10000.0, 760, 1120)
ARCTIC_40M = Grid("EPSG:3413", -3400000.0, 3400000.0, 40.0, 40.0, 170000, 170000)
SEA_ICE_SOURCE = Grid("EPSG:3411", -3850000.0, 5850000.0, 10000.0, 10000.0, 760, 1120)
WEATHER_SOURCE = Grid("EPSG:4326", -180.125, 90.125, 0.25, 0.25, 1440, 721)
# The currents grid is stored south to north; row 0 here is its northernmost row.
CURRENT_SOURCE = Grid("EPSG:4326", -180.0 - 1 / 24, 90.0 + 1 / 24, 1 / 12, 1 / 12, 4320, 841)


def cell_center(row: Column, col: Column, grid: Grid) -> tuple[Column, Column]:
    """Map x and y of a cell centre."""
    return (F.lit(grid.west) + (col + 0.5) * F.lit(grid.res_x),
            F.lit(grid.north) - (row + 0.5) * F.lit(grid.res_y))


def cell_offset(left: Column, top: Column, west: Column, north: Column,
                res: Column) -> tuple[Column, Column]:
    """Row and column of a raster's upper-left corner on a grid, rounded half to even."""
    return (F.rint((north - top) / res).cast("long"), F.rint((left - west) / res).cast("long"))


def cell_index(x: Column, y: Column, grid: Grid) -> tuple[Column, Column]:
    """Row and column of the cell that holds a point."""
    return (F.floor((F.lit(grid.north) - y) / F.lit(grid.res_y)),
            F.floor((x - F.lit(grid.west)) / F.lit(grid.res_x)))


def snap_extent(xmin: Column, ymin: Column, xmax: Column, ymax: Column,
                res: float) -> tuple[Column, Column, Column, Column]:
    """Bounds moved outward to multiples of the resolution."""
    r = F.lit(float(res))
    return (F.floor(xmin / r) * r, F.floor(ymin / r) * r, F.ceil(xmax / r) * r, F.ceil(ymax / r) * r)
