"""Bounds, extents, slice and field statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from floegrid.functions.fields import valid
from floegrid.operators.mosaic import SLICE


def union_bounds(rasters: DataFrame, keys: Sequence[str] = (), strict: bool = True) -> DataFrame:
    """Union of raster bounds, median x resolution, and the first CRS and nodata.

    Rasters: ord, xmin, ymin, xmax, ymax, res_x, crs, nodata. Those without bounds (unreadable)
    are skipped. The median is exact and interpolates between the two middle values.
    """
    readable = rasters.where(F.col("xmin").isNotNull() & F.col("ymin").isNotNull()
                             & F.col("xmax").isNotNull() & F.col("ymax").isNotNull())
    first = F.min_by(F.struct("crs", "nodata"), F.col("ord"))
    out = readable.groupBy(*keys).agg(
        F.min("xmin").alias("west"), F.min("ymin").alias("south"), F.max("xmax").alias("east"),
        F.max("ymax").alias("north"), F.percentile("res_x", F.lit(0.5)).alias("resolution"),
        first.alias("_first"), F.count(F.lit(1)).alias("n_rasters"))
    out = out.select(*keys, "west", "south", "east", "north", "resolution",
                     F.col("_first.crs").alias("crs"), F.col("_first.nodata").alias("nodata"),
                     "n_rasters")
    if strict and not keys:
        ok = F.when(F.col("n_rasters") > 0, F.lit(True)).otherwise(
            F.raise_error(F.lit("no raster with readable bounds")).cast("boolean"))
        out = out.where(ok)
    return out


def merge_bounds(a: DataFrame, b: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Outer extent of two bounds tables."""
    box = ["west", "south", "east", "north"]
    both = a.select(*keys, *box).unionByName(b.select(*keys, *box))
    return both.groupBy(*keys).agg(F.min("west").alias("west"), F.min("south").alias("south"),
                                   F.max("east").alias("east"), F.max("north").alias("north"))


def union_grid(bounds: DataFrame) -> DataFrame:
    """Grid dimensions of union bounds at their resolution."""
    return bounds.withColumns({
        "width": F.ceil((F.col("east") - F.col("west")) / F.col("resolution")),
        "height": F.ceil((F.col("north") - F.col("south")) / F.col("resolution"))})


def cube_summary(slices: DataFrame, keys: Sequence[str] = ("collection",)) -> DataFrame:
    """Bounds, CRS and time hull of a cube from its slices (xmin.., crs, acq_time, ord)."""
    return slices.groupBy(*keys).agg(
        F.min("xmin").alias("west"), F.min("ymin").alias("south"), F.max("xmax").alias("east"),
        F.max("ymax").alias("north"), F.min_by("crs", "ord").alias("crs"),
        F.min("acq_time").alias("min_time"), F.max("acq_time").alias("max_time"),
        F.count("acq_time").alias("n_slices")).where(F.col("n_slices") > 0)


def coordinate_bounds(cells: DataFrame, keys: Sequence[str] = (), x: str = "x", y: str = "y",
                      res: float | None = None) -> DataFrame:
    """Bounds from coordinates where attributes are missing: the last cell adds one step."""
    west, east, north, south = F.min(x), F.max(x), F.max(y), F.min(y)
    step = F.lit(res)
    return cells.groupBy(*keys).agg(west.alias("west"), (south - step).alias("south"),
                                    (east + step).alias("east"), north.alias("north"))


def slice_stats(cells: DataFrame, keys: Sequence[str] = SLICE, value: str = "value") -> DataFrame:
    """Non-zero count per slice; a slice is non-empty if any value is finite and not zero."""
    v = valid(F.col(value).cast("double"))
    live = v.isNotNull() & (F.abs(v) != F.lit(float("inf"))) & (v != 0)
    return cells.groupBy(*keys).agg(F.count_if(live).alias("n_nonzero"),
                                    F.coalesce(F.bool_or(live), F.lit(False)).alias("non_empty"))


def field_stats(cells: DataFrame, keys: Sequence[str] = SLICE, value: str = "value") -> DataFrame:
    v = valid(F.col(value).cast("double"))
    return cells.groupBy(*keys).agg(F.count(v).alias("n_valid"), F.min(v).alias("min_value"),
                                    F.max(v).alias("max_value"), F.avg(v).alias("mean_value"))


def class_census(cells: DataFrame, keys: Sequence[str] = SLICE, code: str = "code") -> DataFrame:
    return cells.where(F.col(code).isNotNull()).groupBy(*keys, code).agg(
        F.count(F.lit(1)).alias("n"))
