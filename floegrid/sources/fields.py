"""Gridded fields and subsets of a gridded variable."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from floegrid.functions.fields import mask_and_scale, mask_nodata, roll_longitude
from floegrid.functions.grids import Grid, cell_center
from floegrid.products import PRODUCTS


def read_field(spark: SparkSession, path: str, product: str, fmt: str = "parquet") -> DataFrame:
    """Cells of one product variable with its fill, scale and nodata applied.

    The entry contract is a table of collection, acq_time, row, col and raw: decoding a file
    format into it is left to whatever produced the file.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.schema("collection string, acq_time timestamp, row int, col int, raw double"
                               ).option("header", "true")
    raw = reader.load(path).select("collection", "acq_time", "row", "col", "raw")
    return clean_field(raw, product)


def clean_field(raw: DataFrame, product: str, nodata: float | None = None) -> DataFrame:
    """Raw cells to values: float with null for nodata, or smallint class codes."""
    p = PRODUCTS[product]
    if p.categorical:
        code = F.when(F.col("raw") != p.fill, F.col("raw")).cast("smallint")
        return raw.withColumn("value", code).drop("raw")
    value = F.col("raw").cast("double")
    if p.fill is not None:
        value = mask_and_scale(value, p.fill, p.scale)
    return raw.withColumn("value", mask_nodata(value, nodata).cast("float")).drop("raw")


def rolled_field(cells: DataFrame, width: int, xres: float, origin: float) -> tuple[DataFrame, float]:
    """Cells of a global grid moved to the -180..180 convention, with the new origin."""
    col, new_origin = roll_longitude(F.col("col"), width, xres, origin)
    return cells.withColumn("col", col.cast("int")), new_origin


def force_grid(cells: DataFrame, grid: Grid, keys: Sequence[str] = ("collection", "acq_time")) -> DataFrame:
    """Cells with map coordinates of a fixed grid; a slice of another shape is an error.

    The check is one aggregate, read back as a scalar in the same plan.
    """
    shapes = cells.groupBy(*keys).agg((F.max("row") + 1).alias("h"), (F.max("col") + 1).alias("w"),
                                      F.min("row").alias("r0"), F.min("col").alias("c0"))
    fits = shapes.agg(F.coalesce(F.bool_and(
        (F.col("h") == grid.height) & (F.col("w") == grid.width)
        & (F.col("r0") == 0) & (F.col("c0") == 0)), F.lit(True))).scalar()
    check = F.when(fits, F.lit(True)).otherwise(
        F.raise_error(F.lit(f"unexpected grid shape; expected {grid.height} x {grid.width}"))
        .cast("boolean"))
    x, y = cell_center(F.col("row"), F.col("col"), grid)
    return cells.where(check).withColumns({"x": x, "y": y})


def subset_field(field: DataFrame, bbox: tuple[float, float, float, float], depth: tuple[float, float],
                 start: str, end: str, time: str = "time", keys: Sequence[str] = (),
                 value: str = "value", tiebreak: Sequence[str] = ()) -> DataFrame:
    """First layer of a variable in a box, depth range and half-open time range.

    Plain comparisons reach the Parquet scan. Per position the earliest, shallowest value stays.
    """
    west, south, east, north = bbox
    kept = field.where((F.col("longitude") >= west) & (F.col("longitude") <= east)
                       & (F.col("latitude") >= south) & (F.col("latitude") <= north)
                       & (F.col("depth") >= depth[0]) & (F.col("depth") <= depth[1])
                       & (F.col(time) >= F.lit(start).cast(field.schema[time].dataType))
                       & (F.col(time) < F.lit(end).cast(field.schema[time].dataType)))
    first = F.min_by(value, F.struct(time, "depth", *tiebreak))
    return kept.groupBy(*keys, "latitude", "longitude").agg(first.alias(value))
