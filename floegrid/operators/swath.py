"""Swath points gridded onto a regular grid, and the registry of swath converters."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from floegrid.functions.fields import valid
from floegrid.functions.grids import ARCTIC_10KM, Grid, cell_index
from floegrid.functions.projection import to_polar

Converter = Callable[[DataFrame, Sequence[str]], dict[str, DataFrame]]
_CONVERTERS: dict[str, tuple[Converter, tuple[str, ...]]] = {}


def grid_points(points: DataFrame, grid: Grid = ARCTIC_10KM, value: str = "value",
                keys: Sequence[str] = ("acq_time",), x: str = "x", y: str = "y") -> DataFrame:
    """Mean of the valid points in each cell; points off the grid are left out."""
    row, col = cell_index(F.col(x), F.col(y), grid)
    placed = points.where(valid(F.col(value).cast("double")).isNotNull()).select(
        *keys, row.cast("int").alias("row"), col.cast("int").alias("col"), value)
    on = ((F.col("row") >= 0) & (F.col("row") < grid.height)
          & (F.col("col") >= 0) & (F.col("col") < grid.width))
    return (placed.where(on).groupBy(*keys, "row", "col")
            .agg(F.avg(value).alias(value), F.count(F.lit(1)).alias("n")))


def register_converter(key: str, variables: Sequence[str]):
    """Register `convert(points, variables)` under a dataset key with its default variables."""
    def register(fn: Converter) -> Converter:
        _CONVERTERS[key] = (fn, tuple(variables))
        return fn
    return register


def convert(key: str, points: DataFrame, variables: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """One cell table per variable of a swath dataset."""
    if key not in _CONVERTERS:
        raise KeyError(f"no converter registered for {key!r}; known keys: {sorted(_CONVERTERS)}")
    fn, defaults = _CONVERTERS[key]
    return fn(points, list(variables or defaults))


# Dataset keys and their default variables.
@register_converter("swot-ssh-expert", ("ssha_karin", "sig0_karin"))
@register_converter("swot-ssh-unsmoothed", ("ssha_karin", "sig0_karin"))
def grid_swath(points: DataFrame, variables: Sequence[str]) -> dict[str, DataFrame]:
    """Swath columns lon, lat, acq_time and variables to polar cells, all JVM-side."""
    x, y = to_polar(F.col("lon"), F.col("lat"))
    mapped = points.withColumns({"x": x, "y": y})
    return {v: grid_points(mapped, value=v).withColumnRenamed(v, "value") for v in variables}
