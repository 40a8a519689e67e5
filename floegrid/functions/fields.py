"""Field clean-up column functions: fill values, longitude roll, classes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def valid(value: Column) -> Column:
    """The value with NaN mapped to null, as Spark aggregates skip only nulls."""
    return F.nanvl(value, F.lit(None).cast("double"))


def mask_and_scale(raw: Column, fill: float, scale: float | None = None) -> Column:
    scaled = raw * F.lit(scale) if scale is not None else raw
    return F.when(raw != F.lit(fill), scaled)


def mask_nodata(value: Column, nodata: float | None) -> Column:
    clean = valid(value.cast("double"))
    return clean if nodata is None or nodata != nodata else F.nullif(clean, F.lit(float(nodata)))


def needs_roll(width: int, xres: float, origin: float) -> bool:
    """True for a global grid on the 0..360 convention with an even width."""
    return abs(width * xres - 360.0) < 1e-3 and origin > -1.0 and width % 2 == 0


def roll_longitude(col: Column, width: int, xres: float, origin: float) -> tuple[Column, float]:
    """Column index and grid origin on the -180..180 convention."""
    if not needs_roll(width, xres, origin):
        return col, origin
    return F.pmod(col + width // 2, F.lit(width)), origin - 180.0


def decode_class(code: Column, meanings: dict[int, str]) -> Column:
    """Meaning of a class code; codes outside the table give null."""
    table = F.create_map(*(F.lit(v) for pair in meanings.items() for v in pair))
    return F.try_element_at(table, code.cast("int"))


def class_from_concentration(percent: Column) -> Column:
    """Ice-edge class of a concentration: below 30, 30 to 70, above 70 percent."""
    return F.when(percent < 30, 1).when(percent <= 70, 2).when(percent > 70, 3)
