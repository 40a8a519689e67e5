"""Same-grid mosaics of cells and of tiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from floegrid.functions.fields import valid

SLICE = ("collection", "acq_date")
CELL = ("row", "col")


def long_rank(*parts: tuple[Column | str, int]) -> Column:
    """One long that sorts like its parts, the first one highest; each is a whole number of at most so many bits.

    `max_by` over a long is a hash aggregate, over a struct a sort of every row. A value that does not fit is an error.
    """
    if sum(bits for _, bits in parts) > 63:
        raise ValueError("a rank has 63 bits")
    out = None
    for part, bits in parts:
        value = (F.col(part) if isinstance(part, str) else part).cast("long")
        fits = F.when((value >= 0) & (value < F.lit(1 << bits)), value).otherwise(
            F.raise_error(F.concat(F.lit(f"a part of a rank does not fit {bits} bits: "), value.cast("string"))).cast("long"))
        out = fits if out is None else F.shiftleft(out, bits).bitwiseOR(fits)
    return out


def paint_rank(order: Sequence[str]) -> Column:
    """One ordering value; a single numeric column keeps the aggregate hash-based."""
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def mosaic(cells: DataFrame, order: Sequence[str], keys: Sequence[str] = SLICE,
           cell: Sequence[str] = CELL, value: str = "value") -> DataFrame:
    """One value per cell: the last valid input by `order` wins, nodata never overwrites.

    `max_by` combines on the map side, so a cell painted by a great many inputs sends one row
    per map task to its reducer.
    """
    present = cells.where(valid(F.col(value).cast("double")).isNotNull())
    return present.groupBy(*keys, *cell).agg(F.max_by(value, paint_rank(order)).alias(value))


def pol_ratio(cross: DataFrame, co: DataFrame, keys: Sequence[str], db: str = "db") -> DataFrame:
    """Cross- to co-polarised ratio per cell: a difference in dB."""
    a = cross.select(*keys, F.col(db).alias("_cross"))
    b = co.select(*keys, F.col(db).alias("_co"))
    return a.join(b, list(keys)).select(*keys, (F.col("_cross") - F.col("_co")).alias("ratio_db"))
