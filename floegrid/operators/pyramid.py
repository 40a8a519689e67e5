"""Overview pyramids.

Each level is made from the one before. All levels share one exchange: cells are placed by the
block of the coarsest level, the block stays in the grouping keys, and every finer grouping is
then already clustered. A block holds at most factor x factor cells of one slice, so no group
can grow with the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from floegrid.functions.fields import valid
from floegrid.operators.mosaic import CELL, SLICE

LEVELS = (2, 4, 8, 16, 32)
HOW = ("average", "mode", "nearest")


def _coarsen(cells: DataFrame, step: int, how: str, keys: list[str], row: str, col: str,
             value: str) -> DataFrame:
    if how == "nearest":
        kept = cells.where((F.col(row) % step == 0) & (F.col(col) % step == 0))
        return kept.select(*keys, F.expr(f"int({row} div {step})").alias(row),
                           F.expr(f"int({col} div {step})").alias(col), value)
    coarse = cells.select(*keys, F.expr(f"int({row} div {step})").alias(row),
                          F.expr(f"int({col} div {step})").alias(col), value)
    if how == "average":
        return coarse.groupBy(*keys, row, col).agg(F.avg(value).alias(value))
    # Mode: most frequent code, smallest code on a tie, ranked by one long so that the
    # aggregate stays hash-based.
    votes = coarse.groupBy(*keys, row, col, value).agg(F.count(F.lit(1)).alias("_n"))
    rank = F.col("_n") * F.lit(1 << 32) - F.col(value).cast("long")
    return votes.groupBy(*keys, row, col).agg(F.max_by(value, rank).alias(value))


def overview(cells: DataFrame, levels: Sequence[int] = LEVELS, how: str = "average",
             keys: Sequence[str] = SLICE, cell: Sequence[str] = CELL, value: str = "value",
             nodata: float | None = None) -> DataFrame:
    """Overview cells of every level, with a `level` column; nulls, NaN and nodata are skipped."""
    if how not in HOW:
        raise ValueError(f"unknown overview method {how!r}; valid: {HOW}")
    levels = sorted(levels)
    if any(b % a for a, b in zip(levels, levels[1:])):
        raise ValueError("each level must be a multiple of the one before")
    row, col = cell
    present = cells.where(valid(F.col(value).cast("double")).isNotNull())
    if nodata is not None:
        present = present.where(F.col(value) != nodata)
    block = levels[-1]
    blocked = present.select(
        *keys, F.expr(f"int({row} div {block})").alias("_block_row"),
        F.expr(f"int({col} div {block})").alias("_block_col"), row, col, value
    ).repartition(*keys, "_block_row", "_block_col")
    grouping = [*keys, "_block_row", "_block_col"]
    out, current, factor = None, blocked, 1
    for level in levels:
        current = _coarsen(current, level // factor, how, grouping, row, col, value)
        factor = level
        tagged = current.select(*keys, F.lit(level).alias("level"), row, col, value)
        out = tagged if out is None else out.unionByName(tagged)
    return out
