"""Pull resampling between grids with a date-independent weight table."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from floegrid.functions.fields import valid
from floegrid.functions.grids import Grid, cell_center
from floegrid.functions.projection import with_lonlat, with_polar
from floegrid.functions.radiometry import bilinear
from floegrid.operators.mosaic import SLICE

METHODS = ("near", "bilinear")
# A weight table up to this size is broadcast; its rows are bounded by the target grid.
# Weights below this are rounding noise of a target centre that falls on a source centre.
NOISE = 1e-9


def source_position(cells: DataFrame, src: Grid, dst: Grid) -> DataFrame:
    """Target cells (row, col) with fractional source position `fr`, `fc`, corner-based.

    Each step is its own projection, so the trigonometry is done once per cell.
    """
    x, y = cell_center(F.col("row"), F.col("col"), dst)
    at = cells.withColumns({"_x": x, "_y": y})
    if src.crs != dst.crs:
        at = with_lonlat(at, "_x", "_y", "_lon", "_lat", dst.polar)
        if src.polar is None:
            at = at.withColumns({"_x": F.col("_lon"), "_y": F.col("_lat")})
        else:
            at = with_polar(at, "_lon", "_lat", "_x", "_y", src.polar)
    return at.select("row", "col", ((F.lit(src.north) - F.col("_y")) / F.lit(src.res_y)).alias("fr"),
                     ((F.col("_x") - F.lit(src.west)) / F.lit(src.res_x)).alias("fc"))


def warp_weights(spark: SparkSession, src: Grid, dst: Grid, method: str = "bilinear") -> DataFrame:
    """Rows (row, col, src_row, src_col, w) that pull a target cell from source cells.

    `near` takes the source cell that holds the target centre. `bilinear` takes the four
    nearest centres; neighbours outside the source are left out, and a target centre outside
    the source has no row. A source that spans all longitudes wraps around.
    """
    if method not in METHODS:
        raise ValueError(f"unknown resampling {method!r}; valid: {METHODS}")
    cells = spark.range(dst.n_cells).select(
        F.expr(f"int(id div {dst.width})").alias("row"), F.expr(f"int(id % {dst.width})").alias("col"))
    at = source_position(cells, src, dst)
    wraps = src.polar is None and abs(src.width * src.res_x - 360.0) < 1e-6
    if wraps:
        at = at.withColumn("fc", F.pmod("fc", F.lit(float(src.width))))
    inside = ((F.col("fr") >= 0) & (F.col("fr") < src.height)
              & (F.col("fc") >= 0) & (F.col("fc") < src.width))
    if method == "near":
        tap = F.struct(F.floor("fr").cast("int").alias("src_row"), F.floor("fc").cast("int").alias("src_col"),
                       F.lit(1.0).alias("w"))
        # A position outside gives no row. Generating it away keeps the test above the
        # trigonometry; a filter would be pushed below and repeat it.
        return at.select("row", "col", F.inline(F.when(inside, F.array(tap))))
    at = at.withColumns({"_r0": F.floor(F.col("fr") - 0.5), "_c0": F.floor(F.col("fc") - 0.5),
                         "_in": inside})
    at = at.withColumns({"_fy": F.col("fr") - 0.5 - F.col("_r0"), "_fx": F.col("fc") - 0.5 - F.col("_c0")})

    def corner(dr: int, dc: int) -> Column:
        wy = F.col("_fy") if dr else 1 - F.col("_fy")
        wx = F.col("_fx") if dc else 1 - F.col("_fx")
        c = F.col("_c0") + dc
        return F.struct((F.col("_r0") + dr).cast("int").alias("src_row"),
                        (F.pmod(c, F.lit(src.width)) if wraps else c).cast("int").alias("src_col"),
                        (wy * wx).alias("w"))
    taps = at.select("row", "col", F.inline(F.when(
        F.col("_in"), F.array(corner(0, 0), corner(0, 1), corner(1, 0), corner(1, 1)))))
    return taps.where((F.col("w") > NOISE) & (F.col("src_row") >= 0) & (F.col("src_row") < src.height)
                      & (F.col("src_col") >= 0) & (F.col("src_col") < src.width))


def weights_table(spark: SparkSession, path: str, src: Grid, dst: Grid, method: str) -> DataFrame:
    """The weight table kept as Parquet under a shared path, written on first use; each pair of grids and method has its own folder."""
    path = f"{path}/{method}-{hashlib.sha256(repr((src, dst)).encode()).hexdigest()[:16]}"
    jvm = spark.sparkContext._jvm
    done = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    fs = done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(done):
        warp_weights(spark, src, dst, method).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def warp(cells: DataFrame, src: Grid, dst: Grid, method: str = "bilinear",
         keys: Sequence[str] = SLICE, value: str = "value", weights: DataFrame | None = None) -> DataFrame:
    """Cells of any number of slices resampled onto the target grid.

    Weights are renormalised over valid cells. The two sides meet on the source cell; whether the weight table is
    small enough to be broadcast is left to runtime statistics. Nearest needs no aggregate at all.
    """
    w = weights if weights is not None else warp_weights(cells.sparkSession, src, dst, method)
    v = valid(F.col(value).cast("double"))
    source = cells.where(v.isNotNull()).select(
        *keys, F.col("row").alias("src_row"), F.col("col").alias("src_col"), F.col(value))
    pulled = source.join(w, ["src_row", "src_col"])
    if method == "near":
        return pulled.select(*keys, "row", "col", value)
    return (pulled.groupBy(*keys, "row", "col")
            .agg((F.sum(F.col("w") * F.col(value)) / F.sum("w")).alias(value)))


LUT_KEYS = ("granule", "polarization", "calibration")
SLOTS = 64


def lut_cells(lut: DataFrame, keys: Sequence[str] = LUT_KEYS) -> DataFrame:
    """Calibration table samples as cells with four corners.

    Windows run inside one line or one pixel column of one table, a few hundred rows at most.
    """
    along = Window.partitionBy(*keys, "line").orderBy("pixel")
    down = Window.partitionBy(*keys, "pixel").orderBy("line")
    right = lut.select(*keys, "line", "pixel", F.col("k").alias("k00"),
                       F.lead("pixel").over(along).alias("pixel1"), F.lead("k").over(along).alias("k01"))
    full = right.select("*", F.lead("line").over(down).alias("line1"),
                        F.lead("k00").over(down).alias("k10"), F.lead("k01").over(down).alias("k11"),
                        F.lag("line").over(down).isNull().alias("_top"),
                        F.lag("pixel").over(along).isNull().alias("_left"))
    cells = full.where("pixel1 is not null and line1 is not null")
    last_line = F.max("line1").over(Window.partitionBy(*keys, "pixel"))
    last_pixel = F.max("pixel1").over(Window.partitionBy(*keys, "line"))
    return cells.withColumns({"_bottom": F.col("line1") == last_line,
                              "_right": F.col("pixel1") == last_pixel})


def lut_join(pixels: DataFrame, lut: DataFrame, height: int, width: int,
             keys: Sequence[str] = LUT_KEYS, block: int = 256) -> DataFrame:
    """Pixels with the bilinear `k` of each calibration table of their granule.

    A range join made equal: every table cell is repeated for the pixel blocks it covers, and
    pixels look up their block. A table stands in every one of SLOTS places and a pixel, by its position, in one, so the pixels of
    a few granules and blocks are shared by many tasks. Outer cells reach to the image edge, so pixels beyond the
    samples extrapolate linearly.
    """
    cells = lut_cells(lut, keys)
    lo_r = F.when(F.col("_top"), F.least("line", F.lit(0))).otherwise(F.col("line"))
    hi_r = F.when(F.col("_bottom"), F.greatest("line1", F.lit(height))).otherwise(F.col("line1"))
    lo_c = F.when(F.col("_left"), F.least("pixel", F.lit(0))).otherwise(F.col("pixel"))
    hi_c = F.when(F.col("_right"), F.greatest("pixel1", F.lit(width))).otherwise(F.col("pixel1"))
    spans = cells.withColumns({"_r0": lo_r, "_r1": hi_r, "_c0": lo_c, "_c1": hi_c})
    keyed = (spans
             .withColumn("_br", F.explode(F.sequence(F.floor(F.col("_r0") / block),
                                                     F.floor((F.col("_r1") - 1) / block))))
             .withColumn("_bc", F.explode(F.sequence(F.floor(F.col("_c0") / block),
                                                     F.floor((F.col("_c1") - 1) / block))))
             .withColumn("_slot", F.explode(F.sequence(F.lit(0), F.lit(SLOTS - 1))))
             .drop("_top", "_bottom", "_left", "_right"))
    looked = pixels.withColumns({"_br": F.floor(F.col("row") / block), "_bc": F.floor(F.col("col") / block),
                                 "_slot": F.pmod(F.xxhash64("row", "col"), F.lit(SLOTS)).cast("int")})
    inside = ((F.col("row") >= F.col("_r0")) & (F.col("row") < F.col("_r1"))
              & (F.col("col") >= F.col("_c0")) & (F.col("col") < F.col("_c1")))
    fy = (F.col("row") - F.col("line")) / (F.col("line1") - F.col("line"))
    fx = (F.col("col") - F.col("pixel")) / (F.col("pixel1") - F.col("pixel"))
    k = bilinear(F.col("k00"), F.col("k01"), F.col("k10"), F.col("k11"), fy, fx)
    on = [c for c in keys if c in pixels.columns]
    extra = [c for c in keys if c not in pixels.columns]
    return (looked.join(keyed, [*on, "_br", "_bc", "_slot"]).where(inside)
            .select(*pixels.columns, *extra, k.alias("k")))


def calibrate(pixels: DataFrame, lut: DataFrame, height: int, width: int,
              conventions: Sequence[str] = ("sigma0",), template: str | None = None,
              keys: Sequence[str] = LUT_KEYS) -> DataFrame:
    """Backscatter in dB of every requested convention from one read of the digital numbers."""
    from floegrid.functions.radiometry import calibrate_db, check_convention

    for convention in conventions:
        check_convention(convention)
    if len(conventions) > 1 and not template:
        raise ValueError("several conventions need a collection template with {calibration}")
    wanted = lut.where(F.col("calibration").isin(list(conventions)))
    out = (lut_join(pixels, wanted, height, width, keys)
           .withColumn("value", calibrate_db(F.col("dn"), F.col("k"))))
    if template:
        out = out.withColumn("collection", F.replace(F.lit(template), F.lit("{calibration}"),
                                                     F.col("calibration")))
    return out
