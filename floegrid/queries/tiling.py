"""Tile pyramids, tile warps and the radar mosaic over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from floegrid.functions.grids import ARCTIC_10KM, SEA_ICE_SOURCE, Grid
from floegrid.operators import mosaic as M, tiles as T
from floegrid.operators.geocode import warp_tiles
from floegrid.operators.pyramid import LEVELS
from floegrid.functions.projection import to_lonlat
from floegrid.plans.bindings import bind, cte, read_table
from floegrid.plans.jobs import radar_mosaic, radar_outputs
from floegrid.queries import REGISTRY, query
from floegrid.queries.pixels import RC
from floegrid.queries.warping import _FIELD

TILE = 8
# Each day of the year-month is one input, painted in the order of its day; every value is a class code of 1 to 50.
_PAINTED = f"""
WITH {cte('cell_b')},
l1 AS (SELECT collection, row_, col_, CAST(dn AS FLOAT) AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY collection, row_, col_ ORDER BY day(acq_date) DESC, k1 DESC, k2 DESC, k3 DESC, k4 DESC) AS r
  FROM cell_b WHERE dn > 5) WHERE r = 1)
"""


def painted_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raster a day of the month, folded to a mosaic tile for each place."""
    cells = bind(spark, sf_dir, "cell_b").where("dn > 5").withColumn("ord", F.dayofmonth("acq_date"))
    rank = F.struct("k1", "k2", "k3", "k4")
    day = cells.groupBy("collection", "ord", *RC).agg(F.max_by("dn", rank).alias("dn"))
    tiles = T.assemble_tiles(day, TILE, keys=["collection", "ord"], cell=RC, value="dn", height=112, width=76)
    return T.mosaic_tiles(tiles, keys=["collection"], bucket=8)


def _pyramid_sql(how: str) -> str:
    """Every level over pixels, each from the one before, with values stored as 32-bit numbers."""
    parts, before = [], "l1"
    for level in LEVELS:
        if how == "nearest":
            body = f"SELECT collection, row_ // 2 AS row_, col_ // 2 AS col_, value FROM {before} WHERE row_ % 2 = 0 AND col_ % 2 = 0"
        elif how == "average":
            body = (f"SELECT collection, row_ // 2 AS row_, col_ // 2 AS col_, CAST(avg(CAST(value AS DOUBLE)) AS FLOAT) AS value"
                    f" FROM {before} GROUP BY ALL")
        else:
            body = (f"SELECT collection, row_, col_, value FROM (SELECT collection, row_ // 2 AS row_, col_ // 2 AS col_, value, row_number() OVER"
                    f" (PARTITION BY collection, row_ // 2, col_ // 2 ORDER BY count(*) DESC, value) AS r FROM {before}"
                    f" GROUP BY collection, row_ // 2, col_ // 2, value) WHERE r = 1")
        parts.append(f"l{level} AS ({body})")
        before = f"l{level}"
    rows = " UNION ALL ".join(
        f"SELECT collection, CAST({level} AS INTEGER) AS level, CAST(row_ AS INTEGER) AS row, CAST(col_ AS INTEGER) AS col,"
        f" round(CAST(value AS DOUBLE), 4) AS value FROM l{level}" for level in LEVELS)
    return _PAINTED + ",\n" + ",\n".join(parts) + "\n" + rows


def _pyramid(spark: SparkSession, sf_dir: str, how: str) -> DataFrame:
    levels = T.overview_tiles(painted_tiles(spark, sf_dir), TILE, how=how, keys=["collection"], height=112, width=76)
    out = T.explode_tiles(levels, TILE, ["collection", "level"])
    return out.withColumn("value", F.round(F.col("value").cast("double"), 4))


@query("tile_pyramid_average", _pyramid_sql("average"))
def tile_pyramid_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pyramid(spark, sf_dir, "average")


@query("tile_pyramid_mode", _pyramid_sql("mode"))
def tile_pyramid_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pyramid(spark, sf_dir, "mode")


@query("tile_pyramid_nearest", _pyramid_sql("nearest"))
def tile_pyramid_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pyramid(spark, sf_dir, "nearest")


@query("warp_sea_ice_tiles", REGISTRY["warp_sea_ice_grid"][1])
def warp_sea_ice_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The field of `warp_sea_ice_grid` as tiles, warped as tiles with exact positions: the same summary by bands of 40 rows."""
    field = (read_table(spark, sf_dir, "lineitem").selectExpr(*_FIELD)
             .groupBy(F.lit("f").alias("collection"), F.col("row_").alias("row"), F.col("col_").alias("col")).agg(F.max("value").alias("value")))
    tiles = T.assemble_tiles(field, 128, keys=["collection"], height=1120, width=760)
    out = T.explode_tiles(warp_tiles(tiles, SEA_ICE_SOURCE, ARCTIC_10KM, 128, 96, keys=["collection"], lattice=1), 96, ["collection"])
    value = F.col("value").cast("double")
    return out.groupBy(F.expr("int(row div 40)").alias("row_band")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(value), 4).alias("mean_value"),
        F.round(F.min(value), 4).alias("min_value"), F.round(F.max(value), 4).alias("max_value"))


_RADAR = Grid("EPSG:3413", -3850000.0, 5850000.0, 50000.0, 50000.0, 152, 224)


@query("radar_daily_outputs", f"""
WITH {cte('cell_b')},
d AS (SELECT DISTINCT CAST(date_trunc('year', acq_date) AS DATE) AS acq_date, c FROM cell_b, (SELECT unnest(['sigma0', 'beta0']) AS c) WHERE dn > 5)
SELECT 'sar-' || c AS collection, acq_date, 'cogs/sar-' || c || '/' || strftime(acq_date, '%Y/%m/%d') || '/sar-' || c || '_' || strftime(acq_date, '%Y%m%d')
  || '_daily_COG.tif' AS key, 'sar-' || c || '_' || strftime(acq_date, '%Y%m%d') || '_daily_COG' AS id, TRUE AS bent_fits, CAST(5 AS BIGINT) AS n_levels FROM d""")
def radar_daily_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Radar images with bent control points, one for each collection and year, through the whole daily job.

    An image's column runs along a curve in the map, so nothing but the spline puts its pixels in place. `bent_fits`: the median value of a
    mosaic is that of its images within 1 dB, and as many target cells are set as the images' area in the map asks for, within a tenth.
    """
    cells = bind(spark, sf_dir, "cell_b").where("dn > 5").withColumn("acq_date", F.trunc("acq_date", "year"))
    dn = M.mosaic(cells, ["dn"], keys=["collection", "acq_date"], cell=RC, value="dn")
    names = ["granule", "polarization", "acq_date", "ord"]
    dn = dn.select(F.concat_ws("-", "collection", F.year("acq_date")).alias("granule"), F.lit("hh").alias("polarization"), "acq_date",
                   F.ascii("collection").alias("ord"), *RC, "dn")
    full = (dn.select(*names).distinct().withColumn("row_", F.explode(F.sequence(F.lit(0), F.lit(111))))
            .withColumn("col_", F.explode(F.sequence(F.lit(0), F.lit(75)))).join(dn, [*names, *RC], "left").fillna({"dn": 20.0}))
    tiles = T.assemble_tiles(full, 32, keys=names, cell=RC, value="dn", height=112, width=76)
    images = full.select("granule").distinct()
    knots = (images.withColumn("row", F.explode(F.array(*[F.lit(14.0 * i) for i in range(9)])))
             .withColumn("col", F.explode(F.array(*[F.lit(19.0 * i) for i in range(5)]))))
    at = knots.withColumns({"x": -1_000_000 + F.col("col") * 40_000, "y": 3_000_000 - F.col("row") * 40_000 - (F.col("col") - 38) ** 2 * 500})
    lon, lat = to_lonlat(F.col("x"), F.col("y"))
    lut = (images.withColumn("polarization", F.lit("hh")).withColumn("line", F.explode(F.array(F.lit(0), F.lit(112))))
           .withColumn("pixel", F.explode(F.array(F.lit(0), F.lit(76))))
           .withColumn("calibration", F.explode(F.array(F.lit("sigma0"), F.lit("beta0")))).withColumn("k", F.lit(1.0)))
    mosaic = radar_mosaic(tiles, lut, at.select("granule", "row", "col", lon.alias("lon"), lat.alias("lat")), ("sigma0", "beta0"),
                          "sar-{calibration}", 32, _RADAR, 64)
    levels, items = radar_outputs(mosaic, "cogs", "{collection}_{date}_daily_COG.tif", _RADAR, 64)
    keys = ["collection", "acq_date"]
    seen = (T.explode_tiles(mosaic, 64, keys).groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n"), F.median("value").alias("middle")))
    want = full.groupBy("acq_date", "row_", "col_").agg(F.max_by("dn", "ord").alias("dn")).groupBy("acq_date").agg(
        F.median(20 * F.log10("dn")).alias("source"), (F.count(F.lit(1)) * F.lit((40 / 50) ** 2)).alias("area"))
    fits = seen.join(want, "acq_date").select(*keys, ((F.abs(F.col("middle") - F.col("source")) < 1)
                                                      & (F.abs(F.col("n") / F.col("area") - 1) < 0.1)).alias("bent_fits"))
    counts = levels.groupBy(*keys).agg(F.count_distinct("level").alias("n_levels"))
    return (items.join(fits, keys).join(counts, keys)
            .select(*keys, "key", F.get_json_object("item", "$.id").alias("id"), "bent_fits", "n_levels"))
