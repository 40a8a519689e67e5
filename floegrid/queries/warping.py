"""Resampling, calibration tables and tile paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from floegrid.functions.grids import ARCTIC_10KM, SEA_ICE_SOURCE, Grid
from floegrid.functions.projection import EPSG3411
from floegrid.operators import mosaic as M, tiles as T, warp as W
from floegrid.plans.bindings import bind, cte, read_table
from floegrid.plans.sql_forms import lonlat, polar_xy
from floegrid.queries import query
from floegrid.queries.pixels import ORDER, RC, _DENSE_SQL, dense_mosaic

SRC = Grid("EPSG:4326", -180.0, 90.0, 360 / 76, 180 / 112, 76, 112)
DST = Grid("EPSG:3413", -3850000.0, 5850000.0, 100000.0, 100000.0, 76, 112)

_LON, _LAT = lonlat("x", "y")
_POS_SQL = _DENSE_SQL + f""",
d AS (SELECT CAST(i // 76 AS INTEGER) AS row, CAST(i % 76 AS INTEGER) AS col, -3850000 + (i % 76 + 0.5) * 100000 AS x,
  5850000 - (i // 76 + 0.5) * 100000 AS y FROM (SELECT unnest(range(8512)) AS i)),
g AS (SELECT row, col, {_LON} AS lon, {_LAT} AS lat FROM d),
f AS (SELECT row, col, (90.0 - lat) / {SRC.res_y!r} AS fr, (((lon + 180.0) / {SRC.res_x!r}) + 76) % 76 AS fc FROM g)
"""


def source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dense_mosaic(spark, sf_dir).withColumnsRenamed({"row_": "row", "col_": "col"}).withColumn(
        "value", F.col("value").cast("double"))


@query("warp_near", _POS_SQL + """
SELECT s.collection, f.row, f.col, CAST(s.value AS DOUBLE) AS value FROM f
JOIN l0 s ON s.row_ = floor(f.fr) AND s.col_ = floor(f.fc)""")
def warp_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.warp(source(spark, sf_dir), SRC, DST, "near", keys=["collection"])


@query("warp_bilinear", _POS_SQL + """,
b AS (SELECT *, floor(fr - 0.5) AS r0, floor(fc - 0.5) AS c0 FROM f),
t AS (SELECT row, col, CAST(r0 + dr AS INTEGER) AS sr, CAST((c0 + dc + 76) % 76 AS INTEGER) AS sc,
  (CASE WHEN dr = 1 THEN fr - 0.5 - r0 ELSE 1 - (fr - 0.5 - r0) END)
  * (CASE WHEN dc = 1 THEN fc - 0.5 - c0 ELSE 1 - (fc - 0.5 - c0) END) AS w
  FROM b, (SELECT unnest([0, 0, 1, 1]) AS dr, unnest([0, 1, 0, 1]) AS dc))
SELECT s.collection, t.row, t.col, round(sum(t.w * s.value) / sum(t.w), 5) AS value FROM t
JOIN l0 s ON s.row_ = t.sr AND s.col_ = t.sc WHERE t.w > 1e-9 GROUP BY ALL""")
def warp_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = W.warp(source(spark, sf_dir), SRC, DST, "bilinear", keys=["collection"])
    return out.withColumn("value", F.round("value", 5))


def calibration_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plane-shaped calibration table per collection and convention, levelled by its row count."""
    base = (bind(spark, sf_dir, "cell_b").groupBy(F.col("collection").alias("granule"))
            .agg((F.count(F.lit(1)) % 1000 + 100).alias("base")))
    k = F.col("base") + F.col("line") + 2 * F.col("pixel")
    return (base
            .withColumn("line", F.explode(F.sequence(F.lit(8), F.lit(88), F.lit(16))))
            .withColumn("pixel", F.explode(F.sequence(F.lit(0), F.lit(60), F.lit(10))))
            .withColumn("calibration", F.explode(F.array(F.lit("sigma0"), F.lit("beta0"))))
            .select("granule", F.lit("hh").alias("polarization"), "calibration", "line", "pixel",
                    F.when(F.col("calibration") == "sigma0", k).otherwise(2 * k).cast("double").alias("k")))


_CAL_SQL = f"""WITH {cte('cell_b')},
n AS (SELECT collection, count(*) % 1000 + 100 AS base FROM cell_b GROUP BY collection),
c AS (SELECT c.*, cal, (base + row_ + 2 * col_) * (CASE cal WHEN 'sigma0' THEN 1 ELSE 2 END) AS k
  FROM cell_b c JOIN n USING (collection), (SELECT unnest(['sigma0', 'beta0']) AS cal))
"""


@query("lut_join", _CAL_SQL + """
SELECT k1, k2, k3, k4, row_ AS row, col_ AS col, cal AS calibration, acq_date, CAST(k AS DOUBLE) AS k FROM c""")
def lut_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    px = bind(spark, sf_dir, "cell_b").withColumnsRenamed({"row_": "row", "col_": "col", "collection": "granule"})
    out = W.lut_join(px.select("granule", "acq_date", *ORDER, "row", "col"), calibration_tables(spark, sf_dir),
                     112, 76, block=32)
    return out.select(*ORDER, "row", "col", "calibration", "acq_date", F.round("k", 6).alias("k"))


@query("calibrate_conventions", _CAL_SQL + """
SELECT k1, k2, k3, k4, row_ AS row, col_ AS col, acq_date, 'sar-hh-' || cal || '-daily' AS collection,
  CASE WHEN dn > 10 THEN round(10 * log10((dn - 10) * (dn - 10) / (k * k)), 5) END AS value FROM c""")
def calibrate_conventions(spark: SparkSession, sf_dir: str) -> DataFrame:
    px = bind(spark, sf_dir, "cell_b").withColumnsRenamed({"row_": "row", "col_": "col", "collection": "granule"})
    px = px.select("granule", "acq_date", *ORDER, "row", "col", (F.col("dn") - 10).alias("dn"))
    out = W.calibrate(px, calibration_tables(spark, sf_dir), 112, 76, ("sigma0", "beta0"),
                      "sar-hh-{calibration}-daily")
    return out.select(*ORDER, "row", "col", "acq_date", "collection", F.round("value", 5).alias("value"))


@query("mosaic_tiles", f"""
WITH {cte('cell_b')}
SELECT collection, month, row_ AS row, col_ AS col, dn AS value FROM (
  SELECT *, CAST(date_trunc('month', acq_date) AS DATE) AS month, row_number() OVER (
    PARTITION BY collection, date_trunc('month', acq_date), row_, col_
    ORDER BY k2 DESC, acq_date DESC, k1 DESC, k3 DESC, k4 DESC) AS r FROM cell_b WHERE dn > 5) WHERE r = 1""")
def mosaic_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line number of a month is one input raster, painted in that order as tiles."""
    painted = bind(spark, sf_dir, "cell_b").where("dn > 5").withColumn(
        "month", F.trunc("acq_date", "month"))
    inputs = M.mosaic(painted, ["acq_date", "k1", "k3", "k4"], keys=["collection", "month", "k2"], cell=RC, value="dn")
    tiles = T.assemble_tiles(inputs, 64, keys=["collection", "month", "k2"], cell=RC, value="dn")
    keys = ["collection", "month"]
    out = T.explode_tiles(T.mosaic_tiles(tiles, order="k2", keys=keys, bucket=3), 64, keys)
    return out.withColumn("value", F.col("value").cast("double"))


@query("calibrate_tiles", _CAL_SQL + """
SELECT collection AS granule, cal AS calibration, count(*) AS n, count(*) AS n_close
FROM (SELECT collection, cal, row_, col_ FROM c WHERE dn > 10 GROUP BY ALL) GROUP BY ALL""")
def calibrate_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tile calibration compared with the cell path, pixel by pixel."""
    px = (bind(spark, sf_dir, "cell_b").where("dn > 10")
          .groupBy(F.col("collection").alias("granule"), F.lit("hh").alias("polarization"),
                   F.col("row_").alias("row"), F.col("col_").alias("col"))
          .agg((F.max("dn") - 10).alias("dn")))
    lut = calibration_tables(spark, sf_dir)
    tiles = T.assemble_tiles(px, 32, keys=["granule", "polarization"], value="dn")
    done = T.explode_tiles(T.calibrate_tiles(tiles, lut, 32), 32,
                           keys=["granule", "polarization", "calibration"])
    want = W.calibrate(px, lut, 112, 76, ("sigma0", "beta0"), "{calibration}", W.LUT_KEYS)
    both = done.join(want.select("granule", "calibration", "row", "col", F.col("value").alias("want")),
                     ["granule", "calibration", "row", "col"])
    return both.groupBy("granule", "calibration").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.abs(F.col("value") - F.col("want")) < 1e-4).alias("n_close"))


# The sea-ice source grid (Hughes ellipsoid) onto the 10 km target grid, full size.
_FIELD = ("CAST((l_orderkey * 7919 + l_linenumber) % 1120 AS INT) AS row_",
          "CAST((l_partkey * 104729 + l_suppkey * 13) % 760 AS INT) AS col_", "l_quantity AS value")
_LON10, _LAT10 = lonlat("x", "y")
_SX, _SY = polar_xy("lon", "lat", EPSG3411)


@query("warp_sea_ice_grid", f"""
WITH s AS (SELECT row_, col_, max(value) AS value FROM (SELECT {', '.join(_FIELD)} FROM lineitem) GROUP BY ALL),
d AS (SELECT CAST(i // 760 AS INTEGER) AS row, CAST(i % 760 AS INTEGER) AS col, -3850000 + (i % 760 + 0.5) * 10000 AS x,
  5850000 - (i // 760 + 0.5) * 10000 AS y FROM (SELECT unnest(range(851200)) AS i)),
g AS (SELECT row, col, {_LON10} AS lon, {_LAT10} AS lat FROM d),
f AS (SELECT row, col, (5850000 - {_SY}) / 10000 AS fr, ({_SX} + 3850000) / 10000 AS fc FROM g),
b AS (SELECT *, floor(fr - 0.5) AS r0, floor(fc - 0.5) AS c0 FROM f WHERE fr >= 0 AND fr < 1120 AND fc >= 0 AND fc < 760),
t AS (SELECT row, col, CAST(r0 + dr AS INTEGER) AS sr, CAST(c0 + dc AS INTEGER) AS sc,
  (CASE WHEN dr = 1 THEN fr - 0.5 - r0 ELSE 1 - (fr - 0.5 - r0) END)
  * (CASE WHEN dc = 1 THEN fc - 0.5 - c0 ELSE 1 - (fc - 0.5 - c0) END) AS w
  FROM b, (SELECT unnest([0, 0, 1, 1]) AS dr, unnest([0, 1, 0, 1]) AS dc)),
o AS (SELECT t.row, t.col, sum(t.w * s.value) / sum(t.w) AS value FROM t
  JOIN s ON s.row_ = t.sr AND s.col_ = t.sc WHERE t.w > 1e-9 GROUP BY ALL)
SELECT CAST(row // 40 AS INTEGER) AS row_band, count(*) AS n, round(avg(value), 4) AS mean_value,
  round(min(value), 4) AS min_value, round(max(value), 4) AS max_value FROM o GROUP BY ALL""")
def warp_sea_ice_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 851,200 target cells, summarised by bands of 40 rows."""
    field = (read_table(spark, sf_dir, "lineitem").selectExpr(*_FIELD)
             .groupBy(F.col("row_").alias("row"), F.col("col_").alias("col")).agg(F.max("value").alias("value")))
    out = W.warp(field, SEA_ICE_SOURCE, ARCTIC_10KM, "bilinear", keys=[])
    return out.groupBy(F.expr("int(row div 40)").alias("row_band")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 4).alias("mean_value"),
        F.round(F.min("value"), 4).alias("min_value"), F.round(F.max("value"), 4).alias("max_value"))
