from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from floegrid.functions.grids import ARCTIC_10KM, SEA_ICE_SOURCE, WEATHER_SOURCE, Grid
from floegrid.operators import tiles as T
from floegrid.operators.cube import Cube
from floegrid.operators.warp import warp, weights_table
from floegrid.plans import jobs


def raw_field(spark, grid, expr):
    return spark.range(grid.n_cells).selectExpr(
        "'c' AS collection", "timestamp'2024-01-01 12:00:00' AS acq_time", f"int(id div {grid.width}) AS row",
        f"int(id % {grid.width}) AS col", f"{expr} AS raw")


def test_concentration_product(spark):
    cells, pyramid = jobs.field_product(raw_field(spark, SEA_ICE_SOURCE, "double(IF(id % 760 < 100, -999, 5000))"), "ice_conc")
    stats = cells.agg(F.count(F.lit(1)), F.min("value"), F.max("value"), F.min("col")).head()
    assert stats[1] == pytest.approx(50) and stats[2] == pytest.approx(50) and 98 <= stats[3] <= 100
    assert 0.85 * ARCTIC_10KM.n_cells < stats[0] < 0.88 * ARCTIC_10KM.n_cells
    n = {r["level"]: r["n"] for r in pyramid.groupBy("level").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sorted(n) == [2, 4, 8, 16, 32] and n[2] > n[4] > n[32]


def test_class_product_keeps_codes(spark):
    cells, pyramid = jobs.field_product(raw_field(spark, SEA_ICE_SOURCE, "int(1 + id % 3)"), "ice_edge")
    assert {r[0] for r in cells.select("value").distinct().collect()} == {1, 2, 3}
    assert {r[0] for r in pyramid.select("value").distinct().collect()} <= {1, 2, 3}


def test_wind_products(spark, tmp_path):
    w = weights_table(spark, str(tmp_path / "w"), WEATHER_SOURCE, ARCTIC_10KM, "bilinear")
    again = weights_table(spark, str(tmp_path / "w"), WEATHER_SOURCE, ARCTIC_10KM, "bilinear")
    assert again.count() == w.count()
    u, v = (warp(raw_field(spark, WEATHER_SOURCE, e).withColumnRenamed("raw", "value"), WEATHER_SOURCE, ARCTIC_10KM,
                 keys=["collection", "acq_time"], weights=w) for e in ("3D", "4D"))
    out = jobs.wind_products(u, v)
    assert out["arrows"].count() == 75 * 51
    r = out["arrows"].head()
    assert r["speed"] == 5.0 and r["dir_to"] == 36.9
    tiers = {r["tier"]: r["count"] for r in out["tiers"].groupBy("tier").count().collect()}
    assert tiers[1] == 851_200 and tiers[16] == 70 * 48
    assert {r["spacing"] for r in out["glyphs"].select("spacing").distinct().collect()} == {160000.0, 40000.0}


def test_radar_mosaic(spark):
    grid = Grid("EPSG:3413", 0.0, -1e6, 1000.0, 1000.0, 60, 60)
    cells = spark.range(40 * 40).selectExpr("int(id div 40) AS row", "int(id % 40) AS col", "10D AS dn")
    images = [cells.selectExpr(f"'{g}' AS granule", "'hh' AS polarization", "date'2024-01-01' AS acq_date", f"{o} AS ord", "row", "col",
                               f"dn * {o} AS dn") for g, o in (("g1", 1), ("g2", 2))]
    tiles = T.assemble_tiles(images[0].unionByName(images[1]), 16, keys=["granule", "polarization", "acq_date", "ord"], value="dn",
                             height=40, width=40)
    lut = spark.range(4).selectExpr("int(id div 2) * 40 AS line", "int(id % 2) * 40 AS pixel", "1D AS k").withColumn(
        "granule", F.explode(F.array(F.lit("g1"), F.lit("g2")))).withColumn(
        "calibration", F.explode(F.array(F.lit("sigma0"), F.lit("beta0")))).withColumn("polarization", F.lit("hh"))
    from floegrid.functions.projection import to_lonlat
    pts = [(g, float(r), float(c), float((c + off) * 1000.0), float(-1e6 - r * 1000.0)) for g, off in (("g1", 0), ("g2", 15))
           for r in np.linspace(0, 40, 5) for c in np.linspace(0, 40, 5)]
    gcps = spark.createDataFrame(pts, "granule string, row double, col double, x double, y double")
    lon, lat = to_lonlat(F.col("x"), F.col("y"))
    gcps = gcps.select("granule", "row", "col", lon.alias("lon"), lat.alias("lat"))
    out = jobs.radar_mosaic(tiles, lut, gcps, ("sigma0", "beta0"), "sar-{calibration}", 16, grid, 32)
    cells = T.explode_tiles(out, 32)
    got = {(r["collection"], r["row"], r["col"]): r["value"] for r in cells.collect()}
    assert {k[0] for k in got} == {"sar-sigma0", "sar-beta0"} and len(got) == 2 * 40 * 55
    assert got[("sar-sigma0", 5, 5)] == pytest.approx(20, abs=1e-3)
    assert got[("sar-sigma0", 5, 30)] == pytest.approx(20 + 20 * np.log10(2), abs=1e-3)
    # Pixels are calibrated in one place of the plan: its table is joined once.
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_set(line") == 1
    levels, items = jobs.radar_outputs(out, "cogs", "{collection}_{date}.tif", grid, 32)
    assert {r["level"] for r in levels.select("level").distinct().collect()} == {2, 4, 8, 16, 32}
    keys = sorted(r["key"] for r in items.collect())
    assert keys == [f"cogs/sar-{c}/2024/01/01/sar-{c}_20240101.tif" for c in ("beta0", "sigma0")]


def counts(spark, rows):
    return spark.createDataFrame(rows, "d string, n long").select(F.to_date("d").alias("acq_date"), "n")


def test_mosaic_dates(spark):
    asf = counts(spark, [(f"2024-01-{d:02d}", n) for d, n in [(1, 50), (2, 50), (3, 5), (4, 30), (5, 40)]])
    cdse = counts(spark, [(f"2024-01-{d:02d}", n) for d, n in [(2, 50), (3, 60), (4, 10), (5, 60), (6, 9)]])
    listing = spark.createDataFrame([("c", "2024-01-02")], "collection string, d string").select("collection", F.to_date("d").alias("acq_date"))
    out = jobs.mosaic_dates(asf, cdse, listing, F.lit("2024-01-07").cast("date"), "c", n=4)
    got = {str(r["acq_date"]): r["source"] for r in out.collect()}
    # The 6th is newest and dropped, the 2nd exists, the walk ends with the 1st.
    assert got == {"2024-01-05": "cdse", "2024-01-04": "asf", "2024-01-03": "cdse"}
    alone = jobs.mosaic_dates(asf, cdse, listing, F.lit("2024-01-07").cast("date"), "c", n=4, secondary_enabled=False)
    assert {str(r["acq_date"]) for r in alone.collect()} == {"2024-01-05", "2024-01-04", "2024-01-01"}


def test_cube_sync_job(spark, tmp_path):
    cube = Cube(spark, str(tmp_path / "cube"))
    cells = spark.createDataFrame([("c", f"2024-01-0{d}", 0, 0, float(d)) for d in (1, 2, 3)],
                                  "collection string, t string, row int, col int, value double").select(
        "collection", F.to_timestamp("t").alias("acq_time"), "row", "col", "value")
    listing = spark.createDataFrame([("c", "2024-01-01", "a.tif", 1), ("c", "2024-01-03", "b_daily_COG.tif", 2), ("x", "2024-01-02", "z.tif", 3)],
                                    "collection string, d string, key string, ord int").withColumn("acq_date", F.to_date("d"))
    done = jobs.cube_sync(cube, "c", listing, cells)
    assert [d.day for d in done["added"]] == [1, 3] and cube.slices().count() == 2
