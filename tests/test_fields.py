from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from floegrid.functions import fields as FI, radiometry as R, vectors as V
from floegrid.functions.grids import (ARCTIC_10KM, ARCTIC_40M, CURRENT_SOURCE, SEA_ICE_SOURCE, WEATHER_SOURCE, Grid,
                                      cell_offset, snap_extent)
from floegrid.operators import lod as L, warp as W
from floegrid.operators.swath import convert, grid_points
from floegrid.products import PRODUCTS, class_dim, product_dim
from floegrid.sources.fields import clean_field, force_grid, rolled_field

SMALL = Grid("EPSG:3413", 0.0, 40.0, 10.0, 10.0, 4, 4)


def row(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).head()


def test_grids():
    assert ARCTIC_10KM.n_cells == 851_200 and ARCTIC_10KM.bounds == (-3850000, -5350000, 3750000, 5850000)
    assert ARCTIC_40M.bounds == (-3400000, -3400000, 3400000, 3400000)
    assert WEATHER_SOURCE.width * WEATHER_SOURCE.res_x == 360


def test_offsets_round_half_even(spark):
    r = row(spark, a=cell_offset(F.lit(25.0), F.lit(65.0), F.lit(0.0), F.lit(100.0), F.lit(10.0))[0],
            b=cell_offset(F.lit(25.0), F.lit(65.0), F.lit(0.0), F.lit(100.0), F.lit(10.0))[1])
    assert (r["a"], r["b"]) == (4, 2)  # 3.5 -> 4, 2.5 -> 2
    s = row(spark, **dict(zip("abcd", snap_extent(F.lit(-13.0), F.lit(5.0), F.lit(21.0), F.lit(40.0), 10))))
    assert tuple(s) == (-20, 0, 30, 40)


def test_radiometry(spark):
    r = row(spark, db=R.calibrate_db(F.lit(100.0), F.lit(10.0)), zero=R.calibrate_db(F.lit(0.0), F.lit(10.0)),
            lin=R.db_to_linear(F.lit(-20.0)), gam=R.sigma_to_gamma(F.lit(-10.0), F.lit(math.pi / 3)),
            lo=R.rescale(F.lit(-40.0)), hi=R.rescale(F.lit(20.0)), mid=R.rescale(F.lit(-10.0)))
    assert r["db"] == pytest.approx(20) and r["zero"] is None and r["lin"] == pytest.approx(0.01)
    assert r["gam"] == pytest.approx(-10 + 10 * math.log10(2)) and (r["lo"], r["hi"], r["mid"]) == (0, 1, 0.5)
    with pytest.raises(ValueError, match="unknown calibration"):
        R.check_convention("delta0")


def test_clean_field(spark):
    raw = spark.createDataFrame([(-999.0,), (5000.0,), (float("nan"),)], "raw double")
    assert [r["value"] for r in clean_field(raw, "ice_conc").collect()] == [None, 50.0, None]
    codes = spark.createDataFrame([(-1,), (3,)], "raw int")
    assert [r["value"] for r in clean_field(codes, "ice_type").collect()] == [None, 3]


def test_roll_only_when_global(spark):
    assert FI.needs_roll(1440, 0.25, -0.125) and not FI.needs_roll(1440, 0.25, -180.125)
    assert not FI.needs_roll(1439, 360 / 1439, 0.0) and not FI.needs_roll(700, 0.25, 0.0)
    cells = spark.range(4).selectExpr("int(id) AS col")
    out, origin = rolled_field(cells, 4, 90.0, 0.0)
    assert [r["col"] for r in out.collect()] == [2, 3, 0, 1] and origin == -180.0


def test_force_grid(spark):
    def cells(h, w):
        return spark.range(h * w).selectExpr("'c' AS collection", "timestamp'2024-01-01' AS acq_time",
                                             f"int(id div {w}) AS row", f"int(id % {w}) AS col")
    first = force_grid(cells(4, 4), SMALL).orderBy("row", "col").head()
    assert (first["x"], first["y"]) == (5.0, 35.0)
    with pytest.raises(Exception, match="unexpected grid shape"):
        force_grid(cells(3, 4), SMALL).collect()


def test_classes(spark):
    assert product_dim(spark).count() == len(PRODUCTS) and class_dim(spark).count() == 7
    r = row(spark, a=FI.decode_class(F.lit(2), PRODUCTS["ice_edge"].classes), b=FI.decode_class(F.lit(9), {1: "x"}),
            c=FI.class_from_concentration(F.lit(29.9)), d=FI.class_from_concentration(F.lit(30.0)),
            e=FI.class_from_concentration(F.lit(70.0)), f=FI.class_from_concentration(F.lit(70.1)))
    assert tuple(r) == ("open_ice", None, 1, 2, 2, 3)


def test_bearing_and_map_vector(spark):
    r = row(spark, n=V.dir_to(F.lit(0.0), F.lit(1.0)), e=V.dir_to(F.lit(1.0), F.lit(0.0)),
            w=V.dir_to(F.lit(-1.0), F.lit(0.0)), m=V.math_angle(F.lit(0.0), F.lit(1.0)))
    assert tuple(r) == pytest.approx((0, 90, 270, 90))
    mx, my = V.map_vector(F.lit(0.0), F.lit(2.0), F.lit(0.0), F.lit(-1e6))
    ex, ey = V.map_vector(F.lit(3.0), F.lit(0.0), F.lit(0.0), F.lit(-1e6))
    px, py = V.map_vector(F.lit(1.0), F.lit(1.0), F.lit(0.0), F.lit(0.0))
    assert tuple(row(spark, a=mx, b=my, c=ex, d=ey, e=px, f=py)) == pytest.approx((0, 2, 3, 0, 0, 0))
    bad = spark.createDataFrame([(1.0, float("nan")), (None, 1.0), (float("inf"), 1.0), (1.0, 1.0)], "u double, v double")
    assert bad.where(V.valid_vector(F.col("u"), F.col("v"))).count() == 1


def full_grid(spark, grid=ARCTIC_10KM):
    return spark.range(grid.n_cells).selectExpr(f"int(id div {grid.width}) AS row", f"int(id % {grid.width}) AS col")


def test_stride_15_and_tiers(spark):
    assert L.decimate(full_grid(spark), 15).count() == 75 * 51
    points = full_grid(spark).withColumn("acq_date", F.lit("2024-01-01").cast("date"))
    tiers = {r["tier"]: r["count"] for r in L.lod_tiers(points).groupBy("tier").count().collect()}
    assert tiers == {1: 851_200, 4: 280 * 190, 8: 140 * 95, 16: 70 * 48}
    short = points.where("row > 0")
    assert {r["tier"] for r in L.lod_tiers(short).select("tier").distinct().collect()} == {1}


def test_chunk_no_matches_grid_form(spark):
    points = (full_grid(spark).where("row % 4 = 0 AND col % 4 = 0")
              .withColumn("acq_date", F.lit("2024-01-01").cast("date")))
    out = L.chunk_no(points, ["acq_date"], ["row", "col"], size=1000, partitions=6)
    wrong = out.where(F.col("chunk") != L.grid_chunk_no(4, size=1000))
    assert out.count() == 280 * 190 and wrong.count() == 0
    state = spark.createDataFrame([("2024-01-01", 50)], "d string, chunks_done int").select(
        F.to_date("d").alias("acq_date"), "chunks_done")
    assert L.pending_chunks(out, state, ["acq_date"]).agg(F.min("chunk")).head()[0] == 50
    for n, first in ((54, 50), (53, 0)):
        again = state.withColumn("n_chunks", F.lit(n))
        assert L.pending_chunks(out, again, ["acq_date"]).agg(F.min("chunk")).head()[0] == first


def test_coregister_needs_one_grid(spark):
    df = full_grid(spark, SMALL).withColumn("acq_time", F.lit(0))
    with pytest.raises(ValueError):
        L.coregister(df, df, SMALL, ARCTIC_10KM)


def cells_of(spark, grid, expr="double(id)"):
    return spark.range(grid.n_cells).selectExpr("'c' AS collection", "date'2024-01-01' AS acq_date",
                                                f"int(id div {grid.width}) AS row", f"int(id % {grid.width}) AS col",
                                                f"{expr} AS value")


@pytest.mark.parametrize("method", ["near", "bilinear"])
def test_warp_to_same_grid_is_identity(spark, method):
    src = cells_of(spark, SMALL)
    out = W.warp(src, SMALL, SMALL, method)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, src.collect()))


def test_bilinear_renormalises_over_valid(spark):
    dst = Grid("EPSG:3413", 5.0, 35.0, 10.0, 10.0, 3, 3)
    src = cells_of(spark, SMALL).withColumn("value", F.when(F.col("row") + F.col("col") > 0, F.col("value"))
                                            .otherwise(F.lit(float("nan"))))
    out = {(r["row"], r["col"]): r["value"] for r in W.warp(src, SMALL, dst, "bilinear").collect()}
    assert len(out) == 9 and out[(0, 0)] == pytest.approx((1 + 4 + 5) / 3) and out[(2, 2)] == pytest.approx(12.5)


def test_warp_sea_ice_is_near_identity(spark):
    w = W.warp_weights(spark, SEA_ICE_SOURCE, ARCTIC_10KM, "near")
    assert w.where("row = src_row AND col = src_col").count() > 0.96 * ARCTIC_10KM.n_cells


def test_weather_weights_sum_to_one(spark):
    w = W.warp_weights(spark, WEATHER_SOURCE, ARCTIC_10KM, "bilinear")
    sums = w.groupBy("row", "col").agg(F.sum("w").alias("s"), F.count(F.lit(1)).alias("n"))
    r = sums.agg(F.min("s"), F.max("s"), F.count(F.lit(1)), F.max("n")).head()
    assert r[0] == pytest.approx(1) and r[1] == pytest.approx(1) and r[2] == ARCTIC_10KM.n_cells and r[3] <= 4
    assert CURRENT_SOURCE.width * CURRENT_SOURCE.res_x == pytest.approx(360)


def test_outside_source_is_absent(spark):
    dst = Grid("EPSG:3413", -20.0, 40.0, 10.0, 10.0, 4, 4)
    cols = {r["col"] for r in W.warp(cells_of(spark, SMALL), SMALL, dst, "near").collect()}
    assert cols == {2, 3}


def plane(spark):
    return (spark.range(3).selectExpr("int(id * 10 + 5) AS line")
            .join(spark.range(4).selectExpr("int(id * 7 + 3) AS pixel")).selectExpr(
                "'g' AS granule", "'hh' AS polarization", "'sigma0' AS calibration", "line", "pixel",
                "double(100 + 2 * line + 3 * pixel) AS k"))


def test_lut_join_extrapolates(spark):
    px = spark.range(40 * 40).selectExpr("'g' AS granule", "int(id div 40) AS row", "int(id % 40) AS col", "10D AS dn")
    out = W.lut_join(px, plane(spark), 40, 40, block=8)
    assert out.count() == 1600
    assert out.where(F.abs(F.col("k") - (100 + 2 * F.col("row") + 3 * F.col("col"))) > 1e-9).count() == 0
    with pytest.raises(ValueError, match="template"):
        W.calibrate(px, plane(spark), 40, 40, ("sigma0", "beta0"))


def test_swath_gridding(spark):
    pts = spark.createDataFrame([(5.0, 35.0, 1.0), (6.0, 36.0, 3.0), (99.0, 0.0, 1.0), (5.0, 35.0, float("nan"))],
                                "x double, y double, value double").withColumn("acq_time", F.lit(0))
    rows = grid_points(pts, SMALL).collect()
    assert [(r["row"], r["col"], r["value"], r["n"]) for r in rows] == [(0, 0, 2.0, 2)]
    with pytest.raises(KeyError, match="known keys"):
        convert("nope", pts)


def test_arrow_fields(spark):
    v = full_grid(spark, Grid("EPSG:3413", -3850000.0, 5850000.0, 10000.0, 10000.0, 760, 20)).selectExpr(
        "row", "col", "3D AS u", "4D AS v")
    r = L.arrows(v).orderBy("row", "col").head()
    assert (r["row"], r["col"], r["speed"], r["dir_to"]) == (7, 7, 5.0, 36.9)
    seg = L.glyph_segments(v).where("row = 8 AND col = 8").collect()
    assert [s["spacing"] for s in seg] == [160000.0]
    s = seg[0]
    assert math.hypot(s["x1"] - s["x0"], s["y1"] - s["y0"]) == pytest.approx(5 * 0.8 * 160000 / 25)
