from __future__ import annotations

import os
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from floegrid.functions.grids import Grid
from floegrid.operators import cube as C, dates as D, mosaic as M, pyramid as P, stats as S, tiles as T
from floegrid.operators.geocode import fit_splines, geocode_tiles, warp_tiles
from floegrid.operators.warp import warp


def times(spark, *stamps, collection="c"):
    return spark.createDataFrame([(collection, s) for s in stamps], "collection string, t string").select(
        "collection", F.to_timestamp("t").alias("acq_time"))


def cells(spark, rows, collection="c"):
    return spark.createDataFrame([(collection, *r) for r in rows],
                                 "collection string, t string, row int, col int, value double").select(
        "collection", F.to_timestamp("t").alias("acq_time"), "row", "col", "value")


def content(cube):
    return sorted((str(r["acq_date"]), r["row"], r["col"], r["value"]) for r in cube.data().collect())


@pytest.fixture()
def cube(spark, tmp_path):
    return C.Cube(spark, str(tmp_path / "cube"))


def test_write_keeps_other_dates_and_empty_slices(spark, cube):
    cube.write_slices(cells(spark, [("2024-01-01", 0, 0, 1.0), ("2024-01-02", 0, 1, 2.0)]),
                      times(spark, "2024-01-01", "2024-01-02", "2024-01-03"))
    assert [str(r["acq_time"])[:10] for r in cube.slices().orderBy("acq_time").collect()] == [
        "2024-01-01", "2024-01-02", "2024-01-03"]
    assert [(str(r["acq_date"]), r["n_valid"]) for r in cube.slice_counts().orderBy("acq_time").collect()] == [
        ("2024-01-01", 1), ("2024-01-02", 1), ("2024-01-03", 0)]
    before = {p: os.path.getmtime(os.path.join(r, p)) for r, _, fs in os.walk(f"{cube.root}/data/collection=c/acq_date=2024-01-01")
              for p in fs}
    cube.write_slices(cells(spark, [("2024-01-02", 5, 5, 9.0)]), times(spark, "2024-01-02"))
    after = {p: os.path.getmtime(os.path.join(r, p)) for r, _, fs in os.walk(f"{cube.root}/data/collection=c/acq_date=2024-01-01")
             for p in fs}
    assert content(cube) == [("2024-01-01", 0, 0, 1.0), ("2024-01-02", 5, 5, 9.0)] and before == after


def test_two_slices_of_one_date_coexist(spark, cube):
    for stamp in ("2024-01-01 00:00:00", "2024-01-01 12:00:00"):
        cube.write_slices(cells(spark, [(stamp, 0, 0, 1.0)]), times(spark, stamp))
    assert cube.slices().count() == 2 and len(content(cube)) == 2


def test_sync_is_idempotent_and_guarded(spark, cube):
    days = ["2024-01-01", "2024-01-02", "2024-01-03"]
    cube.write_slices(cells(spark, [(d, 0, 0, 1.0) for d in days[:2]]), times(spark, *days[:2]))
    want = spark.createDataFrame([(d,) for d in days[1:] + ["2024-01-09"]], "d string").select(F.to_date("d").alias("acq_date"))
    new = cells(spark, [(d, 0, 0, 7.0) for d in days])
    done = cube.sync("c", want, new, times(spark, *days))
    assert done == {"added": [date(2024, 1, 3)], "dropped": [date(2024, 1, 1)], "kept": [date(2024, 1, 2)]}
    state = content(cube)
    assert state == [("2024-01-02", 0, 0, 1.0), ("2024-01-03", 0, 0, 7.0)]
    again = cube.sync("c", want, new, times(spark, *days))
    assert again["added"] == [] and again["dropped"] == [] and content(cube) == state
    with pytest.raises(RuntimeError, match="empty"):
        cube.sync("c", want.limit(0), new, times(spark, *days))
    with pytest.raises(RuntimeError, match="nothing to write"):
        cube.sync("c", want.where("acq_date > date'2024-01-05'"), new, times(spark, *days))
    assert content(cube) == state


def test_retain_is_by_dates_with_data(spark, cube):
    days = ["2024-01-01", "2024-02-01", "2024-03-01"]
    cube.write_slices(cells(spark, [(d, 0, 0, 1.0) for d in days]), times(spark, *days))
    assert cube.retain("c", 0) == [] and cube.retain("c", 2) == [date(2024, 1, 1)]
    assert [c[0] for c in content(cube)] == days[1:]


def raster(spark, rows):
    return spark.createDataFrame(rows, "raster string, t string, ord long, xmin double, ymin double, xmax double, "
                                       "ymax double, res_x double").select(
        "raster", F.lit("c").alias("collection"), F.to_timestamp("t").alias("acq_time"), "ord", "xmin", "ymin", "xmax",
        "ymax", "res_x", F.lit("EPSG:3413").alias("crs"), F.lit(None).cast("double").alias("nodata"))


def raw(spark, rows):
    return spark.createDataFrame(rows, "raster string, row int, col int, value double")


def test_upsert_fresh_append_rebuild(spark, cube):
    a = raster(spark, [("a", "2024-01-01", 1, 0.0, 0.0, 40.0, 40.0, 10.0)])
    assert cube.upsert("c", a, raw(spark, [("a", 0, 0, 1.0), ("a", 3, 3, 2.0)])) == "fresh"
    b = raster(spark, [("b", "2024-01-02", 1, 10.0, 10.0, 30.0, 30.0, 10.0)])
    assert cube.upsert("c", b, raw(spark, [("b", 0, 0, 5.0)])) == "append"
    assert content(cube)[-1] == ("2024-01-02", 1, 1, 5.0)
    far = raster(spark, [("x", "2024-01-03", 1, -20.0, 0.0, 20.0, 60.0, 10.0)])
    with pytest.raises(RuntimeError, match="expansion is off"):
        cube.upsert("c", far, raw(spark, [("x", 0, 0, 9.0)]), allow_expansion=False)
    assert cube.upsert("c", far, raw(spark, [("x", 0, 0, 9.0)])) == "rebuild"
    assert content(cube) == [("2024-01-01", 2, 2, 1.0), ("2024-01-01", 5, 5, 2.0), ("2024-01-02", 3, 3, 5.0),
                             ("2024-01-03", 0, 0, 9.0)]
    m = cube.meta().head()
    assert (m["west"], m["north"], m["width"], m["height"]) == (-20.0, 60.0, 6, 6)


def test_a_second_raster_of_one_time_is_merged(spark, cube):
    one = ("2024-01-01", 1, 0.0, 0.0, 40.0, 40.0, 10.0)
    cube.upsert("c", raster(spark, [("a", *one)]), raw(spark, [("a", 0, 0, 1.0), ("a", 3, 3, 2.0)]))
    assert cube.upsert("c", raster(spark, [("b", *one)]), raw(spark, [("b", 0, 0, 5.0), ("b", 1, 1, 6.0)])) == "append"
    assert content(cube) == [("2024-01-01", 0, 0, 5.0), ("2024-01-01", 1, 1, 6.0), ("2024-01-01", 3, 3, 2.0)]


def test_readers_of_a_version_outlive_a_rebuild(spark, cube):
    """A frame planned before a rebuild still reads its files; `vacuum` removes them later."""
    a = raster(spark, [("a", "2024-01-01", 1, 0.0, 0.0, 40.0, 40.0, 10.0)])
    cube.upsert("c", a, raw(spark, [("a", 0, 0, 1.0)]))
    before = cube.data().select("row", "col", "value")
    before.count()
    far = raster(spark, [("x", "2024-01-03", 1, -20.0, 0.0, 20.0, 60.0, 10.0)])
    assert cube.upsert("c", far, raw(spark, [("x", 0, 0, 9.0)])) == "rebuild"
    assert [tuple(r) for r in before.collect()] == [(0, 0, 1.0)]
    assert cube.data().count() == 2 and cube.meta().head()["source_files_count"] == 2
    assert cube.vacuum() == ["data/collection=c"] and cube.data().count() == 2


def test_sync_reads_only_the_dates_to_add(spark, cube, tmp_path):
    """The dates are literals in the filter of what is offered, so they reach its scan."""
    days = [f"2024-01-{d:02d}" for d in range(1, 21)]
    cells(spark, [(d, 0, 0, 7.0) for d in days]).write.parquet(str(tmp_path / "new"))
    offered = spark.read.parquet(str(tmp_path / "new"))
    cube.write_slices(offered.where("day(acq_time) <= 18"), offered.where("day(acq_time) <= 18").select("collection", "acq_time"))
    picked = cube._of_dates(offered, {date(2024, 1, 19), date(2024, 1, 20)})
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert ">= 2024-01-19 00:00:00" in plan and "PushedFilters" in plan and "LessThan(acq_time,2024-" in plan
    want = spark.createDataFrame([(d,) for d in days], "d string").select(F.to_date("d").alias("acq_date"))
    done = cube.sync("c", want, offered)
    assert [d.day for d in done["added"]] == [19, 20] and cube.data().count() == 20


def test_a_rebuild_that_fails_can_be_repeated(spark, cube, monkeypatch):
    """Stored cells move once, however often the rebuild is tried."""
    a = raster(spark, [("a", "2024-01-01", 1, 0.0, 0.0, 40.0, 40.0, 10.0)])
    cube.upsert("c", a, raw(spark, [("a", 0, 0, 1.0)]))
    far = raster(spark, [("x", "2024-01-03", 1, -20.0, 0.0, 20.0, 60.0, 10.0)])

    def fail(*_, **__):
        raise OSError("lost")
    with monkeypatch.context() as m:
        m.setattr(C.Cube, "write_meta", fail)
        with pytest.raises(OSError):
            cube.upsert("c", far, raw(spark, [("x", 0, 0, 9.0)]))
    assert content(cube) == [("2024-01-01", 0, 0, 1.0)]
    assert cube.upsert("c", far, raw(spark, [("x", 0, 0, 9.0)])) == "rebuild"
    want = [("2024-01-01", 2, 2, 1.0), ("2024-01-03", 0, 0, 9.0)]
    assert content(cube) == want
    further = raster(spark, [("y", "2024-01-04", 1, -30.0, 0.0, 20.0, 70.0, 10.0)])
    assert cube.upsert("c", further, raw(spark, [("y", 0, 0, 4.0)])) == "rebuild"
    assert content(cube) == [("2024-01-01", 3, 3, 1.0), ("2024-01-03", 1, 1, 9.0), ("2024-01-04", 0, 0, 4.0)]
    assert cube.retain("c", 1) and content(cube) == [("2024-01-04", 0, 0, 4.0)]


def test_two_times_within_a_second_are_two_slices(spark, cube):
    cube.write_slices(cells(spark, [("2024-01-01 10:00:00.25", 0, 0, 1.0)]), times(spark, "2024-01-01 10:00:00.25"))
    cube.write_slices(cells(spark, [("2024-01-01 10:00:00.75", 0, 0, 2.0)]), times(spark, "2024-01-01 10:00:00.75"))
    assert cube.slices().count() == 2 and len(content(cube)) == 2


def test_raster_outside_grid_leaves_an_empty_slice(spark, cube):
    a = raster(spark, [("a", "2024-01-01", 1, 0.0, 0.0, 40.0, 40.0, 10.0)])
    cube.upsert("c", a, raw(spark, [("a", 0, 0, 1.0)]))
    grid = cube.meta().select(*C.GRID_COLUMNS)
    off = raster(spark, [("o", "2024-01-05", 1, 400.0, 0.0, 440.0, 40.0, 10.0)])
    placed = C.place_cells(raw(spark, [("o", 0, 0, 1.0)]), off, grid)
    assert placed.count() == 0
    cube.write_slices(placed.select("collection", "acq_time", "row", "col", "value"), off.select("collection", "acq_time"))
    assert {str(r["acq_date"]): r["n_valid"] for r in cube.slice_counts().collect()} == {"2024-01-01": 1, "2024-01-05": 0}


def test_union_bounds_skips_unreadable_and_fails_on_none(spark):
    r = raster(spark, [("a", "2024-01-01", 2, 0.0, 0.0, 40.0, 40.0, 10.0), ("b", "2024-01-01", 1, None, 0.0, 1.0, 1.0, 99.0),
                       ("c", "2024-01-01", 3, -5.0, 0.0, 40.0, 45.0, 11.0)])
    b = S.union_bounds(r).head()
    assert (b["west"], b["north"], b["resolution"], b["n_rasters"]) == (-5.0, 45.0, 10.5, 2)
    with pytest.raises(Exception, match="no raster"):
        S.union_bounds(r.where("raster = 'b'")).collect()


def test_mosaic_rules(spark):
    rows = [(1, 0, 1.0), (2, 0, None), (3, 0, float("nan")), (1, 1, 5.0), (2, 1, 6.0), (2, 2, None)]
    df = spark.createDataFrame(rows, "ord int, col int, value double").selectExpr("*", "0 AS row", "'c' AS collection",
                                                                                "date'2024-01-01' AS acq_date")
    out = M.mosaic(df, ["ord"])
    assert sorted((r["col"], r["value"]) for r in out.collect()) == [(0, 1.0), (1, 6.0)]
    again = M.mosaic(out.withColumn("ord", F.lit(0)), ["ord"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.collect()))


def test_overview_uses_one_exchange(spark):
    df = spark.range(4096).selectExpr(
        "concat('c', id % 1) AS collection", "date_add(date'2024-01-01', int(id % 1)) AS acq_date",
        "int(id div 64) AS row", "int(id % 64) AS col", "double(id % 7) AS value")
    out = P.overview(df, levels=(2, 4, 8))
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    real = [line for line in final.splitlines() if "Exchange hashpartitioning" in line and "Reused" not in line]
    assert len(real) == 1 and final.count("ReusedExchange") == 2
    levels = {r["level"]: r["n"] for r in out.groupBy("level").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert levels == {2: 1024, 4: 256, 8: 64}
    got = {(r["row"], r["col"]): r["value"] for r in out.where("level = 8").collect()}
    grid = np.array([i % 7 for i in range(4096)], float).reshape(64, 64)
    assert got[(3, 5)] == pytest.approx(grid[24:32, 40:48].mean())


def test_overview_mode_ties_and_nodata(spark):
    df = spark.createDataFrame([(0, 0, 3), (0, 1, 2), (1, 0, -1), (1, 1, -1), (2, 2, 4)], "row int, col int, value int").selectExpr(
        "'c' AS collection", "date'2024-01-01' AS acq_date", "*")
    out = P.overview(df, levels=(2,), how="mode", nodata=-1)
    assert sorted((r["row"], r["col"], r["value"]) for r in out.collect()) == [(0, 0, 2), (1, 1, 4)]


def test_dates(spark):
    rows = [("c", f"2024-01-{d:02d}", n) for d, n in [(1, 5), (2, 100), (3, 60), (5, 90), (6, 3)]]
    t = spark.createDataFrame(rows, "collection string, d string, n int").select("collection", F.to_date("d").alias("acq_date"), "n")
    assert sorted(r["n"] for r in D.complete_dates(t, 20, 0.8).collect()) == [90, 100]
    assert sorted(r["n"] for r in D.complete_dates(t, 0, 0).collect()) == [3, 5, 60, 90, 100]
    today = F.lit("2024-01-06").cast("date")
    got = [str(r[0]) for r in D.candidate_dates(t, 2, today, 30, start_offset=1, drop_newest=1).collect()]
    assert got == ["2024-01-03", "2024-01-02"]
    assert [str(r[0]) for r in D.candidate_dates(t, 2, today, 3).orderBy("acq_date").collect()] == ["2024-01-05", "2024-01-06"]
    assert D.calendar_dates(spark, 3, today).count() == 3
    kept = [D.retain_newest(t, n).count() for n in range(5)]
    assert kept == [5, 1, 2, 3, 4]
    p, s = t.select("acq_date", "n"), t.where("n < 90").select("acq_date", (F.col("n") + 1).alias("n"))
    chosen = {str(r["acq_date"]): (r["source"], r["n"]) for r in D.choose_source(p, s).collect()}
    assert chosen["2024-01-02"] == ("asf", 100) and chosen["2024-01-03"] == ("cdse", 61)
    assert {r["source"] for r in D.choose_source(p, s, secondary_enabled=False).collect()} == {"asf"}


def test_pick_per_date_prefers_last_daily_else_first(spark):
    rows = [("c", "d1", "a.tif", 1), ("c", "d1", "b_daily_COG.tif", 2), ("c", "d1", "c_daily_COG.tif", 3), ("c", "d1", "d.tif", 4),
            ("c", "d2", "x.tif", 5), ("c", "d2", "y.tif", 6)]
    df = spark.createDataFrame(rows, "collection string, acq_date string, uri string, ord int")
    assert {r["acq_date"]: r["uri"] for r in D.pick_per_date(df, "uri", "ord").collect()} == {"d1": "c_daily_COG.tif", "d2": "x.tif"}


def test_load_state(spark):
    def dates(*ds):
        return spark.createDataFrame([(d,) for d in ds], "d string").select(F.to_date("d").alias("acq_date"))
    left = D.forget_load_state(dates("2024-01-01", "2024-01-02", "2024-01-09"), F.lit("2024-01-05").cast("date"), dates("2024-01-02"))
    assert sorted(str(r[0]) for r in left.collect()) == ["2024-01-02", "2024-01-09"]


# --- tiles -----------------------------------------------------------------------------------

def tile_cells(spark, h, w, where="true", **cols):
    df = spark.range(h * w).selectExpr("'c' AS collection", "date'2024-01-01' AS acq_date", f"int(id div {w}) AS row",
                                       f"int(id % {w}) AS col", "float(id) AS value").where(where)
    return df.withColumns({k: F.lit(v) for k, v in cols.items()})


def flat(df):
    return sorted((r["row"], r["col"], r["value"]) for r in df.collect())


def test_tiles_round_trip_and_edges(spark):
    df = tile_cells(spark, 20, 13, "value % 3 <> 0")
    tiles = T.assemble_tiles(df, 8, height=20, width=13)
    assert {(r["ty"], r["tx"]): (r["h"], r["w"]) for r in tiles.collect()}[(2, 1)] == (4, 5)
    assert flat(T.explode_tiles(tiles, 8)) == flat(df)


@pytest.mark.parametrize("dr, dc", [(0, 0), (3, 5), (-4, -2), (100, 0)])
def test_retile_clips_on_all_sides(spark, dr, dc):
    df = tile_cells(spark, 20, 13)
    tiles = T.assemble_tiles(df, 8, height=20, width=13).withColumns({"dr": F.lit(dr), "dc": F.lit(dc), "ord": F.lit(1)})
    moved = T.retile(tiles, 8, 6, 22, 15, keys=["collection", "acq_date", "ord"], row_off="dr", col_off="dc")
    out = T.explode_tiles(T.mosaic_tiles(moved), 6)
    want = sorted((r + dr, c + dc, v) for r, c, v in flat(df) if 0 <= r + dr < 22 and 0 <= c + dc < 15)
    assert flat(out) == want


@pytest.mark.parametrize("bucket", [1, 3, 100])
def test_mosaic_tiles_paint_order(spark, bucket):
    parts = [tile_cells(spark, 8, 8, f"value % {o + 1} = 0").withColumns({"value": F.col("value") * 0 + o, "ord": F.lit(o)})
             for o in range(9)]
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p)
    tiles = T.assemble_tiles(df, 4, keys=["collection", "acq_date", "ord"])
    assert flat(T.explode_tiles(T.mosaic_tiles(tiles, bucket=bucket), 4)) == flat(M.mosaic(df, ["ord"]))


def halved(grid, how):
    """A raster at half its resolution, pixel by pixel."""
    out = np.full(((grid.shape[0] + 1) // 2, (grid.shape[1] + 1) // 2), np.nan, np.float32)
    for r, c in np.ndindex(*out.shape):
        block = grid[2 * r:2 * r + 2, 2 * c:2 * c + 2]
        if how == "nearest":
            out[r, c] = block[0, 0]
            continue
        good = block[~np.isnan(block)].tolist()
        if good:
            out[r, c] = sum(good) / len(good) if how == "average" else min(good, key=lambda v: (-good.count(v), v))
    return out


@pytest.mark.parametrize("how", ["average", "mode", "nearest"])
@pytest.mark.parametrize("shape", [(50, 37), (64, 64), (3, 9)])
def test_tile_pyramid_equals_pixels(spark, how, shape):
    rng = np.random.default_rng(shape[0])
    grid = rng.integers(0, 5, shape).astype(np.float32)
    grid[rng.random(shape) < .4] = np.nan
    grid[:, :8] = np.nan
    cells = [("c", int(r), int(c), float(grid[r, c])) for r, c in zip(*np.nonzero(~np.isnan(grid)))]
    df = spark.createDataFrame(cells, "collection string, row int, col int, value float")
    for size in ({"height": shape[0], "width": shape[1]}, {}):
        tiles = T.assemble_tiles(df, 4, keys=["collection"], **size)
        levels = T.overview_tiles(tiles, 4, how=how, keys=["collection"], **size)
        got = {(r["level"], r["row"], r["col"]): r["value"] for r in T.explode_tiles(levels, 4, ["collection", "level"]).collect()}
        want, level = {}, grid
        for n in (2, 4, 8, 16, 32):
            level = halved(level, how)
            want |= {(n, int(r), int(c)): level[r, c] for r, c in zip(*np.nonzero(~np.isnan(level)))}
        assert got == want
    if how == "average":
        edge = T.overview_tiles(T.assemble_tiles(df, 4, keys=["collection"], height=shape[0], width=shape[1]), 4, (2,), keys=["collection"],
                                height=shape[0], width=shape[1]).agg({"h": "min", "w": "min"}).head()
        assert edge["min(h)"] == ((shape[0] + 1) // 2 - 1) % 4 + 1 and edge["min(w)"] == ((shape[1] + 1) // 2 - 1) % 4 + 1


def test_tile_pyramid_limits(spark):
    tiles = T.assemble_tiles(tile_cells(spark, 4, 5, "value <> 0"), 8, height=4, width=5)
    for bad in ({"how": "median"}, {"levels": (2, 8)}):
        with pytest.raises(ValueError):
            T.overview_tiles(tiles, 8, **bad)
    masked = T.overview_tiles(tiles, 8, (2,), nodata=7.0).head()
    assert T.decode(masked["data"], masked["h"], masked["w"])[0, 0] == pytest.approx((1 + 5 + 6) / 3)
    assert T.overview_tiles(tiles.limit(0), 8).count() == 0


SOURCE_LONLAT = Grid("EPSG:4326", -180.0, 90.0, 5.0, 2.5, 72, 12)
SOURCE_HUGHES = Grid("EPSG:3411", -3850000.0, 5850000.0, 200000.0, 200000.0, 38, 56)
TARGET_POLAR = Grid("EPSG:3413", -2500000.0, 2600000.0, 70000.0, 70000.0, 70, 75)


@pytest.mark.parametrize("src", [SOURCE_LONLAT, SOURCE_HUGHES])
@pytest.mark.parametrize("method", ["bilinear", "near"])
def test_warped_tiles_equal_warped_cells(spark, src, method):
    """Over tile borders, holes, the edge of the source and, for longitudes, around the globe."""
    rng = np.random.default_rng(3)
    grid = rng.uniform(0, 100, (src.height, src.width))
    grid[rng.random(grid.shape) < .1] = np.nan
    rows = [(k, int(r), int(c), float(grid[r, c]) + off) for k, off in (("a", 0), ("b", 1000)) for r, c in zip(*np.nonzero(~np.isnan(grid)))]
    df = spark.createDataFrame(rows, "collection string, row int, col int, value double")
    tiles = T.assemble_tiles(df, 16, keys=["collection"], height=src.height, width=src.width)
    want = {(r["collection"], r["row"], r["col"]): r["value"] for r in warp(df, src, TARGET_POLAR, method, keys=["collection"]).collect()}
    for step in (1, 16):
        out = T.explode_tiles(warp_tiles(tiles, src, TARGET_POLAR, 16, 20, method, ["collection"], step, 1e-4), 20, ["collection"])
        got = {(r["collection"], r["row"], r["col"]): r["value"] for r in out.collect()}
        # A position on the very edge of a source pixel may fall to either side.
        assert len(got.keys() ^ want.keys()) <= len(want) // 500
        far = [k for k in got.keys() & want.keys() if abs(got[k] - want[k]) > (1e-3 if step == 1 else 0.1)]
        assert len(want) > 5000 and len(far) <= len(want) // 500


def gcp_table(spark, fn, n=5, size=40):
    pts = [("g", float(r), float(c), *map(float, fn(r, c))) for r in np.linspace(0, size, n) for c in np.linspace(0, size, n)]
    return spark.createDataFrame(pts, "granule string, row double, col double, x double, y double")


def geocoded(spark, df, gcps, grid, lattice, tile=16, out=12):
    tiles = T.assemble_tiles(df, tile, keys=["granule", "collection", "acq_date", "ord"], height=40, width=40)
    part = geocode_tiles(tiles, gcps, grid, tile, out, carry=["collection", "acq_date", "ord"], lattice=lattice)
    return T.explode_tiles(T.mosaic_tiles(part), out)


def test_geocode_identity_and_shift(spark):
    grid = Grid("EPSG:3413", 0.0, 400.0, 10.0, 10.0, 45, 42)
    df = tile_cells(spark, 40, 40, granule="g", ord=1)
    same = geocoded(spark, df, gcp_table(spark, lambda r, c: (c * 10, 400 - r * 10)), grid, 1)
    got = {(r["row"], r["col"]): r["value"] for r in same.collect()}
    assert len(got) == 1600 and max(abs(v - (r * 40 + c)) for (r, c), v in got.items()) < 1e-2


@pytest.mark.parametrize("lattice", [1, 8])
def test_geocode_rotation_crosses_tile_borders(spark, lattice):
    grid = Grid("EPSG:3413", -150.0, 650.0, 10.0, 10.0, 80, 80)
    a = np.radians(25)

    def place(r, c):
        u, v = (c - 20) * 10, -(r - 20) * 10
        return 250 + u * np.cos(a) - v * np.sin(a), 250 + u * np.sin(a) + v * np.cos(a)
    df = tile_cells(spark, 40, 40, granule="g", ord=1)
    got = {(r["row"], r["col"]): r["value"] for r in geocoded(spark, df, gcp_table(spark, place), grid, lattice).collect()}
    bad = n = 0
    for (r, c), v in got.items():
        x, y = -150 + (c + 0.5) * 10 - 250, 650 - (r + 0.5) * 10 - 250
        u, w = x * np.cos(a) + y * np.sin(a), -x * np.sin(a) + y * np.cos(a)
        pr, pc = 20 - w / 10 - 0.5, 20 + u / 10 - 0.5
        if 0.5 < pr < 38.5 and 0.5 < pc < 38.5:
            n += 1
            bad += abs(v - (pr * 40 + pc)) > 1e-2
    assert n > 1300 and bad == 0 and abs(len(got) - 1600) < 80


def test_splines_pass_through_control_points(spark):
    rng = np.random.default_rng(2)
    rows = [("g", float(r), float(c), *map(float, rng.uniform(0, 1e6, 2))) for r in range(6) for c in range(6)]
    gcps = spark.createDataFrame(rows, "granule string, row double, col double, x double, y double")
    f = fit_splines(gcps).head()
    px, py = np.array(f["px"]), np.array(f["py"])
    from floegrid.operators.geocode import _kernel
    basis = np.column_stack([_kernel(px, py, px, py), np.ones(36), px, py])
    assert np.allclose(sorted(basis @ np.array(f["w_row"])), sorted(r[1] for r in rows), atol=1e-5)


def test_tile_cube_layout(spark, tmp_path):
    cube = C.Cube(spark, str(tmp_path / "tiles"), layout="tile")
    tiles = T.assemble_tiles(tile_cells(spark, 20, 13), 8, height=20, width=13).withColumn("acq_time", F.to_timestamp("acq_date"))
    cube.write_slices(tiles.drop("acq_date"), tiles.select("collection", "acq_time"))
    assert flat(T.explode_tiles(cube.data(), 8)) == flat(tile_cells(spark, 20, 13)) and cube.slices().count() == 1


def test_coordinate_bounds_add_one_step(spark):
    df = spark.createDataFrame([(0.0, 40.0), (30.0, 10.0)], "x double, y double")
    assert tuple(S.coordinate_bounds(df, res=10.0).head()) == (0.0, 0.0, 40.0, 40.0)


def test_one_hot_place_is_shared(spark):
    """A third of all inputs painted on one cell and one tile."""
    df = spark.range(3000).selectExpr("id AS ord", "int(IF(id % 3 = 0, 5, id % 40)) AS row", "int(IF(id % 3 = 0, 5, id % 37)) AS col",
                                      "float(id) AS value", "'c' AS collection", "date'2024-01-01' AS acq_date")
    want = flat(M.mosaic(df, ["ord"]))
    assert dict(((r, c), v) for r, c, v in want)[(5, 5)] == 2997.0
    tiles = T.assemble_tiles(df, 8, keys=["collection", "acq_date", "ord"])
    assert flat(T.explode_tiles(T.mosaic_tiles(tiles, bucket=64), 8)) == want


def test_hot_key_chunks(spark):
    from floegrid.operators.lod import chunk_no
    df = spark.range(6000).selectExpr("IF(id % 3 = 0, 'hot', concat('k', id % 50)) AS k", "id")
    out = chunk_no(df, ["k"], ["id"], size=100, partitions=8)
    sizes = out.groupBy("k", "chunk").count()
    full = sizes.where("k = 'hot'")
    assert full.count() == 20 and full.where("count <> 100").count() == 0
    assert out.count() == 6000 and sizes.where("count > 100").count() == 0
