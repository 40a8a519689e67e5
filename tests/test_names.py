from __future__ import annotations

from datetime import datetime
from fnmatch import fnmatchcase

import pytest
from pyspark.sql import functions as F

from floegrid.functions import names as N


def one(spark, column_of, *values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(column_of(F.col("v")).alias("r")).collect()]


NAMES = {
    "SWOT_L2_LR_NPFRB_024_529_20241130T233441_x_freeboard.tif": datetime(2024, 11, 30, 23, 34, 41),
    "swot_bin_20231130_ssha_COG.tif": datetime(2023, 11, 30),
    "SWOT_BIN_202311_ssha_COG.tif": datetime(2023, 11, 1),
    "S1A_EW_GRDM_1SDH_20241201T163328_20241201T163428_sigma0.tif": datetime(2024, 12, 1, 16, 33, 28),
    "S1C_EW_GRDM_1SDH_20241201T163328_20241201T163428_sigma0.tif": datetime(2024, 12, 1, 16, 33, 28),
    "icesat2_bin_20250321_freeboard.tif": datetime(2025, 3, 21),
    "icesat2_bin_202412_lead_ssha.tif": datetime(2024, 12, 1),
    "nothing.tif": datetime(2020, 1, 2, 3),
}


def test_acq_time_families_and_mtime(spark):
    mtime = F.lit("2020-01-02 03:00:00").cast("timestamp")
    assert one(spark, lambda c: N.acq_time(c, mtime), *NAMES) == list(NAMES.values())


def test_acq_time_user_regex(spark):
    regex = r"_(?P<start_date>\d{8})_daily_COG"
    got = one(spark, lambda c: N.acq_time(c, regex=regex), "x_20260616_daily_COG.tif", "x_20261399_daily_COG.tif",
              "swot_bin_20231130_ssha_COG.tif", "nothing.tif")
    assert got == [datetime(2026, 6, 16), None, datetime(2023, 11, 30), None]
    iso = one(spark, lambda c: N.acq_time(c, regex=r"^([^_]+)_"), "2024-02-03T04:05:06_x.tif", "20240203T040506_x.tif")
    assert iso == [datetime(2024, 2, 3, 4, 5, 6), datetime(2024, 2, 3, 4, 5, 6)]
    assert one(spark, lambda c: N.acq_time(c, regex="no groups"), "no groups 20240101") == [None]


def test_catalog_time_noon(spark):
    regex = r"_(?P<start_date>\d{8})_daily_COG"
    assert one(spark, lambda c: N.catalog_time(c, regex, "%Y%m%d"), "x_20260616_daily_COG.tif") == [
        datetime(2026, 6, 16, 12)]
    assert one(spark, lambda c: N.catalog_time(c, r"_(\d{8}T\d{6})Z"), "a_20240101T000000Z.tif", "b.tif") == [
        datetime(2024, 1, 1), None]
    assert one(spark, lambda c: N.catalog_time(c, r"_(\d{4}-\d{2}-\d{2}T\d{2})", "%Y-%m-%dT%H"), "a_2024-01-01T07.tif"
               ) == [datetime(2024, 1, 1, 7)]


def test_parse_granule_name(spark):
    df = spark.createDataFrame([("S1A_EW_GRDM_1SDH_20260628T015949_x",), ("S2A_foo",)], "v string")
    got = [r[0] for r in df.select(N.parse_granule_name(F.col("v"))).collect()]
    assert tuple(got[0]) == ("S1A", "EW", "GRDM", "1SDH", datetime(2026, 6, 28, 1, 59, 49))
    assert got[1] is None


@pytest.mark.parametrize("pattern", ["*", "a*c", "a?c", "[ab]*", "[!ab]*", "a.c", "*_1SDH_*", "[", "a[b", "[]x]a"])
def test_glob_matches_fnmatch(spark, pattern):
    words = ["abc", "ABC", "a.c", "axc", "b", "", "x_1SDH_y", "[", "a[b", "]a", "xa", "cba"]
    assert one(spark, lambda c: N.glob_match(c, pattern), *words) == [fnmatchcase(w, pattern) for w in words]


def test_platform_and_type(spark):
    got = one(spark, N.platform_and_type, "SENTINEL-1A_DP_GRD_MEDIUM", "sentinel-1c_dp_grd_high")
    assert [tuple(g) for g in got] == [("S1A", "_GRDM_"), ("S1C", "_GRDH_")]
    with pytest.raises(Exception, match="no platform"):
        one(spark, N.platform_and_type, "LANDSAT")


def test_uris(spark):
    got = one(spark, N.parse_uri, "s3://b/k/x.tif", "s3://b")
    assert [tuple(g) for g in got] == [("b", "k/x.tif"), ("b", "")]
    with pytest.raises(Exception, match="not an s3 path"):
        one(spark, N.parse_uri, "http://b/k")
    assert one(spark, N.http_to_s3, "https://s3.amazonaws.com/b/k/x", "http://b.s3.amazonaws.com/k/x", "http://z/k") == [
        "s3://b/k/x", "s3://b/k/x", None]


def test_paths(spark):
    assert one(spark, lambda c: N.remap_path(c, "/home/x", "/data"), "/home/x/y", "/z/home/x/home/x", "/q") == [
        "/data/y", "/z/data/home/x", "/q"]
    assert one(spark, N.item_id, "a/b/c.d.TIF", "a/b.tiff", "a/b.json") == ["c.d", "b", None]
    assert [str(d) for d in one(spark, N.key_date, "p/2024/02/29/x.tif", "p/2024/02/30/x", "p")] == [
        "2024-02-29", "None", "None"]
    assert [str(d) for d in one(spark, N.stem_date, "a/c_20240102_full.geojson", "a/c_2024010_full.geojson")] == [
        "2024-01-02", "None"]
    assert N.cube_prefix("/p/", "c") == "p/c/c.zarr/" and N.raster_prefix("", "c") == "c/"
