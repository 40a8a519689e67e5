from __future__ import annotations

import json
import os
import struct
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from floegrid.functions import geometry as G
from floegrid.operators import catalog as K
from floegrid.operators.overlap import overlap_join
from floegrid.sources import refs, sinks
from floegrid.sources.calibration import scan_calibration_lut
from floegrid.sources.fields import read_field, subset_field
from floegrid.sources.granules import (granule_links, newest_links, read_granule_pages, scan_granules, scan_products)
from floegrid.sources.objects import list_objects, scan_objects
from floegrid.plans.jobs import overlap_index


def item(name, start, end=None, ring=((10, 70), (20, 70), (20, 75), (10, 75)), links=(), polygons=None):
    pts = [{"Longitude": x, "Latitude": y} for x, y in ring]
    times = {"BeginningDateTime": start} if start else {}
    if end:
        times["EndingDateTime"] = end
    return {"meta": {"concept-id": f"id-{name}"}, "umm": {
        "GranuleUR": name, "TemporalExtent": {"RangeDateTime": times},
        "SpatialExtent": {"HorizontalSpatialDomain": {"Geometry": {
            "GPolygons": [{"Boundary": {"Points": pts}}] if polygons is None else polygons}}},
        "RelatedUrls": [{"URL": u, "Type": t} for u, t in links]}}


A = "S1A_EW_GRDM_1SDH_20240102T010000_20240102T010100_a"
B = "S1C_EW_GRDM_1SDH_20240103T235900_20240104T000100_b"


@pytest.fixture()
def pages(tmp_path):
    good = [item(A, "2024-01-02T01:00:00Z", links=[("https://h/x_2.TIF?sig=1", "GET DATA"), ("https://h/x.xml", "GET DATA"),
                                                    ("s3://b/x_3.tiff", "GET DATA"), ("https://h/y.tif", "VIEW")]),
            item(B, "2024-01-03T23:59:00Z", "2024-01-04T00:01:00Z", ring=((175, 70), (-175, 70), (-175, 75), (175, 75), (175, 70)))]
    bad = [item("unparseable", "2024-01-02T00:00:00Z"), item(A.replace("_a", "_c"), None),
           item(A.replace("_a", "_d"), "2024-01-02T00:00:00Z", polygons=[]),
           item(A.replace("_a", "_e"), "2024-01-02T00:00:00Z", ring=((0, 70), (1, 70), (0, 70)))]
    (tmp_path / "p1.json").write_text(json.dumps({"items": good + bad}))
    (tmp_path / "p2.json").write_text(json.dumps({"items": good[1:]}))
    return str(tmp_path)


def test_scan_granules(spark, pages):
    rows = scan_granules(spark, pages, date(2024, 1, 1), date(2024, 1, 5)).orderBy("start").collect()
    assert [r["ur"] for r in rows] == [A, B]
    assert rows[0]["end"] == rows[0]["start"] == datetime(2024, 1, 2, 1) and rows[1]["satellite"] == "S1C"
    assert len(rows[0]["parts"][0]) == 81 and 0 < rows[1]["area_km2"] < 300_000
    assert scan_granules(spark, pages, date(2024, 1, 2), date(2024, 1, 2)).count() == 0
    assert scan_granules(spark, pages, date(2024, 1, 2), date(2024, 1, 3)).count() == 1
    assert scan_granules(spark, pages, date(2024, 1, 1), date(2024, 1, 5), glob="S1C*").count() == 1
    assert scan_granules(spark, pages, date(2024, 1, 1), date(2024, 1, 5), bbox=(-180, 76, 180, 90)).count() == 0


def test_granule_links_newest_first(spark, pages):
    links = granule_links(read_granule_pages(spark, f"{pages}/p1.json"))
    got = newest_links(links).collect()
    assert [(r["name"], r["auth_kind"]) for r in got] == [("x_3.tiff", "s3"), ("x_2.TIF", "https_edl")]
    assert got[0]["metadata"]["granule_ur"] == A and newest_links(links, 1).collect()[0]["name"] == "x_3.tiff"


def test_scan_products(spark, tmp_path):
    def p(i, name, start="2024-01-02T00:00:00.000Z", lat=70, kind="Polygon"):
        ring = [[0.0, lat], [1.0, lat], [1.0, lat + 1.0], [0.0, lat]]
        coords = [ring] if kind == "Polygon" else [[ring], [[[0.0, -80.0]] * 4]]
        return {"Id": i, "Name": name, "ContentDate": {"Start": start},
                "GeoFootprint": None if kind is None else {"type": kind, "coordinates": coords}}
    n = "S1A_EW_GRDM_1SDH_{}.SAFE"
    value = [p("1", n.format("b")), p("1", n.format("b")), p("2", n.format("a_COG")), p("3", n.format("c"), kind=None),
             p("4", n.format("d"), lat=-75), p("5", n.format("e"), start="2024-01-03T00:00:00.000Z"),
             p("6", n.format("a"), lat=-75, kind="MultiPolygon"), p("7", "S1B_EW_GRDM_1SDH_x.SAFE"), p("8", "S1A_EW_GRDH_1SDH_x.SAFE"),
             p("9", n.format("f"), lat=65, kind="MultiPolygon")]
    (tmp_path / "p.json").write_text(json.dumps({"value": value}))
    out = scan_products(spark, str(tmp_path), ["SENTINEL-1A_DP_GRD_MEDIUM"], date(2024, 1, 2), date(2024, 1, 3), (60, 90), "*_1SDH_*")
    assert [r["id"] for r in out.collect()] == ["1", "3", "9"]
    with pytest.raises(ValueError):
        scan_products(spark, str(tmp_path), ["LANDSAT"], date(2024, 1, 2), date(2024, 1, 3))


def test_scan_objects(spark, tmp_path):
    for name in ("d/b.tif", "a.TIFF", "c.txt", "d/e/a_lead.tif"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"x" * 10)
    names = [r["name"] for r in scan_objects(spark, str(tmp_path)).collect()]
    assert names == ["a.TIFF", "a_lead.tif", "b.tif"]
    assert [r["name"] for r in scan_objects(spark, str(tmp_path), "*.tif", "*lead*").collect()] == ["b.tif"]
    assert [r["name"] for r in scan_objects(spark, str(tmp_path), limit=1).collect()] == ["a.TIFF"]
    plan = list_objects(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]
    assert refs.input_refs(spark, "s3", prefix=str(tmp_path), include="b*").head()["auth_kind"] == "s3"


class Letters(refs.InputSource):
    kind = "letters"

    def splits(self):
        return list(self.options["alphabet"])

    def list_inputs(self, split):
        yield f"s3://b/{split}.tif", f"{split}.tif", "s3", {"split": split}


def test_input_sources(spark, pages):
    refs.register_input_source(spark, Letters)
    got = refs.input_refs(spark, "letters", alphabet="abc")
    assert sorted(r["name"] for r in got.collect()) == ["a.tif", "b.tif", "c.tif"] and got.rdd.getNumPartitions() == 3
    assert Letters({"alphabet": "ab"}).description == "letters(alphabet=ab)"
    cmr = refs.input_refs(spark, "cmr", path=pages, short_name="X", start="2024-01-01", end="2024-01-05", bbox="-180,60,180,90")
    assert cmr.count() == 2
    for kind, options in [("s3", {}), ("cmr", {"short_name": "x"}), ("ftp", {}),
                          ("cmr", {"short_name": "x", "path": pages, "start": "2024-01-01"}),
                          ("cmr", {"short_name": "x", "path": pages, "bbox": "1,2,3"})]:
        with pytest.raises(ValueError):
            refs.input_refs(spark, kind, **options)


def annotation(vectors):
    rows = "".join(f'<calibrationVector><azimuthTime>t</azimuthTime><line>{line}</line><pixel count="{len(px)}">{" ".join(map(str, px))}</pixel>'
                   f'<sigmaNought count="{len(k)}">{" ".join(map(str, k))}</sigmaNought><betaNought count="1">7.0</betaNought>'
                   f'<gamma count="2">1.0 2.0</gamma></calibrationVector>' for line, px, k in vectors)
    return f'<?xml version="1.0"?><calibration><calibrationVectorList count="2">{rows}</calibrationVectorList></calibration>'


def test_scan_calibration_lut(spark, tmp_path):
    folder = tmp_path / "G1.SAFE" / "annotation" / "calibration"
    folder.mkdir(parents=True)
    (folder / "calibration-s1a-ew-grd-hh-2024.xml").write_text(annotation([(0, [0, 40], [1.5, 2.5]), (10, [0, 40], [3.5, 4.5])]))
    path = str(folder / "*.xml")
    rows = scan_calibration_lut(spark, path).orderBy("line", "pixel").collect()
    assert [tuple(r) for r in rows] == [("G1", "hh", "sigma0", 0, 0, 1.5), ("G1", "hh", "sigma0", 0, 40, 2.5),
                                        ("G1", "hh", "sigma0", 10, 0, 3.5), ("G1", "hh", "sigma0", 10, 40, 4.5)]
    assert scan_calibration_lut(spark, path, "gamma0").count() == 4
    with pytest.raises(Exception, match="shape mismatch"):
        scan_calibration_lut(spark, path, "beta0").collect()
    with pytest.raises(ValueError, match="unknown calibration"):
        scan_calibration_lut(spark, path, "delta0")


def test_fields(spark, tmp_path):
    path = str(tmp_path / "f")
    spark.createDataFrame([("c", 0, 0, -999.0), ("c", 0, 1, 250.0)], "collection string, row int, col int, raw double").withColumn(
        "acq_time", F.lit("2024-01-01").cast("timestamp")).write.parquet(path)
    assert [r["value"] for r in read_field(spark, path, "ice_conc").orderBy("col").collect()] == [None, 2.5]
    rows = [(1, 0.5, 70.0, 10.0, 1.0), (1, 5.0, 70.0, 10.0, 2.0), (2, 0.5, 70.0, 10.0, 3.0), (1, 0.5, 10.0, 10.0, 4.0)]
    f = spark.createDataFrame(rows, "time int, depth double, latitude double, longitude double, value double")
    out = subset_field(f, (-180, 20, 180, 90), (0, 1), "1", "2")
    assert [tuple(r) for r in out.collect()] == [(70.0, 10.0, 1.0)]


def test_overlap_index_job_and_geojson(spark, tmp_path):
    ring2 = ((11, 71), (21, 71), (21, 76), (11, 76))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "p.json").write_text(json.dumps({"items": [
        item(A, "2024-01-02T01:00:00Z"), item(B, "2024-01-06T02:00:00Z", ring=ring2),
        item(A.replace("_a", "_z"), "2024-01-07T00:00:00Z", ring=((175, 70), (-175, 70), (-175, 75), (175, 75)))]}))
    out = str(tmp_path / "out")
    found = overlap_index(spark, str(tmp_path / "in"), date(2024, 1, 1), date(2024, 1, 9), out)
    rows = found.collect()
    assert len(rows) == 1 and rows[0]["day_diff"] == 4 and rows[0]["dt_hours"] == 97.0
    assert rows[0]["granule_a"] == A and 0 < rows[0]["iou"] < 1
    wkb = rows[0]["geometry"]
    assert struct.unpack("<BII", wkb[:9]) == (1, 6, 1)
    assert found.schema["day_diff"].dataType.typeName() == "short"
    back = spark.read.parquet(f"{out}/footprints")
    assert back.schema["geometry"].metadata["crs"] == "EPSG:3413" and back.count() == 3
    granules = spark.read.parquet(f"{out}/granules")
    feats = [json.loads(r["value"]) for r in sinks.footprint_features(granules).collect()]
    by_id = {f["id"]: f for f in feats}
    assert isinstance(by_id[A]["properties"]["area_km2"], float) and len(by_id[A]["geometry"]["coordinates"]) == 1
    split = by_id[A.replace("_a", "_z")]["geometry"]["coordinates"]
    assert len(split) == 2 and all(-180 <= x <= 180 for poly in split for r in poly for x, _ in r)
    pairs = sinks.overlap_features(overlap_join(granules))
    assert json.loads(pairs.head()["value"])["id"] == f"{A}__{B}"
    sinks.write_features(sinks.footprint_features(granules), str(tmp_path / "geo"))
    assert sum(1 for f in os.listdir(tmp_path / "geo") if f.endswith(".txt")) >= 1


def test_index_read_skips_row_groups(spark, tmp_path):
    """The documented filter reaches the scan, and the order of the file leaves few row groups to read."""
    import pyarrow.parquet as pq
    pairs = (spark.range(60_000).selectExpr("string(id) AS granule_a", "string(id * 7) AS granule_b", "smallint(id % 12) AS day_diff",
                                            "double(pmod(hash(id), 100000)) / 100 AS intersect_km2", "double(pmod(hash(id, 1), 1000)) / 1000 AS iou"))
    path = str(tmp_path / "index")
    sinks.write_overlaps(pairs, path, group_bytes=32_768)
    found = sinks.read_overlaps(spark, path, day_diff=4, min_iou=0.7)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(day_diff,4)" in plan and "GreaterThanOrEqual(iou,0.7)" in plan
    assert found.count() == pairs.where("day_diff = 4 AND iou >= 0.7").count() > 0
    total = met = 0
    for f in (tmp_path / "index").glob("*.parquet"):
        meta = pq.ParquetFile(f).metadata
        column = meta.schema.names.index("day_diff")
        for i in range(meta.num_row_groups):
            stats = meta.row_group(i).column(column).statistics
            total += 1
            met += stats.min <= 4 <= stats.max
    assert total > 12 and met <= total / 4


def test_arrow_features(spark):
    df = spark.createDataFrame([(1.5, 70.25, 5.0, 36.9, 3.0, 4.0)], "lon double, lat double, speed double, dir_to double, u double, v double")
    f = json.loads(sinks.arrow_features(df.withColumn("t", F.lit("2024-01-01").cast("timestamp")), "t").head()["value"])
    assert f["geometry"]["coordinates"] == [1.5, 70.25] and f["properties"] == {
        "speed": 5.0, "dir_to": 36.9, "u": 3.0, "v": 4.0, "time": "2024-01-01T00:00:00Z"}


def kv(spark, *rows):
    return spark.createDataFrame(list(rows), "key string, etag string")


def test_manifest(spark):
    remote = kv(spark, ("p/a", "1"), ("p/b", "2"), ("p/n", "9"))
    manifest = kv(spark, ("p/a", "1"), ("p/b", "old"), ("p/gone", "1"), ("p/lost", "1"), ("q/x", "1"))
    disk = spark.createDataFrame([("p/a",), ("p/b",), ("p/gone",), ("p/stray",)], "key string")
    d = K.manifest_diff(remote, manifest, "p/", disk)
    assert {r["key"]: r["action"] for r in d.collect()} == {
        "p/a": "keep", "p/b": "fetch", "p/n": "fetch", "p/gone": "prune", "p/lost": "forget", "p/stray": "prune"}
    assert sorted(map(tuple, K.apply_manifest(manifest, d).collect())) == [("p/a", "1"), ("p/b", "2"), ("p/n", "9"), ("q/x", "1")]
    empty = K.manifest_diff(remote.limit(0), manifest, "p/")
    assert {r["action"] for r in empty.collect()} == {"prune"}


def test_items(spark):
    def items(*rows):
        return spark.createDataFrame(list(rows), "id string, v int")
    t = items(("a", 1), ("b", 2))
    assert sorted(map(tuple, K.upsert_items(t, items(("b", 9), ("c", 3))).collect())) == [("a", 1), ("b", 9), ("c", 3)]
    assert K.upsert_items(t, items(("c", 3)), "insert").count() == 3
    with pytest.raises(Exception, match="already exists"):
        K.upsert_items(t, items(("b", 9)), "insert").collect()
    assert K.delete_items(t, items(("a", 0))).count() == 1


def test_extent_merges_and_defaults(spark):
    rows = [("c", 1.0, 2.0, 3.0, 4.0, "2024-01-02", None), ("d", None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "collection string, west double, south double, east double, north double, a string, b string")
    df = df.withColumns({"t_min": F.to_date("a"), "t_max": F.to_date("b")})
    old = spark.createDataFrame([("c", "2023-01-01", "2025-01-01")], "collection string, a string, b string").select(
        "collection", F.to_date("a").alias("t_min"), F.to_date("b").alias("t_max"))
    got = {r["collection"]: r for r in K.collection_extent(df, old).collect()}
    assert (got["c"]["west"], str(got["c"]["t_min"]), str(got["c"]["t_max"])) == (1.0, "2023-01-01", "2025-01-01")
    assert (got["d"]["west"], got["d"]["north"]) == (-180.0, 90.0)


def test_footprint_features_keep_null_properties(spark):
    box = [[{"x": 0.0, "y": -1e6}, {"x": 1e5, "y": -1e6}, {"x": 1e5, "y": -9e5}, {"x": 0.0, "y": -1e6}]]
    df = spark.createDataFrame([("g", None, "EW", box, 1.0)], f"ur string, satellite string, mode string, parts {G.PARTS}, area_km2 double")
    df = df.withColumns({c: F.lit("2024-01-01").cast("timestamp") for c in ("start", "end")}).withColumn("acq_date", F.to_date("start"))
    f = json.loads(sinks.footprint_features(df).head()["value"])
    assert f["properties"]["satellite"] is None and f["id"] == "g"
