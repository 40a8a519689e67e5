from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from floegrid.functions.grids import Grid
from floegrid.operators.cube import Cube
from floegrid.operators.dates import granule_counts
from floegrid.sources.granules import parse_granules, read_granule_pages
from floegrid.streaming import jobs as J
from tests.test_sources import item


def page(folder, name, *names):
    folder.mkdir(exist_ok=True)
    items = [item(n, f"{n[17:21]}-{n[21:23]}-{n[23:25]}T{n[26:28]}:00:00Z") for n in names]
    (folder / name).write_text(json.dumps({"items": items}))
    # The file source reads oldest first; give the files distinct ages.
    age = 1_700_000_000 + int(name.split(".")[0]) * 60
    os.utime(folder / name, (age, age))


def ur(day, hour, tag, sat="S1A"):
    return f"{sat}_EW_GRDM_1SDH_202401{day:02d}T{hour:02d}0000_x_{tag}"


def drain(df, path, name, **options):
    q = (df.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", str(path)).trigger(availableNow=True).start())
    q.awaitTermination(120)
    return df.sparkSession.table(name)


@pytest.mark.parametrize("per_batch", [1, None])
def test_stream_counts_match_batch_for_closed_days(spark, tmp_path, per_batch):
    src = tmp_path / "in"
    page(src, "1.json", ur(1, 1, "a"), ur(1, 23, "b"), ur(2, 1, "c"))
    page(src, "2.json", ur(1, 23, "b"), ur(2, 5, "d", "S1C"), ur(3, 1, "e"))
    page(src, "3.json", ur(3, 2, "f"), ur(3, 1, "e"), ur(5, 1, "g"))
    stream = J.stream_dedupe(J.stream_granules(spark, str(src), files_per_batch=per_batch), "1 day")
    counts = J.stream_daily_counts(stream, watermarked=True)
    got = {(str(r["acq_date"]), r["satellite"]): r["n"] for r in drain(counts, tmp_path / "ck", f"counts_{per_batch}").collect()}
    batch = parse_granules(read_granule_pages(spark, str(src)))
    want = {(str(r["acq_date"]), r["satellite"]): r["n"] for r in granule_counts(batch, ["acq_date", "satellite"]).collect()}
    want.pop(("2024-01-05", "S1A"))
    assert got == want


def test_stream_upsert_cube_replays(spark, tmp_path):
    schema = "collection string, t string, row int, col int, value double, ord int"
    src, cube = str(tmp_path / "in"), Cube(spark, str(tmp_path / "cube"))

    def put(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(src)

    def run(ck):
        stream = spark.readStream.schema(schema).parquet(src).select(
            "collection", F.to_timestamp("t").alias("acq_time"), "row", "col", F.col("value").cast("float").alias("value"), "ord")
        J.stream_upsert_cube(stream, cube, str(tmp_path / ck), order="ord").awaitTermination(120)
        return sorted((str(r["acq_date"]), r["row"], r["col"], r["value"]) for r in cube.data().collect())
    put(("c", "2024-01-01", 0, 0, 1.0, 1), ("c", "2024-01-01", 0, 1, 2.0, 1), ("c", "2024-01-01", 0, 1, 3.0, 2))
    first = run("ck")
    assert first == [("2024-01-01", 0, 0, 1.0), ("2024-01-01", 0, 1, 3.0)]
    put(("c", "2024-01-01", 0, 0, 9.0, 5), ("c", "2024-01-02", 1, 1, 4.0, 1))
    second = run("ck")
    assert second == [("2024-01-01", 0, 0, 9.0), ("2024-01-01", 0, 1, 3.0), ("2024-01-02", 1, 1, 4.0)]
    assert run("ck") == second and run("other") == second


def test_stream_lod(spark, tmp_path):
    """One date in two micro-batches has all its tiers, and a restart changes nothing."""
    grid = Grid("EPSG:3413", 0.0, 80.0, 10.0, 10.0, 8, 8)
    src = str(tmp_path / "in")
    rows = spark.range(64).selectExpr("date'2024-01-01' AS acq_date", "int(id div 8) AS row", "int(id % 8) AS col")
    schema = "acq_date date, row int, col int"

    def run(part):
        rows.where(part).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        J.stream_lod(stream, str(tmp_path / "out"), str(tmp_path / "ck"), grid, (4, 1), 10).awaitTermination(120)
        return spark.read.parquet(str(tmp_path / "out/tiers"))
    assert {r["tier"]: r["count"] for r in run("row < 3").groupBy("tier").count().collect()} == {1: 24}
    out = run("row >= 3")
    assert {r["tier"]: r["count"] for r in out.groupBy("tier").count().collect()} == {1: 64, 4: 4}
    assert out.where("tier = 1").agg(F.max("chunk")).head()[0] == 6
    assert run("row < 0").count() == 68


def test_stream_catalog(spark, tmp_path):
    schema = ("collection string, key string, west double, south double, east double, north double, t string, href string, ord long")
    src, root = str(tmp_path / "in"), str(tmp_path / "cat")

    def run(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(src)
        s = spark.readStream.schema(schema).parquet(src).withColumns(
            {"t_min": F.to_timestamp("t"), "t_max": F.to_timestamp("t")})
        J.stream_catalog(s, root, str(tmp_path / "ck")).awaitTermination(120)
    run(("c", "a/x.tif", 0.0, 0.0, 1.0, 1.0, "2024-01-02", "h1", 1), ("c", "a/y.json", 0.0, 0.0, 9.0, 9.0, "2024-01-09", "h", 1),
        ("d", "a/z.tif", 5.0, 5.0, 6.0, 6.0, "2024-02-01", "h2", 1))
    run(("c", "a/x.tif", 0.0, 0.0, 2.0, 2.0, "2024-01-05", "h3", 2))
    items = {r["id"]: r["href"] for r in J.read_items(spark, root).collect()}
    assert items == {"x": "h3", "z": "h2"}
    ext = {r["collection"]: r for r in J.read_items(spark, root, "extents").collect()}
    assert ext["c"]["east"] == 2.0 and str(ext["c"]["t_min"])[:10] == "2024-01-02" and str(ext["c"]["t_max"])[:10] == "2024-01-05"
    assert ext["d"]["west"] == 5.0
