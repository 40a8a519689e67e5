"""Inputs that only larger tables hold, against the DuckDB twins."""

from __future__ import annotations

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from floegrid.operators import warp as W
from floegrid.operators.cube import Cube
from floegrid.queries import load_all
from floegrid.queries.flows import _yearly
from tests.test_queries import SF, TABLES, rows


def compare(spark, folder, name, **tables):
    """A query and its twin over the small tables with some of them replaced by a DuckDB query."""
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    for t in TABLES:
        con.execute(f"COPY ({tables.get(t, f'FROM {t}')}) TO '{folder}/{t}.parquet'")
    for t in TABLES:
        con.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    fn, sql = load_all()[name]
    got, want = fn(spark, str(folder)).toPandas(), con.execute(sql).df()
    assert len(want) and sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", ["map_vector", "glyph_segments"])
def test_vectors_at_the_pole(spark, tmp_path, name):
    compare(spark, tmp_path, name, events="SELECT * REPLACE (event_id * 112 + 58 AS event_id, user_id * 76 + 38 AS user_id) FROM events")


def test_tiers_of_a_date_that_events_fill(spark, tmp_path):
    compare(spark, tmp_path, "stream_lod_tiers", events="""
        SELECT e.* REPLACE (i % 112 AS event_id, i // 112 AS user_id, d AS ts)
        FROM (FROM events LIMIT 1) e, range(8512) t(i), (VALUES (TIMESTAMP '2024-01-02'), (TIMESTAMP '2024-01-03')) v(d)""")


def test_pixels_of_one_granule_are_shared_by_tasks(spark):
    """The calibration table of one granule and one block is looked up in many partitions."""
    lut = (spark.range(12).selectExpr("'g' AS granule", "'hh' AS polarization", "'sigma0' AS calibration", "int(id div 4) * 10 AS line",
                                      "int(id % 4) * 7 AS pixel").withColumn("k", (100 + 2 * F.col("line") + 3 * F.col("pixel")).cast("double")))
    px = spark.range(1600).selectExpr("'g' AS granule", "int(id div 40) AS row", "int(id % 40) AS col")
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for key, value in off.items():
        spark.conf.set(key, value)
    try:
        parts = W.lut_join(px, lut, 40, 40).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(n for _, n in parts) == 1600 and max(n for _, n in parts) < 800


def test_stored_cube_reads_its_table_once(spark, tmp_path):
    """Neither the cells nor the rasters of an upsert are made again for each of its steps."""
    assert "lineitem" not in _yearly(spark, SF)._jdf.queryExecution().executedPlan().toString()
    made = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            made.add(len(batch))
            yield batch
    rasters = spark.range(2).selectExpr(
        "'r' || id AS raster", "'c' AS collection", "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, int(id)) AS acq_time", "1 AS ord",
        "0D AS xmin", "0D AS ymin", "2D AS xmax", "2D AS ymax", "1D AS res_x", "'EPSG:3413' AS crs", "double(null) AS nodata")
    cells = spark.range(2).selectExpr("'r' || id AS raster", "1 AS row", "int(id) AS col", "double(id) AS value")
    cube = Cube(spark, str(tmp_path / "cube"))
    assert cube.upsert("c", rasters.mapInPandas(seen, rasters.schema), cells) == "fresh"
    assert made.value == 2
    assert sorted((r["row"], r["col"], r["value"]) for r in cube.data().collect()) == [(1, 0, 0.0), (1, 1, 1.0)]


def test_granule_pages_are_in_few_files(spark, tmp_path):
    """Twenty pages and more are streamed from no more files than there are partitions."""
    root = spark.sparkContext._jsc.sc().getCheckpointDir()
    root = root.get().removeprefix("file:") if root.isDefined() else spark.conf.get("spark.checkpoint.dir")

    def folders():
        return {os.path.join(base, d) for base, dirs, _ in os.walk(root) for d in dirs if d.startswith("pages-")}
    before = folders()
    compare(spark, tmp_path, "stream_granules", orders="SELECT * REPLACE (o_orderkey + i * 1000000 AS o_orderkey) FROM orders, range(20) t(i)")
    new, = folders() - before
    files = [f for f in os.listdir(new) if f.startswith("part-")]
    assert 4 <= len(files) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sum(line.startswith(b'{"items":[') for f in files for line in open(os.path.join(new, f), "rb")) >= 20
