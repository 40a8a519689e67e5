"""Swath points onto the polar grid."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from floegrid.operators.swath import convert
from floegrid.plans.bindings import read_table
from floegrid.plans.sql_forms import polar_xy
from floegrid.queries import query

_LON = "CAST(((o_orderkey * 7919) % 3600) AS DOUBLE) / 10 - 180"
_LAT = "CAST(((o_custkey * 104729) % 260) AS DOUBLE) / 10 + 63.9"
_X, _Y = polar_xy("lon", "lat")


@query("grid_swath", f"""
WITH s AS (SELECT o_totalprice AS v, {_LON} AS lon, {_LAT} AS lat FROM orders),
p AS (SELECT v, CAST(floor((5850000 - {_Y}) / 10000) AS INTEGER) AS row, CAST(floor(({_X} + 3850000) / 10000) AS INTEGER) AS col FROM s)
SELECT row, col, round(avg(v), 3) AS value, count(*) AS n FROM p
WHERE row >= 0 AND row < 1120 AND col >= 0 AND col < 760 GROUP BY row, col""")
def grid_swath(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = read_table(spark, sf_dir, "orders").selectExpr(
        "o_totalprice AS ssha_karin", f"{_LON} AS lon", f"{_LAT} AS lat", "CAST(NULL AS TIMESTAMP) AS acq_time")
    cells = convert("swot-ssh-expert", points, ["ssha_karin"])["ssha_karin"]
    return cells.select("row", "col", F.round("value", 3).alias("value"), "n")
