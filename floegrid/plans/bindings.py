"""Views that map the driver's tables onto the engine's tables.

Each view is a list of expressions that reads the same in Spark SQL and in DuckDB, so a
query and its oracle start from one text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from floegrid.session import configure

_YMD = ("concat(CAST(year(ts) AS STRING), lpad(CAST(month(ts) AS STRING), 2, '0'), "
        "lpad(CAST(day(ts) AS STRING), 2, '0'))")
_HMS = ("concat(lpad(CAST(hour(ts) AS STRING), 2, '0'), lpad(CAST(minute(ts) AS STRING), 2, '0'), "
        "lpad(CAST(second(ts) AS STRING), 2, '0'))")

BINDINGS: dict[str, tuple[str, list[str]]] = {
    # box footprints in metres on the polar plane
    "granule_b": ("orders", [
        "o_orderkey AS ord",
        "CASE WHEN o_orderkey % 2 = 0 THEN 'S1A' ELSE 'S1C' END AS satellite",
        "CAST(o_orderdate AS DATE) AS acq_date",
        "CAST(o_custkey % 24 AS INT) AS start_hour",
        "CAST(-3400000 + ((o_orderkey * 7919) % 6400) * 1000 AS DOUBLE) AS xmin",
        "CAST(-3400000 + ((o_custkey * 104729) % 6400) * 1000 AS DOUBLE) AS ymin",
        "CAST(-3400000 + ((o_orderkey * 7919) % 6400) * 1000 + 300000 + (o_orderkey % 5) * 50000"
        " AS DOUBLE) AS xmax",
        "CAST(-3400000 + ((o_custkey * 104729) % 6400) * 1000 + 300000 + (o_custkey % 7) * 50000"
        " AS DOUBLE) AS ymax",
    ]),
    # sparse cells, several per (date, cell); (k1, k2, k3, k4) is the paint order
    "cell_b": ("lineitem", [
        "l_returnflag AS collection",
        "CAST(l_shipdate AS DATE) AS acq_date",
        "CAST(l_partkey % 112 AS INT) AS row_",
        "CAST((l_suppkey * 8 + l_linenumber) % 76 AS INT) AS col_",
        "l_quantity AS dn",
        "l_extendedprice AS value",
        "l_orderkey AS k1",
        "l_linenumber AS k2",
        "l_partkey AS k3",
        "l_suppkey AS k4",
    ]),
    # signed vector components
    "wind_b": ("events", [
        "event_id",
        "CAST(ts AS DATE) AS acq_date",
        "CAST(event_id % 112 AS INT) AS row_",
        "CAST(user_id % 76 AS INT) AS col_",
        "value - 50 AS u",
        "CAST(event_id % 61 AS DOUBLE) - 30 AS v",
    ]),
    # dated object keys with ETags and two mirrors
    "listing_b": ("events", [
        "event_type AS collection",
        "CAST(ts AS DATE) AS acq_date",
        "concat('cogs/', event_type, '/', CAST(year(ts) AS STRING), '/',"
        " lpad(CAST(month(ts) AS STRING), 2, '0'), '/', lpad(CAST(day(ts) AS STRING), 2, '0'), '/',"
        f" event_type, '_', {_YMD},"
        " CASE WHEN event_id % 3 = 0 THEN '_daily_COG.tif' ELSE '_aux.tif' END) AS key_",
        "CAST(event_id % 97 AS STRING) AS etag",
        "event_id AS ord",
        "CASE WHEN event_type IN ('click', 'view') THEN 'asf' ELSE 'cdse' END AS source",
    ]),
    # file names of every supported family, dated by the event
    "name_b": ("events", [
        "event_id",
        "CASE event_id % 8"
        f" WHEN 0 THEN concat('SWOT_L2_LR_NPFRB_024_529_', {_YMD}, 'T', {_HMS}, '_x_freeboard.tif')"
        f" WHEN 1 THEN concat('swot_bin_', {_YMD}, '_ssha_COG.tif')"
        f" WHEN 2 THEN concat('S1', CASE WHEN user_id % 2 = 0 THEN 'A' ELSE 'C' END, '_EW_GRDM_1SDH_',"
        f" {_YMD}, 'T', {_HMS}, '_', {_YMD}, 'T235959_sigma0.tif')"
        f" WHEN 3 THEN concat('icesat2_bin_', {_YMD}, '_freeboard.tif')"
        " WHEN 4 THEN concat('icesat2_bin_', CAST(year(ts) AS STRING),"
        " lpad(CAST(month(ts) AS STRING), 2, '0'), '_lead_ssha.tif')"
        f" WHEN 5 THEN concat('x_', {_YMD}, '_daily_COG.tif')"
        " WHEN 6 THEN concat('SWOT_BIN_', CAST(year(ts) AS STRING),"
        " lpad(CAST(month(ts) AS STRING), 2, '0'), '_ssha.TIFF')"
        " ELSE 'nothing.tif' END AS name_",
        "ts",
    ]),
    # corner rings in degrees: a box of 8 x 2 degrees, many of which cross the dateline
    "ring_b": ("orders", [
        "o_orderkey AS ord",
        "CAST(o_orderdate AS DATE) AS acq_date",
        "CAST(((o_orderkey * 7919) % 3600) AS DOUBLE) / 10 - 180 AS lon0",
        "CAST(((o_custkey * 104729) % 260) AS DOUBLE) / 10 + 60 AS lat0",
    ]),
}


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def bind(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    table, exprs = BINDINGS[view]
    return read_table(spark, sf_dir, table).selectExpr(*exprs)


def cte(*views: str) -> str:
    """The same views as the head of a DuckDB WITH clause."""
    parts = []
    for view in views:
        table, exprs = BINDINGS[view]
        parts.append(f"{view} AS (SELECT {', '.join(exprs)} FROM {table})")
    return ",\n".join(parts)
