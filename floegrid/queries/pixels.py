"""Cells: radiometry, clean-up, mosaics, pyramids and statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from floegrid.functions import fields as FI, radiometry as R
from floegrid.operators import mosaic as M, pyramid as P, stats as S
from floegrid.operators.lod import decimate
from floegrid.plans.bindings import bind, cte
from floegrid.products import PRODUCTS
from floegrid.queries import query

ORDER = ["k1", "k2", "k3", "k4"]
# A line of an order is unique, so the rest of the paint order never decides.
LINE = (("k1", 44), ("k2", 3))
IDS = "collection, acq_date, row_, col_, k1, k2, k3, k4"
RC = ("row_", "col_")
_ID = IDS.split(", ")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind(spark, sf_dir, "cell_b")


def valid_mosaic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mosaic of the cells whose digital number is above the noise; the rest is nodata."""
    painted = cells(spark, sf_dir).withColumns({"value": F.when(F.col("dn") > 5, F.col("value")), "rank": M.long_rank(*LINE)})
    return M.mosaic(painted, ["rank"], cell=RC)


MOSAIC_SQL = f"""
WITH {cte('cell_b')},
m AS (SELECT collection, acq_date, row_, col_, value, dn FROM (
  SELECT *, row_number() OVER (PARTITION BY collection, acq_date, row_, col_
                               ORDER BY k1 DESC, k2 DESC, k3 DESC, k4 DESC) AS r
  FROM cell_b WHERE dn > 5) WHERE r = 1)
"""


@query("calibrate_db", f"""
WITH {cte('cell_b')}
SELECT {IDS}, CASE WHEN dn > 10 THEN round(10 * log10((dn - 10) * (dn - 10) / ((100 + col_) * (100 + col_))), 6) END AS db
FROM cell_b""")
def calibrate_db(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells(spark, sf_dir).select(
        *_ID, F.round(R.calibrate_db(F.col("dn") - 10, F.col("col_") + 100), 6).alias("db"))


@query("db_conversions", f"""
WITH {cte('cell_b')}
SELECT {IDS}, round(pow(10, (dn - 40) / 10), 9) AS linear,
  round((dn - 40) - 10 * log10(cos(radians(20.0 + col_ % 25))), 6) AS gamma_db,
  round((least(greatest(dn - 40, -30.0), 10.0) + 30) / 40, 6) AS stretched
FROM cell_b""")
def db_conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = F.col("dn") - 40
    theta = F.radians(F.lit(20.0) + F.col("col_") % 25)
    return cells(spark, sf_dir).select(
        *_ID, F.round(R.db_to_linear(db), 9).alias("linear"),
        F.round(R.sigma_to_gamma(db, theta), 6).alias("gamma_db"),
        F.round(R.rescale(db), 6).alias("stretched"))


@query("mask_and_scale", f"""
WITH {cte('cell_b')}
SELECT {IDS}, CASE WHEN dn <> 7 THEN round(dn * 0.01, 6) END AS percent, nullif(dn, 9.0) AS clean FROM cell_b""")
def mask_and_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    dn = F.col("dn")
    return cells(spark, sf_dir).select(
        *_ID, F.round(FI.mask_and_scale(dn, 7, 0.01), 6).alias("percent"),
        FI.mask_nodata(dn, 9).alias("clean"))


@query("roll_longitude", f"""
WITH {cte('cell_b')}
SELECT {IDS}, CAST((col_ + 38) % 76 AS INTEGER) AS rolled, -180.0 AS origin FROM cell_b""")
def roll_longitude(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled, origin = FI.roll_longitude(F.col("col_"), 76, 360 / 76, 0.0)
    return cells(spark, sf_dir).select(*_ID, rolled.cast("int").alias("rolled"),
                                       F.lit(origin).alias("origin"))


@query("decode_class", f"""
WITH {cte('cell_b')}
SELECT {IDS}, CASE CAST(k2 AS INTEGER) WHEN 1 THEN 'open_water' WHEN 2 THEN 'first_year_ice'
  WHEN 3 THEN 'multi_year_ice' WHEN 4 THEN 'ambiguous' END AS meaning,
  CASE WHEN dn * 2 < 30 THEN 1 WHEN dn * 2 <= 70 THEN 2 ELSE 3 END AS edge_class FROM cell_b""")
def decode_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells(spark, sf_dir).select(
        *_ID, FI.decode_class(F.col("k2"), PRODUCTS["ice_type"].classes).alias("meaning"),
        FI.class_from_concentration(F.col("dn") * 2).alias("edge_class"))


@query("mosaic", MOSAIC_SQL + "SELECT collection, acq_date, row_, col_, value FROM m")
def mosaic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_mosaic(spark, sf_dir)


# One mosaic over all dates is dense enough for several pyramid levels.
_DENSE_SQL = f"""
WITH {cte('cell_b')},
l0 AS (SELECT collection, row_, col_, CAST(dn AS BIGINT) AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY collection, row_, col_
                               ORDER BY acq_date DESC, k1 DESC, k2 DESC, k3 DESC, k4 DESC) AS r
  FROM cell_b WHERE dn > 5) WHERE r = 1)
"""


def dated_rank() -> Column:
    """Paint order by date, then by line."""
    return M.long_rank((F.unix_date("acq_date"), 16), *LINE)


def dense_mosaic(spark: SparkSession, sf_dir: str) -> DataFrame:
    painted = cells(spark, sf_dir).withColumn("value", F.when(F.col("dn") > 5, F.col("dn")))
    return (M.mosaic(painted, ["acq_date", *ORDER], keys=["collection"], cell=RC)
            .withColumn("value", F.col("value").cast("long")))


def _levels_sql(how: str) -> str:
    parts, prev = [], "l0"
    for level in P.LEVELS:
        cur = f"l{level}"
        if how == "average":
            parts.append(f"{cur} AS (SELECT collection, row_ // 2 AS row_, col_ // 2 AS col_, avg(value) AS value"
                         f" FROM {prev} GROUP BY ALL)")
        elif how == "mode":
            parts.append(
                f"{cur} AS (SELECT collection, row_, col_, value FROM (SELECT collection, row_ // 2 AS row_,"
                f" col_ // 2 AS col_, value, row_number() OVER (PARTITION BY collection, row_ // 2, col_ // 2"
                f" ORDER BY count(*) DESC, value) AS r FROM {prev} GROUP BY collection, row_ // 2, col_ // 2, value)"
                " WHERE r = 1)")
        else:
            parts.append(f"{cur} AS (SELECT collection, row_ // 2 AS row_, col_ // 2 AS col_, value FROM {prev}"
                         " WHERE row_ % 2 = 0 AND col_ % 2 = 0)")
        prev = cur
    value = "round(value, 6)" if how == "average" else "value"
    tail = " UNION ALL ".join(
        f"SELECT collection, {level} AS level, CAST(row_ AS INTEGER) AS row_, CAST(col_ AS INTEGER) AS col_,"
        f" {value} AS value FROM l{level}" for level in P.LEVELS)
    return _DENSE_SQL + ",\n" + ",\n".join(parts) + "\n" + tail


@query("overview_average", _levels_sql("average"))
def overview_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = P.overview(dense_mosaic(spark, sf_dir), how="average", keys=["collection"], cell=RC)
    return out.withColumn("value", F.round("value", 6))


@query("overview_mode", _levels_sql("mode"))
def overview_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.overview(dense_mosaic(spark, sf_dir), how="mode", keys=["collection"], cell=RC)


@query("overview_nearest", _levels_sql("nearest"))
def overview_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.overview(dense_mosaic(spark, sf_dir), how="nearest", keys=["collection"], cell=RC)


@query("slice_stats", f"""
WITH {cte('cell_b')}
SELECT collection, acq_date, count(*) FILTER (dn - 5 <> 0) AS n_nonzero, bool_or(dn - 5 <> 0) AS non_empty
FROM cell_b GROUP BY collection, acq_date""")
def slice_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.slice_stats(cells(spark, sf_dir).withColumn("value", F.col("dn") - 5))


@query("field_stats", f"""
WITH {cte('cell_b')}
SELECT collection, count(dn) AS n_valid, min(dn) AS min_value, max(dn) AS max_value,
  round(avg(dn), 6) AS mean_value FROM cell_b WHERE dn <> 7 GROUP BY collection""")
def field_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    masked = cells(spark, sf_dir).withColumn("value", FI.mask_nodata(F.col("dn"), 7))
    out = S.field_stats(masked, ["collection"])
    return out.withColumn("mean_value", F.round("mean_value", 6))


@query("class_census", f"""
WITH {cte('cell_b')}
SELECT collection, acq_date, CAST(CASE WHEN dn * 2 < 30 THEN 1 WHEN dn * 2 <= 70 THEN 2 ELSE 3 END AS INTEGER) AS code,
  count(*) AS n FROM cell_b GROUP BY ALL""")
def class_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.class_census(cells(spark, sf_dir).withColumn(
        "code", FI.class_from_concentration(F.col("dn") * 2)))


@query("pol_ratio", f"""
WITH {cte('cell_b')},
d AS (SELECT l_linestatus AS pol, CAST(l_shipdate AS DATE) AS acq_date, CAST(l_partkey % 112 AS INT) AS row_,
  CAST((l_suppkey * 8 + l_linenumber) % 76 AS INT) AS col_, max(l_quantity) AS db FROM lineitem GROUP BY ALL)
SELECT f.acq_date, f.row_, f.col_, f.db - o.db AS ratio_db FROM d f JOIN d o USING (acq_date, row_, col_)
WHERE f.pol = 'F' AND o.pol = 'O'""")
def pol_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    from floegrid.operators.mosaic import pol_ratio as ratio
    from floegrid.plans.bindings import read_table
    d = (read_table(spark, sf_dir, "lineitem").selectExpr(
        "l_linestatus AS pol", "CAST(l_shipdate AS DATE) AS acq_date", "CAST(l_partkey % 112 AS INT) AS row_",
        "CAST((l_suppkey * 8 + l_linenumber) % 76 AS INT) AS col_", "l_quantity AS db")
        .groupBy("pol", "acq_date", "row_", "col_").agg(F.max("db").alias("db")))
    return ratio(d.where("pol = 'F'"), d.where("pol = 'O'"), ["acq_date", "row_", "col_"], "db")


@query("decimate", f"""
WITH {cte('cell_b')}
SELECT {IDS}, value FROM cell_b WHERE row_ % 15 = 7 AND col_ % 15 = 7""")
def decimate_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decimate(cells(spark, sf_dir), 15, "row_", "col_").select(*_ID, "value")


@query("subset_field", f"""
WITH {cte('cell_b')}
SELECT collection, row_, col_, value FROM (
  SELECT *, row_number() OVER (PARTITION BY collection, row_, col_ ORDER BY acq_date, k2, k1, k3, k4) AS r FROM cell_b
  WHERE row_ BETWEEN 20 AND 90 AND col_ BETWEEN 10 AND 60 AND k2 BETWEEN 1 AND 3
    AND acq_date >= DATE '1998-01-01' AND acq_date < DATE '1999-01-01') WHERE r = 1""")
def subset_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    from floegrid.sources.fields import subset_field as subset
    field = cells(spark, sf_dir).withColumnsRenamed({"row_": "latitude", "col_": "longitude", "k2": "depth"})
    out = subset(field, bbox=(10, 20, 60, 90), depth=(1, 3), start="1998-01-01", end="1999-01-01",
                 time="acq_date", keys=["collection"], tiebreak=["k1", "k3", "k4"])
    return out.withColumnsRenamed({"latitude": "row_", "longitude": "col_"})
