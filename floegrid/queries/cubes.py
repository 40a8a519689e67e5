"""Union grids, placement, retiling and cube synchronisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from floegrid.functions.grids import Grid, cell_center, snap_extent
from floegrid.operators import cube as C, stats as S
from floegrid.operators.dates import retain_newest
from floegrid.operators.mosaic import long_rank, mosaic
from floegrid.operators.tiles import assemble_tiles, explode_tiles
from floegrid.plans.bindings import bind, cte
from floegrid.queries import query
from floegrid.queries.pixels import LINE, MOSAIC_SQL, RC, dated_rank, valid_mosaic


def rasters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Box granules as rasters with a slightly varying resolution."""
    return bind(spark, sf_dir, "granule_b").withColumns({
        "res_x": F.lit(40.0) + F.col("ord") % 5, "crs": F.lit("EPSG:3413"),
        "nodata": F.lit(None).cast("double")})


G = f"WITH {cte('granule_b')}"


@query("union_bounds", f"""{G}
SELECT satellite, min(xmin) AS west, min(ymin) AS south, max(xmax) AS east, max(ymax) AS north,
  quantile_cont(40.0 + ord % 5, 0.5) AS resolution, 'EPSG:3413' AS crs, count(*) AS n_rasters
FROM granule_b GROUP BY satellite""")
def union_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.union_bounds(rasters(spark, sf_dir), ["satellite"]).drop("nodata")


@query("union_grid", f"""{G},
b AS (SELECT min(xmin) AS west, min(ymin) AS south, max(xmax) AS east, max(ymax) AS north,
  quantile_cont(40.0 + ord % 5, 0.5) AS resolution FROM granule_b)
SELECT west, north, resolution, CAST(ceil((east - west) / resolution) AS BIGINT) AS width,
  CAST(ceil((north - south) / resolution) AS BIGINT) AS height FROM b""")
def union_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.raster_grid(rasters(spark, sf_dir)).select("west", "north", "resolution", "width", "height")


@query("build_cube_offsets", f"""{G},
b AS (SELECT min(xmin) AS west, max(ymax) AS north, quantile_cont(40.0 + ord % 5, 0.5) AS res FROM granule_b)
SELECT ord, CAST(round_even((b.north - ymax) / b.res, 0) AS BIGINT) AS row_off,
  CAST(round_even((xmin - b.west) / b.res, 0) AS BIGINT) AS col_off FROM granule_b, b""")
def build_cube_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = rasters(spark, sf_dir)
    return C.raster_offsets(r, C.raster_grid(r)).select("ord", "row_off", "col_off")


@query("build_cube", f"""
WITH {cte('cell_b')},
r AS (SELECT DISTINCT k1 AS raster, -300000.0 + (k1 % 7) * 40000 AS xmin, 500000.0 - (k1 % 5) * 40000 AS ymax FROM cell_b),
g AS (SELECT min(xmin) AS west, max(ymax) AS north, max(xmin) + 76 * 40000 AS east, min(ymax) - 112 * 40000 AS south FROM r),
p AS (SELECT c.acq_date, c.row_ + CAST(round_even((g.north - r.ymax) / 40000, 0) AS BIGINT) AS row,
  c.col_ + CAST(round_even((r.xmin - g.west) / 40000, 0) AS BIGINT) AS col, c.value, c.k1, c.k2, c.k3, c.k4,
  CAST(ceil((g.east - g.west) / 40000) AS BIGINT) AS w, CAST(ceil((g.north - g.south) / 40000) AS BIGINT) AS h
  FROM cell_b c JOIN r ON c.k1 = r.raster, g)
SELECT acq_date, row, col, value FROM (SELECT *, row_number() OVER (PARTITION BY acq_date, row, col
  ORDER BY k1 DESC, k2 DESC, k3 DESC, k4 DESC) AS n FROM p WHERE row >= 0 AND row < h AND col >= 0 AND col < w) WHERE n = 1""")
def build_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of an order form one raster of 112 x 76 cells of 40 km, placed by the order key."""
    cells = (bind(spark, sf_dir, "cell_b")
             .withColumnsRenamed({"row_": "row", "col_": "col"}).drop("collection"))
    boxes = cells.select(F.col("k1").alias("raster")).distinct().select(
        "raster", F.lit("cube").alias("collection"), F.lit(None).cast("timestamp").alias("acq_time"),
        F.col("raster").alias("ord"),
        (F.lit(-300000.0) + F.col("raster") % 7 * 40000).alias("xmin"),
        (F.lit(500000.0) - F.col("raster") % 5 * 40000).alias("ymax"), F.lit(40000.0).alias("res_x"),
        F.lit("EPSG:3413").alias("crs"), F.lit(None).cast("double").alias("nodata"))
    boxes = boxes.withColumns({"xmax": F.col("xmin") + 76 * 40000, "ymin": F.col("ymax") - 112 * 40000})
    placed = C.place_cells(cells.withColumn("raster", F.col("k1")), boxes, C.raster_grid(boxes))
    return (placed.groupBy("acq_date", "row", "col")
            .agg(F.max_by("value", long_rank(*LINE)).alias("value")))


_G40 = Grid("EPSG:3413", -3850000.0, 5850000.0, 100000.0, 100000.0, 76, 112)


@query("cell_center", f"""
WITH {cte('cell_b')}
SELECT DISTINCT row_, col_, -3850000 + (col_ + 0.5) * 100000 AS x, 5850000 - (row_ + 0.5) * 100000 AS y FROM cell_b""")
def cell_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = cell_center(F.col("row_"), F.col("col_"), _G40)
    return (bind(spark, sf_dir, "cell_b").select("row_", "col_").distinct()
            .select("row_", "col_", x.alias("x"), y.alias("y")))


@query("snap_extent", f"""{G}
SELECT ord, floor((xmin + 13) / 70000.0) * 70000.0 AS west, floor((ymin + 13) / 70000.0) * 70000.0 AS south,
  ceil((xmax + 13) / 70000.0) * 70000.0 AS east, ceil((ymax + 13) / 70000.0) * 70000.0 AS north FROM granule_b""")
def snapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = snap_extent(*[F.col(c) + 13 for c in ("xmin", "ymin", "xmax", "ymax")], 70000.0)
    return bind(spark, sf_dir, "granule_b").select(
        "ord", *[c.alias(n) for c, n in zip(box, ("west", "south", "east", "north"))])


@query("cube_summary", f"""{G}
SELECT satellite, min(xmin) AS west, min(ymin) AS south, max(xmax) AS east, max(ymax) AS north,
  'EPSG:3413' AS crs, min(acq_date) AS min_time, max(acq_date) AS max_time, count(acq_date) AS n_slices
FROM granule_b GROUP BY satellite""")
def cube_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.cube_summary(rasters(spark, sf_dir).withColumn("acq_time", F.col("acq_date")), ["satellite"])


@query("upsert_modes", f"""{G},
old AS (SELECT satellite, min(xmin) AS w, min(ymin) AS s, max(xmax) AS e, max(ymax) AS n FROM granule_b
  WHERE acq_date < DATE '1999-01-01' GROUP BY satellite),
new AS (SELECT satellite, acq_date, min(xmin) AS w, min(ymin) AS s, max(xmax) AS e, max(ymax) AS n FROM granule_b
  WHERE acq_date >= DATE '1999-01-01' GROUP BY ALL)
SELECT new.satellite, new.acq_date, CASE WHEN old.w IS NULL THEN 'fresh'
  WHEN old.w - 1e-6 <= new.w AND old.s - 1e-6 <= new.s AND old.e + 1e-6 >= new.e AND old.n + 1e-6 >= new.n
  THEN 'append' ELSE 'rebuild' END AS mode FROM new LEFT JOIN old USING (satellite)""")
def upsert_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = rasters(spark, sf_dir)
    cut = F.lit("1999-01-01").cast("date")
    old = S.union_bounds(r.where(F.col("acq_date") < cut), ["satellite"])
    new = S.union_bounds(r.where(F.col("acq_date") >= cut), ["satellite", "acq_date"])
    return C.upsert_modes(new, old, ["satellite"]).select("satellite", "acq_date", "mode")


@query("retile", f"""
WITH {cte('cell_b')},
m AS (SELECT collection, month, row_, col_, dn AS value FROM (
  SELECT *, CAST(date_trunc('month', acq_date) AS DATE) AS month, row_number() OVER (
    PARTITION BY collection, date_trunc('month', acq_date), row_, col_
    ORDER BY acq_date DESC, k1 DESC, k2 DESC, k3 DESC, k4 DESC) AS r FROM cell_b) WHERE r = 1)
SELECT collection, month, CAST(row_ // 32 AS INTEGER) AS ty, CAST(col_ // 32 AS INTEGER) AS tx, count(*) AS n,
  CAST(sum(CAST(value AS BIGINT) * ((row_ % 32) * 32 + col_ % 32)) AS BIGINT) AS checksum
FROM m GROUP BY collection, month, row_ // 32, col_ // 32""")
def retile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly cells to 32 x 32 tiles and back, summarised by position."""
    monthly = bind(spark, sf_dir, "cell_b").withColumn("month", F.trunc("acq_date", "month"))
    m = mosaic(monthly.withColumn("rank", dated_rank()), ["rank"], keys=["collection", "month"], cell=RC, value="dn")
    tiles = assemble_tiles(m, 32, keys=["collection", "month"], cell=RC, value="dn")
    back = explode_tiles(tiles, 32, keys=["collection", "month", "ty", "tx"])
    idx = (F.col("row") % 32) * 32 + F.col("col") % 32
    return back.groupBy("collection", "month", "ty", "tx").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("long") * idx).alias("checksum"))


@query("sync_cube", MOSAIC_SQL + """,
old AS (SELECT * FROM m WHERE day(acq_date) % 3 <> 0),
want AS (SELECT DISTINCT collection, acq_date FROM m WHERE day(acq_date) % 4 <> 1)
SELECT collection, acq_date, row_, col_, CAST(value AS DOUBLE) AS value FROM old JOIN want USING (collection, acq_date)
UNION ALL
SELECT collection, acq_date, row_, col_, value + 1 FROM m JOIN want USING (collection, acq_date)
WHERE (collection, acq_date) NOT IN (SELECT (collection, acq_date) FROM old)""")
def sync_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = valid_mosaic(spark, sf_dir)
    existing = m.where("day(acq_date) % 3 <> 0")
    new = m.withColumn("value", F.col("value") + 1)
    desired = m.where("day(acq_date) % 4 <> 1").select("collection", "acq_date").distinct()
    return C.sync_cells(existing, new, desired)


@query("retain_cube", MOSAIC_SQL + """,
d AS (SELECT collection, acq_date, row_number() OVER (PARTITION BY collection ORDER BY acq_date DESC) AS k
  FROM (SELECT DISTINCT collection, acq_date FROM m))
SELECT collection, count(*) AS n, min(acq_date) AS min_time, max(acq_date) AS max_time
FROM m JOIN d USING (collection, acq_date) WHERE k <= 14 GROUP BY collection""")
def retain_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = retain_newest(valid_mosaic(spark, sf_dir), 14)
    return kept.groupBy("collection").agg(F.count(F.lit(1)).alias("n"), F.min("acq_date").alias("min_time"),
                                          F.max("acq_date").alias("max_time"))


@query("cube_window", f"""
WITH {cte('cell_b')}
SELECT collection, row_, col_, count(value) AS n, min(value) AS min_value, max(value) AS max_value,
  min(acq_date) AS first_date, max(acq_date) AS last_date FROM cell_b
WHERE acq_date >= DATE '1997-01-01' AND acq_date < DATE '2000-01-01' AND row_ >= 16 AND row_ < 96
  AND col_ >= 8 AND col_ < 64 GROUP BY ALL""")
def cube_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    def day(text: str):
        return F.lit(text).cast("date")
    picked = C.cube_window(bind(spark, sf_dir, "cell_b"), day("1997-01-01"), day("2000-01-01"), (16, 96), (8, 64), RC)
    return C.pixel_series(picked, ["collection", *RC])


@query("expand_bounds", MOSAIC_SQL + """,
live AS (SELECT collection, acq_date FROM m GROUP BY ALL HAVING bool_or(value <> 0))
SELECT collection, acq_date, CAST(row_ + 5 AS INTEGER) AS row, CAST(col_ + 3 AS INTEGER) AS col, value
FROM m JOIN live USING (collection, acq_date)""")
def expand_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored cells move onto a union grid that grew by five rows north and three columns west."""
    m = (valid_mosaic(spark, sf_dir).withColumnsRenamed({"row_": "row", "col_": "col"})
         .withColumn("acq_time", F.col("acq_date")))
    boxes = rasters(spark, sf_dir)
    old = boxes.agg(F.min("xmin").alias("west"), F.max("ymax").alias("north"))
    new = old.select((F.col("west") - 3 * 40000).alias("west"), (F.col("north") + 5 * 40000).alias("north"),
                     F.lit(40000.0).alias("resolution"))
    return C.expand_cells(m, old, new).select("collection", "acq_date", "row", "col", "value")


@query("union_slices", MOSAIC_SQL + """
SELECT collection, acq_date, count(*) AS n FROM (SELECT * FROM m WHERE day(acq_date) % 2 = 0
  UNION ALL SELECT * FROM m WHERE day(acq_date) % 2 = 1) GROUP BY ALL""")
def union_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = valid_mosaic(spark, sf_dir)
    both = m.where("day(acq_date) % 2 = 0").unionByName(m.where("day(acq_date) % 2 = 1"))
    return both.groupBy("collection", "acq_date").agg(F.count(F.lit(1)).alias("n"))


