"""Object sync, items, extents and product selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from floegrid.functions import names as N
from floegrid.operators import catalog as K
from floegrid.operators.dates import dedupe_latest
from floegrid.plans.bindings import bind, cte
from floegrid.queries import query
from floegrid.sources.granules import select_products

_LATEST_SQL = f"""WITH {cte('listing_b')},
o AS (SELECT key_ AS key, etag, ord FROM (SELECT *, row_number() OVER (PARTITION BY key_ ORDER BY ord DESC) AS r
  FROM listing_b) WHERE r = 1),
r AS (SELECT key, etag FROM o WHERE ord % 11 <> 0),
k AS (SELECT key, CASE WHEN ord % 7 = 0 THEN 'stale' ELSE etag END AS old_etag FROM o WHERE ord % 5 <> 0)
"""


def remote_and_manifest(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    latest = dedupe_latest(bind(spark, sf_dir, "listing_b"), ["key_"], ["ord"]).withColumnRenamed("key_", "key")
    remote = latest.where("ord % 11 <> 0").select("key", "etag")
    old = F.when(F.col("ord") % 7 == 0, F.lit("stale")).otherwise(F.col("etag"))
    return remote, latest.where("ord % 5 <> 0").select("key", old.alias("etag"))


@query("manifest_diff", _LATEST_SQL + """
SELECT key, etag, old_etag, CASE WHEN etag IS NOT NULL AND etag IS NOT DISTINCT FROM old_etag THEN 'keep'
  WHEN etag IS NOT NULL THEN 'fetch' ELSE 'prune' END AS action FROM r FULL JOIN k USING (key)""")
def manifest_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.manifest_diff(*remote_and_manifest(spark, sf_dir), prefix="cogs/")


@query("manifest_after_sync", _LATEST_SQL + """
SELECT key, etag FROM r WHERE key LIKE 'cogs/c%' UNION ALL SELECT key, old_etag AS etag FROM k WHERE key NOT LIKE 'cogs/c%'""")
def manifest_after_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    remote, manifest = remote_and_manifest(spark, sf_dir)
    return K.apply_manifest(manifest, K.manifest_diff(remote, manifest, prefix="cogs/c"))


_ITEMS_SQL = f"""WITH {cte('listing_b')},
i AS (SELECT regexp_replace(regexp_extract(key_, '([^/]*)$', 1), '\\.[^.]*$', '') AS id, collection, etag, ord FROM listing_b),
t AS (SELECT id, collection, etag, ord FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ord DESC) AS r
  FROM i WHERE ord % 2 = 0) WHERE r = 1),
n AS (SELECT id, collection, etag, ord FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ord DESC) AS r
  FROM i WHERE ord % 2 <> 0) WHERE r = 1),
a AS (SELECT id, collection, etag, ord FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ord DESC) AS r FROM i) WHERE r = 1)
"""


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind(spark, sf_dir, "listing_b").select(
        N.item_id(F.col("key_")).alias("id"), "collection", "etag", "ord")


@query("upsert_items", _ITEMS_SQL + """
SELECT * FROM t WHERE id NOT IN (SELECT id FROM n) UNION ALL SELECT * FROM n""")
def upsert_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _items(spark, sf_dir)
    target = dedupe_latest(items.where("ord % 2 = 0"), ["id"], ["ord"])
    return K.upsert_items(target, items.where("ord % 2 <> 0"), order=["ord"])


@query("delete_items", _ITEMS_SQL + "SELECT * FROM a WHERE id NOT IN (SELECT id FROM i WHERE ord % 10 = 0)")
def delete_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _items(spark, sf_dir)
    target = dedupe_latest(items, ["id"], ["ord"])
    return K.delete_items(target, items.where("ord % 10 = 0").select("id").distinct())


@query("collection_extent", f"""WITH {cte('granule_b')}
SELECT satellite, min(CASE WHEN ord % 3 = 0 THEN xmin END) AS west, min(CASE WHEN ord % 3 = 0 THEN ymin END) AS south,
  max(CASE WHEN ord % 3 = 0 THEN xmax END) AS east, max(CASE WHEN ord % 3 = 0 THEN ymax END) AS north,
  min(acq_date) AS t_min, max(acq_date) AS t_max FROM granule_b GROUP BY satellite""")
def collection_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = bind(spark, sf_dir, "granule_b").withColumns({"t_min": F.col("acq_date"), "t_max": F.col("acq_date")})
    items = g.where("ord % 3 = 0").withColumnsRenamed({"xmin": "west", "ymin": "south", "xmax": "east", "ymax": "north"})
    return K.collection_extent(items, g.where("ord % 3 <> 0"), ["satellite"])


_RING = ("'[[[' || xmin || ',' || ymin || '],[' || xmax || ',' || ymin || '],[' || xmax || ',' || ymax || '],[' ||"
         " xmin || ',' || ymax || '],[' || xmin || ',' || ymin || ']]]'")
_BBOX = "'[' || xmin || ',' || ymin || ',' || xmax || ',' || ymax || ']'"


@query("raster_items", f"""WITH {cte('granule_b')}
SELECT ord, '{{"type":"Feature","stac_version":"1.0.0","id":"' || satellite || '_' || ord || '","collection":"' || satellite
  || '","bbox":' || {_BBOX} || ',"geometry":{{"type":"Polygon","coordinates":' || {_RING}
  || '}},"properties":{{"datetime":"' || strftime(acq_date, '%Y-%m-%d') || 'T12:00:00Z"}},"assets":{{"asset":{{"href":"s3://b/'
  || ord || '.tif","type":"image/tiff; application=geotiff; profile=cloud-optimized","roles":["data"]}}}}}}' AS item
FROM granule_b""")
def raster_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    ord_ = F.col("ord").cast("string")
    noon = F.col("acq_date").cast("timestamp") + F.make_interval(hours=F.lit(12))
    item = K.raster_item(F.concat("satellite", F.lit("_"), ord_), F.col("satellite"),
                         [F.col(c) for c in ("xmin", "ymin", "xmax", "ymax")], noon,
                         F.concat(F.lit("s3://b/"), ord_, F.lit(".tif")))
    return bind(spark, sf_dir, "granule_b").select("ord", item.alias("item"))


@query("series_items", f"""WITH {cte('granule_b')},
s AS (SELECT satellite, min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax,
  min(acq_date) AS a, max(acq_date) AS b FROM granule_b GROUP BY satellite)
SELECT satellite, '{{"type":"Feature","stac_version":"1.0.0","id":"' || satellite || '-timeseries","collection":"' || satellite
  || '","bbox":' || {_BBOX} || ',"geometry":{{"type":"Polygon","coordinates":' || {_RING}
  || '}},"properties":{{"start_datetime":"' || strftime(a, '%Y-%m-%d') || 'T00:00:00Z","end_datetime":"' || strftime(b, '%Y-%m-%d')
  || 'T00:00:00Z","build_mode":"sync","proj:wkt2":"EPSG:3413"}},"assets":{{"data":{{"href":"s3://b/' || satellite
  || '/","type":"application/vnd+parquet","roles":["data"]}}}}}}' AS item FROM s""")
def series_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    hull = bind(spark, sf_dir, "granule_b").groupBy("satellite").agg(
        F.min("xmin").alias("west"), F.min("ymin").alias("south"), F.max("xmax").alias("east"),
        F.max("ymax").alias("north"), F.min("acq_date").cast("timestamp").alias("a"),
        F.max("acq_date").cast("timestamp").alias("b"))
    item = K.series_item(F.col("satellite"), [F.col(c) for c in ("west", "south", "east", "north")],
                         F.col("a"), F.col("b"), F.concat(F.lit("s3://b/"), "satellite", F.lit("/")),
                         F.lit("sync"), F.lit("EPSG:3413"))
    return hull.select("satellite", item.alias("item"))


@query("select_products", f"""WITH {cte('name_b')}
SELECT id, any_value(name) AS name FROM (
  SELECT CAST(event_id // 16 AS BIGINT) AS id, 'S1' || CASE WHEN (event_id // 16) % 2 = 0 THEN 'A' ELSE 'B' END || '_EW_GRD'
    || CASE WHEN (event_id // 16) % 3 = 0 THEN 'H' ELSE 'M' END || '_1SDH_' || (event_id // 16)
    || CASE WHEN (event_id // 16) % 5 = 0 THEN '_COG' ELSE '' END || '.SAFE' AS name, CAST(ts AS DATE) AS d,
    CASE WHEN (event_id // 16) % 7 = 0 THEN NULL ELSE -80.0 + (event_id // 16) % 160 END AS lat FROM name_b)
WHERE name LIKE 'S1A%' AND contains(name, '_GRDM_') AND NOT contains(name, '_COG') AND d >= DATE '2024-01-05'
  AND d < DATE '2024-01-20' AND (lat IS NULL OR NOT (lat + 3 < 60 OR lat > 90)) GROUP BY id""")
def selected_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in sixteens stand for repeated listings of one product."""
    n = F.expr("event_id div 16")
    lat = F.when(n % 7 != 0, (n % 160 - 80).cast("double"))
    products = bind(spark, sf_dir, "name_b").select(
        n.alias("id"),
        F.concat(F.lit("S1"), F.when(n % 2 == 0, "A").otherwise("B"), F.lit("_EW_GRD"),
                 F.when(n % 3 == 0, "H").otherwise("M"), F.lit("_1SDH_"), n.cast("string"),
                 F.when(n % 5 == 0, "_COG").otherwise(""), F.lit(".SAFE")).alias("name"),
        F.col("ts").cast("timestamp").alias("content_start"),
        F.when(lat.isNotNull(), F.struct(lat.alias("lat_min"), (lat + 3).alias("lat_max"))).alias("lats"))
    kept = select_products(products, [("S1A", "_GRDM_")], F.lit("2024-01-05").cast("timestamp"),
                           F.lit("2024-01-20").cast("timestamp"), (60.0, 90.0))
    return kept.select("id", "name").orderBy("name")


_ITEM_SQL = f"""WITH {cte('ring_b')}
SELECT ord, CASE WHEN lon0 + 8 > 180 THEN 'MultiPolygon' ELSE 'Polygon' END AS kind,
  round(CASE WHEN lon0 + 8 > 180 THEN -180.0 ELSE lon0 END, 6) AS west, lat0 AS south,
  round(CASE WHEN lon0 + 8 > 180 THEN 180.0 ELSE lon0 + 8 END, 6) AS east, lat0 + 2 AS north,
  60.0::DOUBLE AS polar_south, strftime(acq_date, '%Y-%m-%dT00:00:00Z') AS datetime FROM ring_b"""


@query("dateline_items", _ITEM_SQL)
def dateline_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of rasters whose corners may lie on both sides of the antimeridian, read back from their JSON text."""
    from floegrid.queries.geometry import corner_ring
    rows = bind(spark, sf_dir, "ring_b")
    args = (F.col("ord").cast("string"), F.lit("c"), corner_ring(), F.col("acq_date").cast("timestamp"), F.lit("x.tif"))
    made = rows.select("ord", K.placed_item(*args).alias("item"), K.placed_item(*args, polar=True).alias("polar"))

    def number(path: str, item: str = "item"):
        return F.round(F.get_json_object(item, path).cast("double"), 6)
    return made.select(
        "ord", F.get_json_object("item", "$.geometry.type").alias("kind"), number("$.bbox[0]").alias("west"),
        number("$.bbox[1]").alias("south"), number("$.bbox[2]").alias("east"), number("$.bbox[3]").alias("north"),
        number("$.bbox[1]", "polar").alias("polar_south"), F.get_json_object("item", "$.properties.datetime").alias("datetime"))
