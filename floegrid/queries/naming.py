"""Names, keys, links and URLs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from floegrid.functions import names as N
from floegrid.plans.bindings import bind, cte, read_table
from floegrid.queries import query
from floegrid.sources.objects import filter_objects

DAILY_REGEX = r"_(?P<start_date>\d{8})_daily_COG"


def _text_time(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


_BUILTIN = r"""
  coalesce(
    try_strptime(nullif(regexp_extract(name_, 'SWOT_L2_LR_NPFRB_\d+_\d+_(\d{8}T\d{6})', 1), ''), '%Y%m%dT%H%M%S'),
    try_strptime(nullif(regexp_extract(name_, '(?i)swot_bin_(\d{8})', 1), ''), '%Y%m%d'),
    try_strptime(nullif(regexp_extract(name_, '(?i)swot_bin_(\d{6})', 1), '') || '01', '%Y%m%d'),
    try_strptime(nullif(regexp_extract(name_, 'S1[A-D]_\w+_\w+_\w+_(\d{8}T\d{6})_\d{8}T\d{6}', 1), ''), '%Y%m%dT%H%M%S'),
    try_strptime(nullif(regexp_extract(name_, 'icesat2_bin_(\d{8})', 1), ''), '%Y%m%d'),
    try_strptime(nullif(regexp_extract(name_, 'icesat2_bin_(\d{6})', 1), '') || '01', '%Y%m%d'))"""
_USER_DAY = r"try_strptime(nullif(regexp_extract(name_, '_(\d{8})_daily_COG', 1), ''), '%Y%m%d')"


@query("acq_time", f"""
WITH {cte('name_b')}
SELECT event_id, name_, strftime(coalesce({_BUILTIN}, date_trunc('day', ts)), '%Y-%m-%d %H:%M:%S') AS acq_time,
  strftime(coalesce({_USER_DAY}, {_BUILTIN}), '%Y-%m-%d %H:%M:%S') AS acq_time_regex
FROM name_b""")
def acq_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = bind(spark, sf_dir, "name_b")
    mtime = F.date_trunc("day", F.col("ts").cast("timestamp"))
    return names.select("event_id", "name_", _text_time(N.acq_time(F.col("name_"), mtime)).alias("acq_time"),
                        _text_time(N.acq_time(F.col("name_"), regex=DAILY_REGEX)).alias("acq_time_regex"))


@query("catalog_time", f"""
WITH {cte('name_b')}
SELECT event_id, strftime(coalesce(
  try_strptime(nullif(regexp_extract(name_, 'S1[A-D]_\\w+_\\w+_\\w+_(\\d{{8}}T\\d{{6}})_\\d{{8}}T\\d{{6}}', 1), ''), '%Y%m%dT%H%M%S'),
  {_USER_DAY} + INTERVAL 12 HOUR), '%Y-%m-%d %H:%M:%S') AS catalog_time
FROM name_b""")
def catalog_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = N.catalog_time(F.col("name_"), DAILY_REGEX, "%Y%m%d")
    return bind(spark, sf_dir, "name_b").select("event_id", _text_time(found).alias("catalog_time"))


_G = N.GRANULE_NAME.replace("\\w+?", "[A-Za-z0-9]+")


@query("parse_granule_name", f"""
WITH {cte('name_b')}
SELECT event_id, regexp_extract(name_, '{_G}', 1) AS satellite, regexp_extract(name_, '{_G}', 2) AS mode,
  regexp_extract(name_, '{_G}', 3) AS product, regexp_extract(name_, '{_G}', 4) AS polarisation,
  strftime(try_strptime(regexp_extract(name_, '{_G}', 5), '%Y%m%dT%H%M%S'), '%Y-%m-%d %H:%M:%S') AS start_time
FROM name_b WHERE regexp_matches(name_, '{_G}')""")
def parse_granule_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = bind(spark, sf_dir, "name_b").select("event_id", N.parse_granule_name(F.col("name_")).alias("g"))
    return g.where("g is not null").select(
        "event_id", "g.satellite", "g.mode", "g.product", "g.polarisation",
        _text_time(F.col("g.start")).alias("start_time"))


@query("glob_match", f"""
WITH {cte('name_b')}
SELECT event_id, name_, name_ GLOB '*_daily_COG.tif' AS is_daily, name_ GLOB 'S1[A-B]_??_*' AS is_s1a
FROM name_b WHERE name_ GLOB '*.tif'""")
def glob_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("name_")
    return (bind(spark, sf_dir, "name_b").where(N.glob_match(n, "*.tif"))
            .select("event_id", "name_", N.glob_match(n, "*_daily_COG.tif").alias("is_daily"),
                    N.glob_match(n, "S1[A-B]_??_*").alias("is_s1a")))


_SHORT = ("concat('SENTINEL-1', substr('ABCD', CAST(o_orderkey % 4 AS INT) + 1, 1), '_DP_GRD_', "
          "CASE o_custkey % 4 WHEN 0 THEN 'MEDIUM' WHEN 1 THEN 'HIGH' WHEN 2 THEN 'FULL' ELSE 'OTHER' END)")


@query("platform_and_type", f"""
WITH s AS (SELECT o_orderkey, {_SHORT} AS short_name FROM orders)
SELECT o_orderkey, short_name,
  CASE WHEN short_name LIKE '%OTHER' THEN NULL ELSE 'S1' || regexp_extract(short_name, '^SENTINEL-1([A-Z])', 1) END AS platform,
  CASE WHEN short_name LIKE '%MEDIUM' THEN '_GRDM_' WHEN short_name LIKE '%HIGH' THEN '_GRDH_'
       WHEN short_name LIKE '%FULL' THEN '_GRDF_' END AS token FROM s""")
def platform_and_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{_SHORT} AS short_name")
    p = s.withColumn("p", N.platform_and_type(F.col("short_name"), strict=False))
    return p.select("o_orderkey", "short_name", "p.platform", "p.token")


# Page links rewritten as the three forms an object link can take.
_LINK = ("CASE page_id % 3 WHEN 0 THEN concat('https://s3.amazonaws.com/bucket', CAST(page_id % 5 AS STRING), '/', substr(url, 8))"
         " WHEN 1 THEN concat('http://bucket', CAST(page_id % 5 AS STRING), '.s3.amazonaws.com/', substr(url, 8))"
         " ELSE url END")


@query("http_to_s3", f"""
WITH l AS (SELECT page_id, {_LINK} AS link FROM pages)
SELECT page_id, CASE
  WHEN regexp_matches(link, '^https?://s3\\.amazonaws\\.com/([^/]+)/(.*)')
    THEN regexp_replace(link, '^https?://s3\\.amazonaws\\.com/([^/]+)/(.*)', 's3://\\1/\\2')
  WHEN regexp_matches(link, '^https?://([^.]+)\\.s3\\.amazonaws\\.com/(.*)')
    THEN regexp_replace(link, '^https?://([^.]+)\\.s3\\.amazonaws\\.com/(.*)', 's3://\\1/\\2') END AS uri
FROM l""")
def http_to_s3(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = read_table(spark, sf_dir, "pages").selectExpr("page_id", f"{_LINK} AS link")
    return links.select("page_id", N.http_to_s3(F.col("link")).alias("uri"))


@query("parse_uri", """
SELECT page_id, split_part(substr(url, 8), '/', 1) AS bucket,
  substr(substr(url, 8), length(split_part(substr(url, 8), '/', 1)) + 2) AS key FROM pages""")
def parse_uri(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    uri = F.concat(F.lit("s3://"), F.substring("url", 8, 1 << 30))
    return (pages.select("page_id", N.parse_uri(uri).alias("p"))
            .select("page_id", "p.bucket", "p.key"))


@query("remap_path", """
SELECT page_id, CASE WHEN instr(url, 'http://') = 1 THEN '/mnt/' || substr(url, 8) ELSE url END AS stripped,
  CASE WHEN instr(url, '.example.') > 0 THEN substr(url, 1, instr(url, '.example.') - 1) || '.test.'
       || substr(url, instr(url, '.example.') + 9) ELSE url END AS inner_
FROM pages""")
def remap_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return read_table(spark, sf_dir, "pages").select(
        "page_id", N.remap_path(url, "http://", "/mnt/").alias("stripped"),
        N.remap_path(url, ".example.", ".test.").alias("inner_"))


@query("item_id", f"""
WITH {cte('name_b')}
SELECT event_id, CASE WHEN lower(name_) LIKE '%.tif' OR lower(name_) LIKE '%.tiff'
  THEN regexp_replace(name_, '\\.[^.]*$', '') END AS item_id FROM name_b""")
def item_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.concat(F.lit("cogs/a.b/"), F.col("name_"))
    return bind(spark, sf_dir, "name_b").select("event_id", N.item_id(key).alias("item_id"))


@query("product_url", f"""
WITH {cte('listing_b')}
SELECT DISTINCT acq_date,
  'https://host/ice/conc/' || strftime(acq_date, '%Y/%m') || '/ice_conc_nh_polstere-100_multi_'
    || strftime(acq_date, '%Y%m%d') || '1200.nc' AS ice_url,
  'https://host/' || strftime(acq_date, '%Y%m%d') || '/06z/ifs/0p25/oper/' || strftime(acq_date, '%Y%m%d')
    || '060000-3h-oper-fc.grib2' AS forecast_url FROM listing_b""")
def product_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = bind(spark, sf_dir, "listing_b").select("acq_date").distinct()
    return days.select("acq_date", N.ice_product_url("https://host/ice", "conc", "ice_conc", "nh",
                                                     F.col("acq_date")).alias("ice_url"),
                       N.forecast_url("https://host", F.col("acq_date"), 6, 3).alias("forecast_url"))


@query("key_date", f"""
WITH {cte('listing_b')}
SELECT ord, CAST(try_strptime(regexp_extract(key_, '/(\\d{{4}})/(\\d{{2}})/(\\d{{2}})/', 1) || regexp_extract(key_, '/(\\d{{4}})/(\\d{{2}})/(\\d{{2}})/', 2)
  || regexp_extract(key_, '/(\\d{{4}})/(\\d{{2}})/(\\d{{2}})/', 3), '%Y%m%d') AS DATE) AS folder_date,
  CAST(try_strptime(nullif(regexp_extract(replace(key_, '_aux', '_full'), '_(\\d{{8}})_full\\.tif$', 1), ''), '%Y%m%d') AS DATE) AS stem_date
FROM listing_b""")
def key_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("key_")
    full = F.replace(key, F.lit("_aux"), F.lit("_full"))
    return bind(spark, sf_dir, "listing_b").select(
        "ord", N.key_date(key).alias("folder_date"), N.stem_date(full).alias("stem_date"))


@query("dated_key", f"""
WITH {cte('listing_b')}
SELECT ord, 'root/p/' || collection || '_x/' || strftime(acq_date, '%Y/%m/%d') || '/f' || etag || '.tif' AS out_key
FROM listing_b""")
def dated_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind(spark, sf_dir, "listing_b").select("ord", N.dated_key(
        "/root/p/", F.concat("collection", F.lit("/x")), F.col("acq_date"),
        F.concat(F.lit("f"), "etag", F.lit(".tif"))).alias("out_key"))


@query("scan_objects", f"""
WITH {cte('listing_b')}
SELECT key_, regexp_extract(key_, '([^/]*)$', 1) AS name, ord FROM listing_b
WHERE regexp_extract(key_, '([^/]*)$', 1) GLOB '*_COG.tif' AND NOT regexp_extract(key_, '([^/]*)$', 1) GLOB 'err*'
ORDER BY name, ord""")
def scan_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = filter_objects(bind(spark, sf_dir, "listing_b"), "key_", include="*_COG.tif", exclude="err*")
    return found.orderBy("name", "ord").select("key_", "name", "ord")


@query("scan_objects_limit", f"""
WITH {cte('listing_b')}
SELECT key_, ord FROM listing_b ORDER BY regexp_extract(key_, '([^/]*)$', 1), ord LIMIT 100""")
def scan_objects_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (filter_objects(bind(spark, sf_dir, "listing_b"), "key_", tiebreak=["ord"], limit=100)
            .select("key_", "ord"))


@query("parent_folders", f"""
WITH {cte('listing_b')}
SELECT DISTINCT regexp_replace(key_, '/[^/]*$', '') AS folder FROM listing_b WHERE key_ LIKE '%.tif'""")
def parent_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    from floegrid.sources.objects import parent_folders as folders
    return folders(bind(spark, sf_dir, "listing_b"), "key_", ".tif")


@query("granule_links_newest", """
WITH l AS (SELECT page_id, concat(replace(split_part(url, '?', 1), 'http:', 'https:'), '.tif') AS stripped FROM pages)
SELECT page_id, stripped AS url, regexp_extract(stripped, '([^/]*)$', 1) AS name
FROM l ORDER BY name DESC, page_id DESC LIMIT 50""")
def granule_links_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from floegrid.sources.granules import newest_links
    pages = read_table(spark, sf_dir, "pages")
    url = F.col("url")
    path = F.concat(F.replace(F.regexp_replace(url, r"\?.*$", ""), F.lit("http:"), F.lit("https:")),
                    F.lit(".tif"), F.regexp_extract(url, r"(\?.*)$", 1))
    links = pages.select("page_id", path.alias("url"))
    return newest_links(links, limit=50, tiebreak=["page_id"]).select(
        "page_id", F.regexp_replace("url", r"\?.*$", "").alias("url"), "name")
