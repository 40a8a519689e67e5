"""Object sync, item catalogues and collection extents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from floegrid.functions.geometry import close_ring, geojson_geometry, let, pieces_bbox, split_antimeridian, unwrap_lons
from floegrid.operators.dates import dedupe_latest

# Default extents of a collection without boxes and of the polar band.
WORLD_BBOX = (-180.0, -90.0, 180.0, 90.0)
ARCTIC_BBOX = (-180.0, 60.0, 180.0, 90.0)


def manifest_diff(listing: DataFrame, manifest: DataFrame, prefix: str = "",
                  local: DataFrame | None = None) -> DataFrame:
    """What a mirror must do per key: fetch, keep, prune or forget.

    `listing` and `manifest` hold key and etag, one row per key. Keys outside the prefix are
    not considered. With `local` (keys on disk), a key that is gone remotely is pruned if it is
    there and otherwise only forgotten by the manifest.
    """
    under = F.col("key").startswith(prefix)
    remote = listing.where(under).select("key", "etag")
    known = manifest.where(under).select("key", F.col("etag").alias("old_etag"))
    both = (remote.withColumn("_remote", F.lit(True))
            .join(known.withColumn("_known", F.lit(True)), "key", "full_outer"))
    gone = F.lit("prune")
    if local is not None:
        disk = local.where(under).select("key", F.lit(True).alias("_disk"))
        both = both.join(disk, "key", "full_outer")
        gone = F.when(F.col("_disk"), F.lit("prune")).otherwise(F.lit("forget"))
    action = (F.when(F.col("_remote") & F.col("_known") & F.col("etag").eqNullSafe(F.col("old_etag")),
                     F.lit("keep"))
              .when(F.col("_remote"), F.lit("fetch")).otherwise(gone))
    return both.select("key", "etag", "old_etag", action.alias("action"))


def apply_manifest(manifest: DataFrame, diff: DataFrame) -> DataFrame:
    """The manifest after a sync: fetched and kept keys, and keys of other prefixes."""
    current = diff.where(F.col("action").isin("fetch", "keep")).select("key", "etag")
    others = manifest.select("key", "etag").join(diff.select("key"), "key", "left_anti")
    return others.unionByName(current)


def upsert_items(target: DataFrame, new: DataFrame, mode: str = "upsert", key: str = "id",
                 order: Sequence[str] = ()) -> DataFrame:
    """Catalogue items after a bulk write.

    `upsert` replaces items of the same id; `insert` fails on one that exists. Where `new` may
    repeat an id, `order` picks its last row.
    """
    if mode not in ("upsert", "insert"):
        raise ValueError(f"unknown write mode {mode!r}")
    fresh = dedupe_latest(new, [key], list(order)) if order else new
    if mode == "insert":
        held = target.select(key, F.lit(True).alias("_held"))
        clash = F.when(F.col("_held"), F.raise_error(
            F.concat(F.lit("item already exists: "), F.col(key).cast("string"))).cast("boolean"))
        fresh = (fresh.join(held, key, "left").where(F.coalesce(clash, F.lit(True)))
                 .select(*new.columns))
        return target.unionByName(fresh)
    return target.join(fresh.select(key), key, "left_anti").unionByName(fresh)


def delete_items(target: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    return target.join(ids.select(key), key, "left_anti")


def collection_extent(items: DataFrame, existing: DataFrame | None = None,
                      keys: Sequence[str] = ("collection",)) -> DataFrame:
    """Box union and time hull per collection.

    Items: west..north, t_min, t_max. Time hulls of existing collections are merged in, nulls
    ignored; the box is that of the items, or the world where none has one.
    """
    cols = ["west", "south", "east", "north", "t_min", "t_max"]
    rows = items.select(*keys, *cols)
    if existing is not None:
        known = existing.select(*keys, *[F.lit(None).cast("double").alias(c) for c in cols[:4]],
                                "t_min", "t_max")
        rows = rows.unionByName(known)
    hull = rows.groupBy(*keys).agg(
        F.min("west").alias("west"), F.min("south").alias("south"), F.max("east").alias("east"),
        F.max("north").alias("north"), F.min("t_min").alias("t_min"), F.max("t_max").alias("t_max"))
    return hull.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in zip(cols[:4], WORLD_BBOX)})


def bbox_polygon(west: Column, south: Column, east: Column, north: Column) -> Column:
    def pt(x: Column, y: Column) -> Column:
        return F.array(x, y)
    ring = F.array(pt(west, south), pt(east, south), pt(east, north), pt(west, north), pt(west, south))
    return F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))


def raster_item(item: Column, collection: Column, bbox: Sequence[Column], time: Column,
                href: Column, geometry: Column | None = None) -> Column:
    """JSON item of one raster file; its geometry is the box, or GeoJSON text that is given."""
    text = F.to_json(F.struct(
        F.lit("Feature").alias("type"), F.lit("1.0.0").alias("stac_version"), item.alias("id"),
        collection.alias("collection"), F.array(*bbox).alias("bbox"),
        (bbox_polygon(*bbox) if geometry is None else F.lit("@geometry@")).alias("geometry"),
        F.struct(F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("datetime")).alias("properties"),
        F.struct(F.struct(href.alias("href"),
                          F.lit("image/tiff; application=geotiff; profile=cloud-optimized").alias("type"),
                          F.array(F.lit("data")).alias("roles")).alias("asset")).alias("assets")))
    return text if geometry is None else F.replace(text, F.lit('"geometry":"@geometry@"'), F.concat(F.lit('"geometry":'), geometry))


def placed_item(item: Column, collection: Column, ring: Column, time: Column, href: Column, polar: bool = False) -> Column:
    """JSON item of a raster with a corner ring in longitude and latitude that may cross the antimeridian.

    A ring that crosses becomes a MultiPolygon of its pieces within 180 degrees, and the box is that of the pieces. With `polar` the box
    is the polar band, as no box of a raster around the pole can be read from its corners.
    """
    pieces = split_antimeridian(unwrap_lons(close_ring(ring)))

    def built(p: Column) -> Column:
        box = pieces_bbox(p)
        corners = [F.lit(v) for v in ARCTIC_BBOX] if polar else [box[i] for i in range(4)]
        rings = F.transform(p, lambda r: F.transform(r, lambda q: F.array(q["x"], q["y"])))
        one = F.to_json(F.struct(F.lit("Polygon").alias("type"), rings.alias("coordinates")))
        geometry = F.when(F.size(p) > 1, geojson_geometry(p)).otherwise(one)
        return raster_item(item, collection, corners, time, href, geometry)
    return let(pieces, built)


def series_item(collection: Column, bbox: Sequence[Column], t_min: Column, t_max: Column,
                href: Column, mode: Column, crs: Column) -> Column:
    """JSON item of one cube; its id is stable, so a rerun replaces it."""
    iso = "yyyy-MM-dd'T'HH:mm:ssXXX"
    return F.to_json(F.struct(
        F.lit("Feature").alias("type"), F.lit("1.0.0").alias("stac_version"),
        F.concat(collection, F.lit("-timeseries")).alias("id"), collection.alias("collection"),
        F.array(*bbox).alias("bbox"), bbox_polygon(*bbox).alias("geometry"),
        F.struct(F.date_format(t_min, iso).alias("start_datetime"),
                 F.date_format(t_max, iso).alias("end_datetime"),
                 mode.alias("build_mode"), crs.alias("proj:wkt2")).alias("properties"),
        F.struct(F.struct(href.alias("href"), F.lit("application/vnd+parquet").alias("type"),
                          F.array(F.lit("data")).alias("roles")).alias("data")).alias("assets")))


def collection_json(collection: Column, bbox: Sequence[Column], t_min: Column, t_max: Column) -> Column:
    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    return F.to_json(F.struct(
        F.lit("Collection").alias("type"), collection.alias("id"), F.struct(
            F.struct(F.array(F.array(*bbox)).alias("bbox")).alias("spatial"),
            F.struct(F.array(F.array(F.date_format(t_min, iso), F.date_format(t_max, iso)))
                     .alias("interval")).alias("temporal")).alias("extent")))
