"""The three daily jobs end to end, as lazily planned DataFrames.

Dates are a column throughout: one job covers every missing date.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from floegrid.functions.grids import ARCTIC_10KM, ARCTIC_40M, SEA_ICE_SOURCE, Grid
from floegrid.functions.names import dated_key, item_id
from floegrid.functions.vectors import GLYPH_BANDS
from floegrid.operators import dates as D
from floegrid.operators.catalog import ARCTIC_BBOX, raster_item
from floegrid.operators.cube import Cube
from floegrid.operators.geocode import geocode_requests, image_shapes, pad_tiles, project_gcps, pull_tiles
from floegrid.operators.lod import arrows, coregister, glyph_segments, lod_tiers
from floegrid.operators.mosaic import SLICE
from floegrid.operators.overlap import overlap_join, overlap_order
from floegrid.operators.pyramid import overview
from floegrid.operators.tiles import TILE_COLUMNS, calibrate_tiles, mosaic_tiles, overview_tiles
from floegrid.operators.warp import warp
from floegrid.products import PRODUCTS
from floegrid.sources.fields import clean_field
from floegrid.sources.granules import scan_granules
from floegrid.sources.sinks import read_overlaps, write_footprints, write_overlaps


def overlap_index(spark: SparkSession, pages: str, start: date, end: date, out: str,
                  glob: str | None = None, bbox: tuple[float, float, float, float] | None = None,
                  short_names: Sequence[str] | None = None, newest: int = 0,
                  min_km2: float = 100.0, max_day_diff: int | None = None) -> DataFrame:
    """Footprints and the overlap index of catalogue pages, written and read back.

    With `max_day_diff`, pairs are limited to so many days apart before they are made: the choice for a long archive.
    The granule table is written once and read by both sides of the join, which cuts the
    lineage of footprint building at a shared folder.
    """
    granules = scan_granules(spark, pages, start, end, glob, bbox, short_names)
    if newest > 0:
        granules = D.retain_newest(granules, newest, keys=())
    granules.write.mode("overwrite").parquet(f"{out}/granules")
    granules = spark.read.parquet(f"{out}/granules")
    write_footprints(granules, f"{out}/footprints")
    write_overlaps(overlap_join(granules, min_km2, max_day_diff), f"{out}/overlaps")
    return overlap_order(read_overlaps(spark, f"{out}/overlaps"))


def mosaic_dates(primary: DataFrame, secondary: DataFrame, listing: DataFrame, today: Column,
                 collection: str, n: int = 7, lookback: int = 30, buffer: int = 2,
                 min_granules: int = 20, min_fraction: float = 0.0,
                 secondary_enabled: bool = True) -> DataFrame:
    """Dates to mosaic and the source of each: complete, not the newest, not there yet.

    `primary` and `secondary` hold acq_date and n; `listing` holds collection and acq_date.
    """
    chosen = D.choose_source(primary, secondary, secondary_enabled=secondary_enabled)
    walked = D.candidate_dates(chosen, n + buffer, today, lookback, start_offset=1, drop_newest=1,
                               collect=n + 1 + buffer)
    rest = chosen.join(D.dates_side(walked, ["acq_date"]), "acq_date", "left_semi")
    whole = D.complete_dates(rest, min_granules, min_fraction).orderBy(F.desc("acq_date")).limit(n)
    wanted = whole.select(F.lit(collection).alias("collection"), "acq_date", "source")
    todo = D.missing_outputs(wanted, listing, 1)
    return wanted.join(D.dates_side(todo.select("acq_date"), ["acq_date"]), "acq_date", "left_semi")


def radar_mosaic(dn_tiles: DataFrame, lut: DataFrame, gcps: DataFrame, conventions: Sequence[str],
                 template: str, tile: int = 512, grid: Grid = ARCTIC_40M, out_tile: int = 512) -> DataFrame:
    """Daily mosaic tiles per convention from digital-number tiles.

    dn_tiles: granule, polarization, acq_date, ord (paint order, an integer per granule) and the
    tile columns. gcps: granule, row, col, lon, lat. Pixels are calibrated once, with the border that resampling needs already around
    their tile; what only asks for sizes reads the digital-number tiles' numbers. The spline depends on the granule alone.
    """
    wanted = lut.where(F.col("calibration").isin(list(conventions)))
    padded = pad_tiles(dn_tiles.select("granule", "polarization", "acq_date", "ord", *TILE_COLUMNS), ["granule", "polarization"])
    db = calibrate_tiles(padded, wanted, tile).withColumn(
        "collection", F.replace(F.lit(template), F.lit("{calibration}"), F.col("calibration")))
    asked = geocode_requests(project_gcps(gcps), image_shapes(dn_tiles, tile, ["granule"]), grid, tile, out_tile, ["granule"])
    partial = pull_tiles(db, asked, grid, tile, out_tile, ["granule"], ["granule", "collection", "acq_date", "ord"])
    return mosaic_tiles(partial, "ord", SLICE)


def radar_outputs(mosaic: DataFrame, prefix: str, filename: str, grid: Grid = ARCTIC_40M, out_tile: int = 512) -> tuple[DataFrame, DataFrame]:
    """Overview tiles of daily mosaics, and the key and catalogue item of each.

    One item for each collection and date, at midnight, with the box of the polar band, as the grid holds the pole; `filename` may
    name {collection} and {date}.
    """
    levels = overview_tiles(mosaic, out_tile, keys=SLICE, height=grid.height, width=grid.width)
    days = mosaic.select(*SLICE).distinct()
    stamp = F.date_format("acq_date", "yyyyMMdd")
    name = F.replace(F.replace(F.lit(filename), F.lit("{collection}"), F.col("collection")), F.lit("{date}"), stamp)
    key = dated_key(prefix, F.col("collection"), F.col("acq_date"), name)
    time = F.col("acq_date").cast("timestamp")
    box = [F.lit(v) for v in ARCTIC_BBOX]
    items = days.withColumn("key", key).withColumn("item", raster_item(item_id(F.col("key")), F.col("collection"), box, time, F.col("key")))
    return levels, items


def field_product(raw: DataFrame, product: str, src: Grid = SEA_ICE_SOURCE,
                  dst: Grid = ARCTIC_10KM) -> tuple[DataFrame, DataFrame]:
    """A product on the target grid, and its overview levels.

    raw: collection, acq_time, row, col, raw on the source grid.
    """
    p = PRODUCTS[product]
    keys = ["collection", "acq_time"]
    cells = warp(clean_field(raw, product), src, dst, p.warp, keys=keys)
    return cells, overview(cells, how=p.overview, keys=keys, nodata=p.nodata)


def wind_products(u: DataFrame, v: DataFrame, grid: Grid = ARCTIC_10KM) -> dict[str, DataFrame]:
    """Arrow points, full-resolution tiers and glyph segments of warped wind components."""
    keys = ["acq_time", "row", "col"]
    both = coregister(u.select(*keys, F.col("value").alias("u")), v.select(*keys, F.col("value").alias("v")),
                      grid, grid, keys).withColumn("acq_date", F.to_date("acq_time"))
    full = arrows(both, grid, stride=1)
    return {"arrows": arrows(both, grid), "tiers": lod_tiers(full, expected=grid.n_cells),
            "glyphs": glyph_segments(both, grid, GLYPH_BANDS)}


def cube_sync(cube: Cube, collection: str, listing: DataFrame, cells: DataFrame) -> dict:
    """Bring a cube in line with the listed objects (collection, key, ord, acq_date).

    One object per date stands for the date; only dates that are missing are read from `cells`.
    """
    picked = D.pick_per_date(listing.where(F.col("collection") == collection), "key", "ord")
    return cube.sync(collection, picked, cells.where(F.col("collection") == collection))
