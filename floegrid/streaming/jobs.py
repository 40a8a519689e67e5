"""Incremental forms of the daily jobs.

Every job is a plain Structured Streaming query. Sinks are idempotent per batch: a replayed
batch after a failure overwrites the same partitions with the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from floegrid.functions.names import item_id
from floegrid.operators.catalog import collection_extent
from floegrid.operators.cube import Cube
from floegrid.operators.dates import dedupe_latest
from floegrid.operators.lod import CHUNK_ROWS, STRIDES, grid_chunk_no, lod_tiers
from floegrid.functions.grids import ARCTIC_10KM, Grid
from floegrid.sources.granules import GRANULE_PAGE, granule_rows


def stream_granules(spark: SparkSession, path: str, glob: str | None = None,
                    files_per_batch: int | None = None, lines: bool = False) -> DataFrame:
    """Granule rows of new catalogue page files as they appear.

    A file is one page, or with `lines` any number of pages, one on each line. Very many pages should come as lines: the stream
    lists, logs and opens every file.
    """
    reader = spark.readStream.schema(GRANULE_PAGE).option("multiLine", str(not lines).lower())
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return granule_rows(reader.json(path), glob)


def stream_dedupe(granules: DataFrame, lateness: str = "10 days", key: Sequence[str] = ("ur",),
                  time: str = "start") -> DataFrame:
    """One row per granule across overlapping polls; keys are forgotten after the watermark."""
    return granules.withWatermark(time, lateness).dropDuplicatesWithinWatermark(list(key))


def stream_daily_counts(granules: DataFrame, keys: Sequence[str] = ("satellite",), lateness: str = "1 day",
                        time: str = "start", watermarked: bool = False) -> DataFrame:
    """Counts per UTC day, emitted once the day is closed, so the newest day is held back.

    A lateness of one day matches the rule that drops the newest date; ten days cover the lag
    of a mirror at the price of later results.
    """
    marked = granules if watermarked else granules.withWatermark(time, lateness)
    return (marked.groupBy(F.window(time, "1 day"), *keys).agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("window.start").cast("date").alias("acq_date"), *keys, "n"))


def _run(query: DataFrame, checkpoint: str, sink) -> StreamingQuery:
    return (query.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def stream_upsert_cube(cells: DataFrame, cube: Cube, checkpoint: str,
                       order: str | None = None) -> StreamingQuery:
    """Slices of each batch into the cube.

    Columns: collection, acq_time and the cube's layout. A batch adds to the slices it touches;
    its cells win over stored ones. Slices it does not touch are not rewritten.
    """
    place = cube.place
    value = [c for c in cells.columns if c not in ("collection", "acq_time", *place, order)]

    def sink(batch: DataFrame, _: int) -> None:
        keys = ["collection", "acq_time", *place]
        best = F.max_by(F.struct(*value), F.col(order)) if order else F.max(F.struct(*value))
        fresh = batch.groupBy(*keys).agg(best.alias("_v")).select(*keys, "_v.*")
        cube.merge_slices(fresh, fresh.select("collection", "acq_time"))
    return _run(cells, checkpoint, sink)


def stream_lod(points: DataFrame, path: str, checkpoint: str, grid: Grid = ARCTIC_10KM,
               strides: Sequence[int] = STRIDES, size: int = CHUNK_ROWS) -> StreamingQuery:
    """Points under `points` and their tiers with batch numbers under `tiers`.

    A date may arrive in several stream batches: each batch stores its points, and the tiers of the dates it touches are
    made again from all points stored for them. The stream checkpoint is the load state and the batch id the idempotence
    key, so a restart resumes at the batch that failed.
    """
    columns = points.columns

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        _overwrite(batch.select(*columns).withColumn("batch", F.lit(batch_id)), f"{path}/points", "acq_date", "batch")
        held = spark.read.schema(points.schema).option("basePath", f"{path}/points").parquet(f"{path}/points")
        days = batch.select("acq_date").distinct()
        whole = held.select(*columns).join(days, "acq_date", "left_semi").dropDuplicates(["acq_date", "row", "col"])
        chunk = F.lit(None).cast("long")
        for stride in strides:
            chunk = F.when(F.col("tier") == stride, grid_chunk_no(stride, grid, size)).otherwise(chunk)
        tiers = lod_tiers(whole, strides, expected=grid.n_cells).withColumn("chunk", chunk)
        _overwrite(tiers.hint("rebalance", "tier", "acq_date"), f"{path}/tiers", "tier", "acq_date")
    return _run(points, checkpoint, sink)


def _overwrite(frame: DataFrame, path: str, *by: str) -> None:
    """Replace the partitions that the rows touch."""
    (frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path))


ITEM_SCHEMA = ("id string, west double, south double, east double, north double, "
               "t_min timestamp, t_max timestamp, href string, ord long, collection string")


def read_items(spark: SparkSession, root: str, table: str = "items") -> DataFrame:
    path = f"{root}/{table}"
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    schema = ITEM_SCHEMA if table == "items" else (
        "west double, south double, east double, north double, t_min timestamp, t_max timestamp, "
        "collection string")
    return (spark.read.schema(schema).parquet(path) if fs.exists(hpath)
            else spark.createDataFrame([], schema))


def stream_catalog(items: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Items of each batch upserted by id, and the extents of their collections merged.

    Input: collection, key, box, time range, href and ord. Only collections of the batch are
    rewritten.
    """
    def sink(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        cols = ["id", "west", "south", "east", "north", "t_min", "t_max", "href", "ord", "collection"]
        fresh = batch.withColumn("id", item_id(F.col("key"))).where("id is not null").select(*cols)
        touched = fresh.select("collection").distinct()
        held = read_items(spark, root).join(touched, "collection", "left_semi").select(*cols)
        merged = dedupe_latest(held.unionByName(fresh), ["collection", "id"], ["ord", "href"]).select(*cols)
        _overwrite(merged, f"{root}/items", "collection")
        known = read_items(spark, root, "extents").join(touched, "collection", "left_semi")
        now = read_items(spark, root).join(touched, "collection", "left_semi")
        _overwrite(collection_extent(now, known), f"{root}/extents", "collection")
    return _run(items, checkpoint, sink)
