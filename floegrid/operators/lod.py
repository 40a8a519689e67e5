"""Arrow points, level-of-detail tiers, resumable chunks and glyph segments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from floegrid.functions import vectors as V
from floegrid.functions.grids import ARCTIC_10KM, Grid, cell_center
from floegrid.functions.projection import EPSG3413, to_lonlat
from floegrid.operators.dates import dates_side
from floegrid.session import checkpoint_dir

# Tier strides, coarsest first, the arrow stride and features per load batch.
STRIDES = (16, 8, 4, 1)
ARROW_STRIDE = 15
CHUNK_ROWS = 25000


def coregister(u: DataFrame, v: DataFrame, u_grid: Grid, v_grid: Grid,
               keys: Sequence[str] = ("acq_time", "row", "col")) -> DataFrame:
    """u and v of the same cell and time; the two grids must be the same."""
    if u_grid != v_grid:
        raise ValueError("the two components are not on the same grid")
    return u.join(v, list(keys))


def decimate(cells: DataFrame, stride: int, row: str = "row", col: str = "col") -> DataFrame:
    """Every stride-th row and column, starting half a stride in."""
    start = stride // 2
    return cells.where((F.pmod(F.col(row), F.lit(stride)) == start)
                       & (F.pmod(F.col(col), F.lit(stride)) == start))


def arrows(vectors: DataFrame, grid: Grid = ARCTIC_10KM, stride: int = ARROW_STRIDE,
           u: str = "u", v: str = "v") -> DataFrame:
    """Point features of a vector field: position, speed, bearing and components."""
    picked = decimate(vectors, stride).where(V.valid_vector(F.col(u), F.col(v)))
    x, y = cell_center(F.col("row"), F.col("col"), grid)
    lon, lat = to_lonlat(x, y, grid.polar or EPSG3413)
    return picked.withColumns({
        "lon": F.round(lon, 4), "lat": F.round(lat, 4),
        "speed": F.round(V.speed(F.col(u), F.col(v)), 2),
        "dir_to": F.round(V.dir_to(F.col(u), F.col(v)), 1),
        u: F.round(F.col(u), 2), v: F.round(F.col(v), 2)})


def lod_tiers(points: DataFrame, strides: Sequence[int] = STRIDES, expected: int | None = ARCTIC_10KM.n_cells,
              keys: Sequence[str] = ("acq_date",), row: str = "row", col: str = "col") -> DataFrame:
    """Points tagged with each tier they belong to, in one pass over the input.

    Thinned tiers exist only for dates whose point count is the full grid; the full tier
    (stride 1) always does.
    """
    tiers = F.filter(F.array(*[F.lit(s) for s in strides]),
                     lambda s: (F.col(row) % s == 0) & (F.col(col) % s == 0))
    tagged = points.withColumn("tier", F.explode(tiers))
    if expected is None:
        return tagged
    whole = (points.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
             .where(F.col("_n") == expected).select(*keys, F.lit(True).alias("_whole")))
    return (tagged.join(dates_side(whole, keys), list(keys), "left")
            .where((F.col("tier") == 1) | F.col("_whole")).drop("_whole"))


def chunk_no(rows: DataFrame, keys: Sequence[str], order: Sequence[str], size: int = CHUNK_ROWS,
             partitions: int | None = None) -> DataFrame:
    """Batch number of each row within its key, `size` rows in `order` per batch.

    Rows are range-partitioned by key and order, so a key with most of the rows is spread over
    many partitions. The placement is checkpointed, which pins it when executors are lost;
    per-partition counts then give each partition's offset, and only rows of one partition are
    ever numbered together. `order` must be unique within a key.
    """
    spark = rows.sparkSession
    checkpoint_dir(spark)
    placed_by = [*keys, *order]
    ranged = (rows.repartitionByRange(partitions, *placed_by) if partitions
              else rows.repartitionByRange(*placed_by))
    pinned = ranged.withColumn("_part", F.spark_partition_id()).checkpoint()
    counts = pinned.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    within = Window.partitionBy(*keys, "_part").orderBy(*order)
    return (pinned.join(offsets, [*keys, "_part"])
            .withColumn("chunk", F.floor((F.col("_off") + F.row_number().over(within) - 1) / size))
            .drop("_part", "_off"))


def grid_chunk_no(stride: int, grid: Grid = ARCTIC_10KM, size: int = CHUNK_ROWS, row: str = "row",
                  col: str = "col"):
    """Batch number of a cell of a complete tier, from its position alone: no sort, no shuffle."""
    per_row = -(-grid.width // stride)
    ordinal = F.expr(f"{row} div {stride}") * per_row + F.expr(f"{col} div {stride}")
    return F.floor(ordinal / size)


def pending_chunks(chunks: DataFrame, state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose batch is not loaded yet.

    State: keys, chunks_done and, where it is kept, n_chunks. A key whose number of batches has changed since is
    loaded from the start.
    """
    known = state if "n_chunks" in state.columns else state.withColumn("n_chunks", F.lit(None).cast("long"))
    total = chunks.groupBy(*keys).agg((F.max("chunk") + 1).alias("_total"))
    start = F.when(F.col("n_chunks").isNull() | (F.col("n_chunks") == F.col("_total")), F.col("chunks_done")).otherwise(0)
    starts = (total.join(known.select(*keys, "chunks_done", "n_chunks"), list(keys), "left")
              .select(*keys, F.coalesce(start, F.lit(0)).alias("_start")))
    return chunks.join(starts, list(keys)).where(F.col("chunk") >= F.col("_start")).drop("_start")


def load_modes(pending: DataFrame, existing: DataFrame, dataset: str, key: str) -> DataFrame:
    """Each pending batch with its `mode`: the first batch of a data set that does not exist yet recreates it, all others append.

    `existing` holds the names of data sets; the result has one row per data set, key and batch.
    """
    batches = pending.groupBy(dataset, key, "chunk").agg(F.count(F.lit(1)).alias("n_rows"))
    first = (batches.groupBy(dataset).agg(F.min(F.struct(key, "chunk")).alias("_first"))
             .join(existing.select(dataset).distinct(), dataset, "left_anti"))
    same = F.struct(key, "chunk") == F.col("_first")
    return (batches.join(first, dataset, "left")
            .withColumn("mode", F.when(same & (F.col("chunk") == 0), "recreate").otherwise("append")).drop("_first"))


def glyph_segments(vectors: DataFrame, grid: Grid = ARCTIC_10KM,
                   bands: Sequence[tuple[float, float]] = V.GLYPH_BANDS, u: str = "u",
                   v: str = "v") -> DataFrame:
    """One arrow segment per sampled cell and zoom band, in map metres."""
    x, y = cell_center(F.col("row"), F.col("col"), grid)
    options = []
    for spacing, _ in bands:
        stride = max(1, round(spacing / grid.res_x))
        on = ((F.pmod(F.col("row"), F.lit(stride)) == stride // 2)
              & (F.pmod(F.col("col"), F.lit(stride)) == stride // 2))
        options.append(F.when(on, F.struct(F.lit(spacing).alias("spacing"), V.glyph_segment(
            F.col(u), F.col(v), x, y, F.lit(spacing)).alias("segment"))))
    band = F.filter(F.array(*options), lambda b: b.isNotNull())
    return (vectors.where(V.valid_vector(F.col(u), F.col(v)))
            .withColumn("_band", F.explode(band))
            .select("*", "_band.spacing", "_band.segment.*").drop("_band"))
