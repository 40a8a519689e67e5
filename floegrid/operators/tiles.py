"""The tile layout: one row per chunk of a raster.

`data` holds h x w little-endian float32 values row-major as bytes; NaN is nodata. Bytes cross
between Spark and Python by block copy, where an array column would be converted value by value,
and they compress well in Parquet. Functions that see many tiles of one place read them as a
sorted stream and hold one tile, so no group is ever gathered in memory.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from floegrid.operators.mosaic import CELL, SLICE
from floegrid.operators.pyramid import LEVELS

TILE_COLUMNS = ["ty", "tx", "h", "w", "data"]
# Values per batch handed back to Spark: a few large tiles or many small ones.
FLUSH_VALUES = 1 << 22
VALUE = np.dtype("<f4")


def decode(data: bytes, h: int, w: int) -> np.ndarray:
    return np.frombuffer(data, dtype=VALUE).reshape(h, w)


def encode(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values, dtype=VALUE).tobytes()


def tile_schema(frame: DataFrame, keys: Sequence[str], extra: Sequence[T.StructField] = ()) -> T.StructType:
    return T.StructType([frame.schema[k] for k in keys] + list(extra) + [
        T.StructField(n, T.IntegerType()) for n in ("ty", "tx", "h", "w")] + [
        T.StructField("data", T.BinaryType())])


def assemble_tiles(cells: DataFrame, tile: int, keys: Sequence[str] = SLICE,
                   cell: Sequence[str] = CELL, value: str = "value",
                   height: int | None = None, width: int | None = None) -> DataFrame:
    """Cells (at most one per position) to tiles. A place without cells has no tile row.

    With a grid height and width, edge tiles are cut to the grid.
    """
    row, col = cell
    h = F.lit(tile) if height is None else F.least(F.lit(tile), F.lit(height) - F.col("ty") * tile)
    w = F.lit(tile) if width is None else F.least(F.lit(tile), F.lit(width) - F.col("tx") * tile)

    @F.pandas_udf(T.BinaryType())
    def scatter(at: pd.Series, values: pd.Series, size: pd.Series) -> pd.Series:
        out = []
        for i, v, n in zip(at, values, size):
            data = np.full(n, np.nan, dtype=VALUE)
            data[i] = v
            out.append(data.tobytes())
        return pd.Series(out)
    placed = cells.select(*keys, F.expr(f"int({row} div {tile})").alias("ty"),
                          F.expr(f"int({col} div {tile})").alias("tx"),
                          F.expr(f"int({row} % {tile})").alias("_r"),
                          F.expr(f"int({col} % {tile})").alias("_c"), F.col(value).cast("float").alias("_v"))
    # A group is one tile: never more than tile x tile cells.
    grouped = (placed.where(F.col("_v").isNotNull()).groupBy(*keys, "ty", "tx")
               .agg(F.collect_list(F.struct("_r", "_c", "_v")).alias("_cells"))
               .withColumns({"h": h.cast("int"), "w": w.cast("int")}))
    at = F.transform("_cells", lambda c: c["_r"] * F.col("w") + c["_c"])
    return grouped.select(*keys, "ty", "tx", "h", "w",
                          scatter(at, F.col("_cells")["_v"], F.col("h") * F.col("w")).alias("data"))


def explode_tiles(tiles: DataFrame, tile: int, keys: Sequence[str] = SLICE) -> DataFrame:
    """Tiles to their valid cells, in batches of bounded size."""
    names = list(keys)
    schema = T.StructType([tiles.schema[k] for k in names] + [
        T.StructField("row", T.IntegerType()), T.StructField("col", T.IntegerType()),
        T.StructField("value", T.FloatType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
            size = 0
            ty, tx, w = (batch.column(c).to_numpy() for c in ("ty", "tx", "w"))
            for i, data in enumerate(batch.column("data")):
                values = np.frombuffer(data.as_buffer(), dtype=VALUE)
                at = np.flatnonzero(~np.isnan(values))
                held.append((i, ty[i] * tile + at // w[i], tx[i] * tile + at % w[i], values[at]))
                size += len(at)
                if size >= FLUSH_VALUES:
                    yield rows(batch, held)
                    held, size = [], 0
            if held:
                yield rows(batch, held)

    def rows(batch: pa.RecordBatch, held: list) -> pa.RecordBatch:
        source = pa.array(np.repeat([h[0] for h in held], [len(h[1]) for h in held]), pa.int64())
        cells = [np.concatenate([h[k] for h in held]) for k in (1, 2, 3)]
        return pa.RecordBatch.from_arrays(
            [*[batch.column(k).take(source) for k in names], pa.array(cells[0], pa.int32()),
             pa.array(cells[1], pa.int32()), pa.array(cells[2], pa.float32())],
            names=[*names, "row", "col", "value"])
    needed = list(dict.fromkeys([*names, "ty", "tx", "w", "data"]))
    return tiles.select(*needed).mapInArrow(scan, schema)


def retile(tiles: DataFrame, tile: int, to: int, height: int, width: int, keys: Sequence[str] = SLICE,
           row_off: str | None = None, col_off: str | None = None) -> DataFrame:
    """Pieces of tiles on another tile lattice, shifted by a raster offset and clipped on all
    four sides of the grid.

    Each source tile is sliced where it lies; a target tile that takes pieces of several
    sources appears once per piece, NaN elsewhere, until `mosaic_tiles` folds them.
    """
    names = list(keys)
    schema = tile_schema(tiles, names)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for rec in pdf.itertuples(index=False):
                r = rec._asdict()
                src = decode(r["data"], r["h"], r["w"])
                top = r["ty"] * tile + (int(r[row_off]) if row_off else 0)
                left = r["tx"] * tile + (int(r[col_off]) if col_off else 0)
                y0, x0 = max(0, top), max(0, left)
                y1, x1 = min(height, top + r["h"]), min(width, left + r["w"])
                if y0 >= y1 or x0 >= x1:
                    continue
                for ty in range(y0 // to, (y1 - 1) // to + 1):
                    for tx in range(x0 // to, (x1 - 1) // to + 1):
                        a, b = max(y0, ty * to), min(y1, (ty + 1) * to)
                        c, d = max(x0, tx * to), min(x1, (tx + 1) * to)
                        piece = src[a - top:b - top, c - left:d - left]
                        if np.isnan(piece).all():
                            continue
                        h, w = min(to, height - ty * to), min(to, width - tx * to)
                        full = np.full((h, w), np.nan, dtype=np.float32)
                        full[a - ty * to:b - ty * to, c - tx * to:d - tx * to] = piece
                        out.append([*[r[k] for k in names], ty, tx, h, w, encode(full)])
                if len(out) * to * to >= FLUSH_VALUES:
                    yield pd.DataFrame(out, columns=[*names, *TILE_COLUMNS])
                    out = []
            if out:
                yield pd.DataFrame(out, columns=[*names, *TILE_COLUMNS])
    return tiles.mapInPandas(cut, schema)


def _fold(tiles: DataFrame, keys: list[str], carry: list[str], order: str) -> DataFrame:
    """Stream sorted tiles and keep the later valid value per pixel."""
    group = [*keys, *carry, "ty", "tx"]
    schema = tile_schema(tiles, keys, extra=[tiles.schema[c] for c in [*carry, order]])
    columns = [f.name for f in schema]

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, acc, last, shape = None, None, None, None
        done: list[list] = []

        def emit() -> list:
            head = dict(zip(group, held))
            tail = {order: last, "h": shape[0], "w": shape[1], "data": encode(acc)}
            return [head[c] if c in head else tail[c] for c in columns]
        for pdf in batches:
            blobs = pdf["data"].tolist()
            for i, key in enumerate(pdf[group].itertuples(index=False, name=None)):
                data = np.frombuffer(blobs[i], dtype=VALUE)
                if key != held:
                    if held is not None:
                        done.append(emit())
                    held, acc = key, data.copy()
                    shape = (int(pdf["h"].iat[i]), int(pdf["w"].iat[i]))
                else:
                    np.copyto(acc, data, where=~np.isnan(data))
                last = pdf[order].iat[i]
                if len(done) * data.size >= FLUSH_VALUES:
                    yield pd.DataFrame(done, columns=columns)
                    done = []
        if held is not None:
            done.append(emit())
        if done:
            yield pd.DataFrame(done, columns=columns)
    placed = tiles.repartition(*group).sortWithinPartitions(*group, order)
    return placed.mapInPandas(fold, schema)


def mosaic_tiles(tiles: DataFrame, order: str = "ord", keys: Sequence[str] = SLICE,
                 bucket: int = 32) -> DataFrame:
    """One tile per place: later valid pixels win, nodata never overwrites.

    Folding runs in two rounds over consecutive ranges of the integer order, so a place with a
    great many inputs is first folded by many tasks, and the rounds keep the paint order.
    """
    names = list(keys)
    ranged = tiles.withColumn("_range", F.floor(F.col(order) / bucket))
    first = _fold(ranged, names, ["_range"], order)
    return _fold(first.drop("_range"), names, [], order).select(*names, *TILE_COLUMNS)


def _halve_average(q: np.ndarray) -> np.ndarray:
    n = (~np.isnan(q)).sum(axis=0)
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.nansum(q, axis=0, dtype=np.float64) / n


def _halve_mode(q: np.ndarray) -> np.ndarray:
    """Most frequent valid value, the smallest on a tie."""
    q = np.sort(q, axis=0)
    votes = (q[:, None] == q[None, :]).sum(axis=1)
    return np.take_along_axis(q, votes.argmax(axis=0)[None], axis=0)[0]


HALVE = {"average": _halve_average, "mode": _halve_mode, "nearest": lambda q: q[0]}


def _halved(values: np.ndarray, how: str) -> np.ndarray:
    """A raster at half its resolution; a last odd row or column stands alone."""
    h, w = values.shape
    even = np.full((h + h % 2, w + w % 2), np.nan, dtype=VALUE)
    even[:h, :w] = values
    return HALVE[how](np.stack([even[::2, ::2], even[::2, 1::2], even[1::2, ::2], even[1::2, 1::2]])).astype(VALUE)


class _Quads:
    """Open tiles of the levels above a Z-ordered stream of tiles of one block: one tile for each level is held."""

    def __init__(self, levels: Sequence[int], tile: int, how: str, height: int | None, width: int | None, nodata: float | None):
        self.levels, self.tile, self.how, self.shape, self.nodata = levels, tile, how, (height, width), nodata
        self.open: list[tuple[tuple[int, int], np.ndarray] | None] = [None] * len(levels)

    def _size(self, k: int, at: tuple[int, int]) -> list[int]:
        """Height and width of a tile of the k-th level: those of the grid at its edge."""
        return [self.tile if n is None else min(self.tile, -(-n // self.levels[k]) - i * self.tile) for n, i in zip(self.shape, at)]

    def add(self, k: int, ty: int, tx: int, values: np.ndarray) -> Iterator[tuple[int, int, int, np.ndarray]]:
        """Put a tile of the level below the k-th into its quad; gives out the tiles that this closes."""
        if k == len(self.levels):
            return
        up = (ty // 2, tx // 2)
        if self.open[k] is not None and self.open[k][0] != up:
            yield from self.close(k)
        if self.open[k] is None:
            self.open[k] = (up, np.full(self._size(k, up), np.nan, dtype=VALUE))
        small = _halved(values, self.how)
        top, left = ty % 2 * (self.tile // 2), tx % 2 * (self.tile // 2)
        self.open[k][1][top:top + small.shape[0], left:left + small.shape[1]] = small

    def close(self, k: int) -> Iterator[tuple[int, int, int, np.ndarray]]:
        """Give out the open tile of the k-th level, then put it into the level above."""
        if self.open[k] is None:
            return
        (ty, tx), values = self.open[k]
        self.open[k] = None
        if not np.isnan(values).all():
            yield self.levels[k], ty, tx, values
            yield from self.add(k + 1, ty, tx, values)

    def close_all(self) -> Iterator[tuple[int, int, int, np.ndarray]]:
        for k in range(len(self.levels)):
            yield from self.close(k)


def _z_order(ty: str, tx: str, bits: int):
    """The bits of two tile numbers in turn, so that the four tiles of a quad follow each other at every level."""
    out = F.lit(0)
    for i in range(bits):
        for name, place in ((tx, 2 * i), (ty, 2 * i + 1)):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(F.col(name), i).bitwiseAND(1), place))
    return out


def overview_tiles(tiles: DataFrame, tile: int, levels: Sequence[int] = LEVELS, how: str = "average", keys: Sequence[str] = SLICE,
                   height: int | None = None, width: int | None = None, nodata: float | None = None) -> DataFrame:
    """Overview tiles of every level, with a `level` column, from one tile per place.

    Each level halves the one before and joins four tiles into one of the same size. All levels share one exchange: tiles are placed by
    the quad of the coarsest level and read in Z-order, so a task holds one open tile for each level however large the quad is.
    With a grid height and width, edge tiles are cut to the grid. NaN and `nodata` are skipped; a tile without a valid value has no row.
    """
    if how not in HALVE:
        raise ValueError(f"unknown overview method {how!r}; valid: {tuple(HALVE)}")
    levels = sorted(levels)
    if levels != [2 << i for i in range(len(levels))] or tile % 2:
        raise ValueError("levels must be 2, 4, 8 and so on, and the tile size even")
    names, bits = list(keys), len(levels)
    schema = T.StructType([*[tiles.schema[k] for k in names], T.StructField("level", T.IntegerType()),
                           *tile_schema(tiles, []).fields])
    columns = [f.name for f in schema]
    group = [*names, "_qy", "_qx"]

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, quads, done = None, None, []
        for pdf in batches:
            blobs = pdf["data"].tolist()
            for i, (key, ty, tx, h, w) in enumerate(zip(pdf[group].itertuples(index=False, name=None),
                                                        *(pdf[c].tolist() for c in ("ty", "tx", "h", "w")))):
                if key != held:
                    if held is not None:
                        done += [(*held[:-2], level, y, x, *v.shape, encode(v)) for level, y, x, v in quads.close_all()]
                    held, quads = key, _Quads(levels, tile, how, height, width, nodata)
                values = decode(blobs[i], h, w)
                if nodata is not None:
                    values = np.where(values == nodata, np.float32(np.nan), values)
                done += [(*held[:-2], level, y, x, *v.shape, encode(v)) for level, y, x, v in quads.add(0, ty, tx, values)]
                if len(done) * tile * tile >= FLUSH_VALUES:
                    yield pd.DataFrame(done, columns=columns)
                    done = []
        if held is not None:
            done += [(*held[:-2], level, y, x, *v.shape, encode(v)) for level, y, x, v in quads.close_all()]
        if done:
            yield pd.DataFrame(done, columns=columns)
    placed = (tiles.select(*names, *TILE_COLUMNS, F.shiftright("ty", bits).alias("_qy"), F.shiftright("tx", bits).alias("_qx"))
              .repartition(*group).withColumn("_z", _z_order("ty", "tx", bits)).sortWithinPartitions(*group, "_z"))
    return placed.mapInPandas(reduce, schema)


def lut_arrays(lut: DataFrame, keys: Sequence[str] = ("granule", "polarization", "calibration")) -> DataFrame:
    """One row per calibration table: sorted lines, pixels and the row-major k values.

    A table is a fixed lattice of a few thousand samples. A table with holes is an error.
    """
    out = lut.groupBy(*keys).agg(
        F.array_sort(F.collect_set("line")).alias("lines"),
        F.array_sort(F.collect_set("pixel")).alias("pixels"),
        F.array_sort(F.collect_list(F.struct("line", "pixel", "k"))).alias("_s"))
    whole = F.when(F.size("_s") == F.size("lines") * F.size("pixels"), F.col("_s")["k"]).otherwise(
        F.raise_error(F.lit("calibration table is not a full line x pixel lattice"))
        .cast("array<double>"))
    return out.select(*keys, "lines", "pixels", whole.alias("k"))


def _bracket(at: np.ndarray, knots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    i = np.clip(np.searchsorted(knots, at, side="right") - 1, 0, len(knots) - 2)
    return i, (at - knots[i]) / (knots[i + 1] - knots[i])


def calibrate_tiles(tiles: DataFrame, lut: DataFrame, tile: int,
                    on: Sequence[str] = ("granule", "polarization")) -> DataFrame:
    """Digital-number tiles to backscatter in dB, once per calibration table of the granule.

    The table rides on the tile row: one equi-join, then vectorised interpolation, linear
    beyond the outer samples.
    """
    joined = tiles.join(lut_arrays(lut), list(on))
    keys = [c for c in joined.columns if c not in ("lines", "pixels", "k", *TILE_COLUMNS)]
    schema = tile_schema(joined, keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for dn, h, w, ty, tx, lines, pixels, k in zip(
                    pdf["data"], pdf["h"], pdf["w"], pdf["ty"], pdf["tx"], pdf["lines"], pdf["pixels"],
                    pdf["k"]):
                k2 = np.asarray(k, dtype=np.float64).reshape(len(lines), len(pixels))
                i, fy = _bracket(ty * tile + np.arange(h), np.asarray(lines, dtype=np.float64))
                j, fx = _bracket(tx * tile + np.arange(w), np.asarray(pixels, dtype=np.float64))
                fy, fx = fy[:, None], fx[None, :]
                kk = ((1 - fy) * ((1 - fx) * k2[np.ix_(i, j)] + fx * k2[np.ix_(i, j + 1)])
                      + fy * ((1 - fx) * k2[np.ix_(i + 1, j)] + fx * k2[np.ix_(i + 1, j + 1)]))
                d = decode(dn, h, w).astype(np.float64)
                with np.errstate(divide="ignore", invalid="ignore"):
                    db = np.where(d > 0, 10 * np.log10(d * d / (kk * kk)), np.nan)
                out.append(encode(db))
            yield pdf[[*keys, "ty", "tx", "h", "w"]].assign(data=out)
    return joined.mapInPandas(run, schema)
