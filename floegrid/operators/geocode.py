"""Resampling of tiles onto another grid: radar images through ground control points, and rasters between two CRSs.

Control points are first projected to the target CRS, which makes the remaining mapping close
to the identity, and one thin-plate spline per granule maps target x, y to image row, column. Rasters on a grid need no
spline: the target's centres are projected to the source grid.

Everything per pixel happens on tiles. Source tiles get the first row and column of their neighbours (`pad_tiles`). A target tile's
positions in the source are worked out once, on a lattice, which also tells the source tiles that it touches; the lattice rides on the
request, requests meet source tiles by an equi-join, each pair yields a partial target tile, and partial tiles are folded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from floegrid.functions.grids import Grid
from floegrid.functions.projection import EPSG3413, PolarCrs, lonlat_arrays, polar_arrays, to_polar
from floegrid.operators.mosaic import SLICE
from floegrid.operators.tiles import TILE_COLUMNS, VALUE, decode, encode, mosaic_tiles, tile_schema
from floegrid.session import spread

# Target pixels between exact spline evaluations to begin with; values between are interpolated linearly.
LATTICE = 16
# Greatest error of that in source pixels: where the middle of a lattice cell is further off, the lattice gets finer.
TOLERANCE = 0.02


def project_gcps(gcps: DataFrame, crs: PolarCrs = EPSG3413) -> DataFrame:
    """Control points with lon and lat as map x and y."""
    x, y = to_polar(F.col("lon"), F.col("lat"), crs)
    return gcps.withColumns({"x": x, "y": y})


def _kernel(x: np.ndarray, y: np.ndarray, px: np.ndarray, py: np.ndarray) -> np.ndarray:
    d2 = (x[:, None] - px[None, :]) ** 2 + (y[:, None] - py[None, :]) ** 2
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(d2 > 0, d2 * np.log(d2) / 2, 0.0)


def fit_splines(gcps: DataFrame, keys: Sequence[str] = ("granule",)) -> DataFrame:
    """Spline coefficients per granule from its control points (row, col, x, y).

    A granule has a few hundred control points by its product format, so the fit is one small
    dense solve.
    """
    names = list(keys)
    num = T.ArrayType(T.DoubleType())
    schema = T.StructType([gcps.schema[k] for k in names] + [
        T.StructField(n, T.DoubleType()) for n in ("cx", "cy", "scale", "gx0", "gy0", "gx1", "gy1")] + [
        T.StructField(n, num) for n in ("px", "py", "w_row", "w_col")])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        x, y = pdf["x"].to_numpy(float), pdf["y"].to_numpy(float)
        cx, cy = x.mean(), y.mean()
        scale = max(np.ptp(x), np.ptp(y), 1e-9)
        px, py = (x - cx) / scale, (y - cy) / scale
        n = len(px)
        a = np.zeros((n + 3, n + 3))
        a[:n, :n] = _kernel(px, py, px, py)
        a[:n, n:] = np.column_stack([np.ones(n), px, py])
        a[n:, :n] = a[:n, n:].T
        rhs = np.zeros((n + 3, 2))
        rhs[:n, 0], rhs[:n, 1] = pdf["row"], pdf["col"]
        w = np.linalg.lstsq(a, rhs, rcond=None)[0]
        head = {k: [pdf[k].iat[0]] for k in names}
        return pd.DataFrame({**head, "cx": [cx], "cy": [cy], "scale": [scale], "gx0": [x.min()],
                             "gy0": [y.min()], "gx1": [x.max()], "gy1": [y.max()], "px": [px], "py": [py],
                             "w_row": [w[:, 0]], "w_col": [w[:, 1]]})
    return gcps.select(*names, "row", "col", "x", "y").groupBy(*names).applyInPandas(fit, schema)


Exact = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


class Lattice(NamedTuple):
    """Source rows and columns (corner-based) at some target rows and columns of a tile, to be interpolated between them."""
    rows: np.ndarray
    cols: np.ndarray
    src_row: np.ndarray
    src_col: np.ndarray

    def between(self, values: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
        across = np.array([np.interp(cols, self.cols, line) for line in values])
        return np.array([np.interp(rows, self.rows, line) for line in across.T]).T

    def every(self, h: int, w: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.rows) == h and len(self.cols) == w:
            return self.src_row, self.src_col
        return tuple(self.between(v, np.arange(h), np.arange(w)) for v in (self.src_row, self.src_col))

    def packed(self) -> bytes:
        head = np.array([len(self.rows), len(self.cols)], np.int64).tobytes()
        return head + b"".join(np.asarray(v, np.float64).tobytes() for v in self)

    @staticmethod
    def unpacked(blob: bytes) -> Lattice:
        n, m = np.frombuffer(blob, np.int64, 2)
        flat = np.frombuffer(blob, np.float64, -1, 16)
        a, b, c = n, n + m, n + m + n * m
        return Lattice(flat[:a], flat[a:b], flat[b:c].reshape(n, m), flat[c:].reshape(n, m))


def lattice_of(exact: Exact, h: int, w: int, step: int, tolerance: float = TOLERANCE) -> Lattice:
    """Exact positions on a lattice that is halved until the middles of its cells are within `tolerance`; at 1 every pixel is exact."""
    while step > 1:
        rows, cols = (np.unique(np.append(np.arange(0, n, step), n - 1)) for n in (h, w))
        coarse = Lattice(rows, cols, *exact(rows, cols))
        my, mx = ((k[1:] + k[:-1]) / 2 if len(k) > 1 else k for k in (rows, cols))
        off = max(np.abs(e - coarse.between(v, my, mx)).max() for e, v in zip(exact(my, mx), (coarse.src_row, coarse.src_col)))
        if off <= tolerance:
            return coarse
        step //= 2
    rows, cols = np.arange(h), np.arange(w)
    return Lattice(rows, cols, *exact(rows, cols))


def _map_axes(grid: Grid, tile: int, ty: int, tx: int, rows: np.ndarray, cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Map x of pixel centres by column and y by row."""
    return (grid.west + (tx * tile + cols + 0.5) * grid.res_x, grid.north - (ty * tile + rows + 0.5) * grid.res_y)


def _by_spline(rec: dict, grid: Grid, tile: int) -> Exact:
    px, py = np.asarray(rec["px"]), np.asarray(rec["py"])

    def exact(rows: np.ndarray, cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        gx, gy = _map_axes(grid, tile, rec["dty"], rec["dtx"], rows, cols)
        xx, yy = np.meshgrid((gx - rec["cx"]) / rec["scale"], (gy - rec["cy"]) / rec["scale"])
        basis = np.column_stack([_kernel(xx.ravel(), yy.ravel(), px, py), np.ones(xx.size), xx.ravel(), yy.ravel()])
        return tuple((basis @ np.asarray(rec[name])).reshape(xx.shape) for name in ("w_row", "w_col"))
    return exact


def _by_grid(src: Grid, dst: Grid, tile: int, ty: int, tx: int) -> Exact:
    def exact(rows: np.ndarray, cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x, y = np.meshgrid(*_map_axes(dst, tile, ty, tx, rows, cols))
        if src.crs != dst.crs:
            x, y = lonlat_arrays(x, y, dst.polar) if dst.polar else (x, y)
            x, y = polar_arrays(x, y, src.polar) if src.polar else (x, y)
        return (src.north - y) / src.res_y, (x - src.west) / src.res_x
    return exact


@F.pandas_udf(T.BinaryType())
def _first_column(data: pd.Series, h: pd.Series, w: pd.Series) -> pd.Series:
    return pd.Series([encode(decode(d, i, j)[:, 0]) for d, i, j in zip(data, h, w)])


def pad_tiles(tiles: DataFrame, keys: Sequence[str] = ("granule",), wrap: int | None = None) -> DataFrame:
    """Tiles with one more row and column: the first ones of their right, lower and diagonal neighbours, NaN where there is none.

    Every tile sends three strips of a few kilobytes; tiles themselves are shuffled once. With `wrap` tiles in a row, the last one's right
    neighbour is the first.
    """
    on = [*keys, "ty", "tx"]
    left = F.col("tx") - 1
    left = left if wrap is None else F.pmod(left, F.lit(wrap))

    def strip(dy: int, tx, right, below, corner):
        none = F.lit(None).cast("binary")
        return F.struct((F.col("ty") - dy).alias("ty"), tx.cast("int").alias("tx"),
                        F.coalesce(right, none).alias("right"), F.coalesce(below, none).alias("below"),
                        F.coalesce(corner, none).alias("corner"))
    none = F.lit(None).cast("binary")
    cut = tiles.select(*on, _first_column("data", "h", "w").alias("_col"),
                       F.expr("substring(data, 1, 4 * w)").alias("_row"),
                       F.expr("substring(data, 1, 4)").alias("_px"))
    sent = cut.select(*keys, F.inline(F.array(strip(0, left, F.col("_col"), none, none),
                                              strip(1, F.col("tx"), none, F.col("_row"), none),
                                              strip(1, left, none, none, F.col("_px")))))
    strips = sent.groupBy(*on).agg(*[F.max(c).alias(c) for c in ("right", "below", "corner")])
    joined = tiles.join(strips, on, "left")

    def pad(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for data, h, w, right, below, corner in zip(*(pdf[c].tolist() for c in ("data", "h", "w", "right", "below", "corner"))):
                full = np.full((h + 1, w + 1), np.nan, dtype=VALUE)
                full[:h, :w] = decode(data, h, w)
                # A neighbour may be shorter at the edge of the raster, or longer than a last tile that wraps around.
                if right is not None:
                    v = np.frombuffer(right, dtype=VALUE)[:h]
                    full[:len(v), w] = v
                if below is not None:
                    v = np.frombuffer(below, dtype=VALUE)[:w]
                    full[h, :len(v)] = v
                if corner is not None:
                    full[h, w] = np.frombuffer(corner, dtype=VALUE)[0]
                out.append(encode(full))
            yield pdf.drop(columns=["right", "below", "corner"]).assign(data=out, h=pdf["h"] + 1, w=pdf["w"] + 1)
    return joined.mapInPandas(pad, joined.drop("right", "below", "corner").schema)


def tile_requests(wanted: DataFrame, grid: Grid, tile: int, out_tile: int, exact: Callable[[dict], Exact], keep: Sequence[str],
                  step: int, tolerance: float = TOLERANCE, wrap: int | None = None, near: bool = False) -> DataFrame:
    """One row for each source tile (ty, tx) that a target tile (dty, dtx) of `wanted` touches, with the target's lattice.

    wanted: dty, dtx, n_rows and n_cols of the source, and what `exact` reads.
    """
    shift = 0.0 if near else 0.5
    names = [*keep, "n_rows", "n_cols", "dty", "dtx"]
    schema = T.StructType([*[wanted.schema[c] for c in names], T.StructField("lattice", T.BinaryType()),
                           T.StructField("ty", T.IntegerType()), T.StructField("tx", T.IntegerType())])

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for rec in pdf.to_dict("records"):
                h, w = _size(grid, out_tile, rec["dty"], rec["dtx"])
                places = lattice_of(exact(rec), h, w, step, tolerance)
                r, c = places.every(h, w)
                if wrap:
                    c = np.mod(c, wrap)
                hit = (r >= 0) & (r < rec["n_rows"]) & (c >= 0) & (c < rec["n_cols"])
                if not hit.any():
                    continue
                br = np.maximum(np.floor(r[hit] - shift), 0).astype(np.int64) // tile
                bc = np.floor(c[hit] - shift)
                bc = (np.mod(bc, wrap) if wrap else np.maximum(bc, 0)).astype(np.int64) // tile
                blob = places.packed()
                for sty, stx in np.unique(np.column_stack([br, bc]), axis=0):
                    out.append([*[rec[k] for k in names], blob, int(sty), int(stx)])
            yield pd.DataFrame(out, columns=schema.names)
    return wanted.mapInPandas(ask, schema)


def _size(grid: Grid, out_tile: int, ty: int, tx: int) -> tuple[int, int]:
    return min(out_tile, grid.height - ty * out_tile), min(out_tile, grid.width - tx * out_tile)


def pull_tiles(padded: DataFrame, requests: DataFrame, grid: Grid, tile: int, out_tile: int, on: Sequence[str], keep: Sequence[str],
               wrap: int | None = None, near: bool = False) -> DataFrame:
    """Partial target tiles: each padded source tile resampled onto the target tiles that asked for it. Partial tiles of one image do not overlap."""
    paired = requests.join(padded, [*on, "ty", "tx"])
    schema = tile_schema(paired, keep)

    def resample(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for rec in pdf.to_dict("records"):
                h, w = _size(grid, out_tile, rec["dty"], rec["dtx"])
                data = _pull(rec, *Lattice.unpacked(rec["lattice"]).every(h, w), tile, wrap, near)
                if not np.isnan(data).all():
                    out.append([*[rec[k] for k in keep], rec["dty"], rec["dtx"], h, w, encode(data)])
            yield pd.DataFrame(out, columns=[*keep, *TILE_COLUMNS])
    return paired.mapInPandas(resample, schema)


def geocode_requests(gcps: DataFrame, shapes: DataFrame, grid: Grid, tile: int, out_tile: int, keys: Sequence[str],
                     lattice: int = LATTICE) -> DataFrame:
    """Requests of all images. gcps: row, col, x, y; shapes: n_rows, n_cols; both by `keys`."""
    names = list(keys)
    splines = fit_splines(gcps, keys).join(shapes, names)
    n_ty, n_tx = -(-grid.height // out_tile), -(-grid.width // out_tile)
    span_x, span_y = out_tile * grid.res_x, out_tile * grid.res_y

    def index(pos, n: int):
        return F.least(F.greatest(F.floor(pos), F.lit(0)), F.lit(n - 1)).cast("int")
    # One output tile of margin: control points may stop short of the image edge.
    wanted = (splines
              .withColumn("dty", F.explode(F.sequence(
                  index((F.lit(grid.north) - F.col("gy1")) / span_y - 1, n_ty),
                  index((F.lit(grid.north) - F.col("gy0")) / span_y + 1, n_ty))))
              .withColumn("dtx", F.explode(F.sequence(
                  index((F.col("gx0") - F.lit(grid.west)) / span_x - 1, n_tx),
                  index((F.col("gx1") - F.lit(grid.west)) / span_x + 1, n_tx)))))
    return tile_requests(wanted, grid, tile, out_tile, lambda rec: _by_spline(rec, grid, out_tile), names, lattice)


def image_shapes(tiles: DataFrame, tile: int, keys: Sequence[str]) -> DataFrame:
    """n_rows and n_cols of each image, from the numbers and sizes of its tiles alone."""
    return tiles.groupBy(*keys).agg(F.max(F.col("ty") * tile + F.col("h")).alias("n_rows"),
                                    F.max(F.col("tx") * tile + F.col("w")).alias("n_cols"))


def geocode_tiles(tiles: DataFrame, gcps: DataFrame, grid: Grid, tile: int, out_tile: int,
                  keys: Sequence[str] = ("granule",), carry: Sequence[str] = (),
                  lattice: int = LATTICE) -> DataFrame:
    """Partial target tiles of each granule, bilinear with weights renormalised over valid pixels.

    `carry` columns of the source tiles (such as collection, acq_date and paint order) stay on
    the rows. Fold the result with `mosaic_tiles`: partial tiles of a granule do not overlap.
    """
    asked = geocode_requests(gcps, image_shapes(tiles, tile, keys), grid, tile, out_tile, keys, lattice)
    return pull_tiles(pad_tiles(tiles, keys), asked, grid, tile, out_tile, keys, [*keys, *carry])


def warp_tiles(tiles: DataFrame, src: Grid, dst: Grid, tile: int, out_tile: int, method: str = "bilinear",
               keys: Sequence[str] = SLICE, lattice: int = LATTICE, tolerance: float = TOLERANCE) -> DataFrame:
    """Tiles of any number of slices resampled onto the target grid; the tile form of `warp`.

    The requests depend on the two grids alone and are worked out once for all slices, by as many tasks as there are target tiles. A
    source that spans all longitudes wraps around. With `lattice` 1 every position is exact, else within `tolerance` source pixels.
    """
    if method not in ("near", "bilinear"):
        raise ValueError(f"unknown resampling {method!r}")
    names, near = list(keys), method == "near"
    wrap = src.width if src.polar is None and abs(src.width * src.res_x - 360.0) < 1e-6 else None
    n_ty, n_tx = -(-dst.height // out_tile), -(-dst.width // out_tile)
    wanted = spread(tiles.sparkSession.range(n_ty * n_tx).select(
        F.expr(f"int(id div {n_tx})").alias("dty"), F.expr(f"int(id % {n_tx})").alias("dtx"),
        F.lit(src.height).alias("n_rows"), F.lit(src.width).alias("n_cols")), "dty", "dtx")
    asked = tile_requests(wanted, dst, tile, out_tile, lambda rec: _by_grid(src, dst, out_tile, rec["dty"], rec["dtx"]), [], lattice,
                          tolerance, wrap, near)
    source = tiles.select(*names, *TILE_COLUMNS)
    padded = source if near else pad_tiles(source, names, -(-src.width // tile) if wrap else None)
    part = pull_tiles(padded, asked, dst, tile, out_tile, [], names, wrap, near)
    return mosaic_tiles(part.withColumn("ord", F.lit(0)), "ord", names)


def _pull(rec: dict, r: np.ndarray, c: np.ndarray, tile: int, wrap: int | None = None, near: bool = False) -> np.ndarray:
    """Values of the target pixels whose base pixel lies in this source tile: bilinear from a padded tile, or the nearest pixel's."""
    src = decode(rec["data"], int(rec["h"]), int(rec["w"]))
    sh, sw = (n if near else n - 1 for n in src.shape)
    c = np.mod(c, wrap) if wrap else c
    hit = (r >= 0) & (r < rec["n_rows"]) & (c >= 0) & (c < rec["n_cols"])
    out = np.full(r.shape, np.nan, dtype=np.float32)
    if near:
        lr, lc = np.floor(r).astype(np.int64) - int(rec["ty"]) * tile, np.floor(c).astype(np.int64) - int(rec["tx"]) * tile
        hit &= (lr >= 0) & (lr < sh) & (lc >= 0) & (lc < sw)
        out[hit] = src[lr[hit], lc[hit]]
        return out
    fr, fc = np.maximum(r - 0.5, 0), np.mod(c - 0.5, wrap) if wrap else np.maximum(c - 0.5, 0)
    r0, c0 = np.floor(fr).astype(np.int64), np.floor(fc).astype(np.int64)
    lr, lc = r0 - int(rec["ty"]) * tile, c0 - int(rec["tx"]) * tile
    hit &= (lr >= 0) & (lr < sh) & (lc >= 0) & (lc < sw)
    lr, lc, fy, fx = lr[hit], lc[hit], (fr - r0)[hit], (fc - c0)[hit]
    total, weight = np.zeros(len(lr)), np.zeros(len(lr))
    for dr, dc, w in ((0, 0, (1 - fy) * (1 - fx)), (0, 1, (1 - fy) * fx), (1, 0, fy * (1 - fx)), (1, 1, fy * fx)):
        v = src[lr + dr, lc + dc].astype(np.float64)
        ok = ~np.isnan(v) & (w > 1e-9)
        total[ok] += w[ok] * v[ok]
        weight[ok] += w[ok]
    with np.errstate(invalid="ignore", divide="ignore"):
        out[hit] = total / weight
    return out
