"""North polar stereographic projection as column arithmetic.

Closed forms of Snyder, Map Projections: A Working Manual (USGS PP 1395), section 21. The
ellipsoid terms are computed on the driver, so each vertex costs a few JVM operations.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class PolarCrs:
    """Ellipsoid, true-scale latitude and central meridian of a polar grid."""
    name: str
    a: float
    f: float
    lat_ts: float = 70.0
    lon_0: float = -45.0

    @property
    def e2(self) -> float:
        return self.f * (2 - self.f)

    @property
    def e(self) -> float:
        return math.sqrt(self.e2)

    @property
    def rho_per_t(self) -> float:
        """Radius in metres per unit of the isometric colatitude t."""
        phi = math.radians(self.lat_ts)
        s = self.e * math.sin(phi)
        m_c = math.cos(phi) / math.sqrt(1 - s * s)
        t_c = math.tan(math.pi / 4 - phi / 2) / ((1 - s) / (1 + s)) ** (self.e / 2)
        return self.a * m_c / t_c


# WGS 84 and Hughes 1980 ellipsoids.
EPSG3413 = PolarCrs("EPSG:3413", 6378137.0, 1 / 298.257223563)
EPSG3411 = PolarCrs("EPSG:3411", 6378273.0, 1 - 6356889.449 / 6378273.0)


def polar_coords(lon: Column, lat: Column, crs: PolarCrs = EPSG3413) -> Column:
    """Struct of map radius `rho` in metres and angle `lam` in radians from the central meridian."""
    phi = F.radians(lat)
    # ((1 + s) / (1 - s)) ** (e / 2) is exp(e * atanh(s)), which names s only once.
    t = F.tan(F.lit(math.pi / 4) - phi / 2) * F.exp(F.lit(crs.e) * F.atanh(F.lit(crs.e) * F.sin(phi)))
    return F.struct((F.lit(crs.rho_per_t) * t).alias("rho"),
                    F.radians(lon - F.lit(crs.lon_0)).alias("lam"))


def to_polar(lon: Column, lat: Column, crs: PolarCrs = EPSG3413) -> tuple[Column, Column]:
    """Map x and y in metres of a longitude and latitude in degrees."""
    q = polar_coords(lon, lat, crs)
    return q["rho"] * F.sin(q["lam"]), -q["rho"] * F.cos(q["lam"])


def _conformal(x: Column, y: Column, crs: PolarCrs) -> Column:
    return F.lit(math.pi / 2) - 2 * F.atan(F.hypot(x, y) / F.lit(crs.rho_per_t))


def _latitude(chi: Column, crs: PolarCrs) -> Column:
    """Geodetic from conformal latitude, four terms of the series."""
    e2 = crs.e2
    e4, e6, e8 = e2 ** 2, e2 ** 3, e2 ** 4
    return (chi
            + F.lit(e2 / 2 + 5 * e4 / 24 + e6 / 12 + 13 * e8 / 360) * F.sin(2 * chi)
            + F.lit(7 * e4 / 48 + 29 * e6 / 240 + 811 * e8 / 11520) * F.sin(4 * chi)
            + F.lit(7 * e6 / 120 + 81 * e8 / 1120) * F.sin(6 * chi)
            + F.lit(4279 * e8 / 161280) * F.sin(8 * chi))


def _longitude(x: Column, y: Column, crs: PolarCrs) -> Column:
    lon = F.degrees(F.atan2(x, -y)) + F.lit(crs.lon_0)
    return F.when(lon < -180, lon + 360).when(lon > 180, lon - 360).otherwise(lon)


def to_lonlat(x: Column, y: Column, crs: PolarCrs = EPSG3413) -> tuple[Column, Column]:
    """Longitude (-180..180) and latitude in degrees of map x and y."""
    return _longitude(x, y, crs), F.degrees(_latitude(_conformal(x, y, crs), crs))


def with_lonlat(frame: DataFrame, x: str, y: str, lon: str = "lon", lat: str = "lat",
                crs: PolarCrs = EPSG3413) -> DataFrame:
    """Add longitude and latitude columns step by step.

    The series uses the conformal latitude many times; as a column of its own it is computed
    once per row.
    """
    conformal = frame.withColumn("_chi", _conformal(F.col(x), F.col(y), crs))
    return conformal.withColumns({
        lon: _longitude(F.col(x), F.col(y), crs), lat: F.degrees(_latitude(F.col("_chi"), crs))}).drop("_chi")


def with_polar(frame: DataFrame, lon: str, lat: str, x: str = "x", y: str = "y",
               crs: PolarCrs = EPSG3413) -> DataFrame:
    """Add map columns step by step, sharing radius and angle."""
    q = polar_coords(F.col(lon), F.col(lat), crs)
    shared = frame.withColumns({"_rho": q["rho"], "_lam": q["lam"]})
    return shared.withColumns({x: F.col("_rho") * F.sin("_lam"), y: -F.col("_rho") * F.cos("_lam")}
                              ).drop("_rho", "_lam")


def polar_arrays(lon: np.ndarray, lat: np.ndarray, crs: PolarCrs = EPSG3413) -> tuple[np.ndarray, np.ndarray]:
    """`to_polar` of arrays, for functions that work on whole tiles."""
    phi = np.radians(lat)
    rho = crs.rho_per_t * np.tan(math.pi / 4 - phi / 2) * np.exp(crs.e * np.arctanh(crs.e * np.sin(phi)))
    lam = np.radians(lon - crs.lon_0)
    return rho * np.sin(lam), -rho * np.cos(lam)


def lonlat_arrays(x: np.ndarray, y: np.ndarray, crs: PolarCrs = EPSG3413) -> tuple[np.ndarray, np.ndarray]:
    """`to_lonlat` of arrays: the conformal latitude is turned into the geodetic one by fixed-point steps."""
    t = np.hypot(x, y) / crs.rho_per_t
    phi = math.pi / 2 - 2 * np.arctan(t)
    for _ in range(6):
        phi = math.pi / 2 - 2 * np.arctan(t * np.exp(-crs.e * np.arctanh(crs.e * np.sin(phi))))
    lon = np.degrees(np.arctan2(x, -y)) + crs.lon_0
    return np.where(lon < -180, lon + 360, np.where(lon > 180, lon - 360, lon)), np.degrees(phi)
