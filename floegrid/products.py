"""Product and class configuration as small fixed tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, types as T


@dataclass(frozen=True)
class Product:
    key: str
    variable: str
    units: str
    categorical: bool = False
    fill: float | None = None
    scale: float | None = None
    nodata: float | None = None
    warp: str = "bilinear"
    overview: str = "average"
    nominal_hour: int = 0
    classes: dict[int, str] = field(default_factory=dict)


# Variables, units, fills, scales, resampling and class codes of each product.
PRODUCTS = {p.key: p for p in (
    Product("ice_conc", "ice_conc", "%", fill=-999, scale=0.01, nominal_hour=12),
    Product("ice_type", "ice_type", "1", categorical=True, fill=-1, nodata=-1, warp="near",
            overview="mode", nominal_hour=12,
            classes={1: "open_water", 2: "first_year_ice", 3: "multi_year_ice", 4: "ambiguous"}),
    Product("ice_edge", "ice_edge", "1", categorical=True, fill=-1, nodata=-1, warp="near",
            overview="mode", nominal_hour=12,
            classes={1: "open_water", 2: "open_ice", 3: "close_ice"}),
    Product("airtemp", "2t", "degC"),
    Product("wind_ns", "10v", "m s-1"),
    Product("wind_ew", "10u", "m s-1"),
    Product("ocean_u", "uo", "m s-1", nominal_hour=12),
    Product("ocean_v", "vo", "m s-1", nominal_hour=12),
)}


def product_dim(spark: SparkSession) -> DataFrame:
    schema = T.StructType([
        T.StructField("product", T.StringType(), False), T.StructField("variable", T.StringType()),
        T.StructField("units", T.StringType()), T.StructField("categorical", T.BooleanType()),
        T.StructField("fill", T.DoubleType()), T.StructField("scale", T.DoubleType()),
        T.StructField("nodata", T.DoubleType()), T.StructField("warp", T.StringType()),
        T.StructField("overview", T.StringType()), T.StructField("nominal_hour", T.IntegerType())])
    rows = [(p.key, p.variable, p.units, p.categorical,
             None if p.fill is None else float(p.fill), p.scale,
             None if p.nodata is None else float(p.nodata), p.warp, p.overview, p.nominal_hour)
            for p in PRODUCTS.values()]
    return spark.createDataFrame(rows, schema)


def class_dim(spark: SparkSession) -> DataFrame:
    rows = [(p.key, code, text) for p in PRODUCTS.values() for code, text in p.classes.items()]
    return spark.createDataFrame(rows, "product string, code int, meaning string")
