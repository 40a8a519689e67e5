"""Calibration annotation files as table samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from floegrid.functions.radiometry import LUT_ELEMENTS, check_convention

_TEXT = "struct<_VALUE: string, _count: int>"
ANNOTATION = "line int, pixel " + _TEXT + "".join(f", {e} {_TEXT}" for e in LUT_ELEMENTS.values())


def scan_calibration_lut(spark: SparkSession, path: str | list[str], calibration: str = "sigma0",
                         strict: bool = True) -> DataFrame:
    """One row per (granule, polarization, line, pixel) with its k.

    The granule is the .SAFE folder of the file (or the file's own name) and the polarization
    the token in its name. Pixels come from the first vector of a file; a vector of another
    length is an error.
    """
    element = check_convention(calibration)
    file = F.col("_metadata.file_path")
    name = F.regexp_extract(file, r"([^/]*)\.xml$", 1)
    safe = F.regexp_extract(file, r"([^/]+)\.SAFE/", 1)

    def numbers(column: str, kind: str):
        return F.split(F.trim(F.col(f"{column}._VALUE")), r"\s+").cast(f"array<{kind}>")
    vectors = (spark.read.format("xml").option("rowTag", "calibrationVector").schema(ANNOTATION)
               .load(path).select(
                   F.when(safe != "", safe).otherwise(name).alias("granule"),
                   F.regexp_extract(name, r"-(hh|hv|vh|vv)-", 1).alias("polarization"),
                   "line", numbers("pixel", "int").alias("pixels"), numbers(element, "double").alias("ks")))
    # One annotation has a few dozen vectors; they are gathered to compare their shapes.
    tables = vectors.groupBy("granule", "polarization").agg(
        F.min_by("pixels", "line").alias("pixels"),
        F.collect_list(F.struct("line", "ks")).alias("vectors"))
    same = F.forall("vectors", lambda v: F.size(v["ks"]) == F.size("pixels"))
    checked = tables.withColumn("vectors", F.when(same, F.col("vectors")).otherwise(F.raise_error(
        F.concat(F.lit(f"calibration table shape mismatch for {calibration} in "), "granule"))
        .cast("array<struct<line:int,ks:array<double>>>"))) if strict else tables
    rows = checked.select("granule", "polarization", "pixels", F.inline("vectors"))
    return rows.select("granule", "polarization", F.lit(calibration).alias("calibration"), "line",
                       F.inline(F.arrays_zip(F.col("pixels").alias("pixel"), F.col("ks").alias("k"))))
