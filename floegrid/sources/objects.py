"""Object listings and input references."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from floegrid.functions.names import TIFF_SUFFIX, base_name, glob_match

INPUT_REF = "url string, name string, auth_kind string, metadata map<string,string>"


def filter_objects(listing: DataFrame, key: str = "key", include: str | None = None,
                   exclude: str | None = None, limit: int | None = None,
                   tiebreak: Sequence[str] = ()) -> DataFrame:
    """TIFF objects whose base name matches, with their `name`; a limit keeps the first by name."""
    named = listing.where(F.col(key).rlike(TIFF_SUFFIX)).withColumn("name", base_name(F.col(key)))
    if include:
        named = named.where(glob_match(F.col("name"), include))
    if exclude:
        named = named.where(~glob_match(F.col("name"), exclude))
    return named if not limit else named.orderBy("name", *tiebreak).limit(limit)


def list_objects(spark: SparkSession, prefix: str) -> DataFrame:
    """Objects under a prefix: key, size, modification time. File contents are not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(prefix)
            .select(F.col("path").alias("key"), F.col("length").alias("size"),
                    F.col("modificationTime").alias("last_modified")))


def scan_objects(spark: SparkSession, prefix: str, include: str | None = None,
                 exclude: str | None = None, limit: int | None = None) -> DataFrame:
    """TIFF objects under a prefix in name order."""
    found = filter_objects(list_objects(spark, prefix), "key", include, exclude, limit, ["key"])
    return found.orderBy("name", "key")


def parent_folders(listing: DataFrame, key: str, extension: str) -> DataFrame:
    """Distinct folders that hold objects with an extension."""
    return (listing.where(F.col(key).endswith(extension))
            .select(F.regexp_replace(key, r"/[^/]*$", "").alias("folder")).distinct())


def object_refs(objects: DataFrame, key: str = "key", auth_kind: str = "s3") -> DataFrame:
    return objects.select(F.col(key).alias("url"), base_name(F.col(key)).alias("name"),
                          F.lit(auth_kind).alias("auth_kind"),
                          F.create_map().cast("map<string,string>").alias("metadata"))
