"""Reading the tables and cutting lineage, shared by the operators of this package."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from floegrid.session import checkpoint_dir, configure


# A bitmap of keys has 2^FILTER_BITS bits, 4 MB, and is put together in PARTS.
FILTER_BITS = 25
PARTS = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def cut(frame: DataFrame) -> DataFrame:
    """The rows as compressed files in the shared checkpoint folder: read again after a loss, never computed again.

    Files stay until the folder that the session made for its checkpoints is deleted.
    """
    spark = frame.sparkSession
    path = f"{checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def cut_by(frame: DataFrame, *keys: str) -> DataFrame:
    """Like `cut`, in buckets of the keys: later joins and groups on exactly these keys do not move these rows."""
    spark = frame.sparkSession
    name = f"floegrid_{uuid.uuid4().hex}"
    (frame.write.option("compression", "zstd").option("path", f"{checkpoint_dir(spark)}/{name}")
     .bucketBy(partitions(spark), *keys).saveAsTable(name))
    return spark.table(name)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_key(text: Column) -> list[Column]:
    """Two independent hashes that stand for a whole text in joins and groups; a null is an empty text."""
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(text), F.xxhash64(F.lit(7), text, F.length(text))]


def passing_through(*names: str) -> Callable[[Callable[..., DataFrame]], Callable[..., DataFrame]]:
    """For an operator that works with columns of these names: the user's columns of the same names come out as they went in."""
    def wrap(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @functools.wraps(operator)
        def run(rows: DataFrame, *args, **kwargs) -> DataFrame:
            aside = {c: f"_kept{i}_{uuid.uuid4().hex}" for i, c in enumerate(rows.columns) if c.lower() in names}
            return operator(rows.withColumnsRenamed(aside), *args, **kwargs).withColumnsRenamed({v: k for k, v in aside.items()})
        return run
    return wrap


def key_bitmap(keys: DataFrame) -> np.ndarray:
    """A bitmap of fixed size for column `key`, with a bit for the first FILTER_BITS bits of each key; put together in two rounds."""
    wide = (1 << FILTER_BITS) // 8 // PARTS

    def blocks(total: np.ndarray, parts: Iterator[int]) -> pa.RecordBatch:
        pack = zstandard.ZstdCompressor(level=1)
        parts = list(parts)
        return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(
            [pack.compress(total[i * wide:(i + 1) * wide].tobytes()) for i in range(len(parts))], pa.binary())], names=["part", "bits"])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
        for batch in batches:
            slot = batch.column("key").to_numpy().view(np.uint64) >> np.uint64(64 - FILTER_BITS)
            np.bitwise_or.at(total, (slot >> np.uint64(3)).astype(np.int64), np.uint8(1) << (slot & np.uint64(7)).astype(np.uint8))
        yield blocks(total, range(PARTS))

    def join(_: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, part = np.zeros(wide, np.uint8), 0
        for batch in batches:
            for row in batch.to_pylist():
                part = row["part"]
                total |= np.frombuffer(zstandard.ZstdDecompressor().decompress(row["bits"]), np.uint8)
        yield blocks(total, [part])
    each = keys.select("key").mapInArrow(mark, "part int, bits binary").withColumn("salt", (F.rand(11) * 64).cast("int"))
    once = each.groupBy("part", "salt").applyInArrow(join, "part int, bits binary").groupBy("part").applyInArrow(join, "part int, bits binary")
    out = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for row in once.collect():
        out[row["part"] * wide:(row["part"] + 1) * wide] = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["bits"]), np.uint8)
    return out


def may_hold(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each unsigned key may be one of the bitmap's; never false for one that is."""
    slot = keys >> np.uint64(64 - FILTER_BITS)
    return (bitmap[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
