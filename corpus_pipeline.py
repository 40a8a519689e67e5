"""A corpus pipeline: reject poor documents, near copies, long repeats and benchmark text, then encode.

Each stage takes the documents that the one before kept. A stage's rows are written as Parquet in the shared
checkpoint folder and read again as the next stage's input. All stages but the last return the columns of `documents`;
further columns of the input are dropped. Null and empty texts stay unless the quality model rejects them; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from floegrid.llm.bpe import encode_documents
from floegrid.llm.decontaminate import find_benchmark, is_contaminated
from floegrid.llm.near_dup import one_of_each
from floegrid.llm.quality import fit_quality, score_quality
from floegrid.llm.queries import id_crc, vocabulary_path
from floegrid.llm.suffix_dedup import remove_repeats
from floegrid.llm.tables import cut, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ORACLE_SQL = None
# Passages of more than 50 words are longer than this in all languages of the corpus; shorter repeats stay.
REPEAT_BYTES = 240


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold; the model learns from rows with crc32(doc_id) mod 5 other than 0."""
    machine = fit_quality(docs, table(spark, sf_dir, "labels").where(id_crc(5) != 0))
    return score_quality(docs.select(*COLUMNS), machine).where("predicted = 1").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return one_of_each(docs.select(*COLUMNS), size=5, percent=80)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remaining text without long repeats; a character cut in two by a removed span goes with it."""
    return (remove_repeats(docs, REPEAT_BYTES).withColumn("text", F.when(F.col("text").isNotNull(), F.col("kept_text")))
            .withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words less than a twentieth is benchmark text."""
    return (find_benchmark(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark")).where(~is_contaminated()).select(*COLUMNS))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_documents(docs.select("doc_id", "text"), vocabulary_path(), ids=False).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("decontaminate", decontaminate),
    ("tokenize", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
