"""A corpus from documents: language, near duplicates, benchmark passages, mixture, token files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm import language, mixing, near_duplicates, token_shards, winnowing
from riskweave.llm.common import new_path, table
from riskweave.llm.queries import TOKENIZER


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language; those without a letter go."""
    return language.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component, that of the smallest doc_id."""
    return near_duplicates.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return winnowing.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mixture: by the number of the file, then by row."""
    return mixing.in_mixed_order(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the order in which the documents lie, read back through their index."""
    number = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1)
    placed = docs.select("doc_id", "text", F.try_to_number(number, F.lit("9999999999")).cast("long").alias("file"), F.col("_metadata.row_index").alias("row"))
    return token_shards.read_shards(token_shards.write_shards(placed, TOKENIZER, order=["file", "row"]))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_ids", write_tokens),
]

#: no SQL: language, the schedule and the tokenizer are beyond it; the tests run the stages in plain Python
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of a folder; each stage is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
