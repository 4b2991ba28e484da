"""A training corpus from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns the documents that it keeps, with the columns of
documents; the last one returns pieces with their places in sequences. run() writes each stage's
rows as Parquet in the folder that all executors share and reads them again for the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidelake.llm import decontaminate, near_dedup, packing, quality, secrets
from tidelake.llm.shared import cut, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmarks),
    ("secrets", without_secrets),
    ("packing", packed),
]
#: No stage but the last has an SQL form of its own kind; tests compare each with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
    return docs
