"""The training-data pipeline: five stages over `documents`, each written as Parquet and read again by the next.

STAGES lists (name, function); a function takes (spark, docs, sf_dir). All but the last return the columns of documents, and
only rows that the stage keeps; the last returns the pieces of all kept documents with their bins and texts.

Edge cases are those of the operators (null or empty texts, null ids, repeated rows, clashing names, empty tables); in short:
texts of fewer than 20 words go at the quality rules, and of repeated rows one stays after the near-duplicate stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strataforge.llm import decontaminate, nearcopies, packing, quality_model, quality_rules
from strataforge.llm.common import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_model.keep_good(docs, quality_model.labels_of(spark, sf_dir))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_by_rules(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return nearcopies.keep_one_per_class(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed_documents(docs, texts=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", rules),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: SQL cannot express the learned stage; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
