"""The operators' queries over the supplied tables, and their SQL where SQL can express them on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strataforge.llm import decontaminate, fim, htmltext, langid, lm, packing, pieces, quality_model, quality_rules, repair, simhash, urlfilter, warc


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.scored_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), quality_model.labels_of(spark, sf_dir))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.page_texts(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scored_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.page_verdicts(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predicted_languages(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_records(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.document_verdicts(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.damaged_and_repaired(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_best_fit_packing": op1_best_fit_packing,
        "op2_quality_classifier": op2_quality_classifier,
        "op3_html_extraction": op3_html_extraction,
        "op4_lm_scoring": op4_lm_scoring,
        "op5_url_filters": op5_url_filters,
        "op6_decontamination": op6_decontamination,
        "op7_language_id": op7_language_id,
        "op8_simhash": op8_simhash,
        "op9_warc": op9_warc,
        "op10_quality_rules": op10_quality_rules,
        "op11_fill_in_middle": op11_fill_in_middle,
        "op12_conversation_repair": op12_conversation_repair,
        "op13_sentencepiece": op13_sentencepiece,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_url_filters": urlfilter.page_verdicts_sql(),
        "op9_warc": warc.page_records_sql(),
        "op10_quality_rules": quality_rules.document_verdicts_sql(),
        "op11_fill_in_middle": fim.digests_sql(),
        "op12_conversation_repair": repair.damaged_and_repaired_sql(),
    }
