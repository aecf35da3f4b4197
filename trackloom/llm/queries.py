"""The subpackage's queries with production parameters, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import alignment, ann, cdc_dedup, decontam, hard_negatives, licenses, near_dup, packing, quality, secret_scan, suffix_dedup, toxicity, url_filter

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.classes(_table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(_table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc_dedup.report(_table(spark, sf_dir, "documents"))


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.select(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(_table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_hits(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"), url_filter.labelled_urls(spark), url_filter.RULES).drop("score")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.links(_table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(_table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {
        "op8_licenses": licenses.oracle_sql(), "op9_suffix_dedup": suffix_dedup.ORACLE_SQL, "op10_decontamination": decontam.ORACLE_SQL,
        "op11_url_filter": url_filter.oracle_sql(), "op13_hard_negatives": hard_negatives.ORACLE_SQL,
    }
