"""The operators and the pipeline as registered queries, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm import (contextmix, decontaminate, language, licences, lines, mixing, near, quality,
                          recipes, resample, substrings, syncmers, variants)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.report(table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.report(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.groups(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.report(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.report(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.copies(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contextmix.report(table(spark, sf_dir, "documents"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.report(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.report(table(spark, sf_dir, "documents"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recipes.report(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_substring_dedup, op3_decontamination, op4_near_dedup, op5_language_id,
                                    op6_quality, op7_licence_scan, op8_mixing, op9_lm_score,
                                    op10_fingerprints, op11_spelling_variants, op12_importance_resampling,
                                    op13_exact_dedup)}
