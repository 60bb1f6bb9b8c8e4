"""The training-corpus pipeline: five stages over ``documents``, each on all that the one before kept.

1. quality: documents the classifier scores below 0.7 go; the classifier learns from ``labels`` and the
   stage's own input.
2. lines: multi-line chunks that stand earlier in the corpus are cut out; documents left empty go.
3. near: one document of each group of near duplicates stays (the smallest id); near duplicates share
   80 % of their five-word shingles (``op4_near_dedup`` takes two words).
4. decontaminate: documents with at least 5 % of their words in passages of ``benchmark`` go.
5. mix: documents are emitted as often as the target weights of their sources call for, with ``mix_copy``.

All but the last return the columns of ``documents``.  A clean document passes stages 1 to 4 unchanged.  No
stage can be written in SQL as a whole (the first learns a model), so ORACLE_SQL is None and the tests compare
the pipeline with a plain one on a small fixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rollcall.functions.lineage import settle
from rollcall.llm import decontaminate, lines, mixing, near, quality

ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.dedup(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near.keep_one(docs, width=5)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.emit(docs)


STAGES = [("quality", quality_stage), ("lines", lines_stage), ("near", near_stage),
          ("decontaminate", decontaminate_stage), ("mix", mix_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of each is written as Parquet and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
