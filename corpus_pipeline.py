"""A training corpus from `documents`: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from breachline.llm import decontamination, language_id, line_dedup, mixing, simhash
from breachline.llm.shared import release_staged, shared_folder, staged


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_leftover: list[str] = []


def _tidy(stage: Stage) -> Stage:
    """What a stage has staged goes when the next one begins, which no longer reads it."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release_staged(spark, _leftover, reading=docs)
        before = set(staged())
        result = stage(spark, docs, sf_dir)
        _leftover[:] = [p for p in staged() if p not in before]
        return result

    return run_stage


@_tidy
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; the others go. Learned from those not held out."""
    labelled = docs.where(~language_id.held_out(F.col("doc_id"))).select("lang", "text")
    judged = language_id.identify(docs, labelled)
    return judged.where(~F.col("lang_rejected")).select(*docs.columns)


@_tidy
def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated line runs; `n_chars` follows the text."""
    cleaned = line_dedup.dedup_lines(docs).select(*docs.columns)
    if "n_chars" not in docs.columns:
        return cleaned
    kind = docs.schema["n_chars"].dataType
    return cleaned.withColumn("n_chars", F.length("text").cast(kind)).select(*docs.columns)


@_tidy
def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: 4-word shingles, up to four differing bits."""
    return simhash.keep_first(docs, distance=4, shingle=4).select(*docs.columns)


@_tidy
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaks."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.decontaminate(docs, benchmark).select(*docs.columns)


@_tidy
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training order: one row for each pass over a document, sources mixed to their targets.

    `size`, `pass_words` and `position` are added, and replace columns of these names.
    """
    return mixing.in_training_order(docs)


STAGES = [
    ("language ID", identify_language),
    ("line dedup", dedup_lines),
    ("SimHash near-dedup", dedup_near),
    ("benchmark decontamination", decontaminate),
    ("mixing to target weights", mix_sources),
]

#: SQL cannot express the first, third and fourth stage; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over all of `documents`; what each returns lies in the shared folder meanwhile."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = os.path.join(shared_folder(spark), f"pipeline-{uuid.uuid4().hex}")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(base)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
    return docs
