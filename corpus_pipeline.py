"""Documents to packed training sequences in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor has kept; run()
writes what a stage returns to the shared folder and reads it back for the next.
"""

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillworks.llm import harmonic_packing, line_runs, minmax_dedup, pii_crf, quality_bands
from tillworks.llm.columns import typed_like
from tillworks.llm.memory import small_batches
from tillworks.session import saved

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _in_small_batches(stage: Stage) -> Stage:
    """The stages share the Python workers, so each lets them hold a few megabytes of text at a time."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


@_in_small_batches
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within their compression band and the base rules; limits are fitted on labelled good ones."""
    bands = quality_bands.fit_bands(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_bands.keep(docs, bands)


@_in_small_batches
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated runs of lines; those that lose every word go.

    n_chars, where there is such a column, is the length of the text that is left.
    """
    return _measured(line_runs.dedup_lines(docs, drop_emptied=True), docs)


@_in_small_batches
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8 or more."""
    return minmax_dedup.keep_one(docs, size=5, percent=80)


@_in_small_batches
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; n_chars is the new length."""
    return _measured(pii_crf.redact(docs), docs)


@_in_small_batches
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens; other stages share the workers, so the memo is small."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return harmonic_packing.pack_documents(docs, path, end_id=1, memo_entries=60_000, keep_encoder=False)


def _measured(changed: DataFrame, docs: DataFrame) -> DataFrame:
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text"))
    return typed_like(changed, docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: zstandard ratios, library token ids and message passing have no SQL counterpart.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir))
    return docs
