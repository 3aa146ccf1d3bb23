"""From raw documents to token ids: quality, line dedup, near-duplicate dedup, mixing, encoding.

``run`` applies the stages to the table ``documents``; a driver may as well write each
stage's result and hand it to the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabstudy.llm import bpe, lines, mixing, neardup, quality
from tabstudy.llm.queries import RANKS_FILE, table
from tabstudy.session import scratch_path

MIX_BUDGET = 0.6  # share of the tokens that mixing keeps in expectation, whatever the rarest source


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier accepts. It learns from the labelled rows of ``sf_dir`` alone."""
    model = quality.fit_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    scored = quality.score_quality(docs, model, output="__score")
    return scored.where(F.col("__score") >= quality.REJECT_BELOW).select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one of them; ``n_chars`` follows the text."""
    return lines.dedup_lines(docs).select(
        *[F.char_length("text").cast("bigint").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns]
    )


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return neardup.keep_one_per_class(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens follow the target weights of source, language and topic."""
    return mixing.mix_sources(docs, budget=MIX_BUDGET).where("mix_kept").select(*docs.columns)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes of every document left."""
    return bpe.encode_documents(
        docs, public_tokenizers.path(RANKS_FILE), public_tokenizers.PATTERN, with_ids=False
    )


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("encoding", encoding_stage),
]

#: The classifier and the signatures cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
