"""Documents to a training mix: stages that each call one operator, written as Parquet and read again in between."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.llm import decontaminate, jaccard, mixing, quality, substrings
from panelwright.llm.common import put, words_of
from panelwright.session import shared_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 80 % of shared five-word shingles: the one with the least id."""
    return jaccard.one_of_each(docs, jaccard.Likeness(words=5, over=4, under=5))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document with a lesser id has as well; documents with nothing left go."""
    cut = substrings.without_repeats(docs)
    return put(cut, "n_chars", F.length("text").cast("long")).select(docs.columns).where(F.size(words_of(F.col("text"))) > 0)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, as it is or with other slot values."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents it takes, with how often (``repeats``) and how many words that is (``taken``); the others go."""
    return mixing.mix(docs).where("repeats > 0")


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("source_mix", source_mix),
]

#: Stages that SQL cannot express are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
