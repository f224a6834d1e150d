"""From raw documents to token files: quality, near-duplicates, benchmark leaks, mixing, token ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rillflow.llm import decontaminate, mixing, neardup, quality, tokens
from rillflow.llm.common import table, written
from rillflow.llm.queries import MIX, quality_model, tokenizer_file
from rillflow.operators.checkpoints import run_folder


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier scores below 0.7."""
    model = quality_model(spark, docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model, 0.7)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group: five-word shingles, similarity 0.8."""
    return neardup.one_per_group(docs, size=5, percent=80)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per repetition that the mix takes; the last one of a source may be cut."""
    return mixing.mixed_documents(docs, **MIX)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token files; returns what they hold per document: start, number of ids, crc32 of the ids."""
    path = run_folder(spark, "tokens")
    tokens.write_tokens(docs, path, tokenizer_file(), end_id=1)
    return tokens.read_tokens(spark, path, visit=tokens.crc32_of_ids, kind="bigint", column="ids_crc32")


STAGES = [
    ("quality", good_quality),
    ("near duplicates", near_duplicates),
    ("benchmark leaks", benchmark_leaks),
    ("mix", mix),
    ("token files", token_files),
]

#: Learned scores, sampled similarity joins and token ids are beyond SQL; tests hold the run against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written as Parquet and read again by the next stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
