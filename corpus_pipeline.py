"""The corpus pipeline: five stages over `documents`, each over all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; the caller may write it and read it back
between stages.  All but the last return the columns of documents.  Nulls, repeats and empty tables
follow the operators' own rules (their module docstrings).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, line_dedup, packing, simhash, toxicity
from tidemark.llm.common import materialise, new_path, prepare, remove_path, scratch
from tidemark.llm.tokens import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.  It learns from docs and the labels outside the held-out fold."""
    prepare(spark)
    model = toxicity.train(toxicity.training_rows(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return toxicity.kept(docs, model)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go; every document stays.  n_chars follows the text."""
    cleaned = line_dedup.clean(docs)
    columns = [F.when(F.col("text").isNotNull(), F.char_length("text")).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns]
    return cleaned.select(*columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group at a Jaccard similarity of 0.8 or more over five-word shingles stays: that with the smallest id.

    SimHash proposes with fingerprints wide enough for that similarity; the shingle sets decide.
    """
    return simhash.one_of_each(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.packed(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack),
]

#: Neither the classifier nor the tokenizer can be said in SQL; tests/llm/test_pipeline.py holds each stage and run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written to the shared folder and read again, and goes when the next is there."""
    prepare(spark)
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        with scratch(spark) as keep:
            keep.append(path := new_path(spark, f"pipeline-{name}"))
            docs = materialise(stage(spark, docs, sf_dir), name, path)
        if last:
            remove_path(spark, last)
        last = path
    return STAGES[-1][1](spark, docs, sf_dir)
