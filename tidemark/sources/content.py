"""Content tables: items of (source, order, title, body), with hash and numbers, from documents or live pages.

Null titles and bodies are empty texts; a null source stays null; items keep their order column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text as t

# The live sources' keys in registry order, and their names.
REGISTRY = {"yahoo_eurusd": "Yahoo Finance (EUR/USD)", "yahoo_markets": "Yahoo Finance Markets", "fed": "Federal Reserve", "imf": "IMF", "reuters": "Reuters"}


def chosen_sources(keys: list[str] | None) -> list[str]:
    """Registry keys that are asked for, in registry order; unknown ones are ignored, none asked means all."""
    return [k for k in REGISTRY if not keys or k in keys]


def content_items(rows: DataFrame) -> DataFrame:
    """Adds `combined` and `content_hash` to rows with title and body."""
    filled = rows.withColumns({"title": F.coalesce("title", F.lit("")), "body": F.coalesce("body", F.lit(""))})
    combined = filled.withColumn("combined", F.concat("title", F.lit(" "), "body"))
    return combined.withColumn("content_hash", t.content_hash(F.col("combined")))


def items(docs: DataFrame, sources: list[str] | None = None) -> DataFrame:
    """id, source_name, ord, title, body, combined, content_hash from a documents table."""
    if sources:
        docs = docs.where(F.col("source").isin(sources))  # reaches the scan
    text = F.coalesce(F.col("text"), F.lit(""))
    cut = F.instr(text, "\n")
    return content_items(docs.select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("source").alias("source_name"),
        F.col("doc_id").alias("ord"),
        F.substring_index(text, "\n", 1).alias("title"),
        F.when(cut > 0, F.substr(text, cut + 1)).otherwise("").alias("body"),
    ))


def read_items(spark: SparkSession, sf_dir: str, sources: list[str] | None = None) -> DataFrame:
    return items(spark.read.parquet(f"{sf_dir}/documents.parquet"), sources)


def union_items(parts: list[DataFrame]) -> DataFrame:
    """Items of live sources in registry order: ord says (source, place in it); ids are made of both."""
    all_ = reduce(DataFrame.unionByName, parts)
    rank = F.array_position(F.array(*[F.lit(k) for k in REGISTRY]), F.col("source_key"))
    named = all_.withColumns({"id": F.concat("source_key", F.lit("-"), F.col("ord").cast("string")), "ord": rank * 1_000_000 + F.col("ord")})
    return content_items(named).withColumns({"numbers": t.numbers_in_context(F.col("combined")), "extracted_at": F.current_timestamp()})
