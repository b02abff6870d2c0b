"""Cap, de-duplication and batches of content, in order of (source, ord).

Null sources count as one source, before all others; items that repeat in every column count once in
``first_wins``; empty tables give empty tables; other columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.text import strip
from tidemark.runtime import numbered

PER_SOURCE = 5
BATCH_ITEMS, LEAST_CHARS = 5, 20


def cap(items: DataFrame, n: int = PER_SOURCE) -> DataFrame:
    """The first n items of each source, before any de-duplication.  Spark keeps n a task before it shuffles."""
    rank = F.row_number().over(W.partitionBy("source_name").orderBy("ord"))
    return items.withColumn("_n", rank).where(F.col("_n") <= n).drop("_n")


def first_wins(items: DataFrame, key: str = "content_hash") -> DataFrame:
    """Of items with one key the first stays.

    The first place of each key is found on narrow rows, folded before they shuffle; texts move only
    for the items that stay, which a semi join picks.
    """
    place = F.struct("source_name", "ord")
    first = items.groupBy(F.col(key).alias("_key")).agg(F.min(place).alias("_first"))
    first = first.select("_key", F.col("_first.source_name").alias("_source"), F.col("_first.ord").alias("_ord"))
    if set(items.columns) <= {key, "id", "source_name", "ord"}:  # nothing but what the aggregate holds anyway
        rest = [c for c in items.columns if c != key]
        kept = items.groupBy(key).agg(F.min(F.struct("source_name", "ord", *[c for c in rest if c not in ("source_name", "ord")])).alias("_k"))
        return kept.select(*[F.col(c) if c == key else F.col("_k")[c].alias(c) for c in items.columns])
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col("source_name").eqNullSafe(F.col("_source")) & F.col("ord").eqNullSafe(F.col("_ord"))
    return items.join(first, same, "left_semi").dropDuplicates([key])


def batches(items: DataFrame, size: int = BATCH_ITEMS) -> DataFrame:
    """(id, source_name, ord, batch, place): consecutive groups of the items long enough, in order."""
    usable = items.where(F.char_length(strip(F.col("combined"))) >= LEAST_CHARS).select("id", "source_name", "ord")
    at = numbered(usable, ["source_name", "ord", "id"], "_at")
    return at.select("id", "source_name", "ord", F.floor(F.col("_at") / size).cast("long").alias("batch"), F.pmod("_at", F.lit(size)).cast("int").alias("place"))
