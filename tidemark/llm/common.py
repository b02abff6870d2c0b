"""Pieces that several operators of this package share."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.runtime import importable, materialise, new_path, remove_path, scratch, shared_folder

__all__ = ["materialise", "new_path", "remove_path", "scratch"]

#: The ASCII white space of every contract here: [\x20\x09-\x0D].
ASCII_SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

#: Texts are worked on in slices of about this many characters, which bounds a worker's memory.
SLICE_CHARS = 2_000_000

#: An Arrow batch's bytes at most, unless the session has its own setting: the JVM and a worker each hold some of them.
ARROW_BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", "16m")
#: Workers live on between tasks, so what they free goes back to the system.
GIVE_BACK = {"MALLOC_MMAP_THRESHOLD_": str(4 << 20), "MALLOC_TRIM_THRESHOLD_": str(16 << 20), "MALLOC_ARENA_MAX": "2", "ARROW_DEFAULT_MEMORY_POOL": "system"}


def prepare(spark: SparkSession) -> None:
    """Lets Python workers import this package, bounds their memory, and sees to a shared folder."""
    context = spark.sparkContext
    if ARROW_BATCH[0] not in spark.conf.getAll:
        spark.conf.set(*ARROW_BATCH)
    for name, value in GIVE_BACK.items():
        context.environment.setdefault(name, value)
    importable(spark)
    shared_folder(spark)


#: Keys that hold a share of 1/HOT or more of all rows count as hot: there are HOT of them at most.
HOT = 1024


def fresh(df: DataFrame, name: str) -> str:
    """The name, or one like it that no column of df has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def spread_join(rows: DataFrame, table: DataFrame, keys: list[str], count: str, own: list[str]) -> DataFrame:
    """rows joined with table (one row a key, `count`: about how many of rows hold it), without a task for a hot key.

    Hot keys, HOT at most, are broadcast; rows that meet one are dealt out by a hash of `own` and their place instead.
    The others shuffle by key.  table is read three times, so it should be written already.
    """
    values = [c for c in table.columns if c not in keys and c != count]
    total = table.agg(F.sum(count)).first()[0] or 0
    hot = F.col(count) * HOT >= max(total, HOT)
    few = table.where(hot).select(*keys, F.struct(*values).alias("_few"))
    rest = table.where(~hot).select(*keys, F.lit(0).cast("long").alias("_deal"), F.struct(*values).alias("_rest"))
    deal = F.when(F.col("_few").isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(*own, F.monotonically_increasing_id()))
    met = rows.join(F.broadcast(few), keys, "left").withColumn("_deal", deal).join(rest, [*keys, "_deal"], "left")  # HOT rows at most
    met = met.withColumn("_few", F.coalesce("_few", "_rest")).where("_few IS NOT NULL")
    return met.select(*rows.columns, *[F.col("_few")[v].alias(v) for v in values])


def doc_rows(docs: DataFrame) -> DataFrame:
    """Only (doc_id long, text string); a null text is the empty text.  Other columns never get in the way."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def fold(of: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo `of`; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(of))


def py_fold(doc_id: int | None, of: int) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % of


def slices(ids: list, texts: list[str], chars: int = SLICE_CHARS) -> Iterator[tuple[list, list[str]]]:
    """Consecutive rows of about `chars` characters; a longer text is a slice of its own."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= chars:
            yield ids[start : i + 1], texts[start : i + 1]
            start, held = i + 1, 0
    if start < len(texts):
        yield ids[start:], texts[start:]
