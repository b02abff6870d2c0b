"""Benchmark decontamination by spaced seeds.

A document and an item overlap if some WINDOW aligned words of theirs agree in at least SIMILARITY of
their places; an item of fewer words is compared over its whole length, so one of four words or less
must stand in the document word for word.

A seed is a hash of the words at the positions that a fixed mask selects; the positions between are
ignored, so a substitution there doesn't hide the seed.  The masks of each window length are such
that no substitutions which SIMILARITY allows hide every seed (``masks``; a test tries all of them),
and documents are hashed only with masks of lengths that the benchmark has.

1. Narrow rows of the documents' seeds (hash, id, place) meet those of the benchmark, which are
   broadcast if they fill at most BROADCAST_BYTES; beyond that the join shuffles.
2. Hits are folded to the first and last on each diagonal of a document and item, before a shuffle.
3. Only documents with hits are read again: their words and the item's are laid side by side once a
   diagonal, and every window there is counted.

DataFrame functions only.  Words are runs of characters other than ASCII white space and punctuation,
lower-cased.

Defined results: null texts and items without words match nothing; a null doc_id or item_id is kept
as such in pairs, each text without doc_id is a document of its own (in ``clean`` it stays unless it
matches itself); rows that repeat a doc_id are one document, rows that repeat an item_id one item;
empty tables give no pairs; other columns are ignored, whatever their names (``clean`` returns them).
"""

from __future__ import annotations

from itertools import combinations
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, materialise, prepare

LONG_MASKS = ((0, 1, 2, 3, 5), (0, 1, 3, 4, 5))
SPAN = 6
WINDOW = 13
SIMILARITY = 0.8
BROADCAST_BYTES = 64 << 20
#: Bytes of a broadcast row of a few numbers at most.
ROW_BYTES = 64
_BREAK = r"[\x09-\x0D\x20-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+"


def needed(window: int) -> int:
    """Places of a window that must agree."""
    return ceil(window * SIMILARITY)


def masks(window: int) -> tuple[tuple[int, ...], ...]:
    """Positions within a window; whichever places may differ, one of these seeds is free of them.

    A whole window's seeds may stand at any of its places (LONG_MASKS).  A shorter item is cut into
    parts, and each mask leaves out as many of them as words may differ.
    """
    if window >= WINDOW:
        return LONG_MASKS
    may = window - needed(window)
    parts = 1 if not may else may + 2
    of = [i * parts // window for i in range(window)]
    return tuple(tuple(i for i in range(window) if of[i] not in gone) for gone in combinations(range(parts), may))


def _words(text: Column) -> Column:
    """Hashes of the words; without empty words, which only a break at an edge makes."""
    words = F.filter(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), _BREAK, -1), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _placed(lengths: list[int]) -> dict[int, list[tuple[int, tuple[int, ...], int]]]:
    """For each length (offset in the item, mask from zero on, its number)."""
    numbers: dict[tuple[int, ...], int] = {}
    out = {}
    for n in lengths:
        out[n] = []
        for mask in masks(n):
            shape = tuple(i - mask[0] for i in mask)
            out[n].append((mask[0], shape, numbers.setdefault(shape, len(numbers))))
    return out


def _hash(w: Column, i: Column, shape: tuple[int, ...], number: int) -> Column:
    return F.xxhash64(*[F.get(w, i + o) for o in shape], F.lit(number))


def _item_seeds(w: Column, placed: dict) -> Column:
    """Structs of place and hash of all seeds of an item."""

    def one(i: Column, shape: tuple[int, ...], number: int) -> Column:
        return F.struct(i.cast("int").alias("i"), _hash(w, i, shape, number).alias("h"))

    def every(shape: tuple[int, ...], number: int) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - SPAN), lambda i: one(i, shape, number))

    out = F.lit(None)
    for n, some in placed.items():
        if n < WINDOW:
            out = F.when(F.size(w) == n, F.array(*[one(F.lit(at), shape, number) for at, shape, number in some])).otherwise(out)
        else:
            out = F.when(F.size(w) >= n, F.concat(*[every(shape, number) for _, shape, number in some])).otherwise(out)
    return out


# The outer forms of explode keep Spark from testing the seeds' number below, where it would work them out again.
def _seeds(w: Column, shapes: list[tuple[tuple[int, ...], int]]) -> Column:
    """An array for each place: a hash for each mask that begins there and doesn't leave the text."""
    short = min(shape[-1] for shape, _ in shapes)

    def one(i: Column, shape: tuple[int, ...], number: int) -> Column:
        found = _hash(w, i, shape, number)
        return found if shape[-1] == short else F.when(F.size(w) - i > shape[-1], found)

    return F.when(F.size(w) > short, F.transform(F.sequence(F.lit(0), F.size(w) - short - 1), lambda i: F.array(*[one(i, shape, number) for shape, number in shapes])))


def _text(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def _own() -> Column:
    """What tells rows without doc_id apart: a hash of the text; null for the others."""
    return F.when(F.col("doc_id").cast("long").isNull(), F.xxhash64(_text()))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, matched, window): pairs that overlap, and how many words of their best window agree."""
    return _pairs(docs, benchmark).drop("_own")


def _few(rows: int) -> bool:
    return rows * ROW_BYTES <= BROADCAST_BYTES


def _pairs(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    prepare(spark)
    item = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.xxhash64(_text()).alias("_bs"), _words(F.col("text")).alias("_b")).dropDuplicates(["item_id", "_bs"])
    lengths = sorted(r["n"] for r in item.select(F.least(F.size("_b"), F.lit(WINDOW)).alias("n")).distinct().collect() if r["n"])  # WINDOW at most
    if not lengths:
        return spark.createDataFrame([], "doc_id long, _own long, item_id long, matched long, window long")
    placed = _placed(lengths)
    shapes = sorted({(shape, number) for some in placed.values() for _, shape, number in some}, key=lambda x: x[1])
    seeds = materialise(item.select("item_id", "_bs", F.explode(_item_seeds(F.col("_b"), placed)).alias("_s")).select("item_id", "_bs", F.col("_s.i").alias("_i"), F.col("_s.h").alias("_h")), "leak-seeds")
    doc = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(_text()).alias("_ds"), _words(F.col("text")).alias("_w"))
    place = doc.select("doc_id", "_ds", F.posexplode_outer(_seeds(F.col("_w"), shapes)).alias("_p", "_s")).select("doc_id", "_ds", "_p", F.explode_outer("_s").alias("_h"))
    met = place.join(F.broadcast(seeds) if _few(seeds.count()) else seeds, "_h")
    hits = met.groupBy("doc_id", "_ds", "item_id", "_bs", (F.col("_p") - F.col("_i")).alias("_d")).agg(F.min("_i").alias("_lo"), F.max("_i").alias("_hi"))
    hits = materialise(hits, "leak-hits")
    # The item's words that a window around the hits can hold, from _a on.
    n = F.least(F.lit(WINDOW), F.size("_b"))
    side = hits.join(item, hits["item_id"].eqNullSafe(item["item_id"]) & (hits["_bs"] == item["_bs"])).select(
        "doc_id", "_ds", hits["item_id"], "_d", "_b", n.alias("_n"), F.greatest(F.lit(0), F.col("_lo") - n + 1).alias("_a"), F.least(F.size("_b") - n, F.col("_hi")).alias("_z")
    )
    side = side.select("doc_id", "_ds", "item_id", "_d", "_n", "_a", "_z", F.slice("_b", F.col("_a") + 1, F.col("_z") - F.col("_a") + F.col("_n")).alias("_b"))
    key = hits.select("doc_id", "_ds").distinct()
    few = _few(hits.count())
    again = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(_text()).alias("_ds"), _text().alias("text"), _own().alias("_own"))
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["_ds"] == b["_ds"])
    wanted = again.join(F.broadcast(key) if few else key, same(again, key), "left_semi").select("doc_id", "_ds", "_own", _words(F.col("text")).alias("_w"))
    laid = wanted.join(side, same(wanted, side)).select(wanted["doc_id"], "_own", "item_id", "_d", "_n", "_a", "_b", "_w", F.greatest(F.col("_a"), -F.col("_d")).alias("_from"), F.least(F.col("_z"), F.size("_w") - F.col("_n") - F.col("_d")).alias("_to"))
    size = F.col("_to") - F.col("_from") + F.col("_n")
    agree = F.zip_with(F.slice("_w", F.col("_from") + F.col("_d") + 1, size), F.slice("_b", F.col("_from") - F.col("_a") + 1, size), lambda a, b: F.when(a == b, 1).otherwise(0))
    laid = laid.select("doc_id", "_own", "item_id", "_n", F.when(F.col("_to") >= F.col("_from"), agree).alias("_same"))
    sums = F.transform(F.sequence(F.lit(1), F.size("_same") - F.col("_n") + 1), lambda i: F.aggregate(F.slice("_same", i, F.col("_n")), F.lit(0), lambda a, x: a + x))
    best = laid.select("doc_id", "_own", "item_id", "_n", F.when(F.size("_same") >= F.col("_n"), F.array_max(sums)).alias("_m"))
    fits = F.col("_m") >= F.ceil(F.col("_n") * F.lit(SIMILARITY))
    # The test goes into the aggregate: as a filter it would move down and be worked out several times.
    out = best.groupBy("doc_id", "_own", "item_id").agg(F.max(F.when(fits, F.col("_m"))).cast("long").alias("matched"), F.max(F.when(fits, F.col("_n"))).cast("long").alias("window"))
    return out.where("matched IS NOT NULL")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the documents that overlap an item; all columns."""
    id_, text = fresh(docs, "found_id"), fresh(docs, "found_text")
    found = _pairs(docs, benchmark).select(F.col("doc_id").alias(id_), F.col("_own").alias(text)).distinct()
    return docs.join(found, F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & _own().eqNullSafe(F.col(text)), "left_anti")


def op9_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


#: Every alignment of every document and item that share a word, without seeds.
OP9_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '{_BREAK}'), lambda x: x <> '') AS w FROM documents
), b AS (
  SELECT row_number() OVER () AS k, item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '{_BREAK}'), lambda x: x <> '') AS w FROM benchmark
), dw AS (
  SELECT r, doc_id, len(w) AS size, unnest(w) AS word, unnest(range(len(w))) AS p FROM d
), bw AS (
  SELECT k, item_id, len(w) AS size, least({WINDOW}, len(w)) AS n, unnest(w) AS word, unnest(range(len(w))) AS i FROM b
), agree AS (
  SELECT dw.r, dw.doc_id, bw.k, bw.item_id, dw.p - bw.i AS diagonal, bw.i, bw.n, bw.size AS item_size, dw.size AS doc_size
  FROM dw JOIN bw ON dw.word = bw.word
), held AS (
  SELECT doc_id, item_id, n, count(*) AS m
  FROM agree, unnest(range(greatest(0, i - n + 1), least(i, item_size - n) + 1)) AS s(s)
  WHERE s + diagonal >= 0 AND s + diagonal + n <= doc_size
  GROUP BY r, doc_id, k, item_id, diagonal, s, n HAVING count(*) >= ceil(n * {SIMILARITY})
)
SELECT doc_id, item_id, max(m)::BIGINT AS matched, max(n)::BIGINT AS "window" FROM held GROUP BY doc_id, item_id
"""
