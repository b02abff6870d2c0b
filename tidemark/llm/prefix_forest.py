"""Approximate nearest neighbours: a hash-prefix forest over shards of the vectors.

A tree is a sorted array of long hash strings, BITS random-hyperplane signs of a vector in one 64-bit
word.  A query descends each tree to its longest prefix match by binary search; all trees then ascend
together, one bit at a time, and on each level every row that is still under the query's prefix gains
a shared bit.  The rows of the shard that share most bits over all trees, SHARE of it, are the
candidates; they are compared exactly, in double precision, on the original vectors.

How many a recall needs is the data's: the vectors at hand are random directions whose fifth neighbour
has a cosine of 0.35 to 0.45, where no index can rule out much.

Every row is indexed, in shards of about SHARD_ROWS rows; every block of queries meets every shard,
and the best TOP of each shard go on, so a query's work grows with the rows and its recall doesn't
fall as they grow.  Of vectors that are the same bit for bit, the TOP + 1 with the smallest ids are
kept: no other can be in an answer, so a large group of copies costs nothing and loses nothing.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no
part, neither do rows without vec_id; only vectors of one length are compared; rows that repeat a
vec_id are never each other's answer; a query with no other vector gets no row; an empty table gives
an empty table; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import prepare

TOP = 5
EVERY = 50
TREES = 64
BITS = 32
#: The ascent ends on this level, where the least bits are shared.
ROOT = 1
#: Candidates of a shard: this share of its rows, and at least so many.
SHARE, LEAST = 0.15, 500
SHARD_ROWS = 8192
QUERY_ROWS = 4096
SEED = 7


def planes(dimension: int) -> np.ndarray:
    return np.random.default_rng([SEED, dimension]).standard_normal((dimension, TREES * BITS))


def hash_strings(units: np.ndarray) -> np.ndarray:
    """[tree, row]: each row's hash string in each tree, its first bit the highest."""
    out = np.empty((TREES, len(units)), np.uint64)
    weights = np.uint64(1) << np.arange(BITS - 1, -1, -1, dtype=np.uint64)
    all_planes = planes(units.shape[1])
    for at in range(0, len(units), 4096):
        signs = (units[at : at + 4096] @ all_planes > 0).reshape(-1, TREES, BITS)
        out[:, at : at + 4096] = (signs * weights).sum(2).T
    return out


class Forest:
    def __init__(self, units: np.ndarray):
        strings = hash_strings(units)
        self.order = np.argsort(strings, axis=1, kind="stable")
        self.sorted = np.take_along_axis(strings, self.order, 1)
        self.rows = len(units)

    def ranges(self, strings: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """[tree, query]: the sorted positions that share the query's first `depth` bits."""
        shift = np.uint64(BITS - depth)
        prefix = strings >> shift
        lo, hi = np.empty(strings.shape, np.int64), np.empty(strings.shape, np.int64)
        for t in range(TREES):
            tree = self.sorted[t] >> shift
            lo[t], hi[t] = np.searchsorted(tree, prefix[t], "left"), np.searchsorted(tree, prefix[t], "right")
        return lo, hi

    def candidates(self, strings: np.ndarray, least: int):
        """For each query: (its number, the rows to compare): the `least` rows, or all, that share most prefix bits with it.

        All trees ascend together from the longest match: on each level a row that is still under the
        query's prefix gains a bit.  Levels are nested ranges of a sorted array, so their sum over a
        tree is one running sum of range ends.
        """
        if least >= self.rows:
            yield from ((q, np.arange(self.rows)) for q in range(strings.shape[1]))
            return
        for at in range(0, strings.shape[1], 256):
            some = strings[:, at : at + 256]
            bounds = []
            for depth in range(BITS, ROOT - 1, -1):
                lo, hi = self.ranges(some, depth)
                bounds.append((lo, hi))
            lo, hi = (np.stack([b[i] for b in bounds], 2) for i in (0, 1))  # [tree, query, level]
            for q in range(some.shape[1]):
                shared = np.zeros(self.rows, np.int32)
                for t in range(TREES):
                    a, b = lo[t, q, -1], hi[t, q, -1]  # the widest range holds all others
                    step = np.bincount(lo[t, q] - a, minlength=b - a + 1) - np.bincount(hi[t, q] - a, minlength=b - a + 1)
                    shared[self.order[t, a:b]] += np.cumsum(step[: b - a])
                yield at + q, np.argpartition(-shared, least)[:least]


def _units(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def _cosines(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Row by row in one order of addition: equal vectors get equal cosines."""
    scale, own = np.abs(rows).max(1, keepdims=True), query / np.abs(query).max()
    rows = rows / scale
    return (rows * own).sum(1) / (np.sqrt((rows * rows).sum(1)) * np.sqrt((own * own).sum()))


def _searched(top: int, share: float):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        asks = table.column("_ask").to_numpy(zero_copy_only=False)
        ids = table.column("_id").to_numpy()
        vectors = np.array(table.column("_v").combine_chunks().flatten()).reshape(len(ids), -1).astype(float)
        query_ids, queries, row_ids, rows = ids[asks], vectors[asks], ids[~asks], vectors[~asks]
        out: list[tuple] = []
        if len(row_ids) and len(query_ids):
            units = _units(rows)
            asked = _units(queries)
            forest = Forest(units)
            for q, found in forest.candidates(hash_strings(asked), max(LEAST, 2 * top, int(share * len(rows)))):
                found = found[row_ids[found] != query_ids[q]]
                if len(found) > top:
                    near = units[found] @ asked[q]
                    found = found[near >= np.partition(near, -top)[-top] - 1e-9]  # ties stay
                score = _cosines(rows[found], queries[q])
                best = np.lexsort((row_ids[found], -score))[:top]
                out += [(query_ids[q], row_ids[found[i]], score[i]) for i in best]
        columns = list(zip(*out)) or [(), (), ()]
        return pa.table({"query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()), "score": pa.array(columns[2], pa.float64())})

    return run


def usable(vectors: DataFrame) -> DataFrame:
    """(_id, _v) of the rows that take part."""
    v = F.col("_v")
    bad: Column = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = vectors.select(F.col("vec_id").cast("long").alias("_id"), F.col("embedding").cast("array<double>").alias("_v"))
    return kept.where(F.col("_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0))


def nearest(vectors: DataFrame, queries: DataFrame, top: int = TOP, share: float = SHARE, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the `top` nearest found of `vectors` for each row of `queries`."""
    prepare(vectors.sparkSession)
    copies = W.partitionBy("_v").orderBy("_id")
    rows = usable(vectors).dropDuplicates(["_id", "_v"]).withColumn("_n", F.row_number().over(copies)).where(F.col("_n") <= top + 1).drop("_n")
    asked = usable(queries).dropDuplicates(["_id", "_v"])
    counts = vectors.agg(F.count(F.lit(1))).first()[0], queries.agg(F.count(F.lit(1))).first()[0]
    shards, blocks = (max(1, -(-n // most)) for n, most in zip(counts, (shard_rows, query_rows)))
    number = lambda n, salt: F.pmod(F.xxhash64(F.lit(salt), "_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.select(F.lit(False).alias("_ask"), "_id", "_v", number(shards, 1).alias("_s"), every(blocks).alias("_b"))
    right = asked.select(F.lit(True).alias("_ask"), "_id", "_v", every(shards).alias("_s"), number(blocks, 2).alias("_b"))
    met = left.unionByName(right).withColumn("_d", F.size("_v"))
    found = met.groupBy("_d", "_s", "_b").applyInArrow(_searched(top, share), "query_id long, vec_id long, score double")
    best = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def op3_prefix_forest(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return nearest(vectors, vectors.where(F.col("vec_id") % EVERY == 0))
