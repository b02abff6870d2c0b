"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A feature is the presence of a character n-gram (3 to 6 characters of the lower-cased text, hashed to
2**BITS slots).  Training counts, for each slot, the toxic and the other documents that hold it; the
log-count ratio scales the feature; the FEATURES slots with the most telling ratio go into a logistic
regression with an L2 penalty.  Labels come from at most TRAIN_ROWS labelled documents, those with the
smallest hash of their id: the only sample here.  Scoring covers every document in one pass without a
shuffle; the model is FEATURES numbers.

Defined results: a null or empty text scores the model's bias; rows that repeat each get a row; a null
doc_id is kept and counts as the empty text for the fold; labels that are null, or that repeat, are
left out or taken once (the larger); of a
labelled id's texts the least in order is learned from; without labels of both kinds every score is 0; an empty table
gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import doc_rows, fold, prepare, slices

NGRAMS = (3, 6)
BITS = 20
TRAIN_ROWS = 10_000
FEATURES = 8_192
MIN_DOCUMENTS = 5
THRESHOLD = 0.3
FOLDS, HELD_OUT = 4, 2
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def hashed_ngrams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """For each n: slots at every position of the texts put together, the text of each position, and n.

    Texts are separated by characters of code 0, which belong to no text (-1); a position whose n-gram
    leaves its text is for the caller to drop (the text at its last character differs).
    """
    chars = np.frombuffer("\0".join(texts).lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.where(chars == 0, -1, np.cumsum(chars == 0))
    gram = np.zeros(len(chars), np.uint64)
    for n in range(1, NGRAMS[1] + 1):
        if len(chars) < n:
            return
        gram = gram[: len(chars) - n + 1] * _MULTIPLIER + chars[n - 1 :]
        if n >= NGRAMS[0]:
            yield ((gram ^ (gram >> np.uint64(29))) * _MULTIPLIER >> np.uint64(64 - BITS)).astype(np.int64), owner, n


def present(texts: list[str], keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, slot) pairs, each once; with keep, only slots that it marks."""
    # The separator must be no character of a text, and lower-casing mustn't move texts apart.
    texts = [t.replace("\0", " ") for t in texts]
    found = []
    for slot, owner, n in hashed_ngrams(texts):
        at = np.flatnonzero(keep[slot]) if keep is not None else np.arange(len(slot))
        at = at[(owner[at] >= 0) & (owner[at] == owner[at + n - 1])]
        found.append(owner[at] << BITS | slot[at])
    pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


@dataclass
class Model:
    slots: np.ndarray
    weights: np.ndarray
    bias: float

    def table(self) -> np.ndarray:
        out = np.zeros(1 << BITS)
        out[self.slots] = self.weights
        return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, 1 << BITS), np.int64)
    for batch in batches:
        for labels, texts in slices(batch.column(0).to_pylist(), batch.column(1).to_pylist(), 500_000):
            doc, slot = present(texts)
            label = np.array(labels, np.int64)[doc]
            for k in (0, 1):
                counts[k] += np.bincount(slot[label == k], minlength=1 << BITS)
    used = np.flatnonzero(counts.sum(0))
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[0][used]), pa.array(counts[1][used])], ["slot", "n0", "n1"])


def _rows(slots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = np.zeros(1 << BITS, bool)
        keep[slots] = True
        for batch in batches:
            for labels, texts in slices(batch.column(0).to_pylist(), batch.column(1).to_pylist(), 500_000):
                doc, slot = present(texts, keep)
                cut = np.searchsorted(doc, np.arange(len(texts) + 1))
                yield pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), pa.array([slot[a:b].astype("<i4").tobytes() for a, b in zip(cut, cut[1:])], pa.binary())], ["label", "slots"])

    return run


def logistic(rows: np.ndarray, cols: np.ndarray, scale: np.ndarray, labels: np.ndarray, penalty: float = 1.0, steps: int = 200) -> tuple[np.ndarray, float]:
    """Weights (times scale) and bias of a penalised logistic regression, by accelerated gradient steps."""
    n, m = len(labels), len(scale)
    x = scale[cols]
    bound = max(1e-9, 0.25 * float(np.bincount(rows, x * x, n).max(initial=0) + 1) * n / 4 + penalty)
    w, v, b, bv, t, rate = np.zeros(m), np.zeros(m), 0.0, 0.0, 1.0, 8 / bound
    last = np.inf
    for _ in range(steps):
        z = np.bincount(rows, x * v[cols], n) + bv
        error = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels
        loss = float(np.logaddexp(0, z).sum() - z @ labels + penalty / 2 * (v @ v))
        if loss > last + 1e-9:  # the step was too long
            rate, t = rate / 2, 1.0
            v, bv, last = w, b, np.inf
            continue
        last = loss
        nw, nb = v - rate * (np.bincount(cols, x * error[rows], m) + penalty * v), bv - rate * float(error.sum())
        nt = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v, bv = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return w * scale, b


def train(labelled: DataFrame) -> Model:
    """labelled: (label int 0/1, text).  Collects FEATURES counts and the sample's features, both bounded."""
    counted = labelled.mapInArrow(_counted, "slot int, n0 long, n1 long").groupBy("slot").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    sizes = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    d0, d1 = sizes.get(0, 0), sizes.get(1, 0)
    if not d0 or not d1:
        return Model(np.zeros(0, np.int64), np.zeros(0), -np.inf)
    ratio = F.log((F.col("n1") + 1) / (d1 + 2)) - F.log((F.col("n0") + 1) / (d0 + 2))
    chosen = counted.where(F.col("n0") + F.col("n1") >= MIN_DOCUMENTS).withColumn("r", ratio).orderBy(F.abs("r").desc(), "slot").limit(FEATURES).collect()
    if not chosen:
        return Model(np.zeros(0, np.int64), np.zeros(0), float(np.log(d1 / d0)))
    slots, scale = np.array([r["slot"] for r in chosen], np.int64), np.array([r["r"] for r in chosen])
    where = np.zeros(1 << BITS, np.int64)
    where[slots] = np.arange(len(slots))
    rows, cols, labels = [], [], []
    for i, r in enumerate(labelled.mapInArrow(_rows(slots), "label int, slots binary").collect()):  # TRAIN_ROWS at most
        found = where[np.frombuffer(bytes(r["slots"]), "<i4")]
        rows.append(np.full(len(found), i))
        cols.append(found)
        labels.append(r["label"])
    weights, bias = logistic(np.concatenate(rows), np.concatenate(cols), scale, np.array(labels, float))
    return Model(slots, weights, bias)


def _scored(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.table()
        keep = np.zeros(1 << BITS, bool)
        keep[model.slots] = True
        for batch in batches:
            for ids, texts in slices(batch.column(0).to_pylist(), batch.column(1).to_pylist(), 500_000):
                doc, slot = present(texts, keep)
                z = np.bincount(doc, table[slot], len(texts)) + model.bias
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40))))], ["doc_id", "score"])

    return run


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(label, text) of at most `rows` labelled documents outside the held-out fold, written to the shared folder."""
    from tidemark.llm.common import materialise

    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label")).where("doc_id IS NOT NULL AND label IN (0, 1)")
    usable = usable.where(fold(FOLDS) != HELD_OUT).groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    held = doc_rows(docs).join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.first("label").alias("label"), F.min("text").alias("text"))  # `rows` rows of 12 bytes
    return materialise(held.select("label", "text"), "toxicity-train")


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for every row."""
    return doc_rows(docs).mapInArrow(_scored(model), "doc_id long, score double")


def kept(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that score below the threshold, all columns, in one pass without a shuffle."""
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _scored(model)
        for batch in batches:
            texts = batch.column(place).cast(pa.string()).fill_null("")
            number = pa.array(range(batch.num_rows), pa.int64())
            below = np.concatenate([x.column(1).to_numpy() for x in score([pa.RecordBatch.from_arrays([number, texts], ["doc_id", "text"])])] or [np.zeros(0)]) < threshold
            yield batch.filter(pa.array(below))

    return docs.mapInArrow(run, docs.schema)


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train(training_rows(docs, labels))
    return scores(docs, model).select("doc_id", (fold(FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
