"""LM scoring: marginal probability of a text under a unigram model over subword pieces.

The pieces are an existing vocabulary (a public sentencepiece file, never trained here); every single
byte is a piece as well, so each word has a segmentation.  A piece that begins with a space begins a
word, no piece holds white space elsewhere, so a text's lattice falls apart at its words: its marginal
probability is the product of its words' marginals and of the end's probability.  A word's marginal
sums over all its segmentations by the forward recursion in log space, for all words of a length at
once.  The vocabulary's scores give the first weights and stay in as a prior of PRIOR tokens;
expectation-maximisation over the counts of all training words does the rest, until it gains little.

The only public file with scores is of a BPE model, whose scores are ranks; a rank r weights a piece
by 1 / (r + 2).

Word counts are gathered by a shuffle over all training texts.  The HEAD_WORDS most frequent words'
counts at most are broadcast (16 bytes each); the others are joined by word, so exact counts serve
every word and no frequent word is a key of that join.

Defined results: a null or empty text is its end alone; rows that repeat each get a row; a null doc_id
is kept and counts as the empty text for the fold; without training texts N = V = 0 and every c = 0;
an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import doc_rows, fold, materialise, prepare, py_fold, slices
from tidemark.llm.tokens import tokenizer_path

FOLDS, HELD_OUT = 5, 1
HEAD_WORDS = 1 << 18
#: Rounds of the fit at most, and the gain in log10 a token under which it ends.
ROUNDS, GAIN = 8, 0.1
#: Words longer than this many bytes take the recursion one by one.
LONG = 64
#: Tokens that the vocabulary's own scores count as, beside the expected counts.
PRIOR = 2_000.0
END = b" "  # no word holds a space
_KEPT = 400_000
_BASE, _MIX = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()  # ASCII only on bytes


def vocabulary(path: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces as bytes (a leading space begins a word) and first probabilities from their ranks, the end's last."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    weight: dict[bytes, float] = {}
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
            continue
        piece = model.id_to_piece(i).replace("▁", " ").encode()
        if b" " not in piece[1:]:
            weight[piece] = 1 / (2 - max(model.get_score(i), -1e6))
    for byte in range(256):
        weight.setdefault(bytes([byte]), 1e-6)
    p = np.array([*weight.values(), 0.1])
    return list(weight), p / p.sum()


class Lattice:
    """Forward and backward recursions; logs are natural here."""

    def __init__(self, pieces: list[bytes], p: np.ndarray):
        self.pieces = pieces
        with np.errstate(divide="ignore"):
            self.log = np.append(np.log(p[:-1]), -np.inf)  # the last: no such piece
        self.end = float(np.log(p[-1]))
        self.longest = max(map(len, pieces))
        keys = np.zeros(len(pieces), np.uint64)
        for i, x in enumerate(pieces):
            key = 0
            for b in x:
                key = (key * int(_BASE) + b + 1) % (1 << 64)
            keys[i] = key
        order = np.argsort(keys)
        self.keys, self.order = keys[order], order
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[(keys * _MIX) >> np.uint64(42)] = True
        self.index = {x: i for i, x in enumerate(pieces)}

    def _arcs(self, words: np.ndarray) -> list[np.ndarray]:
        """arcs[l - 1][i]: the piece of length l at i, for each of the equally long words; -1 for none."""
        b = words.astype(np.uint64).T + np.uint64(1)
        key, out = np.zeros_like(b), []
        for n in range(1, min(self.longest, len(b)) + 1):
            key = key[: len(b) - n + 1] * _BASE + b[n - 1 :]
            piece = np.full(key.shape, -1, np.int32)
            likely = np.nonzero(self.maybe[(key * _MIX) >> np.uint64(42)])
            seen = key[likely]
            at = np.minimum(np.searchsorted(self.keys, seen), len(self.keys) - 1)
            piece[likely] = np.where(self.keys[at] == seen, self.order[at], -1)
            out.append(piece)
        return out

    def _sum(self, terms: list[np.ndarray]) -> np.ndarray:
        if len(terms) == 1:
            return terms[0]
        x = np.stack(terms)
        top = x.max(0)
        return top + np.log(np.exp(x - top).sum(0))

    def _forward(self, arcs: list[np.ndarray], m: int) -> list[np.ndarray]:
        alpha = [np.zeros(m)]
        for j in range(1, len(arcs[0]) + 1):
            alpha.append(self._sum([alpha[j - n] + self.log[arcs[n - 1][j - n]] for n in range(1, min(j, len(arcs)) + 1)]))
        return alpha

    def _groups(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions and bytes of words of one length, with the space before them; some thousands at a time."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(sizes, kind="stable")
        order = order[sizes[order] <= LONG]
        for part in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1):
            for at in range(0, len(part), 8192):
                some = part[at : at + 8192]
                yield some, np.frombuffer(b"".join([b" " + words[i] for i in some.tolist()]), np.uint8).reshape(len(some), -1)

    def marginals(self, words: list[bytes]) -> np.ndarray:
        """Log probability of each word, over all its segmentations."""
        out = np.zeros(len(words))
        for some, matrix in self._groups(words):
            out[some] = self._forward(self._arcs(matrix), len(some))[-1]
        for i, w in enumerate(words):
            if len(w) > LONG:
                out[i] = self._long(b" " + w)[0][-1]
        return out

    def expected(self, words: list[bytes], counts: np.ndarray) -> tuple[np.ndarray, float]:
        """Expected number of times that each piece is used in these words, each counted so often, and their log probability."""
        total, told = np.zeros(len(self.pieces) + 1), 0.0
        for some, matrix in self._groups(words):
            arcs, m = self._arcs(matrix), len(some)
            size = len(arcs[0])
            alpha = self._forward(arcs, m)
            beta: list = [None] * size + [np.zeros(m)]
            for i in range(size - 1, -1, -1):
                beta[i] = self._sum([self.log[arcs[n - 1][i]] + beta[i + n] for n in range(1, min(size - i, len(arcs)) + 1)])
            weight = np.log(counts[some].astype(float)) - alpha[-1]
            told += float(counts[some] @ alpha[-1])
            for n, piece in enumerate(arcs, 1):
                i, j = np.nonzero(piece >= 0)
                found = piece[i, j]
                if len(found):
                    a, b = np.stack(alpha[: len(piece)]), np.stack(beta[n:])
                    total += np.bincount(found, np.exp(a[i, j] + self.log[found] + b[i, j] + weight[j]), len(total))
        for w, c in zip(words, counts.tolist()):
            if len(w) > LONG:
                w = b" " + w
                alpha, arcs = self._long(w)
                told += c * alpha[-1]
                beta = [-math.inf] * len(w) + [0.0]
                for i in range(len(w) - 1, -1, -1):
                    terms = [float(self.log[p]) + beta[j] for j, p in arcs[i]]
                    top = max(terms)
                    beta[i] = top + math.log(sum(math.exp(t - top) for t in terms))
                    for j, p in arcs[i]:
                        total[p] += c * math.exp(alpha[i] + float(self.log[p]) + beta[j] - alpha[-1])
        return total[:-1], told

    def _long(self, w: bytes) -> tuple[list[float], list[list[tuple[int, int]]]]:
        """The recursion over one word, by plain loops: forward sums and the arcs from each position."""
        arcs: list[list[tuple[int, int]]] = [[] for _ in w]
        into: list[list[float]] = [[] for _ in range(len(w) + 1)]
        alpha = [0.0] * (len(w) + 1)
        for i in range(len(w)):
            if i:
                top = max(into[i])
                alpha[i] = top + math.log(sum(math.exp(t - top) for t in into[i]))
                into[i] = []
            for n in range(1, min(self.longest, len(w) - i) + 1):
                p = self.index.get(w[i : i + n])
                if p is not None and self.log[p] > -math.inf:
                    arcs[i].append((i + n, p))
                    into[i + n].append(alpha[i] + float(self.log[p]))
        top = max(into[-1])
        alpha[-1] = top + math.log(sum(math.exp(t - top) for t in into[-1]))
        return alpha, arcs


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        for ids, texts in slices(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for d, t in zip(ids, texts):
                if py_fold(d, FOLDS) != HELD_OUT:
                    held.update(words_of(t))
                    held[END] += 1
            if len(held) > _KEPT:
                yield rows()
                held.clear()
    if held:
        yield rows()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word binary, n): the training tokens, the end as a space; written to the shared folder."""
    return materialise(doc_rows(docs).mapInArrow(_counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "lattice-words")


def _expected(pieces: list[bytes], p: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, total, told = Lattice(pieces, p), np.zeros(len(pieces) + 1), 0.0
        for batch in batches:
            words, n = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            real = [i for i, w in enumerate(words) if w != END]
            total[-1] += n.sum() - n[real].sum()
            for at in range(0, len(real), 50_000):
                some = real[at : at + 50_000]
                found, log = lattice.expected([words[i] for i in some], n[some])
                total[:-1] += found
                told += log
        used = np.flatnonzero(total)
        told += total[-1] * lattice.end
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1).astype(np.int32)), pa.array(np.append(total[used], told))], ["piece", "n"])

    return run


def fit(words: DataFrame, path: str, tokens: int, rounds: int = ROUNDS, gain: float = GAIN, prior: float = PRIOR) -> tuple[list[bytes], np.ndarray]:
    """The vocabulary and its probabilities: its scores as a prior, and expectation-maximisation over all words.

    Ends after a round that told less than `gain` (log10 a token) more than the one before.  Without
    words, or without rounds, the scores alone weight the lattice.
    """
    pieces, scored = vocabulary(path)
    p, last = scored, -math.inf
    for _ in range(rounds if tokens else 0):
        found = words.mapInArrow(_expected(pieces, p), "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()  # a row for each piece at most
        p, told = prior * scored, 0.0
        for r in found:
            if r["piece"] < 0:
                told = r["n"] / tokens / math.log(10)
            else:
                p[r["piece"]] += r["n"]
        p /= p.sum()
        if told - last < gain:
            break
        last = told
    return pieces, p


def _hash(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(_hash(batch.column(0).to_pylist()).view(np.int64)), batch.column(1)], ["h", "n"])


PARTS = "doc_id long, sig long, word binary, n long, rows long, n_tokens long, n_known long, base double, score double"


def _scored(model, head):
    """For each text a row with its sums over the head words, and a row for each other distinct word.

    The first kind has a word of its own (a space and the id), which matches nothing and spreads the rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        pieces, p = model.value
        known, n = head.value
        lattice = Lattice(pieces, p)
        at: dict[bytes, int] = {}
        names: list[bytes] = []
        logs, bases, rare = np.zeros(0), np.zeros(0), np.zeros(0, bool)
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        columns = [x.split()[0] for x in PARTS.split(", ")]

        def batch_of(ids, sig, words, counts, one: int, *rest) -> pa.RecordBatch:
            parts = (ids, sig, words, counts, np.full(len(sig), one), *rest)
            return pa.RecordBatch.from_arrays([pa.array(x if k != pa.int64() or not isinstance(x, np.ndarray) else x.astype(np.int64), k) for x, k in zip(parts, kinds)], columns)

        for batch in batches:
            for ids, texts in slices(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                split = [[*words_of(t), END] for t in texts]
                flat = list(chain.from_iterable(split))
                if len(at) > _KEPT:
                    at, names, logs, bases, rare = {}, [], np.zeros(0), np.zeros(0), np.zeros(0, bool)
                new = [w for w in dict.fromkeys(flat) if w not in at]
                at.update(zip(new, range(len(at), len(at) + len(new))))
                names += new
                h = _hash(new)
                spot = np.minimum(np.searchsorted(known, h), max(0, len(known) - 1))
                held = known[spot] == h if len(known) else np.zeros(len(h), bool)
                marginal = lattice.marginals(new) / math.log(10)
                if END in new:
                    marginal[new.index(END)] = lattice.end / math.log(10)
                logs = np.concatenate([logs, marginal])
                bases = np.concatenate([bases, np.where(held, np.log10(np.where(held, n[spot] if len(known) else 0, 0) + 0.5), 0)])
                rare = np.concatenate([rare, ~held])
                found = np.fromiter(map(at.__getitem__, flat), np.int64, len(flat))
                size = np.fromiter(map(len, split), np.int64, len(split))
                owner = np.repeat(np.arange(len(split)), size)
                seldom = rare[found]
                sums = [np.bincount(owner, x[found], len(split)) for x in (bases, logs)]
                few = np.bincount(owner, seldom, len(split)).astype(np.int64)
                sig = np.array([xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass")) for t in texts], np.uint64).view(np.int64)
                yield batch_of(ids, sig, [f" {d} {x}".encode() for d, x in zip(ids, sig.tolist())], np.zeros(len(split), np.int64), 1, size, size - few, *sums)
                # Each text's other words, once each.
                pair, count = np.unique(owner[seldom] * len(names) + found[seldom], return_counts=True)
                doc, word = np.divmod(pair, max(1, len(names)))
                no = np.zeros(len(pair))
                yield batch_of(pa.array(ids, pa.int64()).take(pa.array(doc)), sig[doc], [names[i] for i in word.tolist()], count, 0, no, no, no, no)

    return run


def scores(docs: DataFrame, path: str, head_words: int = HEAD_WORDS, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row."""
    spark = docs.sparkSession
    prepare(spark)
    words = word_counts(docs)
    sums = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("N"), F.count(F.lit(1)).alias("V")).first()
    denominator = math.log10(sums["N"] + 0.5 * (sums["V"] + 1))
    model = fit(words, path, int(sums["N"]), rounds)
    # The head: all words with 2**least occurrences or more, for the smallest such bound that keeps it small.
    levels = {r["b"]: r["count"] for r in words.groupBy(F.floor(F.log2(F.col("n"))).cast("int").alias("b")).count().collect()}  # 63 rows at most
    least, size = 63, 0
    while least and size + levels.get(least - 1, 0) <= head_words:
        least -= 1
        size += levels.get(least, 0)
    top = words.where(F.col("n") >= 1 << min(least, 62)).mapInArrow(_hashed, "h long, n long").toArrow()
    h, n = top.column("h").to_numpy().view(np.uint64), top.column("n").to_numpy()
    order = np.argsort(h)
    context = spark.sparkContext
    parts = doc_rows(docs).mapInArrow(_scored(context.broadcast(model), context.broadcast((h[order], n[order]))), PARTS)
    seldom = words.where(F.col("n") < 1 << min(least, 62)).select("word", F.col("n").alias("c"))
    joined = parts.join(seldom, "word", "left") if least else parts.withColumn("c", F.lit(None).cast("long"))
    one = joined.groupBy("doc_id", "sig").agg(
        F.sum("rows").alias("rows"),
        F.sum("n_tokens").alias("t"),
        F.sum(F.col("n_known") + F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("k"),
        F.sum(F.col("base") + F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("b"),
        F.sum("score").alias("s"),
    )
    # Rows that repeat have been summed; each gets its share.
    each = lambda c: F.expr(f"{c} div rows")
    out = one.withColumn("n_tokens", each("t")).select(
        "doc_id",
        (fold(FOLDS) == HELD_OUT).alias("held_out"),
        "n_tokens",
        each("k").alias("n_known"),
        F.lit(int(sums["N"])).cast("long").alias("train_tokens"),
        (F.col("b") / F.col("rows") - F.col("n_tokens") * denominator).alias("base_score"),
        (F.col("s") / F.col("rows")).alias("score"),
        F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("_copy"),
    )
    return out.drop("_copy")


def op1_lattice(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scores(docs, tokenizer_path("piece_bpe_32k.model"))
