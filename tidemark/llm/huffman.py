"""Token ids as length-limited canonical Huffman codes, in independent blocks with bit-offset checkpoints.

File format: a directory with two Parquet folders.  `codes` has one row: for each id the code length
(0: never used), from global counts; the codes are canonical, in order of (length, id).  `blocks` has
a row for each block of consecutive documents in ascending doc_id order: part and block number, the
documents' ids, their numbers of ids, the payload, and the bit offset of every STEP-th id of each
document.  A block decodes alone: all its checkpoints are followed at once, one table look-up for each
id, so decoding is as wide as the block has checkpoints.

Defined results: a null or empty text is the end id alone; rows that repeat a doc_id are consecutive,
in order of their ids; null doc_ids come first; an empty table gives an empty table; other columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import doc_rows, materialise, new_path, prepare, slices
from tidemark.llm.tokens import TOKEN_CHARS, tokenizer_path, word_tokenizer

MAX_BITS = 16
STEP = 64
BLOCK_IDS = 1 << 17
END_ID = 2
BLOCKS = "part int, block int, first long, doc_ids array<long>, n_ids array<int>, bits binary, checkpoints binary"


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal lengths of at most `limit` bits by package-merge; 0 where the count is 0."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids don't fit codes of {limit} bits")
    if len(used) < 2:
        out[used] = 1
        return out
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    row, kinds = leaves, [np.ones(len(leaves), bool)]
    for _ in range(limit - 1):
        pairs = row[: len(row) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([leaves, pairs])
        place = np.argsort(both, kind="stable")
        row = both[place]
        kinds.append(place < len(leaves))
    take = 2 * (len(leaves) - 1)
    lengths = np.zeros(len(leaves), np.int64)
    for leaf in reversed(kinds):
        n = int(leaf[:take].sum())
        lengths[:n] += 1  # the lightest n leaves are in this row's choice
        take = 2 * (take - n)
    out[order] = lengths
    return out


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    codes, code, last = np.zeros(len(lengths), np.uint32), 0, 0
    used = np.flatnonzero(lengths)
    for i in used[np.lexsort((used, lengths[used]))].tolist():
        code <<= int(lengths[i]) - last
        last = int(lengths[i])
        codes[i] = code
        code += 1
    return codes


def encode(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bit string, padded to whole 64-bit big-endian words, and each id's bit offset."""
    n = lengths[ids].astype(np.int64)
    ends = np.cumsum(n)
    at = ends - n
    words = np.zeros((int(ends[-1]) + 63) // 64 + 1, np.uint64)
    word, shift = at >> 6, 64 - (at & 63) - n  # a negative shift: the code goes on in the next word
    value = codes[ids].astype(np.uint64)
    first = np.flatnonzero(np.diff(word, prepend=-1))
    here = np.where(shift >= 0, value << np.maximum(shift, 0).astype(np.uint64), value >> np.maximum(-shift, 0).astype(np.uint64))
    words[word[first]] = np.add.reduceat(here, first)
    over = np.flatnonzero(shift < 0)
    words[word[over] + 1] += value[over] << (64 + shift[over]).astype(np.uint64)
    return words[: (int(ends[-1]) + 63) // 64].astype(">u8").tobytes(), at


class Decoder:
    def __init__(self, lengths: np.ndarray):
        codes, used = canonical_codes(lengths), np.flatnonzero(lengths)
        n = lengths[used].astype(np.int64)
        self.width = int(n.max(initial=1))
        lo = codes[used].astype(np.int64) << (self.width - n)
        order = np.argsort(lo, kind="stable")
        self.symbol = np.zeros(1 << self.width, np.uint32)
        self.bits = np.ones(1 << self.width, np.int64)
        spans = (1 << (self.width - n[order])).astype(np.int64)
        filled = int(spans.sum())
        self.symbol[:filled] = np.repeat(used[order], spans)
        self.bits[:filled] = np.repeat(n[order], spans)

    def decode(self, bits: bytes, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """counts[i] ids from bit starts[i] on, one after another."""
        data = np.frombuffer(bits + b"\0" * 8, np.uint8).astype(np.uint32)
        window = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]  # 32 bits from each byte on
        out_at = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), np.uint32)
        order = np.argsort(-counts, kind="stable")
        at, place, left = starts[order].copy(), out_at[order], counts[order]
        for step in range(int(left[0]) if len(left) else 0):
            live = int(np.searchsorted(-left, -step, side="left"))  # those with more than `step` ids
            a = at[:live]
            seen = (window[a >> 3] << (a & 7).astype(np.uint32)) >> np.uint32(32 - self.width)
            out[place[:live] + step] = self.symbol[seen]
            at[:live] = a + self.bits[seen]
        return out


def checkpoints_of(sizes: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Of documents with these numbers of ids: where each checkpoint's run begins, and how long it is."""
    runs = -(-sizes // step)
    doc = np.repeat(np.arange(len(sizes)), runs)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(runs) - runs, runs)
    return np.repeat(np.cumsum(sizes) - sizes, runs) + nth * step, np.minimum(step, sizes[doc] - nth * step)


def _ids(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = word_tokenizer(path)
        end = np.array([end_id], tok.dtype).tobytes()
        for batch in batches:
            for ids, texts in slices(batch.column(0).to_pylist(), batch.column(1).to_pylist(), TOKEN_CHARS):
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([x + end for x in tok.ids(texts)], pa.binary())], ["doc_id", "ids"])

    return run


def _counts(item: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                found = np.bincount(np.frombuffer(b"".join(batch.column(0)[at : at + 256].to_pylist()), item))
                if len(found) > len(total):
                    total = np.concatenate([total, np.zeros(len(found) - len(total), np.int64)])
                total[: len(found)] += found
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["id", "n"])

    return run


def _blocks(item: str, lengths: np.ndarray, step: int, block_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, codes, number, first = TaskContext.get().partitionId(), canonical_codes(lengths), 0, 0
        held: list[tuple] = []
        size = 0

        def block() -> pa.RecordBatch:
            sizes = np.array([len(x) for _, x in held], np.int64)
            bits, at = encode(np.concatenate([x for _, x in held]), codes, lengths)
            marks = at[checkpoints_of(sizes, step)[0]].astype("<i8")
            # Checkpoints as differences, deflated: a few bits each.
            row = {"part": [part], "block": [number], "first": [first], "doc_ids": [[d for d, _ in held]], "n_ids": [sizes.tolist()], "bits": [bits], "checkpoints": [zlib.compress(np.diff(marks, prepend=0).astype("<u4").tobytes(), 1)]}
            types = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row.values(), types)], list(row))

        for batch in batches:
            for d, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.append((d, np.frombuffer(x, item)))
                size += len(held[-1][1])
                if size >= block_ids:
                    yield block()
                    held, first, number, size = [], first + size, number + 1, 0
        if held:
            yield block()

    return run


def write_ids(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID, max_bits: int = MAX_BITS, step: int = STEP, block_ids: int = BLOCK_IDS) -> None:
    """Encodes every document and writes the two folders of the format below `path`."""
    spark = docs.sparkSession
    prepare(spark)
    from tokenizers import Tokenizer

    size = Tokenizer.from_file(tokenizer).get_vocab_size()
    item = "<u2" if size <= 1 << 16 else "<u4"
    staged = materialise(doc_rows(docs).mapInArrow(_ids(tokenizer, end_id), "doc_id long, ids binary"), "huffman-ids")
    found = staged.select("ids").mapInArrow(_counts(item), "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()  # a row for each id of the vocabulary at most
    counts = np.zeros(size, np.int64)
    for r in found:
        counts[r["id"]] = r["n"]
    lengths = code_lengths(counts, max_bits)
    spark.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths binary").write.parquet(f"{path}/codes")
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = staged.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "ids")
    ranged.mapInArrow(_blocks(item, lengths, step, block_ids), BLOCKS).write.parquet(f"{path}/blocks")


def _read(lengths: np.ndarray, step: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(lengths)
        for batch in batches:
            for row in batch.to_pylist():
                sizes = np.array(row["n_ids"], np.int64)
                runs = checkpoints_of(sizes, step)[1]
                starts = np.cumsum(np.frombuffer(zlib.decompress(row["checkpoints"]), "<u4").astype(np.int64))
                ids = decoder.decode(row["bits"], starts, runs).astype("<u4")
                ends = np.cumsum(sizes)
                begin = ends - sizes
                data = ids.tobytes()
                found = [data[4 * a : 4 * b] for a, b in zip(begin.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * len(sizes), pa.int32()), pa.array(row["doc_ids"], pa.int64()), pa.array(begin + row["first"]), pa.array(sizes), pa.array(found, pa.binary())],
                    ["part", "doc_id", "start", "n_tokens", "ids"],
                )

    return run


def read_ids(spark: SparkSession, path: str, step: int = STEP) -> DataFrame:
    """(doc_id, start, n_tokens, ids): ids as little-endian uint32, decoded block by block."""
    prepare(spark)
    lengths = np.frombuffer(bytes(spark.read.parquet(f"{path}/codes").first()["lengths"]), np.uint8)
    blocks = spark.read.parquet(f"{path}/blocks")
    sizes = blocks.groupBy("part").agg(F.sum(F.aggregate("n_ids", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n")).orderBy("part").collect()  # one row for each file
    before, held = [], 0
    for r in sizes:
        before.append((r["part"], held))
        held += r["n"]
    docs = blocks.mapInArrow(_read(lengths, step), "part int, doc_id long, start long, n_tokens long, ids binary")
    offsets = spark.createDataFrame(before, "part int, before long")
    return docs.join(F.broadcast(offsets), "part").select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids")


def op7_token_files(spark, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    path = new_path(spark, "token-files")
    write_ids(docs, tokenizer_path("word_bpe_49k.json"), path)
    return read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
