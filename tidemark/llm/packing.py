"""Packing: first-fit decreasing with a tournament tree, independently in randomised groups of documents.

Tokenised next to the scan, documents are dealt to groups by a hash; a group cuts whole sequences off
its long documents, packs what remains by first-fit decreasing (the tree holds the free room of each
bin, so the first bin with room is found in log time), and then empties its least full bins into gaps
of GAP ids or more, which cutting freely allows.  What stays unfilled is padding.

Defined results: a null or empty text is the end id alone, so every row has at least one piece; rows
that repeat are packed each; a null doc_id is kept; an empty table gives an empty table; other
columns are ignored.  Sequence ids are unique, not consecutive: group * 2**32 + number in the group.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import doc_rows, prepare, slices
from tidemark.llm.tokens import TOKEN_CHARS, tokenizer_path, word_tokenizer

LENGTH = 1024
GROUP_DOCS = 2048
GAP = 8
SEED = 20_240
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class TournamentTree:
    """Free room of up to n bins; each inner node holds the winner (largest room) of its two sides."""

    def __init__(self, n: int, capacity: int):
        self.base = 1 << max(0, (n - 1).bit_length())
        self.room = [capacity] * (2 * self.base)

    def first(self, size: int) -> int:
        """The first bin with room for size: every bin that isn't open yet has full room, so one exists."""
        i = 1
        while i < self.base:
            i *= 2
            if self.room[i] < size:
                i += 1
        return i - self.base

    def take(self, bin_: int, size: int) -> None:
        i = bin_ + self.base
        self.room[i] -= size
        while i > 1:
            i //= 2
            self.room[i] = max(self.room[2 * i], self.room[2 * i + 1])


def pack(lengths: list[int], length: int = LENGTH, gap: int = GAP) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length) pieces, each of at most `length` ids."""
    full = [[(d, s, length)] for d, n in enumerate(lengths) for s in range(0, n - n % length, length)]
    rest = sorted(((n % length, d) for d, n in enumerate(lengths) if n % length), key=lambda x: (-x[0], x[1]))
    tree, bins = TournamentTree(max(1, len(rest)), length), []
    for size, d in rest:
        at = tree.first(size)
        tree.take(at, size)
        if at == len(bins):
            bins.append([])
        bins[at].append((d, lengths[d] - size, size))
    return full + _poured(bins, length, gap)


def _poured(bins: list[list[tuple[int, int, int]]], length: int, gap: int) -> list[list[tuple[int, int, int]]]:
    """Empties the least full bins into the others' gaps as long as that saves a bin."""
    order = sorted(bins, key=lambda b: -sum(p[2] for p in b))
    room = [length - sum(p[2] for p in b) for b in order]
    i, begun = 0, -1
    while True:
        # All gaps of `gap` or more before the last bin must hold what it holds.
        last = len(order) - 1
        if last < 1 or sum(r for r in room[i:last] if r >= gap) < length - room[last]:
            return order
        for d, s, n in order[last]:
            while n:
                while not room[i] or room[i] < gap and i != begun:  # a gap once begun is filled to its end
                    i += 1
                begun = i
                put = min(n, room[i])
                order[i].append((d, s, put))
                room[i] -= put
                d, s, n = d, s + put, n - put
        order.pop()
        room.pop()


def _tokenised(path: str, end_id: int, groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = word_tokenizer(path)
        end = np.array([end_id], tok.dtype).tobytes()
        for batch in batches:
            seen: dict[tuple, int] = {}
            for ids, texts in slices(batch.column(0).to_pylist(), batch.column(1).to_pylist(), TOKEN_CHARS):
                found = [x + end for x in tok.ids(texts)]
                group = []
                for d, x in zip(ids, found):
                    key = (d, zlib.crc32(x, SEED))
                    n = seen[key] = seen.get(key, -1) + 1  # rows that repeat don't all meet in one group
                    group.append(zlib.crc32(f"{key} {n}".encode(), SEED) % groups)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(group, pa.int32()), pa.array(found, pa.binary())], ["doc_id", "g", "ids"])

    return run


def _packed(length: int, gap: int, item: str):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        docs = sorted(zip(table.column("doc_id").to_pylist(), table.column("ids").to_pylist()), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        ids = [np.frombuffer(x, item).astype("<u4") for _, x in docs]
        rows = []
        for number, sequence in enumerate(pack([len(x) for x in ids], length, gap)):
            offset = 0
            for d, s, n in sequence:
                rows.append((docs[d][0], s, n, zlib.crc32(ids[d][s : s + n].tobytes()), len(ids[d]), (key[0].as_py() << 32) + number, offset))
                offset += n
        columns = list(zip(*rows)) or [()] * 7
        names = [x.split()[0] for x in PIECES.split(", ")]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names)

    return run


def packed(docs: DataFrame, path: str, end_id: int = 0, length: int = LENGTH, group_docs: int = GROUP_DOCS, gap: int = GAP) -> DataFrame:
    """One row for each piece: the columns of PIECES."""
    prepare(docs.sparkSession)
    groups = max(1, -(-docs.count() // group_docs))
    from tokenizers import Tokenizer

    item = "<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4"
    ids = doc_rows(docs).mapInArrow(_tokenised(path, end_id, groups), "doc_id long, g int, ids binary")
    return ids.groupBy("g").applyInArrow(_packed(length, gap, item), PIECES)


def op2_packing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return packed(docs, tokenizer_path("byte_bpe_50k.json"))
