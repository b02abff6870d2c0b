"""Suffix-array dedup: a logarithmic family of suffix arrays, in shards of the corpus's windows.

A window is LENGTH bytes; its minimizer is the least hash of the K-byte strings in it.  Equal windows
have equal minimizers, so windows are dealt to shards by minimizer: consecutive windows of a document
with one minimizer travel as one run (their bytes once), and a run that repeats an earlier one of the
same task stays there.  K-byte strings that many documents of a bounded sample hold come last in the
order of hashes, so a common line or phrase seldom is a minimizer and doesn't fill one shard.

A shard takes its runs in the documents' order, in batches.  Windows whose hash comes up again, in the
batch or in a level that holds their run's minimizer, are merge-scanned in one suffix array (ranked to
depth LENGTH by prefix doubling); those that also start earlier are marked.  The others of the batch
become a level, and levels of equal size merge, so there are logarithmically many, and no level holds a
window twice.

Marked spans come back to their documents, whose covered bytes are removed.  A hash of a run's bytes only
proposes that two runs are the same: their bytes are compared before one is marked.  Hashes of windows
only rule out: no mark rests on one.

Defined results: a null or empty text has no bytes and stays; a text shorter than LENGTH is never
touched; a null doc_id counts as the largest; rows that repeat a doc_id are ordered by a
hash of their text, and rows that repeat both are one document, treated alike; an empty table gives an empty
table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import doc_rows, prepare, slices

LENGTH = 100
K = 24
#: Bytes of text for each shard; runs of a chunk of text are sent together.
SHARD_BYTES = 8 << 20
#: Shuffle partitions at most, unless the session has more: four a shard, so that few shards share one.
PARTITIONS = 20_000
CHUNK_CHARS = 6_000_000
SLICE = 1_000_000
#: Windows of a batch, the smallest level.
BATCH_WINDOWS = 500_000
#: Documents and characters of each that the sample for common strings takes at most.
SAMPLE_DOCS, SAMPLE_CHARS, COMMON_SHARE = 400, 8_000, 0.02
LAST_ID = (1 << 63) - 1
_COMMON_BITS, _TABLE_BITS = 20, 22
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_B = 0x5851F42D4C957F2D


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * _C1
    x ^= x >> np.uint64(32)
    x *= _C2
    x ^= x >> np.uint64(29)
    return x


def _eight(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, the first the highest."""
    w = data.astype(np.uint64)
    for n in (1, 2, 4):
        w = w[:-n] << np.uint64(8 * n) | w[n:]
    return w


def string_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the K bytes from each position on."""
    if len(data) < K:
        return np.zeros(0, np.uint64)
    w = _eight(data)
    h = _mixed(w)
    for at in range(8, K, 8):
        h = _mixed(h[: len(w) - at] + w[at:])
    return h


def _least(keys: np.ndarray, size: int) -> np.ndarray:
    """The least of each `size` consecutive keys."""
    span, low = 1, keys
    while 2 * span <= size:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    return np.minimum(low[: len(keys) - size + 1], low[size - span :]) if span < size else low


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inverse = pow(_B, -1, 1 << 64)
    with np.errstate(over="ignore"):
        up, down = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, x, np.uint64)])) for x in (_B, inverse))
    return up, down, np.random.default_rng(1).integers(0, 1 << 64, 256, np.uint64)


def run_hashes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A hash of the bytes data[start : start + size] for each run; equal bytes, equal hash."""
    n = 1 << max(16, int(len(data)).bit_length())
    up, down, table = _powers(n)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * up[: len(data)], out=sums[1:])
    return (sums[starts + sizes] - sums[starts]) * down[starts]


def gathered(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes of the runs, one after another."""
    ends = np.cumsum(sizes)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    shift, at = starts - (ends - sizes), 0
    while at < len(starts):  # an index takes eight times the bytes: a part at a time
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE)))
        a, b = int(ends[at] - sizes[at]), int(ends[upto - 1])
        out[a:b] = data[np.repeat(shift[at:upto], sizes[at:upto]) + np.arange(a, b)]
        at = upto
    return out


def same_bytes(a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each pair: are the `sizes` bytes from a_at in a those from b_at in b?  A part of the pairs at a time."""
    out, ends, at = np.ones(len(sizes), bool), np.cumsum(sizes), 0
    while at < len(sizes):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE)))
        part = slice(at, upto)
        equal = gathered(a, a_at[part], sizes[part]) == gathered(b, b_at[part], sizes[part])
        out[part] = np.logical_and.reduceat(equal, np.cumsum(sizes[part]) - sizes[part])
        at = upto
    return out


@dataclass
class Runs:
    """Runs of windows: minimizer, document (id, checksum), first window's place, windows, bytes."""

    mini: np.ndarray
    doc: np.ndarray
    sig: np.ndarray
    pos: np.ndarray
    windows: np.ndarray
    twice: np.ndarray  # may hold a window more than once: its minimizer stands at several places
    at: np.ndarray  # where a run's windows + LENGTH - 1 bytes begin in data
    data: np.ndarray

    def take(self, index: np.ndarray, compact: bool = False) -> Runs:
        at, data = self.at[index], self.data
        if compact:
            sizes = self.windows[index] + LENGTH - 1
            data, at = gathered(data, at, sizes), np.cumsum(sizes) - sizes
        return Runs(self.mini[index], self.doc[index], self.sig[index], self.pos[index], self.windows[index], self.twice[index], at, data)

    def compacted(self) -> Runs:
        return self.take(np.arange(len(self)), compact=True)

    def __len__(self) -> int:
        return len(self.mini)


def joined(parts: list[Runs]) -> Runs:
    if all(p.data is parts[0].data for p in parts):
        return Runs(*(np.concatenate([getattr(p, n) for p in parts]) for n in ("mini", "doc", "sig", "pos", "windows", "twice", "at")), parts[0].data)
    shift = np.cumsum([0, *(len(p.data) for p in parts)])
    arrays = (np.concatenate([getattr(p, n) for p in parts]) for n in ("mini", "doc", "sig", "pos", "windows", "twice"))
    return Runs(*arrays, np.concatenate([p.at + s for p, s in zip(parts, shift)]), np.concatenate([p.data for p in parts]))


def runs_of(texts: list[bytes], common: np.ndarray) -> tuple[np.ndarray, ...]:
    """(minimizer, text number, first window, windows, twice, where it begins) of each run, and all the bytes."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begin = np.cumsum(sizes) - sizes
    if len(data) < LENGTH:
        return (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3, np.zeros(0, bool), np.zeros(0, np.int64), data)
    h = string_hashes(data)
    keys = (h >> np.uint64(1)) | (common[h >> np.uint64(64 - _COMMON_BITS)].astype(np.uint64) << np.uint64(63))
    mini = _least(keys, LENGTH - K + 1)
    change = np.zeros(len(data) + 1, np.int64)
    long = sizes >= LENGTH
    np.add.at(change, begin[long], 1)
    np.add.at(change, begin[long] + sizes[long] - LENGTH + 1, -1)
    valid = np.cumsum(change[: len(mini)]) > 0
    first = valid.copy()
    first[1:] &= ~(valid[:-1] & (mini[1:] == mini[:-1]))
    starts, all_ = np.flatnonzero(first), np.flatnonzero(valid)
    windows = np.diff(np.append(np.searchsorted(all_, starts), len(all_)))
    text = np.searchsorted(begin, starts, side="right") - 1
    last, span = starts + windows - 1, np.arange(LENGTH - K + 1)
    own = mini[starts][:, None]
    left = starts + (keys[starts[:, None] + span] == own).argmax(1)
    right = last + span[-1] - (keys[last[:, None] + span[::-1]] == own).argmax(1)
    return mini[starts], text, starts - begin[text], windows, left != right, starts, data


def first_runs(runs: Runs, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(kept, again, first): each run of `again` has the bytes of the earlier run `first`; kept are the others, in order.

    The hash only proposes: a run whose bytes differ from the first of its hash is kept as well.
    """
    order = np.lexsort((hashes, runs.windows, runs.mini))
    same = np.ones(len(order), bool)
    same[:1] = False
    for k in (runs.mini, runs.windows, hashes):
        same[1:] &= k[order][1:] == k[order][:-1]
    first = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))][same]
    again = order[same]
    real = same_bytes(runs.data, runs.at[again], runs.data, runs.at[first], runs.windows[again] + LENGTH - 1)
    again, first = again[real], first[real]
    keep = np.ones(len(order), bool)
    keep[again] = False
    return np.flatnonzero(keep), again, first


def suffix_ranks(data: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Rank of the `depth` bytes from each position on (equal bytes, equal rank), by prefix doubling.

    Positions less than `depth` bytes from the end have no meaningful rank.
    """
    keys, span = _eight(np.concatenate([data, np.zeros(7, np.uint8)])), 8
    rank = np.unique(keys, return_inverse=True)[1].astype(np.uint64)
    while span < depth:
        step = min(span, depth - span)
        later = np.zeros_like(rank)
        later[: len(rank) - step] = rank[step:]
        rank = np.unique(rank << np.uint64(32) | later, return_inverse=True)[1].astype(np.uint64)
        span += step
    return rank


def _windows(runs: Runs) -> np.ndarray:
    """Where each window of the runs begins in their data, run by run."""
    ends = np.cumsum(runs.windows)
    return np.repeat(runs.at - (ends - runs.windows), runs.windows) + np.arange(int(ends[-1]) if len(ends) else 0)


def window_hashes(runs: Runs) -> np.ndarray:
    """A hash of each window's bytes, run by run."""
    return _mixed(run_hashes(runs.data, _windows(runs), np.int64(LENGTH)))


def _among(hashes: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Which of hashes are among some, which ascend; a table of bits rules most of them out."""
    table, shift = np.zeros(1 << _TABLE_BITS, bool), np.uint64(64 - _TABLE_BITS)
    table[some >> shift] = True
    out = table[hashes >> shift]
    seen = hashes[out]
    out[out] = some[np.minimum(np.searchsorted(some, seen), len(some) - 1)] == seen
    return out


def likely(earlier: Runs, runs: Runs) -> tuple[np.ndarray, np.ndarray]:
    """For each window of earlier and of runs: may its bytes be those of another one, of runs at least once?

    Never false where they are.
    """
    old, new = window_hashes(earlier), window_hashes(runs)
    order = np.sort(new)
    of_old = _among(old, order)
    again = np.sort(np.concatenate([old[of_old], order[1:][order[1:] == order[:-1]]]))
    return of_old, _among(new, again) if len(again) else np.zeros(len(new), bool)


def stretches(runs: Runs, chosen: np.ndarray) -> Runs:
    """The maximal stretches of chosen windows as runs of their own, over the same data."""
    run, begins, ends, place = _stretches(runs, chosen)
    out = runs.take(run)
    out.pos, out.at, out.windows = out.pos + place[begins], out.at + place[begins], ends - begins + 1
    return out


def _stretches(runs: Runs, chosen: np.ndarray) -> tuple[np.ndarray, ...]:
    """(run, first window, last window) of each stretch, windows by number, and each window's place in its run."""
    ends = np.cumsum(runs.windows)
    run = np.repeat(np.arange(len(runs)), runs.windows)
    place = np.arange(len(chosen)) - np.repeat(ends - runs.windows, runs.windows)
    begins, stops = chosen.copy(), chosen.copy()
    begins[1:] &= ~(chosen[:-1] & (run[1:] == run[:-1]))
    stops[:-1] &= ~(chosen[1:] & (run[1:] == run[:-1]))
    a = np.flatnonzero(begins)
    return run[a], a, np.flatnonzero(stops), place


def repeated_windows(earlier: Runs | None, runs: Runs) -> np.ndarray:
    """For each window of runs, in order: does it also start earlier, in `earlier` or among runs?

    `earlier` comes before all of runs, and runs are in the documents' order.
    """
    both = runs if earlier is None else joined([earlier, runs])
    compact = both.compacted()
    found = suffix_ranks(compact.data)[_windows(compact)]
    # The first of each rank in order is the one that stays; a window of the same document and place is itself.
    first = np.full(int(found.max(initial=0)) + 1, len(found))
    np.minimum.at(first, found.astype(np.int64), np.arange(len(found)))
    repeated = np.arange(len(found)) > first[found.astype(np.int64)]
    return repeated[int(earlier.windows.sum()) if earlier is not None else 0 :]


class Family:
    """The index: levels of runs ordered by minimizer, sizes at least doubling."""

    def __init__(self):
        self.levels: list[tuple[Runs, np.ndarray, np.ndarray]] = []  # runs, their hashes ascending, whose each hash is

    def add(self, batch: Runs) -> list[tuple[np.ndarray, ...]]:
        """Marks the batch's windows that start earlier as well; returns (doc, sig, start, end) of spans."""
        marked: list[tuple[np.ndarray, ...]] = []

        def whole(index: np.ndarray) -> None:
            marked.append((batch.doc[index], batch.sig[index], batch.pos[index], batch.pos[index] + batch.windows[index] + LENGTH - 1))

        hashes = run_hashes(batch.data, batch.at, batch.windows + LENGTH - 1)
        kept, again, _ = first_runs(batch, hashes)
        whole(again)
        known = np.zeros(len(kept), bool)
        for level, level_hashes, owner in self.levels:  # the same run in a level: nothing more to look at
            at = np.minimum(np.searchsorted(level_hashes, hashes[kept]), len(level_hashes) - 1)
            run = owner[at]
            hit = np.flatnonzero((level_hashes[at] == hashes[kept]) & (level.windows[run] == batch.windows[kept]) & ~known)
            known[hit] = same_bytes(batch.data, batch.at[kept[hit]], level.data, level.at[run[hit]], batch.windows[kept[hit]] + LENGTH - 1)
        whole(kept[known])
        kept = kept[~known]
        new, new_hashes = batch.take(kept), hashes[kept]
        if len(new):
            values, counts = np.unique(new.mini, return_counts=True)
            shared = new.twice | np.isin(new.mini, values[counts > 1])
            old = []
            for level, _, _ in self.levels:
                lo, hi = np.searchsorted(level.mini, values, "left"), np.searchsorted(level.mini, values, "right")
                if (hit := hi > lo).any():
                    n = hi[hit] - lo[hit]
                    old.append(level.take(np.repeat(lo[hit] - (np.cumsum(n) - n), n) + np.arange(int(n.sum())), compact=True))
                    shared |= np.isin(new.mini, values[hit])
            if shared.any():
                scanned, rest = new.take(np.flatnonzero(shared), compact=True), new.take(np.flatnonzero(~shared))
                before = joined(old).compacted() if old else scanned.take(np.arange(0))
                of_old, of_new = likely(before, scanned)  # only windows that may repeat need a place in the array
                before, after = stretches(before, of_old), stretches(scanned, of_new)
                repeated = np.zeros(len(of_new), bool)
                if len(after):
                    again = repeated_windows(before if len(before) else None, after)
                    marked.append(_spans(after, again))
                    repeated[np.flatnonzero(of_new)[again]] = True
                # Repeated windows are in the index already.
                new = joined([rest, stretches(scanned, ~repeated)])
                new_hashes = run_hashes(new.data, new.at, new.windows + LENGTH - 1)
            self._put(new, new_hashes)
        return marked

    def _put(self, runs: Runs, hashes: np.ndarray) -> None:
        while self.levels and len(self.levels[-1][0]) < 2 * len(runs):
            level, level_hashes, owner = self.levels.pop()
            of_level = np.empty_like(level_hashes)
            of_level[owner] = level_hashes
            runs, hashes = joined([level, runs]), np.concatenate([of_level, hashes])
        order = np.argsort(runs.mini, kind="stable")
        runs, hashes = runs.take(order, compact=True), hashes[order]
        owner = np.argsort(hashes, kind="stable")
        self.levels.append((runs, hashes[owner], owner))


def _spans(runs: Runs, repeated: np.ndarray) -> tuple[np.ndarray, ...]:
    """Maximal stretches of repeated windows within each run, as spans of bytes."""
    r, a, b, place = _stretches(runs, repeated)
    return runs.doc[r], runs.sig[r], runs.pos[r] + place[a], runs.pos[r] + place[b] + LENGTH


def _packed(*values) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(pickle.dumps(values, protocol=5))


def _unpacked(data: bytes) -> tuple:
    import zstandard

    return pickle.loads(zstandard.ZstdDecompressor().decompress(data))


def _sent_runs(runs: Runs) -> bytes:
    """Runs and their bytes in one small frame, so that a shard may get a few runs from a chunk without a cost of its own."""
    import zstandard

    docs, number = np.unique(np.stack([runs.doc, runs.sig], 1), axis=0, return_inverse=True)
    wide = np.int64 if len(runs) and runs.pos.max() >> 31 else np.int32
    # Ascending numbers go as differences, which pack better.
    steps = lambda x, kind: np.diff(x, prepend=0).astype(kind)
    sig = docs[:, 1].astype(np.uint64)
    columns = (
        runs.mini.astype(np.uint32), steps(docs[:, 0], np.int64), sig.astype(np.uint32), (sig >> np.uint64(32)).astype(np.uint32), steps(number.reshape(-1), np.int32),
        steps(runs.pos, wide), runs.windows.astype(np.int32), np.packbits(runs.twice), gathered(runs.data, runs.at, runs.windows + LENGTH - 1),
    )
    head = np.array([len(runs), len(docs), wide is np.int64], np.int32)
    return zstandard.ZstdCompressor(level=3, write_content_size=True).compress(b"".join(x.tobytes() for x in (head, *columns)))


def _received_runs(frame: bytes) -> Runs:
    import zstandard

    data = zstandard.ZstdDecompressor().decompress(frame)
    (n, m, wide), at = np.frombuffer(data, np.int32, 3).tolist(), 12

    def take(kind, size: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(data, kind, size, at)
        at += out.nbytes
        return out

    mini, doc, low, high = take(np.uint32, n), np.cumsum(take(np.int64, m)), take(np.uint32, m), take(np.uint32, m)
    sig = low.astype(np.int64) | high.astype(np.int64) << 32
    number, pos = np.cumsum(take(np.int32, n), dtype=np.int64), np.cumsum(take(np.int64 if wide else np.int32, n), dtype=np.int64)
    windows, twice = take(np.int32, n).astype(np.int64), take(np.uint8, -(-n // 8))
    sizes = windows + LENGTH - 1
    return Runs(mini, doc[number], sig[number], pos, windows, np.unpackbits(twice, count=n).astype(bool), np.cumsum(sizes) - sizes, take(np.uint8, int(sizes.sum())))


def _checksum(text: bytes, doc: int | None) -> int:
    """Tells rows with one id apart: 63 bits where there is no id, 31 for the few rows that repeat one."""
    import xxhash

    return xxhash.xxh64_intdigest(text) >> (1 if doc is None else 33)


def _bucket(doc: np.ndarray, sig: np.ndarray, buckets: int) -> np.ndarray:
    return (_mixed(doc.astype(np.int64).view(np.uint64) + sig.astype(np.uint64)) >> np.uint64(33)).astype(np.int64) % buckets


def _span_rows(marked: list[tuple[np.ndarray, ...]], buckets: int) -> Iterator[tuple[int, int, bytes]]:
    """(1, bucket, packed spans) for each bucket of documents that has spans."""
    if not marked or not sum(len(m[0]) for m in marked):
        return
    doc, sig, a, b = (np.concatenate([m[i] for m in marked]).astype(np.int64) for i in range(4))
    bucket = _bucket(doc, sig, buckets)
    order = np.lexsort((a, sig, doc, bucket))
    for some in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
        yield 1, int(bucket[some[0]]), _packed(doc[some], sig[some], a[some], b[some])


def _sent(shards: int, buckets: int, shared):
    """kind 0: packed runs for a shard; kind 1: spans that a task can already tell, for a bucket of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = np.unpackbits(np.frombuffer(shared.value, np.uint8)).astype(bool)

        def rows(held: list[tuple]) -> pa.RecordBatch:
            held.sort(key=lambda x: x[:2])
            parts, at = [], 0
            while at < len(held):
                upto, size = at, 0
                while upto < len(held) and (size < SLICE or upto == at):
                    size += len(held[upto][2])
                    upto += 1
                some = held[at:upto]
                mini, text, pos, windows, twice, starts, data = runs_of([x[2] for x in some], common)
                doc, sig = (np.array([x[i] for x in some], np.int64) for i in (0, 1))
                parts.append((Runs(mini, doc[text], sig[text], pos, windows, twice, starts, data), run_hashes(data, starts, windows + LENGTH - 1)))
                at = upto
            found, hashes = joined([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            out = []
            if len(found):
                kept, again, first = first_runs(found, hashes)
                # Rows that repeat (id and checksum) are one document: its run isn't earlier than itself.
                real = (found.doc[first] != found.doc[again]) | (found.sig[first] != found.sig[again]) | (found.pos[first] != found.pos[again])
                again = again[real]
                out += _span_rows([(found.doc[again], found.sig[again], found.pos[again], found.pos[again] + found.windows[again] + LENGTH - 1)], buckets)
                shard = (_mixed(found.mini[kept]) >> np.uint64(33)).astype(np.int64) % shards
                order = np.argsort(shard, kind="stable")
                for some in np.split(kept[order], np.flatnonzero(np.diff(shard[order])) + 1):
                    out.append((0, int((_mixed(found.mini[some[:1]]) >> np.uint64(33))[0]) % shards, _sent_runs(found.take(some))))
            kinds = [pa.int32(), pa.int32(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * 3, kinds)], ["kind", "key", "body"])

        held: list[tuple] = []
        chars = 0
        for batch in batches:
            for ids, texts in slices(batch.column(0).to_pylist(), batch.column(1).to_pylist(), SLICE):
                for d, t in zip(ids, texts):
                    body = t.encode()
                    if len(body) >= LENGTH:
                        held.append((LAST_ID if d is None else d, _checksum(body, d), body))
                        chars += len(body)
                if chars >= CHUNK_CHARS:
                    yield rows(held)
                    held, chars = [], 0
        if held:
            yield rows(held)

    return run


def _indexed(buckets: int, batch_windows: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        if key[0].as_py() == 1:
            return table
        # Only minimizers that come up again, or stand twice in a run, need an index.
        parts = [_received_runs(x.as_py()) for x in table.column("body")]
        order = np.sort(np.concatenate([x.mini for x in parts]))
        again = order[1:][order[1:] == order[:-1]]
        for i, some in enumerate(parts):
            at = np.minimum(np.searchsorted(again, some.mini), max(0, len(again) - 1))
            parts[i] = some.take(np.flatnonzero(some.twice | (again[at] == some.mini if len(again) else False)), compact=True)
        runs = joined(parts)
        del parts
        order = np.lexsort((runs.pos, runs.sig, runs.doc))
        # Rows that repeat, from several tasks: one copy.
        if len(order):
            d, s, p = runs.doc[order], runs.sig[order], runs.pos[order]
            order = order[np.append(True, (d[1:] != d[:-1]) | (s[1:] != s[:-1]) | (p[1:] != p[:-1]))]
        family, marked = Family(), []
        batches = np.cumsum(runs.windows[order]) // batch_windows if len(order) else order
        for some in np.split(order, np.flatnonzero(np.diff(batches)) + 1):
            if len(some):
                marked += family.add(runs.take(some, compact=True))
        rows = list(_span_rows(marked, buckets))
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 3, [pa.int32(), pa.int32(), pa.binary()])], ["kind", "key", "body"])

    return run


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _cut(with_text: bool):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        found = [_unpacked(x.as_py()) for k, x in zip(table.column("kind").to_pylist(), table.column("body")) if k == 1]
        doc, sig, a, b = (np.concatenate([x[i] for x in found]) if found else np.zeros(0, np.int64) for i in range(4))
        order = np.lexsort((a, sig, doc))
        doc, sig, a, b = doc[order], sig[order], a[order], b[order]
        cut = np.flatnonzero((np.diff(doc) != 0) | (np.diff(sig) != 0)) + 1
        first = np.concatenate([[0], cut]) if len(doc) else cut
        where = {(int(doc[i]), int(sig[i])): (int(i), int(j)) for i, j in zip(first, np.append(first[1:], len(doc)))}
        docs = (row for k, x in zip(table.column("kind").to_pylist(), table.column("body")) if k == 2 for row in zip(*_unpacked(x.as_py())))
        rows = []
        for d, check, body in docs:
            runs = []
            if spot := where.get((LAST_ID if d is None else d, check)):
                for x, y in zip(a[spot[0] : spot[1]].tolist(), b[spot[0] : spot[1]].tolist()):
                    if runs and x <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], y)
                    else:
                        runs.append([x, y])
            removed = sum(y - x for x, y in runs)
            kept = body if not runs else b"".join(body[i:j] for i, j in zip([0, *(y for _, y in runs)], [*(x for x, _ in runs), len(body)]))
            rows.append((d, len(body), removed, len(runs), hashlib.sha256(kept).hexdigest(), kept if with_text else None))
        kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 6, kinds)], [x.split()[0] for x in RESULT.split(", ")])

    return run


def common_strings(docs: DataFrame) -> bytes:
    """A bit for each slot of the hash of a K-byte string that many documents of a bounded sample hold."""
    sample = docs.orderBy(F.xxhash64("doc_id")).select(F.substring("text", 1, SAMPLE_CHARS).alias("text")).limit(SAMPLE_DOCS)
    counts, n = np.zeros(1 << _COMMON_BITS, np.int32), 0
    for row in sample.toLocalIterator():
        n += 1
        slots = np.unique(string_hashes(np.frombuffer(row["text"].encode(), np.uint8)) >> np.uint64(64 - _COMMON_BITS))
        counts[slots.astype(np.int64)] += 1
    # Chance meetings of other strings in a slot don't count as common.
    return np.packbits(counts > max(3, COMMON_SHARE * n, counts.mean() + 6 * counts.std() + 3)).tobytes()


def removed(docs: DataFrame, with_text: bool = False, shard_bytes: int = SHARD_BYTES, batch_windows: int = BATCH_WINDOWS) -> DataFrame:
    """The columns of RESULT for every row of docs; `kept`, the remaining bytes, only with_text."""
    spark = docs.sparkSession
    prepare(spark)
    rows = doc_rows(docs)
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    shards = buckets = max(8, -(-size // shard_bytes))
    shared = spark.sparkContext.broadcast(common_strings(rows))
    sent = rows.mapInArrow(_sent(shards, buckets, shared), "kind int, key int, body binary")
    parts = min(4 * shards, max(PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    spans = sent.repartition(parts, "kind", "key").groupBy("kind", "key").applyInArrow(_indexed(buckets, batch_windows), "kind int, key int, body binary")  # one pass over the texts serves both kinds
    texts = rows.mapInArrow(_texts(buckets), "kind int, key int, body binary")
    return spans.unionByName(texts).groupBy("key").applyInArrow(_cut(with_text), RESULT)


def _texts(buckets: int):
    """kind 2: packed documents for a bucket; together they compress far better than one by one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for ids, texts in slices(batch.column(0).to_pylist(), batch.column(1).to_pylist(), 4 * CHUNK_CHARS):
                bodies = [t.encode() for t in texts]
                sig = np.array([_checksum(x, d) for x, d in zip(bodies, ids)], np.int64)
                key = _bucket(np.array([LAST_ID if d is None else d for d in ids], np.int64), sig, buckets)
                order = np.argsort(key, kind="stable")
                for some in np.split(order, np.flatnonzero(np.diff(key[order])) + 1):
                    out.append((2, int(key[some[0]]), _packed([ids[i] for i in some], sig[some].tolist(), [bodies[i] for i in some])))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * 3, [pa.int32(), pa.int32(), pa.binary()])], ["kind", "key", "body"])

    return run


def op10_suffix_index(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return removed(docs).drop("kept")
