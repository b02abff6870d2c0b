"""SimHash near-dedup: tiled exact comparison with numpy exclusive-or and bit counts.

1. Fingerprints are computed next to the scan, one document at a time: LANES words of 64 bits each.
2. Distinct nodes are grouped in tiles of one population count, split by a hash where a tile would pass
   TILE rows.  Fingerprints within the radius differ in population count by at most the radius, so
   only such tile pairs meet; each pair is one group of two packed rows.
3. Within a pair, rows are ordered by the population count of their upper half, which rules out further
   blocks.  A task returns a spanning forest of the links it found, at most one edge a node, so a large
   group of copies never becomes all its pairs.
4. Components of the forest by alternating large and small stars over DataFrames.

``near_duplicates`` links fingerprints of one lane within a radius.  ``near_copies`` uses a fingerprint
of several lanes, wide enough that a pair at SIMILARITY is within COPY_RADIUS but for about one in a
hundred thousand, and then lets the shingle sets decide: linked is what has that Jaccard similarity
exactly.  Only texts that share one of their least shingle hashes are compared (``prefix``: pairs at
SIMILARITY all do), a bucket for each such set of texts; a bucket of more than COPY_TILE is dealt to
pairs of tiles, and so is a component of candidates that fills more than COMPONENT_BYTES.

``near_duplicates`` takes comparisons by the square of the distinct nodes; that is the method.  A tile
pair takes some 20 seconds at most, whatever the input.

Defined results: a null or empty text has no words: fingerprint zero, or an empty shingle set, linked
like any other; texts of fewer words than a shingle are one shingle; rows that repeat a doc_id each
get their row; a null doc_id keeps its row and never names a component unless all its component's ids
are null (then component_id is null); an empty table gives an empty table; other columns are ignored
(``one_of_each`` returns them, whatever their names).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import doc_rows, fresh, materialise, prepare, spread_join

SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
#: Nodes of a tile at most (on average, where a population count is split): 1 MB a lane.
TILE = 131_072
#: The near copies' shingles, similarity, lanes, and the radius for half of the lanes and for all.
COPY_WORDS, SIMILARITY = 5, 0.8
LANES, HALF_RADIUS, COPY_RADIUS = 4, 45, 76
COPY_TILE = 32_768
#: Hashes of prefixes, and rows of buckets, that a task takes about.
PREFIX_HASHES, BUCKET_ROWS = 1 << 19, 20_000
#: Comparisons that a task takes about, and tasks at most: a tile pair has few bytes and much work.
TASK_COMPARISONS, TASKS = 200_000_000, 20_000
COMPONENT_BYTES = 64 << 20
#: Rows of narrow tables that are broadcast at most: 64 bytes each.
BROADCAST_ROWS = 1 << 20
#: Tasks that one star's edges are dealt to.
SALTS = 16
_CELLS = 1 << 19
_GOLDEN, _M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def shingle_hashes(text: str, words_each: int) -> np.ndarray:
    """XXH64 of each shingle in order; words are lower-cased A-Z, white space is ASCII's."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()  # both ASCII only on bytes
    if not words:
        return np.zeros(0, np.uint64)
    buffer, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    last = ends[words_each - 1 :] or ends[-1:]
    return np.fromiter((digest(buffer[a : b - 1], SEED) for a, b in zip(starts, last)), np.uint64, len(last))


def lane(hashes: np.ndarray, number: int) -> np.ndarray:
    """Another hash of each hash; lane 0 is the hash itself."""
    if not number:
        return hashes
    x = hashes + _GOLDEN * np.uint64(number)
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def majority(hashes: np.ndarray) -> int:
    """64 bits: a bit is set if it is set in over half of the hashes; of a half, or of none, it isn't."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _CELLS):
        counts += np.unpackbits(hashes[at : at + _CELLS].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * counts > len(hashes)).tolist())


def fingerprint(text: str, words_each: int = SHINGLE_WORDS) -> int:
    return majority(shingle_hashes(text, words_each))


def shingle_set(text: str, words_each: int = COPY_WORDS) -> np.ndarray:
    return np.unique(shingle_hashes(text, words_each))


def lanes_of(held: np.ndarray, lanes: int = LANES) -> list[int]:
    """The set's fingerprint; an even set counts its least hash twice, so that no bit is undecided."""
    if len(held) and len(held) % 2 == 0:
        held = np.append(held, held[0])
    return [majority(lane(held, i)) for i in range(lanes)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1)
        found = np.array([fingerprint(texts[i].as_py()) for i in range(len(texts))], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["doc_id", "fp"])


def _near_one(a: np.ndarray, b: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of a and b (each ordered by its upper half's population count) within the radius."""
    ha, hb = (np.bitwise_count(x >> np.uint64(32)).astype(np.int64) for x in (a, b))
    delta = int(np.bitwise_count(a[0])) - int(np.bitwise_count(b[0]))
    for h in np.unique(ha).tolist():
        lo, hi = np.searchsorted(ha, [h, h + 1])
        fits = [x for x in range(33) if abs(h - x) + abs(delta - (h - x)) <= radius]
        if not fits:
            continue
        left, right = np.searchsorted(hb, [fits[0], fits[-1] + 1])
        if left == right:
            continue
        step = max(1, _CELLS // int(right - left))
        for i in range(lo, hi, step):
            x = np.bitwise_count(a[i : min(hi, i + step), None] ^ b[None, left:right]) <= radius
            ii, jj = np.nonzero(x)
            yield ii + i, jj + left


def spanning_links(a: np.ndarray, b: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(child, root): a forest over the rows of one tile (b None) or two, a's first, that joins all that are linked."""
    n = len(a) + (0 if b is None else len(b))
    root = np.arange(n)
    parent = root.tolist()

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    place = [np.argsort(np.bitwise_count(x >> np.uint64(32)), kind="stable") for x in ([a] if b is None else [a, b])]
    for ii, jj in _near_one(a[place[0]], a[place[0]] if b is None else b[place[1]], radius):
        ii, jj = place[0][ii], place[-1 if b is not None else 0][jj] + (0 if b is None else len(a))
        new = root[ii] != root[jj]
        ii, jj = ii[new], jj[new]
        if not len(ii):
            continue
        for x, y in np.unique(np.stack([root[ii], root[jj]], 1), axis=0).tolist():
            x, y = find(x), find(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
        flat = np.array(parent)
        while not np.array_equal(flat, up := flat[flat]):
            flat = up
        root, parent = flat, flat.tolist()
    child = np.flatnonzero(root != np.arange(n))
    return child, root[child]


def _compare(radius: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        nodes, words = {}, {}
        for side, packed in zip(table.column("side").to_pylist(), table.column("packed")):
            held = packed.values
            nodes[side], words[side] = held.field("node"), np.asarray(held.field("lanes").flatten()).view(np.uint64)
        u, v = spanning_links(words[0], words.get(1), radius)
        all_nodes = pa.concat_arrays([nodes[s] for s in sorted(nodes)])
        return pa.table({"u": all_nodes.take(pa.array(u)), "v": all_nodes.take(pa.array(v))})

    return run


def links(nodes: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(u, v): edges that connect exactly the nodes that are reachable over links.

    nodes: distinct `node`, and `lanes`, its fingerprint as an array of one long.
    """
    spark = nodes.sparkSession
    kind = nodes.schema["node"].dataType.simpleString()
    bits = F.aggregate("lanes", F.lit(0), lambda n, x: n + F.bit_count(x).cast("int"))
    counted = nodes.groupBy(bits.alias("p")).count().collect()  # a row for each population count
    sizes = {r["p"]: r["count"] for r in counted}
    splits = {p: -(-n // tile) for p, n in sizes.items()}
    if not splits:
        return nodes.select(F.col("node").alias("u"), F.col("node").alias("v")).where("false")
    table = spark.createDataFrame(sorted(splits.items()), "p int, m int")
    tiles = (
        nodes.withColumn("p", bits).join(F.broadcast(table), "p")  # a row for each population count
        .groupBy("p", F.pmod(F.xxhash64("node"), F.col("m")).cast("int").alias("s")).agg(F.collect_list(F.struct("node", "lanes")).alias("packed"))
    )
    near = spark.createDataFrame([(p, q, m) for p in splits for q, m in splits.items() if abs(p - q) <= radius], "p int, q int, m int")
    met = tiles.join(F.broadcast(near), "p").withColumn("t", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))  # population counts squared at most
    mine, theirs = F.struct("p", "s"), F.struct(F.col("q").alias("p"), F.col("t").alias("s"))
    pairs = met.select(F.least(mine, theirs).alias("a"), F.greatest(mine, theirs).alias("b"), F.when(mine <= theirs, 0).otherwise(1).alias("side"), "packed")
    work = sum(m * n for p, m in sizes.items() for q, n in sizes.items() if abs(p - q) <= radius) // 2
    tasks = max(8, min(TASKS, work // TASK_COMPARISONS))
    return pairs.repartition(tasks, "a", "b").groupBy("a", "b").applyInArrow(_compare(radius), f"u {kind}, v {kind}")


def _star(edges: DataFrame, least: DataFrame) -> DataFrame:
    """edges with their u's least neighbour; a star's edges are dealt to SALTS tasks, each with a copy of that one row."""
    rows = edges.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    return rows.join(least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["u", "salt"]).drop("salt")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the smallest node of the component; only nodes that have an edge.

    Alternating large-star and small-star steps; every round is checkpointed to the shared folder.
    """
    state, seen = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct().checkpoint(), None
    while True:
        mark = tuple(state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if mark == seen:
            return state.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = mark
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _star(both, least).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _star(large, low).select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
        state = small.select("e.u", "e.v").where("u <> v").distinct().checkpoint()


def near_duplicates(docs: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(doc_id, fp, component_id) for every row of docs."""
    prepare(docs.sparkSession)
    printed = materialise(doc_rows(docs).mapInArrow(_fingerprints, "doc_id long, fp long"), "simhash-fingerprints")
    nodes = materialise(printed.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n")), "simhash-nodes")
    member = components(links(nodes.select(F.col("fp").alias("node"), F.array("fp").alias("lanes")), radius, tile))
    named = member.join(nodes, member["node"] == nodes["fp"]).select("node", "root", "rep")
    least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    moved = named.join(least, "root").select(F.col("node").alias("fp"), "component_id")
    known = materialise(nodes.join(moved, "fp", "left").select("fp", "n", F.coalesce("component_id", "rep").alias("component_id")), "simhash-known")
    return spread_join(printed, known, ["fp"], "n", ["doc_id"])


# Near copies: candidates by wide fingerprints, decided by the shingle sets.


def linked_sets(sets: list[np.ndarray], least: float = SIMILARITY) -> np.ndarray:
    """For each set the first one of its group: groups are what pairs with a similarity of `least` or more connect.

    A set is expanded by the lists of sets that hold each of its shingles, which gives its similarity to
    all others exactly.  Groups with few sets left to expand go first; when a single group has any
    left, no link can be missing, so a large group of copies takes few expansions.
    """
    m = len(sets)
    size = np.fromiter(map(len, sets), np.int64, m)
    flat = np.concatenate([*sets, np.zeros(0, np.uint64)])
    owner = np.repeat(np.arange(m), size)
    order = np.argsort(flat, kind="stable")
    starts = np.flatnonzero(np.append(True, np.diff(flat[order]) != 0)) if len(flat) else np.zeros(0, np.int64)
    values, posting = flat[order][starts], owner[order]
    ends = np.append(starts[1:], len(flat))
    group = np.arange(m)
    members = {i: [i] for i in range(m)}
    waiting = {i: [i] for i in range(m)}
    empty = np.flatnonzero(size == 0)

    def join(x: int, y: int) -> None:
        if len(members[x]) < len(members[y]):
            x, y = y, x
        group[members[y]] = x
        members[x] += members.pop(y)
        left = waiting.pop(x, []) + waiting.pop(y, [])
        if left:
            waiting[x] = left

    for y in empty[1:].tolist():
        join(int(group[empty[0]]), int(group[y]))
    while len(waiting) > 1:
        for x in sorted(waiting, key=lambda g: len(waiting[g]))[:-1]:
            if x not in waiting or len(waiting) < 2:
                continue
            i = waiting[x].pop()
            if not waiting[x]:
                del waiting[x]
            if not size[i]:
                continue
            at = np.searchsorted(values, sets[i])
            n = ends[at] - starts[at]
            where = np.repeat(starts[at] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            both = np.bincount(posting[where], minlength=m)
            near = np.flatnonzero(both >= least * (size[i] + size - both))
            near = near[both[near] / (size[i] + size[near] - both[near]) >= least]
            for g in np.unique(group[near]).tolist():
                if group[g] != group[i]:
                    join(int(group[g]), int(group[i]))
    first = np.full(m, m)
    np.minimum.at(first, group, np.arange(m))
    return first[group]


def prefix(held: np.ndarray, least: float = SIMILARITY) -> np.ndarray:
    """The set's least hashes, so many that sets with a similarity of `least` or more share one of them.

    Such sets have in common `least` of either one's hashes, and so many can't all come after the prefix.
    """
    return held[: len(held) - ceil(least * len(held) * (1 - 1e-12)) + 1]


def _within(words: np.ndarray, size: np.ndarray, i: np.ndarray, j: np.ndarray, least: float = SIMILARITY) -> np.ndarray:
    """Whether rows i and j (the larger set) may have the similarity by their sizes and fingerprints."""
    apart = np.bitwise_count(words[i] ^ words[j])
    half = apart[:, : words.shape[1] // 2].sum(1, dtype=np.int64)
    return (size[i] >= least * (1 - 1e-12) * size[j]) & (half <= HALF_RADIUS) & (apart.sum(1, dtype=np.int64) <= COPY_RADIUS)


def linked_rows(words: np.ndarray, size: np.ndarray, least: float = SIMILARITY) -> np.ndarray:
    """For each row of a bucket, ordered by size, the first of its group: groups are what the proposed pairs connect.

    Rows of all groups but the one with most left meet the rows of a fitting size, some at a time; when a
    single group has any left, no link can be missing, so a large group of copies takes few comparisons.
    """
    n, width, first = len(words), 1 << 14, words.shape[1] // 2
    columns = [np.ascontiguousarray(words[:, k]) for k in range(first)]
    root, left = np.arange(n), np.ones(n, bool)
    while True:
        waiting = np.bincount(root[left], minlength=n)
        if np.count_nonzero(waiting) < 2:
            return root
        rows = np.flatnonzero(left & (root != waiting.argmax()))[:32]
        left[rows] = False
        lo = int(np.searchsorted(size, least * (1 - 1e-12) * size[rows[0]]))
        hi = int(np.searchsorted(size, size[rows[-1]] / (least * (1 - 1e-12)), side="right"))
        for at in range(lo, hi, width):
            to = min(hi, at + width)
            x = sum(np.bitwise_count(words[rows, k][:, None] ^ columns[k][None, at:to]) for k in range(first))
            ii, jj = np.nonzero(x <= HALF_RADIUS)
            ii, jj = rows[ii], jj + at
            new = root[ii] != root[jj]
            ii, jj = np.minimum(ii, jj)[new], np.maximum(ii, jj)[new]
            near = _within(words, size, ii, jj)
            for u, v in np.unique(np.stack([root[ii[near]], root[jj[near]]], 1), axis=0).tolist():
                u, v = sorted((int(root[u]), int(root[v])))
                if u != v:
                    root[root == v] = u


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    for batch in batches:
        texts, nodes, sizes, found, least = batch.column(2), [], [], [], []
        for i in range(len(texts)):
            held = shingle_set(texts[i].as_py())
            nodes.append(xxhash.xxh3_128_digest(held.tobytes()))
            sizes.append(len(held))
            found.append([_signed(x) for x in lanes_of(held)])
            least.append(prefix(held).tobytes())
        keys = np.array([int.from_bytes(n[:8]) for n in nodes], np.uint64).view(np.int64)
        columns = [batch.column(0), batch.column(1), pa.array(nodes, pa.binary()), pa.array(keys), pa.array(sizes, pa.int64()), pa.array(found, pa.list_(pa.int64())), pa.array(least, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "sig", "node", "k", "size", "lanes", "prefix"])


def _dealt(parts: int):
    """Hashes of prefixes and the keys of their texts, packed by the hash's remainder; a batch's copies count once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = dict(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            h = np.frombuffer(b"".join(held.values()), np.uint64)
            k = np.repeat(np.fromiter(held, np.int64, len(held)), [len(x) // 8 for x in held.values()])
            p = (h % np.uint64(parts)).astype(np.int32)
            order = np.argsort(p, kind="stable")
            h, k, p = h[order], k[order], p[order]
            at = np.flatnonzero(np.diff(p, prepend=-1))
            ends = [*at[1:].tolist(), len(p)]
            packed = [pa.array([x[a:b].tobytes() for a, b in zip(at.tolist(), ends)], pa.binary()) for x in (h, k)]
            yield pa.RecordBatch.from_arrays([pa.array(p[at], pa.int32()), *packed], ["p", "h", "k"])

    return run


def _shared(key: tuple, table: pa.Table) -> pa.Table:
    """(bucket, k): the sets of texts that share a hash, each set once; bucket is a hash of the set."""
    import xxhash

    h, k = (np.frombuffer(b"".join(table.column(c).to_pylist()), t) for c, t in (("h", np.uint64), ("k", np.int64)))
    order = np.lexsort((k, h))
    h, k = h[order], k[order]
    new = np.append(True, (h[1:] != h[:-1]) | (k[1:] != k[:-1]))
    h, k = h[new], k[new]
    starts = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    ends = np.append(starts[1:], len(h))
    some = ends - starts > 1
    sets = {k[a:b].tobytes() for a, b in zip(starts[some].tolist(), ends[some].tolist())}
    bucket = np.repeat(np.array([_signed(xxhash.xxh3_64_intdigest(x)) for x in sets], np.int64), [len(x) // 8 for x in sets])
    return pa.table({"bucket": pa.array(bucket), "k": pa.array(np.frombuffer(b"".join(sets), np.int64))})


def _proposed(key: tuple, table: pa.Table) -> pa.Table:
    """(u, v): for each bucket a forest that joins what the fingerprints propose."""
    bucket, a, b, size = (table.column(c).to_numpy() for c in ("bucket", "a", "b", "size"))
    order = np.lexsort((size, b, a, bucket))
    bucket, a, b, size = bucket[order], a[order], b[order], size[order]
    words = np.asarray(table.column("lanes").combine_chunks().flatten()).view(np.uint64).reshape(len(order), -1)[order]
    starts = np.flatnonzero(np.append(True, (bucket[1:] != bucket[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
    root, two = np.arange(len(order)), np.diff(starts, append=len(order)) == 2
    x = starts[two]
    root[x + 1] -= _within(words, size, x, x + 1)
    for i, j in zip(starts[~two].tolist(), np.append(starts[1:], len(order))[~two].tolist()):
        root[i:j] = i + linked_rows(words[i:j], size[i:j])
    child = np.flatnonzero(root != np.arange(len(order)))
    node = table.column("node").combine_chunks()
    return pa.table({"u": node.take(pa.array(order[child])), "v": node.take(pa.array(order[root[child]]))})


def _verified(key: tuple, table: pa.Table) -> pa.Table:
    texts, seen = table.column("text"), {}
    for i, node in enumerate(table.column("node").to_pylist()):
        if node not in seen:
            seen[node] = shingle_set(texts[i].as_py())
    nodes = sorted(seen)
    first = linked_sets([seen[n] for n in nodes])
    return pa.table({"u": pa.array(nodes, pa.binary()), "v": pa.array([nodes[i] for i in first.tolist()], pa.binary())})


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _key() -> list[Column]:
    """A row's identity: its id and a hash of its text."""
    return [F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(_text()).alias("sig")]


def _to_tiles(rows: DataFrame, key: str) -> DataFrame:
    """rows without `m`, with (a, b): a copy for each pair of m tiles that a row is in; one tile is the pair (0, 0)."""
    own = F.pmod(F.xxhash64(key), F.col("m")).cast("int")
    other = F.when(F.col("m") == 1, F.array(F.lit(0))).otherwise(F.filter(F.sequence(F.lit(0), F.col("m") - 1), lambda j: j != own))
    dealt = rows.withColumn("_k", own).withColumn("_j", F.explode(other))
    return dealt.withColumn("a", F.least("_k", "_j")).withColumn("b", F.greatest("_k", "_j")).drop("m", "_k", "_j")


def proposed(printed: DataFrame, nodes: DataFrame, tile: int = COPY_TILE) -> DataFrame:
    """(u, v): edges that connect the nodes that fingerprints propose, of those that share a hash of their prefixes."""
    of = nodes.agg(F.sum("size"), F.count(F.lit(1))).first()
    parts = max(8, int((of[0] or 0) * (1 - SIMILARITY) + of[1]) // PREFIX_HASHES)
    met = printed.select("k", "prefix").mapInArrow(_dealt(parts), "p int, h binary, k binary").groupBy("p").applyInArrow(_shared, "bucket long, k long")
    met = materialise(met.distinct(), "copies-buckets")
    large = met.groupBy("bucket").count().where(F.col("count") > tile).select("bucket", F.ceil(F.col("count") / tile).cast("int").alias("_m"))
    dealt = _to_tiles(met.join(F.broadcast(large), "bucket", "left").withColumn("m", F.coalesce("_m", F.lit(1))).drop("_m"), "k")  # a row for `tile` rows at most
    tasks = max(8, min(TASKS, met.count() // BUCKET_ROWS))
    rows = dealt.join(nodes.select("k", "node", "size", "lanes"), "k").withColumn("q", F.pmod(F.xxhash64("bucket", "a", "b"), F.lit(tasks)))
    return rows.repartition(tasks, "q").groupBy("q").applyInArrow(_proposed, "u binary, v binary")


def near_copies(docs: DataFrame, component_bytes: int = COMPONENT_BYTES, tile: int = COPY_TILE) -> DataFrame:
    """(doc_id, sig, part, component_id) for every row of docs; part names the group, component_id is its smallest id."""
    prepare(docs.sparkSession)
    rows = docs.select(*_key(), _text().alias("text"))
    printed = materialise(rows.mapInArrow(_sketches, "doc_id long, sig long, node binary, k long, size long, lanes array<long>, prefix binary"), "copies-sketches")
    nodes = printed.groupBy("node").agg(F.min("doc_id").alias("rep"), F.min(F.struct("doc_id", "sig")).alias("at"), F.count(F.lit(1)).alias("n"), F.first("k").alias("k"), F.first("size").alias("size"), F.first("lanes").alias("lanes"))
    nodes = materialise(nodes, "copies-nodes")
    member = materialise(components(proposed(printed, nodes, tile)).join(nodes.select("node", "at", "size"), "node"), "copies-candidates")
    # Each half of a pair of tiles holds about half of what a task may.
    tiles = F.when(F.sum("size") * 8 <= component_bytes, 1).otherwise(F.ceil(F.sum("size") * 16 / component_bytes)).cast("int")
    sized = member.groupBy("root").agg(tiles.alias("m"))
    most = sized.agg(F.max("m")).first()[0] or 0
    dealt = _to_tiles(member.join(sized, "root").select("root", "node", F.col("at.doc_id").alias("_id"), F.col("at.sig").alias("_sig"), "m"), "node")
    small = member.count() <= BROADCAST_ROWS
    texts = rows.join(F.broadcast(dealt) if small and most <= 1 else dealt, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("sig") == F.col("_sig"))).select("root", "a", "b", "node", "text")
    edges = materialise(texts.groupBy("root", "a", "b").applyInArrow(_verified, "u binary, v binary"), "copies-links")
    part = edges.select(F.col("u").alias("node"), F.col("v").alias("part")) if most <= 1 else components(edges).select("node", F.col("root").alias("part"))
    known = nodes.join(part, "node", "left").select("node", "rep", "n", F.coalesce("part", "node").alias("part"))
    least = known.groupBy("part").agg(F.min("rep").alias("component_id"))
    known = materialise(known.join(least, "part").select("node", "n", "part", "component_id"), "copies-known")
    return spread_join(printed.select("doc_id", "sig", "node"), known, ["node"], "n", ["doc_id", "sig"]).drop("node")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each group of near copies, all columns: that with the smallest id, rows without id last; ties go by a hash of the text."""
    found = near_copies(docs).groupBy("doc_id", "sig").agg(F.first("part").alias("part"), F.count(F.lit(1)).alias("n"))
    kept = found.groupBy("part").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "sig", "n")).alias("k"))
    id_, sig = fresh(docs, "kept_id"), fresh(docs, "kept_sig")
    kept = materialise(kept.select(F.col("k.doc_id").alias(id_), F.col("k.sig").alias(sig), F.col("k.n").alias("n")), "copies-kept")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & (F.xxhash64(_text()) == F.col(sig))
    chosen = docs.join(kept.select(id_, sig), same, "left_semi")
    # Texts are dealt out once more only if such a row is there several times.
    return chosen if kept.where("n > 1").isEmpty() else chosen.dropDuplicates(["doc_id", "text"])


def op8_simhash(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
