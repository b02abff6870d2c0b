"""Near copies by wide fingerprints and exact shingle sets, against brute force over all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import simhash


def sets(text):
    w = (text or "").lower().split()
    return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def alike(a, b):
    return a == b or bool(a & b) and len(a & b) / len(a | b) >= 0.8


def corpus():
    r, rows = random.Random(11), []
    for _ in range(60):
        words = [f"w{r.randint(0, 10**6)}" for _ in range(r.choice((3, 12, 40, 200, 400)))]
        rows.append(words)
        for changes in (1, 2, 3, 8, 14, 30):
            copy = list(words)
            for i in r.sample(range(len(copy)), min(changes, len(copy))):
                copy[i] = f"x{r.randint(0, 10**6)}"
            rows.append(copy)
        rows.append([*words, "tail"])
    return [(i, " ".join(w)) for i, w in enumerate(rows)]


@pytest.mark.parametrize("component_bytes", [simhash.COMPONENT_BYTES, 2000])
def test_groups_are_those_of_all_pairs(spark, component_bytes):
    rows = [*corpus(), (9000, None), (9001, ""), (9002, "   ")]
    held = {d: sets(t) for d, t in rows}
    group = {d: d for d in held}
    while True:
        new = {a: min(group[b] for b in held if alike(held[a], held[b])) for a in held}
        if new == group:
            break
        group = new
    docs = spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, kept_id int")
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_copies(docs, component_bytes, tile=100).collect()}
    assert got == group
    if component_bytes == simhash.COMPONENT_BYTES:
        kept = simhash.one_of_each(docs)
        assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(set(group.values()))
        assert simhash.near_copies(docs.limit(0)).count() == 0


def test_candidates_hold_pairs_at_the_similarity():
    r = np.random.default_rng(4)
    missed = 0
    for n in (4, 5, 9, 20, 100, 1000):
        for _ in range(300):
            a = np.unique(r.integers(0, 1 << 63, n, np.uint64))
            common = -(-8 * 2 * n // 18)  # the least that gives 0.8 for sets of one size
            b = np.unique(np.concatenate([a[r.permutation(n)[:common]], r.integers(0, 1 << 63, n - common, np.uint64)]))
            if len(np.intersect1d(a, b)) / len(np.union1d(a, b)) >= 0.8:
                x, y = (np.array(simhash.lanes_of(s), np.uint64) for s in (a, b))
                d = np.bitwise_count(x ^ y)
                missed += d[:2].sum() > simhash.HALF_RADIUS or d.sum() > simhash.COPY_RADIUS
    assert not missed


def test_linked_sets_are_those_of_all_pairs():
    r = random.Random(3)
    base = [r.sample(range(1000), 40) for _ in range(4)]
    some = [np.unique(np.array(r.sample(b, r.randint(30, 40)) + r.sample(range(1000, 2000), r.randint(0, 4)), np.uint64)) for b in base for _ in range(25)]
    some += [np.zeros(0, np.uint64)] * 2
    group = list(range(len(some)))
    while True:
        new = [min(group[j] for j, y in enumerate(some) if alike(set(x.tolist()), set(y.tolist()))) for x in some]
        if new == group:
            break
        group = new
    assert simhash.linked_sets(some).tolist() == group


def test_one_word_of_200_replaced_is_a_copy(spark):
    r = random.Random(2)
    rows = []
    for i in range(50):
        words = [f"v{r.randint(0, 10**6)}" for _ in range(200)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join([*words[:100], "other", *words[101:]]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in simhash.one_of_each(docs).collect()) == list(range(0, 100, 2))


def test_null_and_repeated_ids_follow_their_own_group(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(50)) for x in "abc")
    rows = [(1, a), (None, a + " more"), (None, b), (None, b), (None, b + " more"), (2, c), (2, a), (2, c)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r["doc_id"], r["text"]) for r in simhash.one_of_each(docs).collect()]
    assert len(kept) == 3 and {(1, a), (2, c)} < set(kept) and next(t for d, t in kept if d is None) in (b, b + " more")


def test_sets_at_the_similarity_share_a_hash_of_their_prefixes():
    r = np.random.default_rng(8)
    for n in (1, 4, 5, 9, 10, 40, 333):
        for _ in range(200):
            a = np.unique(r.integers(0, 1 << 63, n, np.uint64))
            gone, more = r.integers(0, n // 5 + 1), r.integers(0, n // 4 + 1)
            b = np.unique(np.concatenate([a[r.permutation(len(a))[gone:]], r.integers(0, 1 << 63, more, np.uint64)]))
            if len(np.intersect1d(a, b)) / len(np.union1d(a, b)) >= 0.8:
                assert len(np.intersect1d(simhash.prefix(a), simhash.prefix(b)))


def compared(monkeypatch):
    """The words whose bits are counted from now on."""
    seen, count = [0], np.bitwise_count

    def counted(x):
        seen[0] += x.size
        return count(x)

    monkeypatch.setattr(np, "bitwise_count", counted)
    return seen


def test_rows_are_linked_as_by_all_pairs_with_few_comparisons_of_copies(monkeypatch):
    r = np.random.default_rng(5)
    base = r.integers(0, 1 << 63, (3, simhash.LANES), np.uint64)
    words = np.concatenate([base[r.integers(0, 3, 300)] ^ (np.uint64(1) << r.integers(0, 63, (300, simhash.LANES), np.uint64)), r.integers(0, 1 << 63, (60, simhash.LANES), np.uint64)])
    size = np.sort(r.integers(50, 400, len(words)))
    d = np.bitwise_count(words[:, None] ^ words[None])
    near = (d[..., :2].sum(-1) <= simhash.HALF_RADIUS) & (d.sum(-1) <= simhash.COPY_RADIUS) & (np.minimum.outer(size, size) >= 0.8 * np.maximum.outer(size, size))
    group = np.arange(len(words))
    while not np.array_equal(group, new := np.where(near, group[None], len(words)).min(1)):
        group = new
    assert simhash.linked_rows(words, size).tolist() == group.tolist()
    seen, n = compared(monkeypatch), 4000
    copies = base[:1] ^ (np.uint64(1) << r.integers(0, 63, (n, simhash.LANES), np.uint64))
    assert not simhash.linked_rows(copies, np.full(n, 100)).any() and seen[0] < 100 * simhash.LANES * n


def test_unrelated_texts_are_not_compared():
    r = random.Random(9)
    texts = [" ".join(f"w{r.randint(0, 10**7)}" for _ in range(30)) for _ in range(2000)]
    batch = pa.RecordBatch.from_pylist([{"doc_id": i, "sig": i, "text": t} for i, t in enumerate([*texts, texts[0] + " tail", texts[0]])])
    sketch = pa.Table.from_batches(simhash._sketches(iter([batch])))
    dealt = pa.Table.from_batches(simhash._dealt(1)(iter(sketch.select(["k", "prefix"]).to_batches())))
    assert sorted(simhash._shared((0,), dealt).column("k").to_pylist()) == sorted(sketch.column("k").to_pylist()[i] for i in (0, 2000))


def test_a_passage_of_more_texts_than_a_tile_loses_no_copies(spark):
    r = random.Random(12)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(30):
        own = [f"w{r.randint(0, 10**7)}" for _ in range(60)]
        rows += [(2 * i, " ".join(own + passage)), (2 * i + 1, " ".join([*own[:20], "other", *own[21:], *passage]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x["doc_id"]: x["component_id"] for x in simhash.near_copies(docs, tile=7).collect()}
    assert got == {d: d - d % 2 for d, _ in rows}
