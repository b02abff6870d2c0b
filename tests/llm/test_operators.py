"""The operators against brute force on small fixtures, with nulls, empty texts, repeats and clashing columns."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from tidemark.llm import decontaminate, huffman, lattice, line_dedup, packing, pii, prefix_forest, simhash, suffix_index, tokens, toxicity

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()


def corpus(n=60, seed=3):
    r = random.Random(seed)
    rows = [(i, " ".join(r.choices(WORDS, k=r.randint(0, 120))) + ("\nA common line here\n" if i % 3 == 0 else "")) for i in range(n)]
    return [*rows, (n, rows[5][1]), (n + 1, rows[5][1] + " x"), (n + 2, None), (n + 3, ""), (n + 4, "é" * 150 + "a" * 300)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(d, t, "x", 1, 2) for d, t in corpus()], "doc_id long, text string, fp string, n_lines long, key int")


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def test_packing_covers_every_id():
    r = random.Random(1)
    for n in (0, 1, 5, 400, 2000):
        sizes = [r.randint(1, 2500) for _ in range(n)]
        out = packing.pack(sizes)
        assert all(0 < sum(p[2] for p in s) <= 1024 and all(p[2] > 0 for p in s) for s in out)
        pieces = sorted(p for s in out for p in s)
        for d, size in enumerate(sizes):
            own = [p for p in pieces if p[0] == d]
            assert [p[1] for p in own] == [sum(q[2] for q in own[:i]) for i in range(len(own))] and sum(p[2] for p in own) == size
        if n >= 400:
            assert len(out) <= 1.02 * sum(sizes) / 1024 + 1


def test_tokens_are_those_of_the_whole_text():
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        w = tokens.WordTokenizer(tokens.tokenizer_path(name))
        texts = ["  a  b", "a\n b", " x", "x ", "", "a. b, c.", "it's \n\n ok", "a\x01 b", "ÄΣ. 12, !!", "<|endoftext|> a", "a  b"]
        for _ in range(2):
            for t, x in zip(texts, w.ids(texts)):
                assert np.frombuffer(x, w.dtype).tolist() == w.tokenizer.encode(t, add_special_tokens=False).ids


def test_huffman_round_trip():
    r = np.random.default_rng(2)
    ids = np.minimum((r.pareto(0.7, 5000) * 3).astype(np.int64), 4000)
    counts = np.bincount(ids, minlength=4001)
    lengths = huffman.code_lengths(counts, 13)
    used = lengths[lengths > 0].astype(float)
    assert used.max() <= 13 and (2.0**-used).sum() <= 1
    bits, at = huffman.encode(ids, huffman.canonical_codes(lengths), lengths)
    starts, runs = huffman.checkpoints_of(np.array([1, 999, 4000]), 64)
    assert np.array_equal(huffman.Decoder(lengths).decode(bits, at[starts], runs), ids)


def test_lattice_sums_over_all_segmentations():
    pieces, p = lattice.vocabulary(tokens.tokenizer_path("piece_bpe_32k.model"))
    model = lattice.Lattice(pieces, p)
    for word in (b"the", b"thtiononand", "tién".encode(), b"ab" * 40):
        w, a = b" " + word, [1.0]
        for j in range(1, len(w) + 1):
            a.append(sum(a[i] * p[model.index[w[i:j]]] for i in range(j) if w[i:j] in model.index))
        assert np.isclose(model.marginals([word])[0], np.log(a[-1]))
        assert np.isclose(sum(len(pieces[i]) * x for i, x in enumerate(model.expected([word], np.ones(1))[0])), len(w))


def test_line_dedup(spark, docs):
    got = {r["doc_id"]: r for r in line_dedup.clean(docs, counts=("n_lines", "n_dropped")).collect()}
    keys, first = {}, {}
    for d, t in corpus():
        for line in (t or "").split("\n"):
            k = line.strip(" \t\n\x0b\x0c\r").lower()
            if len(k) >= 10:
                keys.setdefault(k, set()).add(d)
    for d, t in corpus():
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(keys.get(k := x.strip(" \t\n\x0b\x0c\r").lower(), ())) >= 2 and d > min(keys[k]))]
        assert (got[d]["text"], got[d]["n_dropped"]) == ("\n".join(kept), len(lines) - len(kept))
    assert line_dedup.clean(docs).columns == docs.columns  # the documents' own n_lines stays
    assert {r["n_lines"] for r in line_dedup.clean(docs).collect()} == {1}
    assert line_dedup.clean(empty(spark)).count() == 0


def test_simhash(spark, docs):
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs).collect()}
    fps = {d: simhash.fingerprint(t or "") for d, t in corpus()}
    group = {d: d for d in fps}
    for _ in fps:
        for a in fps:
            group[a] = min(group[b] for b in fps if (fps[a] ^ fps[b]).bit_count() <= 4)
    assert {d: r["component_id"] for d, r in got.items()} == group
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_suffix_index(spark, docs):
    seen = set()
    got = {r["doc_id"]: r for r in suffix_index.removed(docs, shard_bytes=4096, batch_windows=500).collect()}
    for d, t in corpus():
        b = (t or "").encode()
        cut = np.zeros(len(b), bool)
        for i in range(len(b) - 99):
            if b[i : i + 100] in seen:
                cut[i : i + 100] = True
            seen.add(b[i : i + 100])
        kept = bytes(np.frombuffer(b, np.uint8)[~cut])
        assert (got[d]["n_removed"], got[d]["kept_sha256"]) == (int(cut.sum()), hashlib.sha256(kept).hexdigest())
    assert suffix_index.removed(empty(spark)).count() == 0


def test_pii():
    spans = lambda t: {(pii.KINDS[k], t[a:b]) for a, k, b in pii.all_spans(t)[1]}
    assert spans("to jo.x@a.example.com, 10.0.0.1 or +1 (212) 555-1234") == {("email", "jo.x@a.example.com"), ("ip", "10.0.0.1"), ("phone", "+1 (212) 555-1234")}
    assert spans("4111 1111 1111 1111") == {("card", "4111 1111 1111 1111")}
    assert spans("jo (at) example (dot) com") == {("email", "jo (at) example (dot) com")}
    assert spans("jо@ex.com") == {("email", "jо@ex.com")}
    assert spans("plus one two one two five five five one two three four") == {("phone", "plus one two one two five five five one two three four")}
    assert spans("look at example.com") == spans("") == set()


def test_decontamination(spark):
    r = random.Random(5)
    words = [f"w{r.randint(0, 10**6)}" for _ in range(40)]
    changed = [w if i % 9 else "zzz" for i, w in enumerate(words)]
    rows = [(1, "before " + " ".join(words) + " after"), (2, "x " + " ".join(changed)), (3, " ".join(words[:8])), (4, None), (5, "")]
    docs = spark.createDataFrame([(*x, 0) for x in rows], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(9, " ".join(words)), (10, None), (11, "short one")], "item_id long, text string")
    assert {(x["doc_id"], x["item_id"]) for x in decontaminate.contaminated(docs, bench).collect()} == {(1, 9), (2, 9)}
    assert sorted(x["doc_id"] for x in decontaminate.clean(docs, bench).collect()) == [3, 4, 5]


def test_nearest(spark):
    x = np.random.default_rng(1).standard_normal((300, 8))
    x[7] = x[3]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(300, None), (301, [0.0] * 8), (302, [float("nan")] * 8)]
    t = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r["query_id"], r["vec_id"]) for r in prefix_forest.nearest(t, t.where("vec_id % 50 = 0"), shard_rows=100).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = {(q, int(j)) for q in range(0, 300, 50) for j in np.argsort(-np.where(np.arange(300) == q, -2, u @ u[q]))[:5]}
    assert len(got) == len(want) and len(got & want) >= 0.9 * len(want)


def test_toxicity(spark):
    r = random.Random(7)
    rows = [(i, " ".join(r.choices(WORDS, k=40) + (["grobian"] if i % 3 == 0 else []))) for i in range(300)]
    docs = spark.createDataFrame([*rows, (300, None), (301, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id long, toxic int")
    model = toxicity.train(toxicity.training_rows(docs, labels))
    wrong = [x for x in toxicity.scores(docs, model).collect() if (x["score"] >= 0.3) != (x["doc_id"] < 300 and x["doc_id"] % 3 == 0)]
    assert not [x for x in wrong if zlib.crc32(str(x["doc_id"]).encode()) % 4 == 2 and x["doc_id"] < 300] and toxicity.kept(docs, model).count() <= 202
