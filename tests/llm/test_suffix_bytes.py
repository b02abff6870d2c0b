"""The suffix index compares bytes: with a hash that tells nothing apart, results stay those of brute force."""

import random

import numpy as np

from tidemark.llm import suffix_index as s


def runs(docs):
    mini, text, pos, windows, twice, starts, data = s.runs_of([d for _, d in docs], np.zeros(1 << s._COMMON_BITS, bool))
    ids = np.array([i for i, _ in docs], np.int64)[text]
    return s.Runs(mini, ids, np.zeros(len(ids), np.int64), pos, windows, twice, starts, data)


def brute(docs):
    seen, out = set(), {}
    for d, b in docs:
        cut = np.zeros(len(b), bool)
        for i in range(len(b) - s.LENGTH + 1):
            w = b[i : i + s.LENGTH]
            cut[i : i + s.LENGTH] |= w in seen
            seen.add(w)
        out[d] = cut
    return out


def documents():
    r = random.Random(8)
    passages = ["".join(r.choices("abcd", k=r.randint(90, 400))) for _ in range(6)]
    docs = [(i, "".join(r.choices("abcd", k=r.randint(0, 150)) + r.choices(passages, k=r.randint(0, 3))).encode()) for i in range(40)]
    return [*docs, (40, b"xy" * 300), (41, b"xz" * 300), (42, b"xy" * 200)]


def test_equal_hashes_of_other_bytes(monkeypatch):
    monkeypatch.setattr(s, "run_hashes", lambda data, starts, sizes: np.zeros(len(starts), np.uint64))
    docs = documents()
    family, got = s.Family(), {d: np.zeros(len(b), bool) for d, b in docs}
    for at in range(0, len(docs), 5):
        some = runs(docs[at : at + 5])
        if len(some):
            for doc, _, a, b in family.add(some):
                for d, x, y in zip(doc.tolist(), a.tolist(), b.tolist()):
                    got[d][x:y] = True
    want = brute(docs)
    assert all(np.array_equal(got[d], want[d]) for d in want)


def test_first_runs_keeps_runs_that_only_share_a_hash(monkeypatch):
    found = runs([(0, b"a" * 150), (1, b"a" * 150), (2, b"b" * 150)])
    found.mini[:] = 7
    kept, again, first = s.first_runs(found, np.zeros(len(found), np.uint64))
    assert (kept.tolist(), again.tolist(), first.tolist()) == ([0, 2], [1], [0])
