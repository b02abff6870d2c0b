"""Decontamination: no allowed substitution hides every seed, and rows are those of all alignments without seeds."""

import random
from itertools import combinations

import duckdb
import pytest

from tidemark.llm import decontaminate as d


@pytest.mark.parametrize("n", range(1, 21))
def test_no_allowed_substitution_hides_every_seed(n):
    w = min(n, d.WINDOW)
    placed = [{i + at for i in mask} for mask in d.masks(w) for at in (range(w - d.SPAN + 1) if w == d.WINDOW else [0])]
    for gone in combinations(range(w), w - d.needed(w)):
        assert any(not seed & set(gone) for seed in placed)


def rows(docs, bench):
    c = duckdb.connect()
    c.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    c.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    c.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    c.executemany("INSERT INTO benchmark VALUES (?, ?)", bench)
    return sorted(c.sql(d.OP9_SQL).fetchall())


def test_rows_are_those_of_all_alignments(spark):
    r = random.Random(6)
    word = lambda: f"w{r.randint(0, 400)}"
    bench = [(n, " ".join(word() for _ in range(n))) for n in range(1, 21)] + [(30, None), (31, " .. "), (32, " ".join(word() for _ in range(60))), (33, "the same " * 12)]
    docs = [(0, None), (1, ""), (2, "the same " * 30)]
    for i in range(300):
        w = r.choice(bench)[1] or ""
        part = w.split()
        cut = r.randint(0, max(0, len(part) - 13)) if len(part) > 13 else 0
        part = part[cut : cut + r.choice((13, 14, 60))]
        for _ in range(r.randint(0, 4)):
            if part:
                part[r.randrange(len(part))] = "zz"
        docs.append((10 + i, " ".join([word() for _ in range(r.randint(0, 9))] + part + [word() for _ in range(r.randint(0, 9))])))
    t = spark.createDataFrame([(*x, 0, "y") for x in docs], "doc_id long, text string, item_id int, _found string")
    b = spark.createDataFrame([(*x, 0) for x in bench], "item_id long, text string, _b int")
    got = [(x["doc_id"], x["item_id"], x["matched"], x["window"]) for x in d.contaminated(t, b).collect()]
    want = rows(docs, bench)
    assert len(want) > 150 and sorted(got) == want
    kept = d.clean(t, b)
    assert kept.columns == t.columns and sorted(x["doc_id"] for x in kept.collect()) == sorted({x[0] for x in docs} - {x[0] for x in want})


def test_the_shuffled_way_gives_the_same(spark, monkeypatch):
    item = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, "x " + item), (None, item), (None, "other"), (3, "w1 w2 w3")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, item), (9, item)], "item_id long, text string")
    a = sorted(map(str, d.contaminated(docs, bench).collect()))
    monkeypatch.setattr(d, "BROADCAST_BYTES", 0)
    assert sorted(map(str, d.contaminated(docs, bench).collect())) == a and len(a) == 4
    assert d.contaminated(docs.limit(0), bench).count() == d.contaminated(docs, bench.limit(0)).count() == 0
    assert d.clean(docs, bench.limit(0)).count() == 4
