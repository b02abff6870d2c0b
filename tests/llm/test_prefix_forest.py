"""The forest against brute force: recall, scores, ranks and ties, and rows that take no part."""

import numpy as np

from tidemark.llm import prefix_forest as f

SF = "/root/testdata/sf0.01"


def brute(ids, x, q, top=5):
    u = x / np.sqrt((x * x).sum(1, keepdims=True))
    score = u @ u[q]
    order = np.lexsort((ids, -score))
    return [(int(ids[i]), float(score[i])) for i in order if ids[i] != ids[q]][:top]


def test_query_on_the_table(spark):
    t = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    ids, x = t["vec_id"].to_numpy(), np.array(t["embedding"].tolist(), float)
    got = {}
    for r in f.op3_prefix_forest(spark, SF).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = total = 0
    assert set(got) == {int(i) for i in ids if i % 50 == 0}
    for q, rows in got.items():
        want = brute(ids, x, int(np.flatnonzero(ids == q)[0]))
        rows.sort()
        assert [r[0] for r in rows] == [1, 2, 3, 4, 5] and [r[2] for r in rows] == sorted((r[2] for r in rows), reverse=True)
        true = dict(want)
        assert all(abs(s - true[i]) < 1e-12 for _, i, s in rows if i in true)
        hits += len({r[1] for r in rows} & set(true))
        total += len(want)
    assert hits >= 0.95 * total


def test_recall_where_only_a_share_is_compared():
    r = np.random.default_rng(5)
    x = f._units(r.standard_normal((8000, 64)))
    queries = np.arange(0, 8000, 50)
    sims = x[queries] @ x.T
    sims[np.arange(len(queries)), queries] = -2
    want = np.argsort(-sims, axis=1)[:, :5]
    found = dict(f.Forest(x).candidates(f.hash_strings(x[queries]), int(f.SHARE * 8000)))
    assert all(len(v) == int(f.SHARE * 8000) for v in found.values())
    recall = np.mean([np.isin(w, found[i]).mean() for i, w in enumerate(want)])
    assert recall >= 0.9


def test_ties_copies_and_rows_without_a_part(spark):
    a, b, c = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [1.0, 1.0, 0.0]
    rows = [(50, a), (9, a), (3, a), (7, b), (4, b), (8, c), (1, c), (2, None), (5, [0.0] * 3), (6, [float("nan"), 1.0, 0.0]), (10, [None, 1.0, 0.0]), (11, [1.0, 0.0]), (None, a), (12, []), (9, a)]
    t = spark.createDataFrame([(*x, 0, 1) for x in rows], "vec_id long, embedding array<double>, rank int, _id int")
    got = [(r["rank"], r["vec_id"], round(r["score"], 12)) for r in f.nearest(t, t.where("vec_id = 50")).orderBy("rank").collect()]
    half = round(0.5**0.5, 12)
    assert got == [(1, 3, 1.0), (2, 9, 1.0), (3, 1, half), (4, 8, half), (5, 4, 0.0)]
    assert f.nearest(t, t.where("vec_id = 2")).count() == f.nearest(t, t.limit(0)).count() == f.nearest(t.limit(0), t).count() == 0
    alone = spark.createDataFrame([(50, a)], "vec_id long, embedding array<double>")
    assert f.nearest(alone, alone).count() == 0
    many = spark.createDataFrame([(i, a) for i in range(400)] + [(1000, b)], "vec_id long, embedding array<double>")
    assert [r["vec_id"] for r in f.nearest(many, many.where("vec_id = 1000"), shard_rows=50).orderBy("rank").collect()] == [0, 1, 2, 3, 4]
