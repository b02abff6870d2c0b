"""The corpus pipeline: each stage and the whole against brute force, on documents with nulls, repeats and clashing columns."""

import zlib
from collections import Counter

import corpus_pipeline
import duckdb
import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import toxicity
from tidemark.llm.decontaminate import OP9_SQL
from tidemark.llm.tokens import tokenizer_path

SPACE = " \t\n\x0b\x0c\r"


def pairs(df):
    return Counter((r["doc_id"], r["text"]) for r in df.collect())


def lines_left(rows):
    keys, lower = {}, str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    last = 2**63 - 1
    key = lambda x: x.strip(SPACE).translate(lower)
    for d, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 10:
                keys.setdefault(key(x), set()).add(last if d is None else d)
    gone = lambda d, x: len(keys.get(key(x), ())) >= 2 and (last if d is None else d) > min(keys[key(x)])
    return [(d, "\n".join(x for x in (t or "").split("\n") if not gone(d, x))) for d, t in rows]


def one_of_each(rows):
    held = sorted({(d is None, d or 0, t or "") for d, t in rows})
    sets = []
    for _, _, t in held:
        w = t.encode().lower().split()
        sets.append({b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    group = list(range(len(held)))
    linked = [[j for j, y in enumerate(sets) if x == y or x and y and len(x & y) >= 0.8 * len(x | y)] for x in sets]
    while True:
        new = [min(group[j] for j in some) for some in linked]
        if new == group:
            break
        group = new
    return {group[i]: held[i] for i in reversed(range(len(held)))}, held, group


def test_stages_and_whole(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "simhash", "decontamination", "packing"]

    def staged(name, before):
        out = stages[name](spark, before, folder)
        assert name == "packing" or out.schema == before.schema
        out.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    one = staged("toxicity", docs)
    model = toxicity.train(toxicity.training_rows(docs.select("doc_id", "text"), spark.read.parquet(f"{folder}/labels.parquet")))
    bad = Counter()
    for r, s in zip(docs.select("doc_id", "text").collect(), toxicity.scores(docs, model).collect()):
        assert r["doc_id"] == s["doc_id"]
        bad[r["doc_id"], r["text"]] += s["score"] >= 0.3
    assert pairs(one) == Counter({k: n - bad[k] for k, n in pairs(docs).items() if n > bad[k]})

    two = staged("line_dedup", one)
    assert pairs(two) == Counter(lines_left(list(pairs(one).elements())))
    assert two.where(~F.col("n_chars").eqNullSafe(F.char_length("text"))).count() == two.where("text IS NULL").count() == 0 and set(two.select("n_lines").distinct().toPandas()["n_lines"]) == {1}

    three = staged("simhash", two)
    _, held, group = one_of_each(list(pairs(two).elements()))
    number = {(None if n else d, t): g for (n, d, t), g in zip(held, group)}
    kept = pairs(three)
    assert max(kept.values()) == 1 and Counter(number[k] for k in kept) == Counter(set(group))
    for (d, t), _ in kept.items():  # the smallest id of its group, ids before none
        mates = [(n, i) for (n, i, _), g in zip(held, group) if g == number[d, t]]
        assert (d is None, d or 0) == min(mates)

    four = staged("decontamination", three)
    c = duckdb.connect()
    c.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    c.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{folder}/benchmark.parquet/*.parquet'")
    names = list(enumerate(kept))
    c.executemany("INSERT INTO documents VALUES (?, ?)", [(i, t) for i, (_, t) in names])
    found = {r[0] for r in c.sql(f"SELECT DISTINCT doc_id FROM ({OP9_SQL})").fetchall()}
    ids_found = {k[0] for i, k in names if i in found and k[0] is not None}
    assert pairs(four) == Counter(k for i, k in names if i not in found and (k[0] is None or k[0] not in ids_found)) and found

    five = staged("packing", four)
    t = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    texts = {}
    for d, x in pairs(four):
        texts.setdefault(d, []).append(np.array([*t.encode(x, add_special_tokens=False).ids, 0], "<u4"))
    pieces = [tuple(r[c] for c in ("doc_id", "start", "length", "ids_crc32")) for r in five.collect()]
    assert sum(n for _, _, n, _ in pieces) == sum(len(x) for xs in texts.values() for x in xs)
    assert all(any(zlib.crc32(x[a : a + n].tobytes()) == crc for x in texts[d]) for d, a, n, crc in pieces)

    whole = corpus_pipeline.run(spark, folder)
    assert whole.columns == five.columns
    assert Counter(tuple(r[c] for c in ("doc_id", "doc_tokens")) for r in whole.where("start = 0").collect()) == Counter(tuple(r[c] for c in ("doc_id", "doc_tokens")) for r in five.where("start = 0").collect())


def test_empty_tables(spark, empty_folder):
    assert corpus_pipeline.run(spark, empty_folder).count() == 0
