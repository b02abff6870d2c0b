"""Rows without an id go or stay by their own text."""

from tidemark.llm import decontaminate


def test_clean_keeps_rows_without_id_that_do_not_match(spark):
    item = " ".join(f"w{i}" for i in range(30))
    rows = [(None, "before " + item), (None, "a clean text"), (None, None), (1, item), (1, "clean, but of document one"), (2, "clean")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(9, item)], "item_id long, text string")
    assert {(r["doc_id"], r["text"]) for r in decontaminate.clean(docs, bench).collect()} == {(None, "a clean text"), (None, None), (2, "clean")}
    assert sorted(str(r["doc_id"]) for r in decontaminate.contaminated(docs, bench).collect()) == ["1", "None"]
