"""A small set of tables: the smallest documents, and rows with nulls, empty texts, repeats and clashing columns."""

import pytest

SF = "/root/testdata/sf0.001"
#: Names that operators use inside, as columns of the documents.
CLASHES = {"n_lines": 1, "n_dropped": 2, "_kept": 3, "_found": 4, "_rest": 5, "fp": 6, "key": 7, "kept_id": 8, "found_id": 9, "component_id": 10, "score": 11}


@pytest.fixture(scope="session")
def rows(spark):
    """(doc_id, text) of the table `documents` in `folder`."""
    held = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    long = " ".join(f"word{i % 977}" for i in range(30_000))
    extra = [(10_001, None), (10_002, ""), (10_003, " \n\t "), (10_004, "x"), (10_005, long), (None, "a text without an id"), (None, None), (None, held[3][1])]
    return [*held, *extra, held[0], held[0], (held[1][0], "another text of that id"), (10_006, "é\u0085 Ä İ\x00 ퟿日本"), (10_006, "é\u0085 Ä İ\x00 ퟿日本")]


@pytest.fixture(scope="session")
def folder(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    names = ", ".join(f"{c} int" for c in CLASHES)
    docs = spark.createDataFrame([(d, t, "en", "s", 0, *CLASHES.values()) for d, t in rows], f"doc_id long, text string, lang string, source string, n_chars long, {names}")
    docs.repartition(3).write.parquet(f"{path}/documents.parquet")
    for t in ("labels", "benchmark", "embeddings"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{path}/{t}.parquet")
    return path


@pytest.fixture(scope="session")
def empty_folder(spark, folder, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty"))
    for t in ("documents", "labels", "benchmark", "embeddings"):
        spark.read.parquet(f"{folder}/{t}.parquet").limit(0).write.parquet(f"{path}/{t}.parquet")
    return path
