"""Sinks and matching on small tables."""

import json

from tidemark.operators import matching, sinks


def test_files_hold_the_rows(spark, tmp_path):
    rows = spark.createDataFrame([("retail", "a"), ("fund", "b")], "audience string, text string")
    for _ in range(2):  # the second run replaces the first
        sinks.write_results({"notes": rows}, str(tmp_path))
        sinks.write_briefings(rows, str(tmp_path))
    assert {tuple(r) for r in spark.read.json(f"{tmp_path}/notes").select("audience", "text").collect()} == {("retail", "a"), ("fund", "b")}
    assert spark.read.text(f"{tmp_path}/briefings/audience=fund").first()[0] == "b"


def test_cost_report(spark):
    rows = spark.createDataFrame([("x", "", 1.0), ("x", "s", 2.0), ("y", "s", 0.5)], "stage string, source_name string, estimated_cost double")
    assert json.loads(sinks.cost_report(rows, "r").first()[0]) == {"run_id": "r", "total_cost_usd": 3.5, "by_stage": {"x": 3.0, "y": 0.5}, "by_source": {"s": 2.5}}


def test_match_takes_the_strong_pass_first(spark):
    entities = spark.createDataFrame([(1, 0, "bank_of_x", "Bank of X", "box"), (1, 1, "dax", "DAX", "dax")], "item long, place long, canonical_id string, canonical_name string, surface_form string")
    said = [(1, 0, "the DAX bank"), (1, 1, "bank news"), (1, 2, "BOX"), (1, 3, "of"), (1, 4, "zz"), (1, 5, ""), (1, 6, None), (2, 0, "dax")]
    found = matching.match(spark.createDataFrame(said, "item long, nth long, surface string"), entities)
    assert {r["nth"]: r["canonical_id"] for r in found.collect()} == {0: "dax", 1: "bank_of_x", 2: "bank_of_x", 3: "bank_of_x", 5: "bank_of_x"}


def test_links_end_at_the_first_repeat(spark):
    rows = spark.createDataFrame([(1, i, u) for i, u in enumerate("abcbd")] + [(2, i, str(i)) for i in range(25)], "page long, pos long, url string")
    kept = [(r["page"], r["pos"]) for r in matching.until_repeat(rows, "page", "url", "pos").collect()]
    assert sorted(kept) == [(1, 0), (1, 1), (1, 2)] + [(2, i) for i in range(20)]
