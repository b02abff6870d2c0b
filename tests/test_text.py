"""Semantic traps, with examples worked out by hand."""

from pyspark.sql import functions as F

from tidemark.functions import text as t
from tidemark.operators import analysis, content, entities
from tidemark.sources.content import chosen_sources


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x"))).first()[0]


def test_number_pattern_has_no_boundaries(spark):
    assert [tuple(r) for r in one(spark, t.numbers, "2024")] == [(202.0, ""), (4.0, "")]
    assert [tuple(r) for r in one(spark, t.numbers, "15-20 bps")] == [(15.0, ""), (-20.0, "bps")]
    assert [tuple(r) for r in one(spark, t.numbers, "1,234,567.5 million and 5 USD, 5 usd")] == [(1234567.5, "million"), (5.0, "USD"), (5.0, "usd")]


def test_normalise_and_slug(spark):
    assert one(spark, t.normalise, " THE  fed") == "fed"
    assert one(spark, t.normalise, "the the fed") == "the fed"
    assert one(spark, t.normalise, "People's Bank of China") == "peoples bank of china"
    assert one(spark, t.slug, "S&P 500") == "s_p_500"
    assert one(spark, t.slug, "日本") == ""


def test_strip_takes_all_white_space(spark):
    assert one(spark, t.strip, "\n  x \x1c") == "x"


def test_dates(spark):
    assert str(one(spark, t.parse_date, "January 5, 2024")) == str(one(spark, t.parse_date, "Jan 05, 2024")) == "2024-01-05 00:00:00"
    assert one(spark, t.parse_date, "soon") is None


def test_cap_comes_before_dedup(spark):
    rows = [("s", i, "same" if i < 5 else str(i)) for i in range(7)]
    items = spark.createDataFrame(rows, "source_name string, ord long, content_hash string")
    assert [r["ord"] for r in content.first_wins(content.cap(items)).collect()] == [0]


def test_low_confidence_joins_a_seed(spark):
    found = spark.createDataFrame([("i", 1, 1, "S&P-500", "index")], "id string, ord long, alias_ord long, surface_form string, entity_type string")
    row = entities.resolve(found, entities.alias_dimension(spark)).first()
    assert (row["canonical_id"], row["canonical_name"], row["resolution_confidence"]) == ("s_p_500", "S&P 500", 0.3)


def test_prices_and_sources(spark):
    calls = spark.createDataFrame([("openai/gpt-4o-mini-2024", 1000, 1000), ("other", 1000, 0)], "model string, prompt_tokens long, completion_tokens long")
    assert [float(r["estimated_cost"]) for r in analysis.priced(calls).collect()] == [0.00075, 0.001]
    assert chosen_sources(["imf", "nope", "fed"]) == ["fed", "imf"]


def test_difference_is_strict_and_relative_to_the_first(spark):
    rows = [("m", 0, 0, "a", 0.0), ("m", 1, 0, "b", 1.0), ("m", 2, 0, "c", 1.005), ("m", 3, 0, "d", 1.02)]
    found = analysis.inconsistencies(spark.createDataFrame(rows, "metric string, ord long, nth long, source_name string, value double"))
    assert {(r["value_a"], r["value_b"]) for r in found.collect()} == {(1.0, 1.02), (1.005, 1.02)}


def test_coercion_of_labels_and_ranges(spark):
    rows = spark.createDataFrame([("odd", 3.0, 1.7), ("bearish", -3.0, -1.0), ("neutral", float("nan"), float("nan")), (None, 0.5, 0.25)], "l string, s double, c double")
    got = [tuple(r) for r in rows.select(*analysis.coerced(F.col("l"), F.col("s"), F.col("c"))).collect()]
    assert got == [("neutral", 1.0, 1.0), ("bearish", -1.0, 0.0), ("neutral", 1.0, 1.0), ("neutral", 0.5, 0.25)]


def test_ties_and_nulls_in_the_summary(spark):
    rows = [("x", 2, "bearish", 0.0, 0.5, "s2", "two"), ("x", 1, "bullish", 1.0, None, "s1", "one"), ("y", 3, "neutral", None, None, None, None)]
    found = analysis.summary(spark.createDataFrame(rows, "canonical_name string, ord long, label string, score double, confidence double, source_name string, evidence_span string"))
    assert [(r["canonical_name"], r["dominant_label"], r["avg_score"], r["avg_confidence"], r["sources"], r["evidence"]) for r in found.collect()] == [("x", "bullish", 0.5, 0.5, "s1|s2", "one"), ("y", "neutral", None, None, "", None)]
    assert analysis.summary(found.limit(0).select("canonical_name", F.lit(1).alias("ord"), F.lit("a").alias("label"), F.lit(1.0).alias("score"), F.lit(1.0).alias("confidence"), F.lit("s").alias("source_name"), F.lit("e").alias("evidence_span"))).count() == 0


def test_results_do_not_depend_on_the_partitions(spark):
    from tidemark.plans import catalog

    seen = []
    for n in ("1", "4", "17"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        seen.append([sorted(map(str, catalog.QUERIES[q](spark, "/root/testdata/sf0.001").collect())) for q in ("cap_then_dedup", "ner_batches", "unresolved_surfaces", "unresolved_flags")])
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert seen[0] == seen[1] == seen[2]
