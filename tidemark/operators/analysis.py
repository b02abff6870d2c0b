"""Sentiment rows, the quality checks, summaries and annotation cost.

Null sources and values take part in no pair; a null or unknown label is neutral; rows that repeat give
their pairs again where an operator says pairs, and count again in means; empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.text import rendered
from tidemark.runtime import materialise

LABELS = ("bullish", "bearish", "neutral")
LEAST_CONFIDENCE, LEAST_DIFFERENCE = 0.6, 0.005
#: Tasks that one key's pairs are dealt to.
SALTS = 16
# The metrics, their patterns ignoring case.
METRICS = {
    "EUR/USD rate": r"(?:EUR/USD|EURUSD|euro.*dollar)\D{0,20}(\d+\.\d{2,6})",
    "USD/JPY rate": r"(?:USD/JPY|USDJPY|dollar.*yen)\D{0,20}(\d{2,4}\.\d{1,4})",
    "interest rate": r"(?:interest rate|fed funds rate|federal funds rate)\D{0,20}(\d+\.?\d*)\s*%",
    "CPI": r"(?:CPI|consumer price index)\D{0,20}(\d+\.?\d*)\s*%",
    "GDP": r"(?:GDP|gross domestic product)\D{0,20}(\d+\.?\d*)\s*%",
}
# The flags' messages.
CONFLICT = "'{name}' is {la} ({ca:.2f}) per {sa}, but {lb} ({cb:.2f}) per {sb}."
LOST = "Entity '{form}' (type: {kind}) could not be resolved."
DOUBTFUL = "Entity '{form}' resolved to '{id}' with low confidence ({sure:.2f})."
APART = "'{metric}' shows inconsistent values across sources: {va} ({sa}) vs {vb} ({sb}), difference: {d:.1%}."
# Price for 1000 tokens in and out, the first model name contained wins.
PRICES = (("gpt-4o-mini", "0.00015", "0.0006"), ("gpt-4o", "0.0025", "0.01"), ("gpt-4-turbo", "0.01", "0.03"))
OTHER_PRICE = ("0.001", "0.003")


def coerced(label: Column, score: Column, confidence: Column) -> tuple[Column, Column, Column]:
    return F.when(label.isin(*LABELS), label).otherwise("neutral"), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), score)), F.greatest(F.lit(0.0), F.least(F.lit(1.0), confidence))


def _salted(left: DataFrame, right: DataFrame, key: str, own: str) -> DataFrame:
    """An equi join on key whose left rows with one key are dealt to SALTS tasks, each with all of right's."""
    a = left.withColumn("_salt", F.pmod(F.xxhash64(own), F.lit(SALTS)).cast("int"))
    b = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return a.join(b, [key, "_salt"]).drop("_salt")


def conflicts(rows: DataFrame) -> DataFrame:
    """Pairs of bullish and bearish rows of one entity from different sources, both confident enough.

    Both sides are reduced to confident bullish or bearish rows before the join on the entity.  Every
    pair is wanted, so the result has bulls x bears rows for each entity; an entity's are dealt out.
    """
    sure = rows.where((F.col("confidence") >= LEAST_CONFIDENCE) & F.col("label").isin("bullish", "bearish"))
    sure = materialise(sure.select("canonical_id", "canonical_name", "ord", "label", "confidence", "source_name"), "sure")  # both sides, from one pass over the texts
    a, b = (sure.select("canonical_id", *([F.col("canonical_name")] if x == "a" else []), *[F.col(c).alias(f"{c}_{x}") for c in ("ord", "label", "confidence", "source_name")]) for x in "ab")
    return _salted(a, b, "canonical_id", "ord_a").where("ord_a < ord_b AND label_a <> label_b AND source_name_a <> source_name_b")


def summary(rows: DataFrame) -> DataFrame:
    """For each canonical name: means, the commonest label (first seen on a tie), sources, first evidence."""
    place = F.struct(*[c for c in ("ord", "nth", "alias_ord") if c in rows.columns])
    # One pass: by name and label first, then by name.
    each = rows.groupBy("canonical_name", "label").agg(
        F.count(F.lit(1)).alias("n"), F.min(place).alias("first"), F.sum("score").alias("score"), F.count("score").alias("scores"), F.sum("confidence").alias("confidence"), F.count("confidence").alias("confidences"),
        F.collect_set("source_name").alias("sources"), F.min_by("evidence_span", place).alias("evidence"),
    )
    out = each.groupBy("canonical_name").agg(
        F.try_divide(F.sum("score"), F.sum("scores")).alias("avg_score"),
        F.try_divide(F.sum("confidence"), F.sum("confidences")).alias("avg_confidence"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("sources")))), "|").alias("sources"),
        F.min_by("evidence", "first").alias("evidence"),
        F.min_by("label", F.struct(-F.col("n"), "first")).alias("dominant_label"),
    )
    return out.orderBy("canonical_name")


def readings(items: DataFrame, patterns: dict[str, str] | None = None) -> DataFrame:
    """(metric, ord, nth, source_name, value): all readings of each metric's pattern, whose group 1 is the number.

    One pass over the texts tries all patterns.  A text may give several readings; `.` stops at line ends.
    """
    patterns = METRICS if patterns is None else patterns
    tried = F.array(*[F.struct(F.lit(m).alias("metric"), F.regexp_extract_all("combined", F.lit(f"(?i){p}"), F.lit(1)).alias("values")) for m, p in patterns.items()])
    each = items.select("ord", "source_name", F.explode(tried).alias("_m")).select("ord", "source_name", "_m.metric", F.posexplode("_m.values").alias("nth", "_v"))
    return each.select("metric", "ord", F.col("nth").cast("long").alias("nth"), "source_name", F.col("_v").cast("double").alias("value"))


def inconsistencies(found: DataFrame) -> DataFrame:
    """(metric, value_a, value_b, source_a, source_b, difference, first): readings that differ by more than the threshold.

    The difference is relative to the earlier reading; those of zero are skipped.  Readings are first
    folded to the first and last place of each value and source, so the join meets distinct values
    only, as many as there are distinct messages; a metric's are dealt out.  first is the place of the
    earlier reading.
    """
    place = F.struct("ord", "nth")
    each = materialise(found.groupBy("metric", "value", "source_name").agg(F.min(place).alias("first"), F.max(place).alias("last")), "readings")
    a = each.where("value <> 0").select("metric", F.col("value").alias("value_a"), F.col("source_name").alias("source_a"), "first")
    b = each.select("metric", F.col("value").alias("value_b"), F.col("source_name").alias("source_b"), "last")
    difference = F.abs(F.col("value_a") - F.col("value_b")) / F.abs("value_a")
    met = _salted(a, b, "metric", "value_a").where((F.col("source_a") != F.col("source_b")) & (F.col("first") < F.col("last")))
    return met.withColumn("difference", difference).where(F.col("difference") > LEAST_DIFFERENCE).select("metric", "value_a", "value_b", "source_a", "source_b", "difference", "first")


# The three families of flags, with their messages.

FLAG = "flag_type string, entity_id string, details string, sources array<string>, family int"


def _flags(rows: DataFrame, family: int, kind: str, entity: Column, details: Column, sources: Column, place: Column) -> DataFrame:
    return rows.select(F.lit(kind).alias("flag_type"), entity.cast("string").alias("entity_id"), details.alias("details"), sources.alias("sources"), F.lit(family).alias("family"), place.cast("string").alias("place"))


def conflict_flags(pairs: DataFrame) -> DataFrame:
    """One flag a pair, never folded."""
    said = rendered(CONFLICT, name=F.col("canonical_name"), la=F.col("label_a"), ca=F.col("confidence_a"), sa=F.col("source_name_a"), lb=F.col("label_b"), cb=F.col("confidence_b"), sb=F.col("source_name_b"))
    return _flags(pairs, 0, "sentiment_conflict", F.col("canonical_id"), said, F.array("source_name_a", "source_name_b"), _place(F.col("ord_a"), F.col("ord_b")))


def resolution_flags(low: DataFrame) -> DataFrame:
    """low: rows of ``entities.unresolved_flags``."""
    lost = rendered(LOST, form=F.col("surface_form"), kind=F.col("entity_type"))
    doubtful = rendered(DOUBTFUL, form=F.col("surface_form"), id=F.coalesce("canonical_id", F.lit("")), sure=F.col("resolution_confidence"))
    return _flags(low, 1, "unresolved_entity", F.col("canonical_id"), F.when(F.col("canonical_id").isNull(), lost).otherwise(doubtful), F.array("source_content_id"), _place(F.col("place.ord"), F.col("place.alias_ord")))


def number_flags(found: DataFrame) -> DataFrame:
    """found: rows of ``inconsistencies``; of flags with one message the first stays."""
    said = rendered(APART, metric=F.col("metric"), va=F.col("value_a"), sa=F.col("source_a"), vb=F.col("value_b"), sb=F.col("source_b"), d=F.col("difference"))
    rows = _flags(found, 2, "numeric_inconsistency", F.lit(None), said, F.array("source_a", "source_b"), _place(F.col("first.ord"), F.col("first.nth")))
    return rows.groupBy("flag_type", "entity_id", "details", "family").agg(F.min_by("sources", "place").alias("sources"), F.min("place").alias("place")).select(*rows.columns)


def _place(*order: Column) -> Column:
    """Numbers as text that sorts like them."""
    return F.concat_ws(".", *[F.lpad(o.cast("string"), 20, "0") for o in order])


def quality_flags(sentiments: DataFrame, low: DataFrame, found: DataFrame) -> DataFrame:
    """All flags, the families in order; within one by place."""
    all_ = conflict_flags(conflicts(sentiments)).unionByName(resolution_flags(low)).unionByName(number_flags(inconsistencies(found)))
    return all_.orderBy("family", "place", "details")


def priced(calls: DataFrame) -> DataFrame:
    """Adds estimated_cost, exact decimals."""
    price = lambda i: F.coalesce(*[F.when(F.contains("model", F.lit(p[0])), F.lit(p[i + 1]).cast("decimal(10,5)")) for p in PRICES], F.lit(OTHER_PRICE[i]).cast("decimal(10,5)"))
    cost = (F.col("prompt_tokens").cast("decimal(18,0)") * price(0) + F.col("completion_tokens").cast("decimal(18,0)") * price(1)) / F.lit(1000).cast("decimal(4,0)")
    return calls.withColumn("estimated_cost", cost.cast("decimal(18,8)"))


def cost_by(records: DataFrame, key: str) -> DataFrame:
    return records.where(F.col(key) != "").groupBy(key).agg(F.sum("estimated_cost").cast("double").alias("cost"))


def top_by_order(rows: DataFrame, group: str, order: str, n: int) -> DataFrame:
    return rows.withColumn("_n", F.row_number().over(W.partitionBy(group).orderBy(order))).where(F.col("_n") <= n).drop("_n")
