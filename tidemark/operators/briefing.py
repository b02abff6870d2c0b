"""Briefings for three audiences from the sentiment summary and the flags.

Without sentiments or flags a fixed sentence stands in their place; an audience whose request has no
answer gets a placeholder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import rendered
from tidemark.operators.annotate import REQUEST

EVIDENCE_CHARS, WARMTH = 100, 0.3
# Audiences, headings, the sentences for empty parts, the placeholder, the line of a summary.
AUDIENCES = ("trader", "analyst", "executive")
NO_SENTIMENT, NO_FLAGS, FAILED = "No entities with sentiment found.", "No QA flags raised.", "[Briefing generation failed for audience: {}]"
KNOWN, RAISED = "## Entity Sentiment Summary ({known} entities identified)", "## QA Flags"
LINE = '- {name}: {label} (avg score {score:+.2f}, confidence {confidence:.2f}) | sources: {sources} | evidence: "{evidence}..."'

VOICES = {
    "trader": "Write for a trader who acts within minutes: bullets, a table of entity, signal, confidence and level, conflicts marked; rates, central banks and EUR/USD first.",
    "analyst": "Write for a research analyst: connected paragraphs that compare sources, name them, and say where data disagree or are thin.",
    "executive": "Write for an executive with two minutes: three to five plain sentences on the situation, the largest risk and the largest opportunity; no tables.",
}


def summary_lines(summary: DataFrame) -> DataFrame:
    """(canonical_name, line) of a sentiment summary; sources in order, evidence cut."""
    line = rendered(LINE, name=F.col("canonical_name"), label=F.col("dominant_label"), score=F.col("avg_score"), confidence=F.col("avg_confidence"), sources=F.replace("sources", F.lit("|"), F.lit(", ")), evidence=F.coalesce(F.substring("evidence", 1, EVIDENCE_CHARS), F.lit("")))
    return summary.select("canonical_name", line.alias("line"))


def flag_lines(flags: DataFrame) -> DataFrame:
    """(family, place, line): `[TYPE] details`."""
    return flags.select("family", "place", F.concat(F.lit("["), F.upper("flag_type"), F.lit("] "), "details").alias("line"))


def context(summary: DataFrame, flags: DataFrame, entities: DataFrame) -> DataFrame:
    """One row (context): what all audiences' requests are about.  A report for people: its lines are one text."""
    told = summary_lines(summary).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("canonical_name", "line"))), lambda x: x["line"]), "\n").alias("told"))
    raised = flag_lines(flags).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("family", "place", "line"))), lambda x: x["line"]), "\n").alias("raised"))
    known = entities.agg(F.count(F.lit(1)).alias("known"))
    one = told.crossJoin(raised).crossJoin(known)  # one row each
    part = lambda c, other: F.when(F.col(c) == "", other).otherwise(F.col(c))
    return one.select(F.concat(rendered(KNOWN, known=F.col("known")), F.lit("\n"), part("told", NO_SENTIMENT), F.lit(f"\n\n{RAISED}\n"), part("raised", NO_FLAGS)).alias("context"))


def requests(spark: SparkSession, about: DataFrame, model: str) -> DataFrame:
    voices = spark.createDataFrame([(f"briefing:{a}", VOICES[a]) for a in AUDIENCES], "request_id string, system string")
    each = voices.crossJoin(about)  # three rows and one
    values = {"request_id": F.col("request_id"), "stage": F.lit("briefing"), "model": F.lit(model), "source_name": F.lit(""), "system": F.col("system"), "user": F.col("context"), "temperature": F.lit(WARMTH)}
    return each.select(*[values[n].alias(n) for n in REQUEST])


def briefings(spark: SparkSession, answers: DataFrame) -> DataFrame:
    """(audience, text) for every audience."""
    asked = spark.createDataFrame([(a, f"briefing:{a}", FAILED.format(a)) for a in AUDIENCES], "audience string, request_id string, _failed string")
    return asked.join(answers.select("request_id", "response"), "request_id", "left").select("audience", F.coalesce("response", "_failed").alias("text"))
