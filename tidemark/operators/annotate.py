"""The annotator boundary: requests out, JSON answers in.  Everything on both sides is a DataFrame plan.

Requests: (request_id, stage, model, source_name, system, user, temperature).  Answers: (request_id,
response, prompt_tokens, completion_tokens); a request without an answer, or with a null one, has failed
and gives no rows.  ``recorded`` looks answers up in a table, ``remote`` asks a chat endpoint and writes
what comes back, so that no call is made twice.

Answers are read as variants, so one element of a wrong type never hides the others: an element that is
no object, or a field of a wrong type, drops that element; text that isn't JSON gives no rows.
"""

from __future__ import annotations

import json
import time
import urllib.request
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text as t
from tidemark.operators import analysis, matching
from tidemark.runtime import importable, materialise
from tidemark.sources.live import waits

REQUEST = ("request_id", "stage", "model", "source_name", "system", "user", "temperature")
ANSWER = "request_id string, response string, prompt_tokens long, completion_tokens long"
ATTEMPTS, WAIT = 3, 2.5
# Defaults of absent fields, the kinds of entities.
UNKNOWN, SOME_CONFIDENCE, NO_SCORE = "unknown", 0.5, 0.0
KINDS = ("currency_pair", "index", "central_bank", "indicator", "company", "person")

FIND = f"""Find every financial entity that the numbered articles name. Kinds: {", ".join(KINDS)}.
Answer with JSON alone: {{"articles": {{"<number>": {{"entities": [{{"surface_form": "...", "entity_type": "..."}}]}}}}}}.
A surface form stands in its article letter for letter; an article without entities has an empty list."""
MERGE = f"""Group the names below that mean the same thing and give each group its full name.
Answer with JSON alone: {{"resolutions": [{{"surface_forms": ["..."], "canonical_name": "...", "entity_type": "...", "confidence": 0.0}}]}}.
Kinds: {", ".join(KINDS)}. Keep names apart if in doubt; a doubtful group has a confidence under 0.5."""
JUDGE = """For each entity below, say how the article speaks of that entity, not of the whole.
Answer with JSON alone: {"sentiments": [{"entity_surface_form": "...", "label": "bullish|bearish|neutral", "score": 0.0, "confidence": 0.0, "evidence_span": "..."}]}.
score is from -1 to 1, confidence from 0 to 1, evidence_span a passage of the article; leave out entities that it doesn't name."""


def _request(stage: str, key: Column, model: str, source: Column, system: str, user: Column, temperature: float = 0.0) -> list[Column]:
    values = (F.concat(F.lit(f"{stage}:"), key.cast("string")), F.lit(stage), F.lit(model), source, F.lit(system), user, F.lit(temperature))
    return [v.alias(n) for v, n in zip(values, REQUEST)]


def recorded(requests: DataFrame, answers: DataFrame) -> DataFrame:
    return requests.join(answers, "request_id").where("response IS NOT NULL").select(*[c.split()[0] for c in ANSWER.split(", ")])


def ask(url: str, key: str, model: str, system: str, user: str, temperature: float, as_json: bool, timeout: float, attempts: int, wait: float) -> tuple[str, int, int]:
    body = {"model": model, "temperature": temperature, "messages": [{"role": "system", "content": system}, {"role": "user", "content": user}]} | ({"response_format": {"type": "json_object"}} if as_json else {})
    for pause in [*waits(attempts, wait), None]:
        try:
            request = urllib.request.Request(f"{url.rstrip('/')}/chat/completions", json.dumps(body).encode(), {"Content-Type": "application/json", "Authorization": f"Bearer {key}"})
            with urllib.request.urlopen(request, timeout=timeout) as answer:
                found = json.load(answer)
            usage = found.get("usage") or {}
            return found["choices"][0]["message"].get("content") or "", int(usage.get("prompt_tokens", 0)), int(usage.get("completion_tokens", 0))
        except Exception:
            if pause is None:
                raise
            time.sleep(pause)
    raise AssertionError


def remote(requests: DataFrame, url: str, key: str = "", as_json: bool = True, workers: int = 6, timeout: float = 60.0, attempts: int = ATTEMPTS, wait: float = WAIT) -> DataFrame:
    """Answers of a chat endpoint, `workers` calls at a time, written before anything reads them."""
    importable(requests.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                try:
                    yield pd.DataFrame([(r.request_id, *ask(url, key, r.model, r.system, r.user, r.temperature, as_json, timeout, attempts, wait))], columns=[c.split()[0] for c in ANSWER.split(", ")])
                except Exception:  # a call that fails gives no answer; the others go on
                    continue

    return materialise(requests.repartition(workers, "request_id").mapInPandas(run, ANSWER), "answers")


def cost_records(requests: DataFrame, answers: DataFrame) -> DataFrame:
    """One record a call that was answered; calls that say nothing of tokens cost nothing and give none."""
    said = answers.where("prompt_tokens IS NOT NULL AND completion_tokens IS NOT NULL").select("request_id", "prompt_tokens", "completion_tokens")
    called = requests.join(said, "request_id").select(F.col("request_id").alias("call_id"), "stage", "model", "prompt_tokens", "completion_tokens", F.coalesce("source_name", F.lit("")).alias("source_name"), F.lit("").alias("entity_id"))
    return analysis.priced(called)


def _list(response: Column, path: str | Column) -> Column:
    """The elements of a JSON list as variants; null if there is no such list."""
    return F.try_variant_get(F.try_parse_json(response), path, "array<variant>")


def _is(element: Column, kind: str) -> Column:
    return F.startswith(F.schema_of_variant(element), F.lit(kind))


def _string(element: Column, field: str, default: str | None) -> Column:
    """A field that must be a string; `default` if it is absent, null if it is something else."""
    held = F.try_variant_get(element, f"$.{field}", "variant")
    return F.when(held.isNull(), F.lit(default)).when(_is(held, "STRING"), F.try_variant_get(held, "$", "string"))


def _number(element: Column, field: str, default: float) -> Column:
    """A field that must be a number, or text that holds one; `default` if it is absent, null if it is something else."""
    held = F.try_variant_get(element, f"$.{field}", "variant")
    return F.when(held.isNull(), F.lit(default)).otherwise(F.try_variant_get(held, "$", "double"))


# Entity recognition.


def recognition_requests(batched: DataFrame, model: str) -> DataFrame:
    """One request a batch, charged to its first item's source.  batched: (batch, place, source_name, combined)."""
    block = F.concat(F.lit("Article "), F.col("place").cast("string"), F.lit(" (source: "), F.coalesce("source_name", F.lit("")), F.lit(")\n"), t.annotated(F.col("combined")))
    each = batched.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("place", block.alias("block")))).alias("b"), F.min_by("source_name", "place").alias("source_name"))  # a batch has few items
    return each.select(*_request("extraction", F.col("batch"), model, F.col("source_name"), FIND, F.array_join(F.transform("b", lambda x: x["block"]), "\n\n---\n\n")))


def recognised(batched: DataFrame, answers: DataFrame) -> DataFrame:
    """Mentions (id, source_name, ord, place_in_answer, surface_form, entity_type, span_start, span_end).

    A surface that doesn't stand in the whole text, case aside, was made up and is dropped; one that is
    given twice stays twice.
    """
    asked = batched.withColumn("request_id", F.concat(F.lit("extraction:"), F.col("batch").cast("string"))).join(answers.select("request_id", "response"), "request_id")
    path = F.concat(F.lit('$.articles["'), F.col("place").cast("string"), F.lit('"].entities'))
    each = asked.select("id", "source_name", "ord", "combined", F.posexplode(_list(F.col("response"), path)).alias("nth", "e")).where(_is(F.col("e"), "OBJECT"))
    named = each.select("id", "source_name", "ord", "combined", F.col("nth").cast("long").alias("alias_ord"), t.strip(_string(F.col("e"), "surface_form", "")).alias("surface_form"), t.strip(_string(F.col("e"), "entity_type", UNKNOWN)).alias("entity_type"))
    start = t.span_start(F.col("combined"), F.col("surface_form")).cast("long")
    kept = named.where("surface_form <> '' AND entity_type IS NOT NULL").withColumn("span_start", start).where("span_start >= 0")
    return kept.select("id", "source_name", "ord", "alias_ord", "surface_form", "entity_type", "span_start", (F.col("span_start") + F.char_length("surface_form")).alias("span_end"))


# Resolution.


def resolution_requests(unresolved: DataFrame, model: str) -> DataFrame:
    """One request a chunk.  unresolved: (norm, entity_type, number, chunk)."""
    line = F.concat(F.lit('- "'), F.col("norm"), F.lit('" (kind: '), F.col("entity_type"), F.lit(")"))
    each = unresolved.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("number", line.alias("line")))).alias("l"))  # a chunk's size is bounded
    return each.select(*_request("resolution", F.col("chunk"), model, F.lit(""), MERGE, F.array_join(F.transform("l", lambda x: x["line"]), "\n")))


def resolutions(answers: DataFrame) -> DataFrame:
    """(chunk, nth, canonical_name, canonical_id, entity_type, confidence, surface_forms) of usable answers.

    A name and at least one surface form are needed.  A confidence that is no number drops the element.
    """
    chunk = F.substring_index("request_id", ":", -1).cast("long")
    each = answers.where(F.startswith("request_id", F.lit("resolution:"))).select(chunk.alias("chunk"), F.posexplode(_list(F.col("response"), "$.resolutions")).alias("nth", "e")).where(_is(F.col("e"), "OBJECT"))
    e = F.col("e")
    forms = F.filter(F.transform(F.try_variant_get(e, "$.surface_forms", "array<variant>"), lambda x: F.when(_is(x, "STRING"), F.try_variant_get(x, "$", "string"))), lambda x: x.isNotNull())
    out = each.select("chunk", F.col("nth").cast("long").alias("nth"), t.strip(_string(e, "canonical_name", "")).alias("canonical_name"), _string(e, "entity_type", UNKNOWN).alias("entity_type"), _number(e, "confidence", SOME_CONFIDENCE).alias("confidence"), forms.alias("surface_forms"))
    out = out.where("canonical_name <> '' AND size(surface_forms) > 0 AND entity_type IS NOT NULL AND confidence IS NOT NULL")
    return out.withColumn("canonical_id", t.slug(F.col("canonical_name")))


def last_resolution(found: DataFrame) -> DataFrame:
    """(norm, canonical_id, canonical_name, confidence): of several resolutions that name a surface the last one wins.

    An entity's name is the first that was given to its id.
    """
    each = found.select("chunk", "nth", "canonical_id", "confidence", F.posexplode("surface_forms").alias("k", "form"))
    order = F.struct("chunk", "nth", "k")
    last = each.groupBy(t.normalise(F.col("form")).alias("norm")).agg(F.max_by("canonical_id", order).alias("canonical_id"), F.max_by("confidence", order).alias("confidence"))
    names = found.groupBy("canonical_id").agg(F.min_by("canonical_name", F.struct("chunk", "nth")).alias("canonical_name"))
    return last.join(names, "canonical_id").select("norm", "canonical_id", "canonical_name", "confidence")


# Sentiment.


def entity_groups(resolved: DataFrame) -> DataFrame:
    """(id, canonical_id, place, surface_form): each item's entities with their first surface; entities without an id are left out."""
    order = F.struct("ord", "alias_ord")
    return resolved.where("canonical_id <> ''").groupBy("id", "canonical_id").agg(F.min("alias_ord").alias("place"), F.min_by("surface_form", order).alias("surface_form"), F.min_by("canonical_name", order).alias("canonical_name"))


def sentiment_requests(items: DataFrame, resolved: DataFrame, model: str) -> DataFrame:
    """One request an item that names entities; an id without an item gives none."""
    line = F.concat(F.lit("- "), F.coalesce("canonical_name", "canonical_id"), F.lit(' (written "'), F.col("surface_form"), F.lit('")'))
    each = entity_groups(resolved).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("place", line.alias("line")))).alias("l"))  # the entities that one text names
    user = F.concat(F.lit("Entities:\n"), F.array_join(F.transform("l", lambda x: x["line"]), "\n"), F.lit("\n\nArticle (source: "), F.coalesce("source_name", F.lit("")), F.lit("):\n"), t.annotated(F.col("combined")))
    return each.join(items.select("id", "source_name", "combined"), "id").select(*_request("sentiment", F.col("id"), model, F.col("source_name"), JUDGE, user))


def returned_sentiments(answers: DataFrame) -> DataFrame:
    """(id, nth, surface, label, score, confidence, evidence_span), coerced and cut."""
    id_ = F.substr("request_id", F.lit(len("sentiment:") + 1))
    each = answers.where(F.startswith("request_id", F.lit("sentiment:"))).select(id_.alias("id"), F.posexplode(_list(F.col("response"), "$.sentiments")).alias("nth", "e")).where(_is(F.col("e"), "OBJECT"))
    e = F.col("e")
    label, score, confidence = analysis.coerced(F.coalesce(F.try_variant_get(e, "$.label", "string"), F.lit("neutral")), _number(e, "score", NO_SCORE), _number(e, "confidence", SOME_CONFIDENCE))
    out = each.select("id", F.col("nth").cast("long").alias("nth"), _string(e, "entity_surface_form", "").alias("surface"), label.alias("label"), _number(e, "score", NO_SCORE).alias("_s"), score.alias("score"), _number(e, "confidence", SOME_CONFIDENCE).alias("_c"), confidence.alias("confidence"), t.evidence(_string(e, "evidence_span", "")).alias("evidence_span"))
    return out.where("surface IS NOT NULL AND evidence_span IS NOT NULL AND _s IS NOT NULL AND _c IS NOT NULL").drop("_s", "_c")


def scored(items: DataFrame, resolved: DataFrame, answers: DataFrame) -> DataFrame:
    """Sentiments (id, ord, nth, canonical_id, canonical_name, label, score, confidence, evidence_span, source_name)."""
    said = returned_sentiments(answers)
    candidates = resolved.select(F.col("id").alias("item"), F.col("alias_ord").alias("place"), "canonical_id", "canonical_name", "surface_form")
    matched = matching.match(said.select(F.col("id").alias("item"), "nth", "surface"), candidates).select(F.col("item").alias("id"), "nth", "canonical_id", "canonical_name")
    return said.join(matched, ["id", "nth"]).join(items.select("id", "ord", "source_name"), "id").select("id", "ord", "nth", "canonical_id", "canonical_name", "label", "score", "confidence", "evidence_span", "source_name")
