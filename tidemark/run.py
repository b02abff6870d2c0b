"""The whole run: sources, cap, de-duplication, recognition, resolution, sentiment, checks, briefings, files.

``dry_run`` ends after de-duplication and writes nothing.  An annotator is a function from requests to
answers; the default asks the endpoint that the settings name.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import analysis, annotate, briefing, content, entities, sinks
from tidemark.runtime import materialise, scratch
from tidemark.settings import Settings
from tidemark.sources import listings, live
from tidemark.sources.content import chosen_sources, union_items

Annotator = Callable[[DataFrame], DataFrame]


def gathered(spark: SparkSession, sources: list[str] | None = None, pages: DataFrame | None = None, articles: DataFrame | None = None) -> DataFrame:
    """Items of the chosen sources, from live pages or given ones; a page's links are fetched unless articles are given."""
    read = live.read_pages(spark, sources) if pages is None else pages
    read = materialise(read, "pages")  # a page is fetched once
    parts = []
    for key in chosen_sources(sources):
        own = read.where(read["source_key"] == key).select("page_url", "html")
        if key in ("fed", "imf"):
            links = listings.fed_links(own) if key == "fed" else listings.imf_links(own)
            found = materialise(live.fetched(links.selectExpr("source_url AS page_url")), "articles") if articles is None else articles
            parts.append(listings.fed(own, found) if key == "fed" else listings.imf(own, found))
        else:
            parts.append({"yahoo_eurusd": listings.quote, "yahoo_markets": listings.markets, "reuters": listings.reuters}[key](own))
    return union_items(parts)


def unique_items(items: DataFrame) -> DataFrame:
    """The cap, then the first of each hash."""
    return content.first_wins(content.cap(items))


def annotated(spark: SparkSession, items: DataFrame, annotator: Annotator, settings: Settings) -> tuple[dict[str, DataFrame], DataFrame]:
    """All tables of a run over unique items, and the records of what it cost."""
    aliases, calls = entities.alias_dimension(spark), []

    def ask(requests: DataFrame) -> DataFrame:
        requests = materialise(requests, "requests")
        answers = materialise(annotator(requests), "answers")
        calls.append(annotate.cost_records(requests, answers))
        return answers

    batched = content.batches(items).join(items.select("id", "combined"), "id")
    found = materialise(annotate.recognised(batched, ask(annotate.recognition_requests(batched, settings.model_extraction))), "mentions")
    open_ = entities.unresolved(found, aliases)
    resolutions = annotate.resolutions(ask(annotate.resolution_requests(open_, settings.model_extraction)))
    resolved = entities.resolve(found, aliases, annotate.last_resolution(resolutions))
    known = entities.registry(aliases, resolved, resolutions)
    names = known.select("canonical_id", "canonical_name")
    resolved = materialise(resolved.drop("canonical_name").join(names, "canonical_id", "left"), "resolved")
    sentiments = materialise(annotate.scored(items, resolved, ask(annotate.sentiment_requests(items, resolved, settings.model_sentiment))), "sentiments")
    flags = materialise(analysis.quality_flags(sentiments, entities.unresolved_flags(resolved), analysis.readings(items)), "flags")
    about = briefing.context(analysis.summary(sentiments), flags, known)
    texts = briefing.briefings(spark, ask(briefing.requests(spark, about, settings.model_briefing)))
    tables = {"content_items": items, "entities": known.drop("place"), "sentiments": sentiments, "qa_flags": flags, "briefings": texts}
    return tables, reduce(DataFrame.unionByName, calls)


def run(spark: SparkSession, folder: str = "output", sources: list[str] | None = None, dry_run: bool = False, annotator: Annotator | None = None, settings: Settings | None = None, pages: DataFrame | None = None, articles: DataFrame | None = None) -> dict[str, DataFrame] | str:
    """Dry: the table of unique items.  Else: writes all files to folder and returns the summary's text."""
    settings, began, run_id = settings or Settings.read(), time.time(), str(uuid.uuid4())
    if dry_run:
        return {"content_items": unique_items(gathered(spark, sources, pages, articles))}
    annotator = annotator or (lambda requests: annotate.remote(requests, settings.annotator_url, settings.annotator_key))
    with scratch(spark):
        items = materialise(unique_items(gathered(spark, sources, pages, articles)), "items")
        tables, records = annotated(spark, items, annotator, settings)
        sinks.write_results({k: v for k, v in tables.items() if k != "briefings"}, folder)
        sinks.write_briefings(tables["briefings"], folder)
        sinks.write_cost_report(records, folder, run_id)
        return sinks.printed_summary(spark, tables, records, run_id, time.time() - began, folder)
