"""The live sources' pages as items: each source's rules over the elements of its pages.

Input pages have (page_url, html); the page that a link leads to is looked up among `articles` (page_url,
html), which a plan joins by URL.  Results are rows of ITEM: source_key, source_name, ord, source_url,
title, body, published_at.  Every rule works within one page's row; only the look-up of articles shuffles.

Defined results: null or empty pages give no links; a page without headlines gives its own text where
the source says so, and nothing if that is empty too; a link without an article has an empty body;
articles that repeat a URL count once, the one whose text is least.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text as t
from tidemark.sources import html as h
from tidemark.sources.content import REGISTRY

# Headline words; bases, titles' least lengths, most items, lengths of bodies.
HEADLINE = "(?i)(dollar|euro|yen|pound|yuan|currency|forex|fed|rate|bank|inflation)"
FED_BASE, IMF_BASE = "https://www.federalreserve.gov", "https://www.imf.org"
NEXT_DATA = r'(?s)<script id="__NEXT_DATA__"[^>]*>(.+?)</script>'
MARKETS_TITLE, FED_TITLE, IMF_TITLE, REUTERS_TITLE = 15, 10, 15, 20
MARKETS_ITEMS, FED_ITEMS, IMF_ITEMS, REUTERS_ITEMS, REUTERS_ELEMENTS = 30, 20, 20, 20, 200
ARTICLE_CHARS, PAGE_CHARS, OVERVIEW_CHARS, QUOTE_CHARS, QUOTE_PAGE_CHARS = 8000, 4000, 5000, 6000, 3000
PRICE_TOLD, RATE_TOLD, CHANGE_TOLD, NOT_TOLD = "EUR/USD price: ", "EUR/USD rate: ", ", change: ", "N/A"
QUOTE_TITLE, MARKETS_OVERVIEW, REUTERS_OVERVIEW = "EUR/USD Exchange Rate", "Yahoo Finance Markets Overview", "Reuters Currencies Market Overview"
ITEM = ("source_key", "source_name", "ord", "source_url", "title", "body", "published_at")


def _items(pages: DataFrame, key: str, found: Column) -> DataFrame:
    """One row for each struct (title, body, published_at, url) of `found`, numbered from zero within its page."""
    each = pages.select("page_url", F.posexplode(found).alias("_n", "_e"))
    url = F.coalesce(F.col("_e.url"), F.col("page_url"))
    return each.select(
        F.lit(key).alias("source_key"), F.lit(REGISTRY[key]).alias("source_name"), F.col("_n").cast("long").alias("ord"), url.alias("source_url"),
        F.col("_e.title").alias("title"), F.col("_e.body").alias("body"), F.col("_e.published_at").alias("published_at"),
    )


def _row(title: Column, body: Column, published: Column | None = None, url: Column | None = None) -> Column:
    published = F.lit(None).cast("timestamp") if published is None else published
    return F.struct(title.alias("title"), body.alias("body"), published.alias("published_at"), (F.lit(None).cast("string") if url is None else url).alias("url"))


def _headlines(found: Column, chosen: Column) -> Column:
    """Headlines with the paragraph beside them and the next time in the page."""
    body = lambda e: F.coalesce(h.later_sibling(found, e, "p")["text"], F.lit(""))
    time = lambda e: t.parse_iso(h.next_one(found, e, "time")["attrs"]["datetime"])
    return F.transform(chosen, lambda e: _row(e["text"], body(e), time(e)))


def _or_page(rows: Column, title: str, text: Column) -> Column:
    """The rows, or one of the page's text if there are none."""
    return F.when(F.size(rows) > 0, rows).otherwise(F.array(_row(F.lit(title), text)))


def quote(pages: DataFrame) -> DataFrame:
    """The quote page: the embedded data if its path holds a quote, else price and two-cell rows, else its text."""
    stores = F.try_variant_get(F.try_parse_json(F.regexp_extract("html", NEXT_DATA, 1)), "$.props.pageProps.financialData", "variant")
    held = pages.select("page_url", "html", stores.alias("_s")).select(
        "page_url", "html",
        F.when(F.col("_s").isNotNull() & ~F.col("_s").cast("string").isin("null", "{}", "[]", '""', "0", "false"), F.struct(
            F.coalesce(F.try_variant_get("_s", "$.regularMarketPrice.raw", "string"), F.lit(NOT_TOLD)).alias("price"),
            F.coalesce(F.try_variant_get("_s", "$.regularMarketChangePercent.fmt", "string"), F.lit(NOT_TOLD)).alias("change"),
        )).alias("_q"),
    )
    page = h.elements(held)
    found = F.col("elements")
    price = h.first(found, lambda e: (e["tag"] == "fin-streamer") & (e["attrs"]["data-symbol"] == "EURUSD=X"))
    cells = lambda r: h.inside(h.tagged(found, "td"), r)
    rows = F.filter(F.transform(h.tagged(found, "tr"), cells), lambda c: F.size(c) == 2)
    parts = F.concat(F.when(price.isNotNull(), F.array(F.concat(F.lit(PRICE_TOLD), price["text"]))).otherwise(F.array().cast("array<string>")), F.transform(rows, lambda c: F.concat(F.get(c, F.lit(0))["text"], F.lit(": "), F.get(c, F.lit(1))["text"])))
    seen = F.when(F.size(parts) > 0, F.array_join(parts, " | ")).otherwise(F.substring(h.page_text(found), 1, QUOTE_PAGE_CHARS))
    told = F.concat(F.lit(RATE_TOLD), F.col("_q.price"), F.lit(CHANGE_TOLD), F.col("_q.change"), F.lit("%"))
    body = F.when(F.col("_q").isNotNull(), told).otherwise(F.substring(seen, 1, QUOTE_CHARS))
    return _items(page, "yahoo_eurusd", F.filter(F.array(_row(F.lit(QUOTE_TITLE), body)), lambda x: x["body"] != ""))


def markets(pages: DataFrame) -> DataFrame:
    """Headlines of the markets page; the page's text if there is none."""
    found = F.col("elements")
    long = F.filter(h.tagged(found, "h3", "h2"), lambda e: F.char_length(e["text"]) >= MARKETS_TITLE)
    rows = _headlines(found, F.slice(h.firsts(long, "text"), 1, MARKETS_ITEMS))
    return _items(h.elements(pages), "yahoo_markets", _or_page(rows, MARKETS_OVERVIEW, F.substring(h.page_text(found), 1, OVERVIEW_CHARS)))


def reuters(pages: DataFrame) -> DataFrame:
    """Headlines and links that speak of money, among the first elements; the page's text if there is none."""
    found = F.col("elements")
    some = F.slice(h.tagged(found, "h3", "h2", "a"), 1, REUTERS_ELEMENTS)
    told = F.filter(some, lambda e: (F.char_length(e["text"]) >= REUTERS_TITLE) & e["text"].rlike(HEADLINE))
    rows = _headlines(found, F.slice(h.firsts(told, "text"), 1, REUTERS_ITEMS))
    page = F.substring(h.page_text(found), 1, OVERVIEW_CHARS)
    return _items(h.elements(pages), "reuters", F.filter(_or_page(rows, REUTERS_OVERVIEW, page), lambda x: x["title"] != F.when(page == "", REUTERS_OVERVIEW).otherwise("")))


def _links(found: Column, anchors: Column, base: str, day_first: bool) -> Column:
    """(url, title, published_at) of each anchor; the date is that in its parent's text."""
    date = lambda e: t.parse_date(t.written_date(F.coalesce(h.parent_text(found, e), F.lit(""))), day_first)
    return F.transform(anchors, lambda e: F.struct(t.absolute(e["attrs"]["href"], base).alias("url"), e["text"].alias("title"), date(e).alias("published_at")))


def fed_links(pages: DataFrame) -> DataFrame:
    """Press releases: each URL's first link counts, also where its title is too short to be kept."""
    found = F.col("elements")
    place = F.coalesce(h.first(found, lambda e: (e["tag"] == "div") & (e["attrs"]["id"] == "article")), h.first(found, lambda e: e["tag"] == "main"), F.get(found, F.lit(0)))
    href = lambda e: F.coalesce(e["attrs"]["href"], F.lit(""))
    fits = lambda e: (F.endswith(href(e), F.lit(".htm")) | F.endswith(href(e), F.lit(".html"))) & (F.contains(href(e), F.lit("pressrelease")) | F.contains(href(e), F.lit("monetary")) | F.contains(href(e), F.lit("fomc")))
    rows = h.firsts(_links(found, F.filter(h.inside(h.tagged(found, "a"), place), fits), FED_BASE, False), "url")
    return _linked(pages, F.slice(F.filter(rows, lambda x: F.char_length(x["title"]) >= FED_TITLE), 1, FED_ITEMS))


def imf_links(pages: DataFrame) -> DataFrame:
    """News links up to the first that comes again: what follows it is lost."""
    found = F.col("elements")
    href = lambda e: F.lower(F.coalesce(e["attrs"]["href"], F.lit("")))
    fits = lambda e: (F.contains(href(e), F.lit("/en/news/articles/")) | F.contains(href(e), F.lit("/en/publications/"))) & (F.char_length(e["text"]) >= IMF_TITLE)
    rows = _links(found, F.filter(h.tagged(found, "a"), fits), IMF_BASE, True)
    urls = F.transform(rows, lambda x: x["url"])
    again = F.filter(F.transform(urls, lambda u, i: F.when(F.array_position(urls, u) <= i, i)), lambda i: i.isNotNull())
    return _linked(pages, F.slice(rows, 1, F.least(F.lit(IMF_ITEMS), F.coalesce(F.get(again, F.lit(0)), F.size(rows)))))


def _linked(pages: DataFrame, rows: Column) -> DataFrame:
    each = h.elements(pages).select("page_url", F.posexplode(rows).alias("_n", "_l"))
    return each.select("page_url", F.col("_n").cast("long").alias("ord"), F.col("_l.url").alias("source_url"), F.col("_l.title").alias("title"), F.col("_l.published_at").alias("published_at"))


def fed_body(found: Column) -> Column:
    article = F.coalesce(h.first(found, lambda e: (e["tag"] == "div") & (e["attrs"]["id"] == "article")), h.first(found, lambda e: (e["tag"] == "div") & (e["attrs"]["class"] == "col-xs-12 col-sm-8")))
    return F.when(article.isNotNull(), F.substring(article["spaced"], 1, ARTICLE_CHARS)).otherwise(F.substring(h.page_text(found), 1, PAGE_CHARS))


def imf_body(found: Column) -> Column:
    div = lambda test: h.first(found, lambda e: (e["tag"] == "div") & test(e))
    article = F.coalesce(div(lambda e: h.has_class(e, "imf-article-body")), div(lambda e: e["attrs"]["id"] == "content"), h.first(found, lambda e: e["tag"] == "article"), h.first(found, lambda e: e["tag"] == "main"))
    return F.when(article.isNotNull(), F.substring(article["spaced"], 1, ARTICLE_CHARS)).otherwise(F.substring(h.page_text(found), 1, PAGE_CHARS))


def _with_bodies(key: str, links: DataFrame, articles: DataFrame, body) -> DataFrame:
    text = h.elements(articles.select(F.col("page_url").alias("source_url"), "html")).select("source_url", body(F.col("elements")).alias("body"))
    text = text.groupBy("source_url").agg(F.min("body").alias("body"))
    rows = links.join(text, "source_url", "left")
    return rows.select(F.lit(key).alias("source_key"), F.lit(REGISTRY[key]).alias("source_name"), "ord", "source_url", "title", F.coalesce("body", F.lit("")).alias("body"), "published_at")


def fed(pages: DataFrame, articles: DataFrame) -> DataFrame:
    return _with_bodies("fed", fed_links(pages), articles, fed_body)


def imf(pages: DataFrame, articles: DataFrame) -> DataFrame:
    return _with_bodies("imf", imf_links(pages), articles, imf_body)


def first_tier(plain: DataFrame, rendered: DataFrame) -> DataFrame:
    """(page_url, html) of pages fetched plainly, else as a browser rendered them; pages that neither has are left out."""
    other = rendered.select(F.col("page_url").alias("_url"), F.col("html").alias("_html"))
    both = plain.join(other, plain["page_url"] == other["_url"], "full")
    return both.select(F.coalesce("page_url", "_url").alias("page_url"), F.coalesce("html", "_html").alias("html")).where("html IS NOT NULL")
