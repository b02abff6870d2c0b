"""Small literal rows for queries that the tables at hand can't feed: finance words, annotators' answers, pages."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

#: (doc_id, source, text): title, line end, body.
ITEMS = (
    (1, "Federal Reserve", "Fed holds rates\nThe Fed kept the interest rate at 5.25 % while EUR/USD traded at 1.0850.\nCPI rose 3.1% in May."),
    (2, "Reuters", "Euro slips\nEUR/USD fell to 1.0904 as the ECB spoke. Interest rate: 5.5%. GDP grew 0% last quarter after Powell's remarks."),
    (3, "IMF", "Global outlook\nGDP grew 2.9% and the consumer price index 3.4%. USD/JPY near 150.25; S&P-500 steady, Jerome Powell said."),
    (4, "Yahoo Finance Markets", "Dollar and yen\nThe dollar rose against the yen to 151.10. The euro x dollar 1.2345 euro dollar 1.0900 today. GDP at 3.1%"),
    (5, "Reuters", "Short\nx"),
    (6, "Reuters", "Reserve Bank of Australia\nThe Reserve Bank of Australia and 日本 markets; fiber and cable, Dow and DAX."),
    (7, "Zeta", "Sterling note\nThe pound and GBP/USD were flat on the day, 1,234,567.5 million traded, 15-20 bps."),
)


def _entities(*found: object) -> dict:
    return {"entities": [{"surface_form": x[0], "entity_type": x[1]} if isinstance(x, tuple) else x for x in found]}


#: (batch, answer): made-up, repeated, mistyped and missing ones; the second isn't JSON.
RECOGNISED = (
    (0, json.dumps({"articles": {
        "0": _entities(("the Fed", "central_bank"), ("EUR/USD", "currency_pair"), ("EUR/USD", "currency_pair"), ("Bundesbank", "central_bank"), 7, "x", {"surface_form": 5}, (" CPI ", "indicator")),
        "1": _entities(("S&P-500", "index"), ("Jerome Powell", "person"), {"surface_form": "GDP"}),
        "2": _entities(("ECB", "central_bank"), ("EUR/USD", "currency_pair"), ("Powell", "person"), ("GDP", "indicator"), ("GDP", 3)),
        "3": _entities(("Reserve Bank of Australia", "central_bank"), ("日本", "country"), ("", "person")),
    }}, ensure_ascii=False)),
    (1, "I found nothing."),
)
RESOLVED = (
    (0, json.dumps({"resolutions": [
        {"surface_forms": ["Powell", "Jerome Powell"], "canonical_name": "Jerome Powell", "entity_type": "person", "confidence": 0.95},
        {"surface_forms": ["powell"], "canonical_name": "J. Powell", "entity_type": "person"},
        {"surface_forms": ["s&p-500"], "canonical_name": "", "confidence": 1},
        {"surface_forms": [], "canonical_name": "Nobody"},
        {"surface_forms": ["s&p-500"], "canonical_name": "Some Index", "confidence": "high"},
        3,
    ]})),
)
SCORED = (
    ("1", json.dumps({"sentiments": [
        {"entity_surface_form": "Federal Reserve", "label": "bullish", "score": 3, "confidence": 1.7, "evidence_span": "kept " * 80},
        {"entity_surface_form": "EUR/USD", "label": "bullish", "score": -3, "confidence": 0.6},
        "x", {"entity_surface_form": "CPI", "score": "abc"}, {"label": "odd", "confidence": "0.6"}, {"entity_surface_form": None},
    ]})),
    ("2", json.dumps({"sentiments": [
        {"entity_surface_form": "EUR/USD rate", "label": "bearish", "score": -0.675, "confidence": 0.625, "evidence_span": "fell"},
        {"entity_surface_form": "ecb", "label": "neutral"}, {"entity_surface_form": "the Powell talk", "label": "bearish", "score": -0.1, "confidence": 0.9},
        {"entity_surface_form": "GDP", "label": "bearish", "score": -0.2, "confidence": 0.59},
    ]})),
    ("3", json.dumps({"sentiments": [{"entity_surface_form": "GDP", "label": "bullish", "score": 0.125, "confidence": 0.9, "evidence_span": "grew 2.9%"}, {"entity_surface_form": "zz", "label": "bullish"}]})),
    ("6", "[1, 2"),
)
#: (stage, answer's number, prompt tokens, completion tokens)
TOKENS = {"extraction": (1000, 200), "resolution": (300, 50), "sentiment": (800, 120), "briefing": (2000, 500)}

_FED = "https://www.federalreserve.gov"
FED_PAGE = """<html><body><a href="/x/pressrelease0.htm">Outside of the article</a><div id=article><p>January 5, 2024 <a href="/a/pressrelease1.htm">Short</a>
<p>January 6, 2024 <a href='/a/pressrelease1.htm'>The same link with a long title</a><p>March 12, 2024: <a href="/a/monetary2.html"><b>Policy</b> <i>statement</i> released</a> text</p>
<div><a href="https://elsewhere.org/fomc3.htm">FOMC &amp; minutes, third</a></div><a href="/a/speech.htm">A speech that isn't listed</a><a href="/a/fomc4.pdf">FOMC as a portable document</a></div></body></html>"""
FED_ARTICLE = "<body><nav>Menu</nav><div id='article'><h3>Policy</h3><p>Rates <b>stay</b>.</p><!-- no --><script>var x = '</p>';</script></div></body>"
FED_OTHER = "<body><nav>Menu</nav><p>Minutes of the meeting</body>"
IMF_PAGE = """<main><ul><li>February 2, 2024<a href="/en/News/Articles/one">First article of the list</a><li><a href="/en/Publications/two">Too short</a>
<li><a href="/en/Publications/three">Third, a publication</a><li><a href="/en/News/Articles/one">First article, once more</a><li><a href="/en/News/Articles/five">Lost behind the repeat</a></ul></main>"""
IMF_ARTICLE = "<body><article>An article</article><div class='x imf-article-body y'>The <i>body</i> itself</div></body>"
MARKETS_PAGE = """<section><h3>Stocks rally on a broad front</h3><div><p>not a sibling</p></div><p>Gains&nbsp;were <b>broad</b></p><time datetime="2024-03-01T09:30:00Z">now</time></section>
<section><h2>Too short</h2><p>x</p></section><section><h3>Stocks rally on a broad front</h3><p>again</p></section><section><h2>Bonds fall as yields climb</h2><time datetime="soon">t</time></section>"""
REUTERS_PAGE = """<a href="/1">Dollar firms before payrolls data</a><h3>Weather stays mild in the north</h3><h2>Yen slides</h2><h3>Bank of Japan hints at a change</h3><p>It may end</p><time datetime="2024-03-02T10:00:00+02:00"></time>"""
QUOTE_PAGE = """<table><tr><td>Open</td><td>1.0850</td></tr><tr><td>Only one</td></tr><tr><td>Range</td><td>1.08 <b>to</b> 1.09</td></table><fin-streamer data-symbol="EURUSD=X">1.0861</fin-streamer>"""
QUOTE_DATA = """<script id="__NEXT_DATA__" type="application/json">{"props":{"pageProps":{"financialData":{"regularMarketPrice":{"raw":1.0842}}}}}</script><p>page</p>"""
QUOTE_BAD = """<script id="__NEXT_DATA__">{"props":</script><p>Just   <b>text</b></p>"""


def items(spark: SparkSession) -> DataFrame:
    from tidemark.sources.content import items as content

    return content(spark.createDataFrame(ITEMS, "doc_id long, source string, text string"))


def answers(spark: SparkSession, stage: str, rows: tuple) -> DataFrame:
    prompt, completion = TOKENS[stage]
    return spark.createDataFrame([(f"{stage}:{k}", text, prompt, completion) for k, text in rows], "request_id string, response string, prompt_tokens long, completion_tokens long")


def all_answers(spark: SparkSession) -> DataFrame:
    """Of the briefings the executive's fails."""
    out = answers(spark, "briefing", (("trader", "Buy."), ("analyst", "On the other hand.")))
    for stage, rows in (("extraction", RECOGNISED), ("resolution", RESOLVED), ("sentiment", SCORED)):
        out = out.unionByName(answers(spark, stage, rows))
    return out


def pages(spark: SparkSession, *html: str) -> DataFrame:
    return spark.createDataFrame([(f"page{i}", x) for i, x in enumerate(html)], "page_url string, html string")


def fed_articles(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(f"{_FED}/a/monetary2.html", FED_ARTICLE), ("https://elsewhere.org/fomc3.htm", FED_OTHER)], "page_url string, html string")


def imf_articles(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("https://www.imf.org/en/News/Articles/one", IMF_ARTICLE), ("https://www.imf.org/en/Publications/three", None)], "page_url string, html string")
