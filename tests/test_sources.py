"""HTML elements, listings, live pages with a local server, settings and the whole run with recorded answers."""

import json
import re
import threading
from contextlib import suppress
from http.server import BaseHTTPRequestHandler, HTTPServer
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark import run as runs
from tidemark.__main__ import main
from tidemark.functions import text as t
from tidemark.operators import annotate, content, entities, sinks
from tidemark.plans import fixtures as fx
from tidemark.runtime import numbered
from tidemark.settings import Settings
from tidemark.sources import html, listings, live


def of(page, *tags):
    return [(e["pos"], e["last"], e["parent"], e["tag"], e["text"], e["spaced"]) for e in html.parsed(page, frozenset(tags))]


def test_unclosed_elements_end_where_they_must():
    assert of("<p>one<p>two <b>bold</b><div>three</div>", "p", "div") == [(-1, 3, -1, "", "onetwoboldthree", "one two bold three"), (0, 0, -1, "p", "one", "one"), (1, 2, -1, "p", "twobold", "two bold"), (3, 3, -1, "div", "three", "three")]
    assert [x[4] for x in of("<ul><li>a<ul><li>b</ul><li>c</ul>", "li")[1:]] == ["ab", "b", "c"]
    assert [x[4] for x in of("<table><tr><td>1<td>2<tr><td>3</table>x", "tr", "td")[1:]] == ["12", "1", "2", "3", "3"]


def test_scripts_comments_and_references():
    assert of("<a href=x>A&amp;B&nbsp;</a><script>var t = '</p><a>no</a>';</script><!-- <a>no</a> --><br/>", "a")[0][5] == "A&B"
    assert of(None) == of("") == [(-1, -1, -1, "", "", "")]
    assert html.parsed("<a href='1' href='2' x>t", frozenset("a"))[1]["attrs"] == {"href": "1", "x": ""}


def test_siblings_and_next_ones(spark):
    page = fx.pages(spark, "<div><h3>head</h3><span><p>deep</p></span><p>beside</p></div><p>outside</p><time datetime='2024-01-01'>")
    e = F.col("elements")
    h3 = html.first(e, lambda x: x["tag"] == "h3")
    row = html.elements(page).select(html.later_sibling(e, h3, "p")["text"].alias("s"), html.next_one(e, h3, "p")["text"].alias("n"), html.next_one(e, h3, "time")["attrs"]["datetime"].alias("t")).first()
    assert tuple(row) == ("beside", "deep", "2024-01-01")


def test_listings_of_empty_pages(spark):
    empty = spark.createDataFrame([("u", None), ("v", "")], "page_url string, html string")
    assert listings.fed(empty, empty).count() == listings.imf(empty, empty).count() == listings.quote(empty).count() == listings.reuters(empty).count() == 0
    assert listings.markets(empty).count() == 2
    assert listings.fed(empty.limit(0), empty).count() == 0


def test_most_items_of_a_listing(spark):
    heads = "".join(f"<h3>The dollar headline number {i}</h3>" for i in range(250))
    page = fx.pages(spark, heads)
    assert listings.markets(page).count() == 30 and listings.reuters(page).count() == 20
    late = fx.pages(spark, "<h3>nothing to see here at all</h3>" * 200 + "<h3>The dollar headline, too late</h3>")
    assert [r["title"] for r in listings.reuters(late).collect()] == [listings.REUTERS_OVERVIEW]
    links = fx.pages(spark, "".join(f'<a href="/en/News/Articles/{i}">An article of the listing {i}</a>' for i in range(30)))
    assert listings.imf(links, links.limit(0)).count() == 20


@pytest.fixture(scope="module")
def server():
    pages = {"/fed": fx.FED_PAGE, "/markets": fx.MARKETS_PAGE, "/quote": fx.QUOTE_DATA}
    asked = []

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            asked.append(self.path)
            found = pages.get(self.path)
            self.send_response(404 if found is None else 200)
            self.end_headers()
            self.wfile.write((found or "").encode())

        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            asked.append(body)
            self.send_response(200)
            self.end_headers()
            self.wfile.write(json.dumps({"choices": [{"message": {"content": "{}"}}], "usage": {"prompt_tokens": 7, "completion_tokens": 2}}).encode())

        def log_message(self, *_):
            pass

    s = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}", asked
    s.shutdown()


def test_a_source_that_fails_stops_no_other(spark, server):
    url, asked = server
    urls = json.dumps({"fed": f"{url}/fed", "yahoo_markets": f"{url}/markets", "imf": f"{url}/gone"})
    got = live.read_pages(spark, ["imf", "fed", "nope", "yahoo_markets"], urls=urls, attempts="2", wait="0.01").collect()
    assert {(r["source_key"], r["html"]) for r in got} == {("fed", fx.FED_PAGE), ("yahoo_markets", fx.MARKETS_PAGE)}
    assert asked.count("/gone") == 2
    links = spark.createDataFrame([(f"{url}/quote",), (f"{url}/quote",), (f"{url}/gone",), (None,)], "page_url string")
    assert [tuple(r) for r in live.fetched(links, attempts=1).collect()] == [(f"{url}/quote", fx.QUOTE_DATA)]
    assert live.waits(3, 2.0) == [2.0, 2.0] and live.waits(5, 2.0) == [2.0, 2.0, 4.0, 8.0]


def test_remote_annotator(spark, server):
    url, asked = server
    requests = spark.createDataFrame([("a:1", "a", "m", "s", "sys", "use", 0.0)], "request_id string, stage string, model string, source_name string, system string, user string, temperature double")
    assert [tuple(r) for r in annotate.remote(requests, url, "key").collect()] == [("a:1", "{}", 7, 2)]
    assert [m["content"] for m in asked[-1]["messages"]] == ["sys", "use"] and asked[-1]["response_format"] == {"type": "json_object"}
    assert annotate.remote(requests, "http://127.0.0.1:1", attempts=1).count() == 0


def test_settings(tmp_path):
    (tmp_path / ".env").write_text("# c\nMODEL_BRIEFING='m'\nhttp_timeout=5\nother=1\n")
    s = Settings.read(str(tmp_path), {"HTTP_TIMEOUT": "7"})
    assert (s.model_briefing, s.http_timeout, s.model_extraction) == ("m", 7, "gpt-5")


def pages(spark):
    rows = [("fed", "f", fx.FED_PAGE), ("imf", "i", fx.IMF_PAGE), ("yahoo_markets", "m", fx.MARKETS_PAGE), ("reuters", "r", fx.REUTERS_PAGE), ("yahoo_eurusd", "q", fx.QUOTE_DATA)]
    return spark.createDataFrame(rows, "source_key string, page_url string, html string")


def test_dry_run_and_whole_run(spark, tmp_path, capsys):
    articles = fx.fed_articles(spark).unionByName(fx.imf_articles(spark))
    dry = runs.run(spark, dry_run=True, pages=pages(spark), articles=articles)["content_items"]
    assert [r["source_key"] for r in dry.orderBy("ord").collect()] == ["yahoo_eurusd", "yahoo_markets", "yahoo_markets", "fed", "fed", "imf", "imf", "reuters", "reuters"]
    assert [n["value"] for n in dry.where("source_key = 'yahoo_eurusd'").first()["numbers"]] == [1.0842]
    assert runs.run(spark, dry_run=True, sources=["fed"], pages=pages(spark), articles=articles)["content_items"].count() == 2

    def annotator(requests):
        say = F.when(F.col("stage") == "extraction", F.lit(json.dumps({"articles": {"0": {"entities": [{"surface_form": "EUR/USD"}, {"surface_form": "Policy"}]}}})))
        say = say.when(F.col("stage") == "sentiment", F.lit(json.dumps({"sentiments": [{"entity_surface_form": "Policy", "label": "bullish", "score": 0.5}]})))
        return requests.where("stage <> 'briefing' OR request_id LIKE '%trader'").select("request_id", F.coalesce(say, F.lit("text")).alias("response"), F.lit(1000).cast("long").alias("prompt_tokens"), F.lit(0).cast("long").alias("completion_tokens"))

    text = runs.run(spark, str(tmp_path), pages=pages(spark), articles=articles, annotator=annotator, settings=Settings())
    assert "items: 9" in text and "sources: 5" in text and "entities: 27" in text and "[unresolved_entity] Entity 'Policy'" in text
    assert spark.read.json(f"{tmp_path}/sentiments").first()["canonical_id"] == "policy"
    report = json.loads(spark.read.text(f"{tmp_path}/cost_report").first()[0])
    assert set(report["by_stage"]) == {"extraction", "resolution", "sentiment", "briefing"} and report["total_cost_usd"] == round(sum(report["by_stage"].values()), 6)
    assert spark.read.json(f"{tmp_path}/cost_records").count() == round(report["total_cost_usd"] / 0.001)
    assert spark.read.text(f"{tmp_path}/briefings/audience=executive").first()[0].startswith("[Briefing generation failed")
    assert sinks.listing(spark, str(tmp_path / "none")) == [] and f"{tmp_path}/briefings" in sinks.listing(spark, str(tmp_path))
    main(["sources"])
    assert capsys.readouterr().out.split() == ["yahoo_eurusd", "yahoo_markets", "fed", "imf", "reuters"]


def test_nulls_and_empty_tables(spark):
    rows = [("a", None, 1, "x y", "long enough, this text of no source"), ("b", "s", 2, None, None), ("c", None, 3, "x y", "long enough, this text of no source")]
    items = spark.createDataFrame(rows, "id string, source_name string, ord long, title string, body string")
    from tidemark.sources.content import content_items

    items = content_items(items)
    got = {r["id"]: (r["batch"], r["place"]) for r in content.batches(items, 2).collect()}
    assert got == {"a": (0, 0), "c": (0, 1)}
    assert sorted(r["id"] for r in content.first_wins(items).collect()) == ["a", "b"]
    assert content.first_wins(items.unionByName(items)).count() == 2
    assert content.batches(items.limit(0)).count() == entities.mentions(items.limit(0)).count() == 0
    assert entities.mentions(items.withColumn("combined", F.lit(None).cast("string"))).count() == 0
    found = spark.createDataFrame([("a", 1, 0, None, "x"), ("a", 1, 1, "FOMC", "x")], "id string, ord long, alias_ord long, surface_form string, entity_type string")
    assert [r["canonical_id"] for r in entities.resolve(found, entities.alias_dimension(spark)).orderBy("alias_ord").collect()] == [None, "federal_reserve"]


def test_numbered_is_consecutive(spark):
    rows = spark.range(1000).select((F.col("id") * 7 % 1000).alias("x"), F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise("a").alias("y"))
    got = [(r["y"], r["x"]) for r in numbered(rows, ["y", "x"], "n").orderBy("n").collect()]
    assert got == sorted(got, key=lambda r: (r[0] is not None, r[0] or "", r[1])) and len(got) == 1000


def test_number_contexts_and_windows(spark):
    one = lambda c, x: spark.createDataFrame([(x,)], "x string").select(c(F.col("x"))).first()[0]
    got = one(t.numbers_in_context, "rates up 15-20 bps, 5 USD and 5 usd; -0 and 0; 20 bps")
    assert [(n["value"], n["unit"]) for n in got] == [(15.0, ""), (-20.0, "bps"), (5.0, "USD"), (5.0, "usd"), (-0.0, ""), (0.0, ""), (20.0, "bps")]
    assert got[0]["context_span"] == "rates up 15-20 bps, 5 USD and 5 usd; -0 a"
    assert one(t.numbers_in_context, None) is None and one(t.numbers_in_context, "") == []
    long = "a" * 1000 + "Fed" + "b" * 1000
    assert one(lambda c: t.context_window(c, F.lit("fed")), long) == "a" * 400 + "Fed" + "b" * 397
    assert one(lambda c: t.context_window(c, F.lit("ecb")), long) == "a" * 800
    assert one(lambda c: t.rendered("{x:.2f} {x:.1%}", x=c.cast("double")), "0.125") == "0.12 12.5%"
    assert one(lambda c: t.rendered("{x:.2f}", x=c.cast("double")), "2.675") == "2.67"


LINKED = "<title>t</title>" + "".join(f"<p><a href='/{i}' rel=x>link {i}</a>" for i in range(40))


def test_elements_come_in_parts_of_bounded_size():
    pages, tags = [LINKED, None, "", "<a>" + "x" * 3_000_000, LINKED] * 20, frozenset("a")
    got = list(html.parts(iter([pa.array(pages), pa.array([], pa.string()), pa.array([LINKED])]), tags))
    assert [dict(e, attrs=dict(e["attrs"])) for part in got for page in part.to_pylist() for e in page] == [e for page in [*pages, LINKED] for e in html.parsed(page, tags)]
    assert len(got) == 22 and max(part.nbytes for part in got) < html.PART_BYTES + 12_000_000  # the largest page's four texts


def test_a_worker_does_not_hold_a_batch_of_elements(spark):
    def workers(what):
        for p in Path("/proc").glob("[0-9]*"):
            with suppress(OSError):  # it may end meanwhile
                if b"pyspark.daemon" in (p / "cmdline").read_bytes():
                    yield p, int(re.search(rf"{what}:\s+(\d+)", (p / "status").read_text())[1]) // 1024

    pages = spark.range(0, 10_000, 1, 1).select(F.col("id").alias("page_id"), F.concat(F.lit(LINKED), F.col("id")).alias("html"))
    before = dict(workers("VmRSS"))
    for p in before:
        with suppress(OSError):
            (p / "clear_refs").write_text("5")  # the peak starts anew
    assert html.elements(pages, tags=("a",)).agg(F.sum(F.size("elements"))).first()[0] == 10_000 * 81
    grown = [peak - before.get(p, 0) for p, peak in workers("VmHWM")]
    assert grown and max(grown) < 400, grown  # MB; 991 when a batch was held whole
