"""Live pages: a data source with one partition for each source, and look-ups of linked pages.

``spark.read.format("tidemark_pages")`` gives (source_key, page_url, html).  A source that fails gives no
row and stops no other.  Options: `sources` (keys, comma-separated; unknown ones are ignored, none means
all), `urls` (JSON that names other addresses by key), `timeout`, `attempts`, `wait` (the shortest wait
between attempts in seconds, the longest is four times that).
"""

from __future__ import annotations

import json
import logging
import time
import urllib.request
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidemark.runtime import importable
from tidemark.sources.content import chosen_sources

log = logging.getLogger(__name__)

# The sources' pages.
PAGES = {
    "yahoo_eurusd": "https://finance.yahoo.com/quote/EURUSD%3DX/",
    "yahoo_markets": "https://finance.yahoo.com/markets/",
    "fed": "https://www.federalreserve.gov/newsevents/pressreleases.htm",
    "imf": "https://www.imf.org/en/News",
    "reuters": "https://www.reuters.com/markets/currencies/",
}
TIMEOUT, ATTEMPTS, WAIT = 30.0, 3, 2.0
HEADERS = {"User-Agent": "Mozilla/5.0 (compatible; tidemark)", "Accept-Language": "en-US,en;q=0.9", "Accept": "text/html,application/xhtml+xml"}


def waits(attempts: int, shortest: float) -> list[float]:
    """Seconds between attempts: they double, from the shortest to four times that."""
    return [min(4 * shortest, max(shortest, shortest / 2 * 2**n)) for n in range(attempts - 1)]


def fetch(url: str, timeout: float = TIMEOUT, attempts: int = ATTEMPTS, wait: float = WAIT) -> str:
    """The page's text; redirects are followed, anything but success raises after the last attempt."""
    for pause in [*waits(attempts, wait), None]:
        try:
            with urllib.request.urlopen(urllib.request.Request(url, headers=HEADERS), timeout=timeout) as answer:
                return answer.read().decode(answer.headers.get_content_charset() or "utf-8", "replace")
        except Exception:
            if pause is None:
                raise
            time.sleep(pause)
    raise AssertionError


class _Source(InputPartition):
    def __init__(self, key: str, url: str):
        self.key, self.url = key, url


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        asked = [k.strip() for k in options.get("sources", "").split(",") if k.strip()]
        urls = PAGES | json.loads(options.get("urls", "{}"))
        self.sources = [_Source(k, urls[k]) for k in chosen_sources(asked)]
        self.how = float(options.get("timeout", TIMEOUT)), int(options.get("attempts", ATTEMPTS)), float(options.get("wait", WAIT))

    def partitions(self) -> list[InputPartition]:
        return self.sources or [_Source("", "")]

    def read(self, partition: _Source) -> Iterator[tuple]:
        if partition.key:
            try:
                yield partition.key, partition.url, fetch(partition.url, *self.how)
            except Exception:
                log.exception("source %s failed", partition.key)


class Pages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tidemark_pages"

    def schema(self) -> str:
        return "source_key string, page_url string, html string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


def read_pages(spark: SparkSession, sources: list[str] | None = None, **options: str) -> DataFrame:
    importable(spark)
    spark.dataSource.register(Pages)
    return spark.read.format("tidemark_pages").options(sources=",".join(sources or []), **options).load()


def fetched(urls: DataFrame, timeout: float = TIMEOUT, attempts: int = ATTEMPTS, wait: float = WAIT) -> DataFrame:
    """(page_url, html) of the distinct page_url in urls; those that fail are left out."""
    importable(urls.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for url in batch["page_url"]:
                try:
                    yield pd.DataFrame({"page_url": [url], "html": [fetch(url, timeout, attempts, wait)]})
                except Exception:
                    log.warning("no page at %s", url)

    return urls.select("page_url").where("page_url IS NOT NULL").distinct().mapInPandas(run, "page_url string, html string")
