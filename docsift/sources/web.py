"""Web sources (SRC-6..SRC-8, TXT-4): sitemap -> URLs -> pages -> articles."""

from __future__ import annotations

import time
from html.parser import HTMLParser
from typing import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift.session import ship_package

SITEMAP_LOC_XPATH = '//*[local-name()="loc"]/text()'


def sitemap_urls(df: DataFrame, xml_col: str = "xml", max_documents: int | None = None,
                 partitions: int | None = None) -> DataFrame:
    """SRC-6/7: every ``loc`` of each sitemap document, in document order.

    ``max_documents`` keeps the first N per sitemap (0/None = all), the
    sitemap's own order; ``partitions`` spreads the URLs for fetching.
    """
    locs = df.select(F.posexplode(F.xpath(F.col(xml_col), F.lit(SITEMAP_LOC_XPATH))).alias("pos", "url"))
    if max_documents:
        locs = locs.filter(F.col("pos") < max_documents)
    locs = locs.select(F.trim("url").alias("url"))
    return locs.repartition(partitions) if partitions else locs


def read_sitemap(spark, path: str, max_documents: int | None = None, partitions: int | None = None) -> DataFrame:
    """Sitemap files (one XML document per file) -> URL rows."""
    x = spark.read.option("wholetext", True).text(path).withColumnRenamed("value", "xml")
    return sitemap_urls(x, "xml", max_documents, partitions)


def http_fetcher(timeout: float = 10.0, retries: int = 3, backoff: float = 3.0, threads: int = 16):
    """Network fetcher: status 200 -> decoded body; other status or error -> None.

    Retries only on HTTP 429, sleeping ``backoff * 2**attempt`` seconds.
    """
    def fetch_one(url):
        import urllib.error
        import urllib.request
        for attempt in range(retries + 1):
            try:
                with urllib.request.urlopen(url, timeout=timeout) as r:
                    if r.status != 200:
                        return None
                    return r.read().decode("utf-8", errors="replace")
            except urllib.error.HTTPError as e:
                if e.code == 429 and attempt < retries:
                    time.sleep(backoff * (2 ** attempt))
                    continue
                return None
            except Exception:  # noqa: BLE001 - any request error gives null
                return None
        return None

    def fetch(urls: list) -> list:
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=threads) as ex:
            return list(ex.map(lambda u: None if u is None else fetch_one(u), urls))

    return fetch


def fetch_pages(urls: DataFrame, fetcher: Callable[[list], list], url_col: str = "url",
                out_col: str = "html") -> DataFrame:
    """SRC-8: fetch each URL once (``mapInArrow``: a filter on the result
    never re-runs the fetch)."""
    ship_package(urls.sparkSession)
    schema = T.StructType(urls.schema.fields + [T.StructField(out_col, T.StringType())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            bodies = fetcher(b.column(url_col).to_pylist())
            yield b.append_column(out_col, pa.array(bodies, type=pa.string()))

    return urls.mapInArrow(run, schema)


def fetch_offline(urls: DataFrame, pages: DataFrame, url_col: str = "url", html_col: str = "html",
                  version_col: str | None = "page_id") -> DataFrame:
    """Offline fetcher: left join of URLs to stored pages; a missing page is null.

    A fetch returns one body per URL: stored copies of a URL are first
    reduced to the one with the highest ``version_col`` (a partial
    aggregation, so a URL stored a million times is no hot join key).
    """
    if version_col and version_col in pages.columns:
        body = F.max_by(F.col(html_col), F.col(version_col))
    else:
        body = F.max(F.col(html_col))
    p = pages.groupBy(F.col("url").alias(url_col)).agg(body.alias("html"))
    return urls.join(p, url_col, "left")


def article_text(html: Column) -> Column:
    """TXT-4 (fixed container): inner HTML of ``<article>``, trimmed; null if none."""
    from docsift.functions.text import article
    return article(html)


class _Container(HTMLParser):
    """Outer HTML of the first element with the wanted tag and attributes."""

    def __init__(self, tag: str, attrs: dict):
        super().__init__(convert_charrefs=False)
        self.tag, self.want = tag, attrs
        self.depth, self.start, self.end = 0, None, None
        self._lines = None

    def _offset(self):
        line, col = self.getpos()
        return self._lines[line - 1] + col

    def handle_starttag(self, tag, attrs):
        if self.end is not None:
            return
        if self.start is None:
            a = dict(attrs)
            if tag == self.tag and all(a.get(k) == v for k, v in self.want.items()):
                self.start, self.depth = self._offset(), 1
        elif tag == self.tag:
            self.depth += 1

    def handle_endtag(self, tag):
        if self.start is not None and self.end is None and tag == self.tag:
            self.depth -= 1
            if self.depth == 0:
                self.end = self._offset() + len(f"</{tag}>")

    def find(self, html: str):
        offs, pos = [0], 0
        for ln in html.splitlines(keepends=True):
            pos += len(ln)
            offs.append(pos)
        self._lines = offs
        self.feed(html)
        self.close()
        if self.start is None:
            return None
        end = self.end if self.end is not None else len(html)
        out = html[self.start:end].strip()
        return out or None


def container_udf(tag: str = "div", **attrs):
    """TXT-4 (nested containers): Arrow UDF over the standard library parser,
    e.g. ``container_udf("div", itemprop="articleBody")``."""
    @F.arrow_udf("string")
    def extract(col: pa.Array) -> pa.Array:
        out = [None if h is None else _Container(tag, attrs).find(h) for h in col.to_pylist()]
        return pa.array(out, type=pa.string())
    return extract


def scrape_articles(urls: DataFrame, fetch: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """SRC-6 -> SRC-8 -> TXT-4 -> FLT-1: (url, text) of pages with an article."""
    pages = fetch(urls)
    return pages.select("url", article_text(F.col("html")).alias("text")).filter(F.col("text").isNotNull())
