"""Pages from a fetcher, robots rules and sitemaps. Fetchers run in tasks; a table of pages is the offline one."""

from __future__ import annotations

import time
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator
from typing import Protocol
from urllib.parse import urljoin
from urllib.request import Request, urlopen
from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from sparkweft.session import cut_lineage

FETCHED = "url string, final_url string, status int, html string, error string"


class Fetcher(Protocol):
    """One for each task; get() returns (final URL, status, text) or raises."""

    def get(self, url: str) -> tuple[str, int, str]: ...

    def close(self) -> None: ...


class UrlFetcher:
    """Plain HTTP by the standard library, with a deadline and a user agent; pages are not rendered."""

    def __init__(self, user_agent: str, timeout: float = 20.0):
        self.headers, self.timeout = {"User-Agent": user_agent}, timeout

    def get(self, url: str) -> tuple[str, int, str]:
        with urlopen(Request(url, headers=self.headers), timeout=self.timeout) as r:
            return r.url, r.status, r.read().decode(r.headers.get_content_charset() or "utf-8", "replace")

    def close(self) -> None:
        pass


def fetch(urls: DataFrame, make: Callable[[], Fetcher], attempts: int = 3, backoff: float = 0.0) -> DataFrame:
    """FETCHED rows for the distinct URLs; after the last attempt the error is kept (200 characters), the status if the server answered, and html is null."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fetcher = make()
        try:
            for b in batches:
                out = []
                for url in b["url"]:
                    error = answered = None
                    for k in range(max(1, attempts)):
                        try:
                            final, status, html = fetcher.get(url)
                            out.append((url, final, status, html, None))
                            error = None
                            break
                        except Exception as e:  # whatever the fetcher raises is this URL's result
                            error, answered = str(e)[:200], getattr(e, "code", None)
                            if backoff and k + 1 < attempts:
                                time.sleep(backoff)
                    if error is not None:
                        out.append((url, None, answered, None, error))
                yield pd.DataFrame(out, columns=["url", "final_url", "status", "html", "error"])
        finally:
            fetcher.close()

    return urls.select("url").distinct().mapInPandas(run, FETCHED)


def fetch_table(urls: DataFrame, make: Callable[[], Fetcher], attempts: int = 3, backoff: float = 0.0) -> DataFrame:
    """fetch(), done once and kept: later stages read the same snapshot. Found by the URL asked for and by the final one."""
    found = cut_lineage(fetch(urls, make, attempts, backoff))
    moved = found.filter("final_url <> url").join(found.select(F.col("url").alias("final_url")), "final_url", "left_anti")
    return found.unionByName(moved.withColumn("url", F.col("final_url")).dropDuplicates(["url"]))


def parse_robots(text: str | None, root_url: str, status_ok: bool = True) -> tuple[RobotFileParser, list[str]]:
    """Rules and sitemaps. No answer (None) allows all; an answer that is an error leaves rules unread, which blocks all."""
    parser, sitemaps = RobotFileParser(), []
    if text is None:
        parser.parse([])
    elif status_ok:
        lines = text.splitlines()
        parser.parse(lines)
        sitemaps = [line.partition(":")[2].strip() for line in lines if line.lower().startswith("sitemap:")]
    return parser, sitemaps or [urljoin(root_url, "/sitemap.xml"), urljoin(root_url, "/sitemap_index.xml")]


def robots_of(answer: Row | None) -> tuple[str | None, bool]:
    """(text, whether it is one) of a FETCHED row for robots.txt, as parse_robots takes them: an error of the server is an answer, none at all is not."""
    if answer is None or (answer.html is None and answer.status is None):
        return None, True
    return answer.html or "", answer.html is not None and (answer.status or 200) < 400


def allowed_by_robots(urls: DataFrame, robots: str | None, root_url: str, user_agent: str, status_ok: bool = True) -> DataFrame:
    """urls with `allowed`."""

    @F.pandas_udf("boolean")
    def allowed(found: pd.Series) -> pd.Series:
        parser, _ = parse_robots(robots, root_url, status_ok)
        return found.map(lambda u: u is not None and parser.can_fetch(user_agent, u))

    return urls.withColumn("allowed", allowed("url"))


def sitemap_links(xml: str) -> tuple[str, list[str]]:
    """('index' or 'urls', the locations); a text that is no sitemap has none."""
    try:
        root = ET.fromstring(xml)
    except ET.ParseError:
        return "urls", []
    kind = "index" if root.tag.rpartition("}")[2] == "sitemapindex" else "urls"
    return kind, [e.text.strip() for e in root.iter() if e.tag.rpartition("}")[2] == "loc" and e.text and e.text.strip()]


@F.pandas_udf(StructType([StructField("kind", StringType()), StructField("links", ArrayType(StringType()))]))
def _links(xml: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([sitemap_links(x or "") for x in xml], columns=["kind", "links"])


def sitemap_urls(start: DataFrame, sitemaps: DataFrame) -> DataFrame:
    """Distinct page URLs from the sitemaps in start (url), through indexes of any depth. sitemaps: url, html (the XML)
    of what can be fetched. A sitemap is visited once, so indexes that name each other end."""
    level = start.select("url").distinct()
    seen, found = level, None
    while True:
        read = cut_lineage(level.join(sitemaps.select("url", F.col("html").alias("xml")), "url").select(_links("xml").alias("s")).select("s.*"))
        links = read.filter("kind = 'urls'").select(F.explode("links").alias("url"))
        found = links if found is None else found.unionByName(links)
        level = cut_lineage(read.filter("kind = 'index'").select(F.explode("links").alias("url")).distinct().join(seen, "url", "left_anti"))
        if not level.limit(1).count():
            return found.distinct()
        seen = cut_lineage(seen.unionByName(level))
