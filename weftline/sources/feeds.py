"""Feeds and list pages into items; the connector that fetches them can be put in by the caller."""

from __future__ import annotations

import re
import time
import urllib.request
import xml.etree.ElementTree as ET
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions import scalars as S

MIN_TITLE, DATE_REACH = 5, 80
USER_AGENT = "weftline/0.1"
ENTRIES = "pos int, title string, url string, summary string, published string, publisher string"


def fetch(url: str, retries: int = 3, timeout: float = 30, opener=urllib.request.urlopen, sleep=time.sleep) -> bytes:
    """Bytes of a page; waits 1, 2, ... seconds between tries and raises RuntimeError after the last."""
    last = None
    for attempt in range(retries):
        try:
            with opener(urllib.request.Request(url, headers={"User-Agent": USER_AGENT}), timeout=timeout) as answer:
                return answer.read()
        except Exception as error:
            last = error
            if attempt + 1 < retries:
                sleep(2**attempt)
    raise RuntimeError(f"{url}: {last}")


def _name(element: ET.Element) -> str:
    return element.tag.rsplit("}", 1)[-1].lower() if isinstance(element.tag, str) else ""


def _child(element: ET.Element, *names: str) -> ET.Element | None:
    """The first child that is there, in the order of names."""
    for name in names:
        for child in element:
            if _name(child) == name:
                return child
    return None


def _words(element: ET.Element | None) -> str:
    return "" if element is None else "".join(element.itertext()).strip()


def parse_feed(raw: bytes) -> list[dict]:
    """Entries of an RSS 2.0, RDF or Atom feed, whatever its namespaces; an entry needs a title and a url."""
    out = []
    for entry in ET.fromstring(raw).iter():
        if _name(entry) not in ("item", "entry"):
            continue
        link = _words(_child(entry, "link"))
        if not link:
            link = next((c.get("href", "") for c in entry if _name(c) == "link" and c.get("rel", "alternate") == "alternate"), "")
        title = S.strip_html(_words(_child(entry, "title"))) or ""
        if not link or not title:
            continue
        title, publisher = S.cut_publisher(title, _words(_child(entry, "source")))
        summary = S.strip_html(_words(_child(entry, "description", "summary", "content", "encoded"))) or ""
        if summary == title or summary.startswith(title[:20]):
            summary = ""
        day = S.feed_date(_words(_child(entry, "pubdate", "date", "published", "updated")))
        out.append({"title": title, "url": S.canonical_url(link), "summary": summary, "published": day, "publisher": publisher})
    return out


class _Links(HTMLParser):
    """A page as stretches of text and links (address, words) in turn; links inside a link belong to it."""

    HIDDEN = {"script", "style", "noscript", "svg", "head"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts, self.hidden, self.nested, self.feeds = [""], 0, 0, []

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        if tag == "link" and "xml" in (attrs.get("type") or ""):
            self.feeds.append(attrs.get("href") or "")
        self.hidden += tag in self.HIDDEN
        if tag == "a" and not self.hidden:
            self.nested += 1
            if self.nested == 1:
                self.parts.append([attrs.get("href") or "", ""])

    def handle_endtag(self, tag):
        self.hidden -= tag in self.HIDDEN and self.hidden > 0
        if tag == "a" and self.nested and not self.hidden:
            self.nested -= 1
            if not self.nested:
                self.parts.append("")

    def handle_data(self, data):
        if self.hidden:
            return
        if self.nested:
            self.parts[-1][1] += data
        else:
            self.parts[-1] += data


def parse_links(page: str, base: str, pattern: str) -> list[dict]:
    """Items of a list page: links whose address matches, with a title of five characters or more, each address once.

    The date is the last one of the 80 characters between the link before and this one, else the first of the 80 between
    it and the next, of the title or of the address's path.
    """
    if not pattern:
        raise ValueError("a list page needs a link pattern")
    reader = _Links()
    reader.feed(page or "")
    reader.close()
    parts = reader.parts + [""] * (len(reader.parts) % 2 == 0)  # a link that never ends is one, too
    found: dict[str, dict] = {}
    for before, (href, words), after in zip(parts[::2], parts[1::2], parts[2::2]):
        if not href or href.startswith(("#", "javascript:", "mailto:")):
            continue
        url, title = S.canonical_url(urljoin(base, href)), S.normalize_text(words) or ""
        if url in found or len(title) < MIN_TITLE or not re.search(pattern, url):
            continue
        day = S.last_date(before[-DATE_REACH:]) or S.first_date(after[:DATE_REACH]) or S.first_date(title) or S.first_date(urlsplit(url).path)
        found[url] = {"title": title, "url": url, "summary": "", "published": day, "publisher": ""}
    return list(found.values())


def _entries(frames):
    names = [p.split()[0] for p in ENTRIES.split(", ")]
    for frame in frames:
        rows = []
        for source, kind, base, pattern, raw in frame[["source_id", "kind", "url", "link_pattern", "content"]].itertuples(index=False):
            try:
                found = parse_feed(bytes(raw)) if kind == "rss" else parse_links(S.decode_page(bytes(raw)), base, pattern)
                rows += [(source, None, i, *(e[n] for n in names[1:])) for i, e in enumerate(found)]
            except Exception as error:  # one source's failure is a row, the others go on
                rows.append((source, str(error)[:200], *[None] * len(names)))
        yield pd.DataFrame(rows, columns=["source_id", "error", *names])


def scan_pages(pages: DataFrame) -> DataFrame:
    """pages (source_id, kind, url, link_pattern, content) -> (source_id, error, pos, title, url, summary, published, publisher)."""
    return pages.mapInPandas(_entries, f"source_id string, error string, {ENTRIES}")


def list_links(pages: DataFrame, pattern: str) -> DataFrame:
    """Links of HTML text pages (url, html) that match, as items."""

    def run(frames):
        for frame in frames:
            rows = [(u, i, e["title"], e["url"], e["published"]) for u, h in zip(frame["url"], frame["html"]) for i, e in enumerate(parse_links(h, u, pattern))]
            yield pd.DataFrame(rows, columns=["page", "pos", "title", "url", "published"])

    return pages.select("url", "html").mapInPandas(run, "page string, pos int, title string, url string, published string")


def probe(raw: bytes, base: str) -> dict:
    """What a page offers: the first five entries if it is a feed, else the feeds it names and its first ten links."""
    try:
        entries = parse_feed(raw)
        if entries:
            return {"feed": entries[:5]}
    except ET.ParseError:
        pass
    reader = _Links()
    reader.feed(S.decode_page(raw) or "")
    links = [(urljoin(base, h), " ".join(t.split())) for h, t in reader.parts[1::2] if h and not h.startswith(("#", "javascript:", "mailto:"))]
    feeds = [urljoin(base, f) for f in reader.feeds if f] + [u for u, _ in links if re.search(r"(?:xml|rdf|rss)$", u)]
    return {"feeds": list(dict.fromkeys(feeds)), "links": links[:10]}


def read_pages(sources: DataFrame, folder: str) -> DataFrame:
    """Fetched pages <source id>.* in a folder, beside their source definitions."""
    files = sources.sparkSession.read.format("binaryFile").load(folder)
    named = files.select(F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1).alias("source_id"), "content")
    return named.join(sources.select(F.col("id").alias("source_id"), "kind", "url", "link_pattern"), "source_id")
