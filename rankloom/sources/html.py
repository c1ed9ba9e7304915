"""Links of web pages."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urldefrag, urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..scratch import Scratch
from ..shipping import map_arrow


class _Anchors(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[str, str]] = []
        self.href: str | None = None
        self.parts: list[str] = []

    def handle_starttag(self, tag, attrs):
        # An anchor that is never closed gives no link: the next one takes its place.
        if tag == "a" and (href := dict(attrs).get("href")):
            self.href, self.parts = href, []

    def handle_data(self, data):
        if self.href is not None:
            self.parts.append(data)

    def handle_endtag(self, tag):
        if tag == "a" and self.href is not None:
            self.found.append((self.href, " ".join(" ".join(self.parts).split())))
            self.href, self.parts = None, []


def links_of(base: str, html: str | None) -> list[tuple[str, str]]:
    """(absolute url without fragment, text), the first of each url."""
    parser = _Anchors()
    parser.feed(html or "")
    out: dict[str, str] = {}
    for href, text in parser.found:
        out.setdefault(urldefrag(urljoin(base or "", href))[0], text)
    return list(out.items())


def page_links(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    """page_id, place, url, text of every distinct link of every page, parsed in Arrow batches."""
    kind = pages.schema[page_id].dataType.simpleString()

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [links_of(base, h) for base, h in zip(b.column("u").to_pylist(), b.column("h").to_pylist())]
            rows = [(n, u, t) for links in found for n, (u, t) in enumerate(links)]
            ids = b.column("i").take(pa.array([k for k, links in enumerate(found) for _ in links], pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *(pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.int32(), pa.string(), pa.string())))], names=["page_id", "place", "url", "text"])

    work = pages.select(F.col(page_id).alias("i"), F.col(url).alias("u"), F.col(html).alias("h"))
    return map_arrow(work, parse, f"page_id {kind}, place int, url string, text string").withColumnRenamed("page_id", page_id)


def hrefs(html: Column) -> Column:
    """Targets of anchors as written, distinct in order; an expression, for regular markup."""
    return F.array_distinct(F.regexp_extract_all(html, F.lit('<a[^>]*href="([^"]*)"'), F.lit(1)))


def crawl(edges: DataFrame, roots: DataFrame, most: int = 30) -> DataFrame:
    """url, depth: breadth-first from the roots over edges (url, target), at most `most` pages, nearest and then
    alphabetically first. A level is one join, written so that the next one starts from its rows; it ends when a level
    brings nothing new. The bound keeps what is counted on the driver, and the number of levels, small."""
    scratch = Scratch(edges.sparkSession, "crawl")
    seen = scratch.table(roots.select("url").distinct().withColumn("depth", F.lit(0)), "roots")
    level, n = seen, seen.count()
    depth = 0
    while n < most:
        depth += 1
        new = edges.join(level.select("url"), "url").select(F.col("target").alias("url")).distinct().join(seen.select("url"), "url", "left_anti")
        new = scratch.table(new.orderBy("url").limit(most - n).withColumn("depth", F.lit(depth)), "level")
        got = new.count()
        if not got:
            break
        seen, level, n = seen.unionByName(new), new, n + got
    return seen


def crawl_documents(links: DataFrame, roots: DataFrame, label: Column, follows: Column, is_document: Column, most: int = 30) -> tuple[DataFrame, DataFrame]:
    """Pages in the order in which a queue visits them, at most `most`, and the documents that they link to.

    links: page, place, url, text (as page_links gives them). roots: url. label says what a link's text or url names
    (null if nothing), and a link without one takes its page's label; the first link to a page decides. follows and
    is_document are conditions on a link. Pages: url, nth (from 1), depth, label. Documents: page, place, url, text,
    label (never null), as often as visited pages link to them.

    A level of the search is one join from its pages; a level's pages are numbered by their first link (the linking
    page's number, then place), which is the queue's order. Levels end at the bound or when nothing new is reached."""
    scratch = Scratch(links.sparkSession, "crawl")
    marked = links.select("page", "place", "url", "text", label.alias("__label"), follows.alias("__follows"), is_document.alias("__is_document"))
    first = W.partitionBy("url").orderBy("__parent", "place")
    numbered = W.orderBy("__parent", "place", "url")
    # One row for each page of a level, which the bound keeps few.
    level = roots.select("url").distinct().withColumn("nth", F.row_number().over(W.orderBy("url"))).filter(F.col("nth") <= most)
    level = scratch.table(level.select("url", "nth", F.lit(0).alias("depth"), F.lit(None).cast("string").alias("label")), "level")
    seen, n, depth = level, level.count(), 0
    while n < most:
        depth += 1
        reached = marked.filter("__follows").join(level.select(F.col("url").alias("page"), F.col("nth").alias("__parent"), F.col("label").alias("__from")), "page")
        fresh = reached.join(seen.select("url"), "url", "left_anti").withColumn("__k", F.row_number().over(first)).filter("__k = 1")
        placed = fresh.select("url", (F.row_number().over(numbered) + n).alias("nth"), F.lit(depth).alias("depth"), F.coalesce("__label", "__from").alias("label"))
        level = scratch.table(placed.filter(F.col("nth") <= most), "level")
        got = level.count()
        if not got:
            break
        seen, n = seen.unionByName(level), n + got
    found = marked.filter("__is_document").join(seen.select(F.col("url").alias("page"), F.col("label").alias("__from")), "page")
    documents = found.withColumn("label", F.coalesce("__label", "__from")).filter("label is not null")
    return seen, documents.select("page", "place", "url", "text", "label")
