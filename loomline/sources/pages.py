"""List and detail pages: charsets, links, dates."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType
from pyspark.sql.window import Window

from loomline.functions.time import dotted_timestamp, page_timestamp
from loomline.functions.url import absolute_url, path_timestamp

LINKS = ArrayType(StructType([StructField("url", StringType()), StructField("title", StringType()), StructField("date", StringType())]))
_DATE = re.compile(r"(?:\d{4}|\d{2})[.\-/]\d{1,2}[.\-/]\d{1,2}(?:\s+\d{1,2}:\d{2})?|\d{1,2}[.\-/]\d{1,2}\s+\d{1,2}:\d{2}")
CHARSETS = ("utf-8", "cp949", "euc-kr")


def decode_page(data: bytes, charsets: tuple[str, ...] = CHARSETS) -> str:
    """The first charset that decodes all of it; else the first with replacements."""
    for c in charsets:
        try:
            return data.decode(c)
        except UnicodeDecodeError:
            continue
    return data.decode(charsets[0], "replace")


class _Links(HTMLParser):
    """Anchors with text, each with the first date that follows it before the next anchor."""

    def __init__(self) -> None:
        super().__init__()
        self.found: list[dict] = []
        self.open: dict | None = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "a":
            self.open = {"url": dict(attrs).get("href"), "title": "", "date": None}

    def handle_data(self, data: str) -> None:
        if self.open is not None:
            self.open["title"] += data
        elif self.found and self.found[-1]["date"] is None and (m := _DATE.search(data)):
            self.found[-1]["date"] = m[0]

    def handle_endtag(self, tag: str) -> None:
        if tag == "a" and self.open is not None:
            self.open["title"] = " ".join(self.open["title"].split())
            if self.open["url"] and self.open["title"]:
                self.found.append(self.open)
            self.open = None


def page_links(html: str | None) -> list[dict]:
    parser = _Links()
    parser.feed(html or "")
    return parser.found


@dataclass(frozen=True)
class Rule:
    """An element by tag and, if given, by class or attribute: ``Rule("h1")``, ``Rule("div", "title")``, ``Rule("meta", attribute=("property", "og:title"), value="content")``."""

    tag: str
    css: str | None = None
    attribute: tuple[str, str] | None = None
    value: str | None = None

    def fits(self, tag: str, attrs: dict) -> bool:
        return tag == self.tag and (self.css is None or self.css in (attrs.get("class") or "").split()) and (self.attribute is None or attrs.get(self.attribute[0]) == self.attribute[1])


_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class _Elements(HTMLParser):
    """Texts (or attribute values) and inner markup of the elements that each rule fits."""

    def __init__(self, rules: list[Rule]) -> None:
        super().__init__()
        self.rules, self.open = rules, []
        self.texts: list[list[str]] = [[] for _ in rules]
        self.inner: list[list[str]] = [[] for _ in rules]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        raw, found = self.get_starttag_text() or "", dict(attrs)
        for o in self.open:
            o["html"].append(raw)
        fits = [k for k, r in enumerate(self.rules) if r.fits(tag, found)]
        for k in fits:
            if self.rules[k].value:
                self.texts[k].append(found.get(self.rules[k].value) or "")
        if tag not in _VOID:
            for o in self.open:
                o["depth"] += o["tag"] == tag
            self.open += [{"rule": k, "tag": tag, "depth": 1, "text": [], "html": []} for k in fits if not self.rules[k].value]

    def handle_data(self, data: str) -> None:
        for o in self.open:
            o["text"].append(data)
            o["html"].append(data)

    def handle_endtag(self, tag: str) -> None:
        for o in list(self.open):
            o["depth"] -= o["tag"] == tag
            if o["depth"] == 0:
                self.open.remove(o)
                self.texts[o["rule"]].append(" ".join("".join(o["text"]).split()))
                self.inner[o["rule"]].append("".join(o["html"]))
            else:
                o["html"].append(f"</{tag}>")


def first_match(page: str | None, rules: list[Rule]) -> str | None:
    """The first non-empty text of the first rule that has one: rules are tried in order."""
    parser = _Elements(rules)
    parser.feed(page or "")
    return next((t for texts in parser.texts for t in texts if t), None)


def listed_links(page: str | None, containers: list[Rule]) -> list[dict]:
    """Links inside the first kind of container that holds any; of the whole page if none does."""
    parser = _Elements(containers)
    parser.feed(page or "")
    for parts in parser.inner:
        found = [x for p in parts for x in page_links(p)]
        if found:
            return found
    return page_links(page)


@dataclass(frozen=True)
class PageSpec:
    """How a site's pages are read: where list pages hold their links, and where detail pages hold title, date and summary, each in order of preference."""

    site: str
    wanted: str
    containers: list[Rule]
    title: list[Rule]
    date: list[Rule]
    summary: list[Rule]
    zone: str = "UTC"


def list_pages(pages: DataFrame, spec: PageSpec, as_of: datetime, wanted: int | None = None) -> DataFrame:
    """``url, title, published_ts`` of list pages ``page_no, html``: each address once, by page and place; pages after the one that fills ``wanted`` are not used."""

    @F.pandas_udf(LINKS)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(lambda p: listed_links(p, spec.containers))

    rows = pages.select("page_no", F.posexplode(found("html")).alias("pos", "l")).select("page_no", "pos", absolute_url(F.col("l.url"), spec.site).alias("url"), F.col("l.title").alias("title"), F.col("l.date").alias("date"))
    at = F.struct("page_no", "pos")
    once = rows.where(F.col("url").rlike(spec.wanted)).groupBy("url").agg(F.min(at).alias("_at"), F.min_by("title", at).alias("title"), F.min_by("date", at).alias("date"))
    once = once.select(F.col("_at.page_no").alias("page_no"), F.col("_at.pos").alias("pos"), "url", "title", F.coalesce(page_timestamp("date", as_of, spec.zone), path_timestamp("url")).alias("published_ts"))
    if wanted is not None:
        counts = once.groupBy("page_no").agg(F.count("*").alias("_n"))
        before = Window.orderBy("page_no").rowsBetween(Window.unboundedPreceding, -1)  # one row per list page
        read = counts.where(F.lit(True)).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).where(F.col("_before") < wanted).select("page_no")
        once = once.join(read, "page_no", "left_semi")
    return once


def detail_pages(pages: DataFrame, spec: PageSpec, listed: DataFrame, as_of: datetime) -> DataFrame:
    """``url, title, summary, published_ts`` of detail pages ``url, html``: the list's title and date where it has them, then the page's own by the spec's preference."""

    def pick(rules: list[Rule]) -> Callable:
        @F.pandas_udf(StringType())
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for s in batches:
                yield s.map(lambda p: first_match(p, rules))

        return run

    own = pages.select("url", pick(spec.title)("html").alias("_t"), pick(spec.summary)("html").alias("summary"), pick(spec.date)("html").alias("_d"))
    joined = listed.select("url", "title", "published_ts").join(own, "url")
    return joined.select("url", F.coalesce(F.nullif("title", F.lit("")), "_t").alias("title"), "summary", F.coalesce("published_ts", page_timestamp("_d", as_of, spec.zone)).alias("published_ts"))


@F.pandas_udf(LINKS)
def links(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in pages:
        yield s.map(page_links)


@F.pandas_udf(StringType())
def decoded(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in pages:
        yield s.map(lambda b: decode_page(bytes(b)) if b is not None else None)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """``path, html`` of all files under ``path``."""
    return spark.read.format("binaryFile").load(path).select("path", decoded("content").alias("html"))


def list_articles(pages: DataFrame, site: str, wanted: str) -> DataFrame:
    """``url, title, published_ts`` of the links whose address matches ``wanted``, each address once. The date in the list counts before that in the address."""
    rows = pages.select(F.posexplode(links("html")).alias("pos", "l")).select("pos", absolute_url(F.col("l.url"), site).alias("url"), F.col("l.title").alias("title"), F.col("l.date").alias("date"))
    rows = rows.where(F.col("url").rlike(wanted))
    return rows.groupBy("url").agg(F.min_by("title", "pos").alias("title"), F.min_by("date", "pos").alias("date")).select("url", "title", F.coalesce(list_date("date"), path_timestamp("url")).alias("published_ts"))


def list_date(text: Column | str) -> Column:
    d = F.regexp_replace(F.col(text) if isinstance(text, str) else text, "[-/]", ".")
    whole = F.when(d.rlike(r"^\d{2}\."), F.concat(F.lit("20"), d)).otherwise(d)
    return F.coalesce(dotted_timestamp(whole), F.try_to_timestamp(whole, F.lit("yyyy.MM.dd")))


def enrich(articles: DataFrame, pages: DataFrame, chars: int = 200) -> DataFrame:
    """Fills missing summary, image and authors of articles from ``url, body, image_url, authors``; what is there stays."""
    extra = pages.select("url", F.substring("body", 1, chars).alias("_s"), F.col("image_url").alias("_i"), F.col("authors").alias("_a"))
    joined = articles.join(extra, "url", "left")
    fill = lambda c, e: F.coalesce(F.nullif(c, F.lit("")), e)
    return joined.withColumns({"summary": fill("summary", "_s"), "image_url": fill("image_url", "_i"), "authors": fill("authors", "_a")}).drop("_s", "_i", "_a")
