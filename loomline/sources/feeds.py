"""Feeds and configuration files."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator
from functools import reduce
from urllib.request import Request, urlopen

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.utils import AnalysisException

from loomline.sources.sinks import with_retry

ITEM = "title string, description string, summary string, link string, guid string, id string, href string, pubDate string, published string, updated string, source string"
_ENTRY = ("title", "summary", "link", "id", "href", "published", "updated", "pubDate")


def read_feed(spark: SparkSession, path: str, row_tag: str = "item") -> DataFrame:
    """Entries of RSS (``item``) or Atom (``entry``) files with their position; broken files give no rows."""
    raw = spark.read.format("xml").option("rowTag", row_tag).option("mode", "PERMISSIVE").schema(ITEM).load(path)
    placed = raw.withColumn("pos", F.monotonically_increasing_id())
    return placed.select("pos", "title", F.coalesce("summary", "description").alias("summary"), "link", F.coalesce("id", "guid").alias("id"), "href", "published", "updated", "pubDate")


def read_feeds(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """All feeds with ``feed_ord`` and ``feed_name``, in the order given."""
    parts = [read_feed(spark, p).withColumns({"feed_ord": F.lit(k), "feed_name": F.lit(n)}) for k, (n, p) in enumerate(paths.items())]
    return reduce(DataFrame.unionByName, parts)


def read_present_feeds(spark: SparkSession, paths: dict[str, str]) -> tuple[DataFrame, dict[str, str]]:
    """The same, but feeds whose path cannot be read are left out and named with what went wrong."""
    parts, failed = [], {}
    for k, (name, path) in enumerate(paths.items()):
        try:
            part = read_feed(spark, path)
            part.schema  # noqa: B018 - a path that does not exist is noticed here
        except AnalysisException as e:
            failed[name] = str(e).split("\n")[0]
            continue
        parts.append(part.withColumns({"feed_ord": F.lit(k), "feed_name": F.lit(name)}))
    empty = spark.createDataFrame([], "pos bigint, title string, summary string, link string, id string, href string, published string, updated string, pubDate string, feed_ord int, feed_name string")
    return (reduce(DataFrame.unionByName, parts) if parts else empty), failed


def feed_entries(data: bytes) -> list[dict]:
    """Entries of an RSS or Atom document; ValueError if it is none."""
    try:
        root = ET.fromstring(data)
    except ET.ParseError as e:
        raise ValueError(f"no feed: {e}") from e
    out = []
    for node in (n for n in root.iter() if n.tag.rsplit("}", 1)[-1] in ("item", "entry")):
        entry: dict[str, str | None] = dict.fromkeys(_ENTRY)
        for child in node:
            name = child.tag.rsplit("}", 1)[-1]
            value = (child.text or "").strip() or None
            name = {"description": "summary", "guid": "id"}.get(name, name)
            if name == "link" and child.get("href"):
                value = child.get("href")
            if name in entry and entry[name] is None:
                entry[name] = value
        out.append(entry)
    return out


class _Url(InputPartition):
    def __init__(self, order: int, name: str, url: str) -> None:
        super().__init__(order)
        self.order, self.name, self.url = order, name, url


class _FeedReader(DataSourceReader):
    def __init__(self, urls: list[tuple[str, str]], timeout: float, attempts: int) -> None:
        self.urls, self.timeout, self.attempts = urls, timeout, attempts

    def partitions(self) -> list[InputPartition]:
        return [_Url(k, n, u) for k, (n, u) in enumerate(self.urls)]

    def read(self, partition: _Url) -> Iterator[tuple]:
        def load() -> list[dict]:
            with urlopen(Request(partition.url, headers={"User-Agent": "loomline"}), timeout=self.timeout) as answer:  # noqa: S310
                return feed_entries(answer.read())

        try:
            entries = with_retry(load, self.attempts, delay=0.5)
        except Exception as e:  # noqa: BLE001 - one source's fault is a row, not the end of the others
            yield (partition.order, partition.name, None, *(None for _ in _ENTRY), f"{type(e).__name__}: {e}")
            return
        for k, e in enumerate(entries):
            yield (partition.order, partition.name, k, *(e[c] for c in _ENTRY), None)


class FeedSource(DataSource):
    """``spark.read.format("news_feeds").option("feed.NAME", "https://…")``: one partition and one download per feed, retried; a feed that fails gives one row with ``error``."""

    @classmethod
    def name(cls) -> str:
        return "news_feeds"

    def schema(self) -> str:
        return "feed_ord int, feed_name string, pos bigint, title string, summary string, link string, id string, href string, published string, updated string, pubDate string, error string"

    def reader(self, schema) -> DataSourceReader:
        urls = [(k[5:], v) for k, v in self.options.items() if k.startswith("feed.")]
        return _FeedReader(urls, float(self.options.get("timeout", 20)), int(self.options.get("attempts", 3)))


def fetch_feeds(spark: SparkSession, urls: dict[str, str], timeout: float = 20, attempts: int = 3) -> tuple[DataFrame, DataFrame]:
    """Entries of remote feeds, and ``feed_name, ok, n, error`` of each; downloads run side by side and fail each for itself."""
    spark.dataSource.register(FeedSource)
    reader = spark.read.format("news_feeds").option("timeout", timeout).option("attempts", attempts)
    for name, url in urls.items():
        reader = reader.option(f"feed.{name}", url)
    rows = reader.load()
    names = spark.createDataFrame([(n.lower(), n, k) for k, n in enumerate(urls)], "low string, feed_name string, feed_ord int")
    rows = rows.withColumn("low", F.lower("feed_name")).drop("feed_name", "feed_ord").join(F.broadcast(names), "low").drop("low")  # one row per feed
    status = rows.groupBy("feed_name").agg(F.max("error").isNull().alias("ok"), F.count("pos").alias("n"), F.max("error").alias("error"))
    return rows.where("error IS NULL").drop("error"), status


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """A JSON document as one row."""
    return spark.read.option("multiLine", True).json(path)
