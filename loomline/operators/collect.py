"""From feed rows to raw articles: one parametrised transform for every collector."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomline.functions.text import split_suffix, strip_outlet, strip_tags, valid_title
from loomline.functions.time import feed_timestamp, recent
from loomline.functions.url import valid_url


@dataclass(frozen=True)
class SourceSpec:
    """How one source's feed rows become articles."""

    name: str
    hours: float = 24
    outlets: list[str] = field(default_factory=list)
    check_title: bool = False
    clear_snippet: bool = False
    summary_chars: int | None = None
    cap: int | None = None
    constants: dict[str, str] = field(default_factory=dict)
    blank_words: list[str] = field(default_factory=list)
    #: feeds read in order until ``wanted`` addresses are there (all of them where it is None); zone of wall clocks without one
    feeds: int = 1
    wanted: int | None = None
    zone: str = "UTC"
    hook: Callable[[DataFrame], DataFrame] | None = None


def collect(entries: DataFrame, spec: SourceSpec, as_of: datetime) -> DataFrame:
    """Articles of one source: first date and address that are there, time window, clean title, summary rules, cap in feed order.

    entries: ``feed_ord, pos, title, summary, link, id, href, published, updated, pubDate`` (strings; missing ones NULL).
    """
    filled = lambda *names: F.coalesce(*(F.nullif(F.trim(n), F.lit("")) for n in names))
    rows = entries.withColumn("published", filled("published", "updated", "pubDate")).withColumn("url", filled("link", "id", "href"))
    stamp = feed_timestamp("published")
    if spec.zone != "UTC":  # a time that is written without zone is the outlet's wall clock
        stamp = F.when(F.col("published").rlike(r"([+-]\d{2}:?\d{2}|[A-Z]{1,4})\s*$"), stamp).otherwise(F.to_utc_timestamp(stamp, spec.zone))
    rows = rows.where(F.col("url").rlike("^https?://")).withColumn("published_ts", stamp).where(recent("published_ts", as_of, spec.hours))
    title = strip_outlet(strip_tags("title"), spec.outlets) if spec.outlets else strip_tags("title")
    summary = strip_tags(F.coalesce("summary", F.lit("")))
    if spec.summary_chars:
        summary = F.substring(summary, 1, spec.summary_chars)
    rows = rows.withColumn("title", title).withColumn("summary", summary)
    blank = F.trim("summary") == F.col("title")
    for w in spec.blank_words:
        blank = blank | F.lower("summary").contains(w.lower())
    rows = rows.withColumn("summary", F.when(blank, "").otherwise(F.col("summary")) if not spec.clear_snippet else F.lit(""))
    if spec.check_title:
        rows = rows.where(valid_title("title"))
    if spec.hook:
        rows = spec.hook(rows)
    rows = first_url(rows)
    if spec.wanted:
        rows = waterfall(rows.withColumn("_g", F.lit(0)), spec.wanted, "_g").drop("_g")
    if spec.cap:
        rows = rows.orderBy("feed_ord", "pos").limit(spec.cap)
    return rows.withColumns({"source": F.lit(spec.name), **{k: F.lit(v) for k, v in spec.constants.items()}})


def first_url(rows: DataFrame) -> DataFrame:
    """The first row of each address, by feed and position."""
    return rows.withColumn("_rn", F.row_number().over(Window.partitionBy("url").orderBy("feed_ord", "pos"))).where("_rn = 1").drop("_rn")


def search_rank(rows: DataFrame, by: str = "source", pos: str = "pos") -> DataFrame:
    return rows.withColumn("search_rank", F.row_number().over(Window.partitionBy(by).orderBy(pos)))


def waterfall(rows: DataFrame, wanted: int, group: str, feed: str = "feed_ord", pos: str = "pos", key: str = "url", cap: int | None = None) -> DataFrame:
    """Feeds are read in order while fewer than ``wanted`` different keys came before; then the first ``cap`` rows of each group."""
    once = rows.withColumn("_rn", F.row_number().over(Window.partitionBy(group, key).orderBy(feed, pos))).where("_rn = 1").drop("_rn")
    counts = once.groupBy(group, feed).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy(feed).rowsBetween(Window.unboundedPreceding, -1)
    read = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).where(F.col("_before") < wanted).select(group, feed)
    out = once.join(read, [group, feed], "left_semi")
    return top_per_group(out, group, [F.col(feed), F.col(pos)], cap) if cap else out


def primary_then_fallback(rows: DataFrame, wanted: int, topic: str = "topic") -> DataFrame:
    """The first ``wanted`` addresses of each topic, those of the primary query (``tier`` 0) before those of the fallback (1)."""
    once = rows.withColumn("_rn", F.row_number().over(Window.partitionBy(topic, "url").orderBy("tier", "pos"))).where("_rn = 1").drop("_rn")
    return top_per_group(once, topic, [F.col("tier"), F.col("pos")], wanted)


def top_per_group(rows: DataFrame, group: str, order: list, most: int) -> DataFrame:
    return rows.withColumn("_rn", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("_rn") <= most).drop("_rn")


def first_filled(*columns: str) -> Column:
    """The first column that is neither NULL nor empty."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in columns))


def article_error(title: str, url: str, source: str) -> Column:
    """What is wrong with an article, the first fault; NULL if nothing is."""
    strip = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)^\s+|\s+$", "")
    empty = [F.when(strip(c) == "", f"Empty required field: {n}") for n, c in (("title", title), ("url", url), ("source", source))]
    return F.coalesce(*empty, F.when(~valid_url(strip(url)), F.concat(F.lit("Invalid URL format: "), strip(url))))


def split_press(rows: DataFrame) -> DataFrame:
    """``title - press`` of search feeds into two columns; the source is the press name, else the topic."""
    title, press = split_suffix("title")
    return rows.withColumn("press_name", press).withColumn("title", title).withColumn("source", F.coalesce(F.nullif("press_name", F.lit("")), "topic"))
