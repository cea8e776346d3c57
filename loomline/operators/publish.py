"""From stored reports to pages, headlines and tags; stand-ins for the model that selects and writes."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from datetime import date
from functools import reduce
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window


class Selector(Protocol):
    """Picks topics for sections: topics in, ``section, topic_id, place`` out."""

    def __call__(self, topics: DataFrame) -> DataFrame: ...


class Writer(Protocol):
    """Writes a section's text with ``[Ref: id]`` marks: articles in, ``section, text`` out."""

    def __call__(self, articles: DataFrame) -> DataFrame: ...


def select_by_count(topics: DataFrame, most: int = 5) -> DataFrame:
    """The largest topics of each category, newest first among equals."""
    w = Window.partitionBy("category").orderBy(F.desc("original_count"), F.desc("id"))
    return topics.where(F.size("news_ids") > 0).withColumn("place", F.row_number().over(w)).where(F.col("place") <= most).select(F.col("category").alias("section"), F.col("id").alias("topic_id"), "place")


def executive_summary(topics: DataFrame, most: int = 10) -> DataFrame:
    """The largest topics of all categories, as the section of the summary."""
    top = topics.where(F.size("news_ids") > 0).orderBy(F.desc("original_count"), F.desc("id")).limit(most)
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("original_count"), F.desc("id")))  # ``most`` rows
    return top.select(F.lit("Executive Summary").alias("section"), F.col("id").alias("topic_id"), place.alias("place"))


def picks_map(*parts: DataFrame) -> DataFrame:
    """One row ``picks map<section, array<topic_id>>`` from ``section, topic_id, place``; rows without a section are left out."""
    rows = reduce(DataFrame.unionByName, parts).where("section IS NOT NULL")
    lists = rows.groupBy("section").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "topic_id"))), lambda x: x["topic_id"]).alias("ids"))
    return lists.agg(F.map_from_entries(F.collect_list(F.struct("section", "ids"))).alias("picks"))


def picks_rows(picks: DataFrame) -> DataFrame:
    """``section, topic_id`` of such a map."""
    return picks.select(F.explode("picks").alias("section", "ids")).select("section", F.explode("ids").alias("topic_id"))


def write_from_titles(articles: DataFrame) -> DataFrame:
    """A line per topic: its title and the marks of its articles. articles: ``section, topic_id, place, topic_title, ord, id``."""
    refs = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "id"))), lambda x: x["id"].cast("string")), ", ")
    lines = articles.groupBy("section", "topic_id", "place", "topic_title").agg(refs.alias("refs"))
    line = F.concat(F.lit("### "), "topic_title", F.lit("\n[Ref: "), "refs", F.lit("]"))
    return lines.groupBy("section").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", line.alias("l")))), lambda x: x["l"]), "\n\n").alias("text"))


def dated_headline(title: Column | str, day: Column | str, style: str = "M/d") -> Column:
    """``[3/5] title`` (``M/d``) or ``[Mar 5] title`` (``MMM d``)."""
    t, d = (F.col(c) if isinstance(c, str) else c for c in (title, day))
    return F.concat(F.lit("["), F.date_format(d, style), F.lit("] "), t)


def title_tags(title: Column | str, constants: list[str], most: int = 3) -> Column:
    """The constants and the first words of more than three characters."""
    t = F.col(title) if isinstance(title, str) else title
    return F.concat(F.array(*map(F.lit, constants)).cast("array<string>"), F.slice(F.filter(F.split(t, " "), lambda w: F.length(w) > 3), 1, most))


def percent(part: Column | str, whole: Column | str) -> Column:
    """One decimal and a percent sign; ``0.0%`` of nothing."""
    p, w = (F.col(c) if isinstance(c, str) else c for c in (part, whole))
    return F.format_string("%.1f%%", F.coalesce(F.try_divide(p * 100.0, w), F.lit(0.0)))


_INLINE = [(re.compile(r"\*\*(.+?)\*\*"), r"<strong>\1</strong>"), (re.compile(r"\[([^\]]+)\]\((https?://[^)\s]+)\)"), r'<a href="\2">\1</a>')]


def _inline(text: str) -> str:
    out = html.escape(text, quote=False)
    for pattern, to in _INLINE:
        out = pattern.sub(to, out)
    return out


def markdown_html(text: str, classes: dict[str, str] | None = None) -> str:
    """Headings, lists, quotes and paragraphs; ``classes`` gives tags a class. Markup in the text is escaped."""
    classes, out, open_list = classes or {}, [], None

    def tag(name: str) -> str:
        return f'<{name} class="{classes[name]}">' if name in classes else f"<{name}>"

    def close() -> None:
        nonlocal open_list
        if open_list:
            out.append(f"</{open_list}>")
            open_list = None

    for line in text.split("\n"):
        s = line.strip()
        if not s:
            close()
        elif m := re.match(r"(#{1,6})\s+(.*)", s):
            close()
            n = f"h{len(m[1])}"
            out.append(f"{tag(n)}{_inline(m[2])}</{n}>")
        elif m := re.match(r"(?:(>\s*)?[•*-]|(\d+)\.)\s+(.*)", s):
            kind = "ol" if m[2] else "ul"
            if open_list != kind:
                close()
                out.append(tag(kind))
                open_list = kind
            out.append(f"{tag('li')}{_inline(m[3])}</li>")
        elif s.startswith(">"):
            close()
            out.append(f"{tag('blockquote')}{_inline(s[1:].strip())}</blockquote>")
        else:
            close()
            out.append(f"{tag('p')}{_inline(s)}</p>")
    close()
    return "\n".join(out)


def page(markdown: Column | str, classes: dict[str, str] | None = None) -> Column:
    @F.pandas_udf(StringType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(lambda t: markdown_html(t, classes) if t is not None else None)

    return run(markdown)


def report_json(sections: DataFrame, day: date, language: str, title: str, model: str = "") -> DataFrame:
    """One row ``meta, sections``: the report document. sections: ``section, block, title, text, links``; the number of sections is that of the categories."""
    blocks = sections.groupBy("section").agg(F.transform(F.array_sort(F.collect_list(F.struct("block", "title", "text", "links"))), lambda b: F.struct(b["title"].alias("title"), b["text"].alias("text"), b["links"].alias("links"))).alias("blocks"))
    meta = F.struct(F.lit(day.isoformat()).alias("date"), F.lit(model).alias("model"), F.lit(title).alias("posting_title"), F.lit(language).alias("language"))
    return blocks.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("section", "blocks")))).alias("sections")).select(meta.alias("meta"), "sections")
