"""Topics to reports: ordered strings, blocks, citations, messages, digests."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType
from pyspark.sql.window import Window

from loomline import dims
from loomline.functions.text import escape_html, round_brackets, unescape_html
from loomline.functions.url import clean_url


def category_name(code: Column | str, table: list[tuple[str, str]] = dims.CATEGORIES) -> Column:
    c = F.col(code) if isinstance(code, str) else code
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in table for x in kv)), c), c)


def category_order(code: Column | str, table: list[tuple[str, str]] = dims.CATEGORIES) -> Column:
    c = F.col(code) if isinstance(code, str) else code
    at = F.array_position(F.array(*(F.lit(k) for k, _ in table)), c)
    return F.when(F.coalesce(at, F.lit(0)) > 0, at).otherwise(99)


def topic_articles(topics: DataFrame, processed: DataFrame, raw: DataFrame) -> DataFrame:
    """``topic_id, ord, id, title, snippet, publisher, url, published`` of every article a topic names; ids without a row vanish."""
    named = topics.select(F.col("id").alias("topic_id"), F.posexplode("news_ids").alias("ord", "pid")).where("pid IS NOT NULL")
    once = named.groupBy("topic_id", "pid").agg(F.min("ord").alias("ord"))
    p = processed.select(F.col("id").alias("pid"), "ref_raw_id").distinct()
    r = raw.select(F.col("id").alias("ref_raw_id"), "title", "snippet", F.coalesce("publisher", "source").alias("publisher"), "url", "published")
    return once.join(p, "pid").join(r, "ref_raw_id").select("topic_id", "ord", F.col("pid").alias("id"), "title", "snippet", "publisher", "url", "published")


def joined_columns(rows: DataFrame, key: str, order: list[str], columns: list[str]) -> DataFrame:
    """Per key one newline-joined string per column, all in the same order."""
    items = F.array_sort(F.collect_list(F.struct(*order, *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_{c}") for c in columns))))
    grouped = rows.groupBy(key).agg(items.alias("_i"))
    return grouped.select(key, *(F.array_join(F.col("_i").getField(f"_{c}"), "\n").alias(c) for c in columns))


def split_columns(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The inverse: one row per position."""
    zipped = F.arrays_zip(*(F.split(c, "\n").alias(c) for c in columns))
    return rows.select(key, F.posexplode(zipped).alias("pos", "_z")).select(key, "pos", *(F.col("_z")[c].alias(c) for c in columns))


def sanitise(rows: DataFrame) -> DataFrame:
    """Entities resolved, brackets rounded, addresses cleaned."""
    fix = lambda c: F.when(F.col(c).contains("&"), unescape_html(c)).otherwise(F.col(c))
    return rows.withColumns({"title": round_brackets(fix("title")), "snippet": fix("snippet"), "url": clean_url("url")})


_LINK = r"^\s*(>|•|- |\*-)"
_HEADER = r"^\s*(#{3,}.*|\*\*[^*]{1,100}\*\*:?)\s*$"


def section_blocks(texts: DataFrame, key: str, text: str = "text", pos: str | None = None) -> DataFrame:
    """``key, block, title, text, links`` of Markdown sections.

    Blank lines are skipped. A line is a link (starts with ``>``, ``•``, ``- `` or ``*-``), a header (``###…`` or short ``**…**``) or text. A header starts a
    block, a text line starts one if the line before is a link. Blocks without any part vanish.
    """
    lines = texts.select(key, F.posexplode(F.split(text, "\n")).alias("pos", "line")) if pos is None else texts.select(key, F.col(pos).alias("pos"), F.col(text).alias("line"))
    lines = lines.where(F.trim("line") != "").withColumn("kind", F.when(F.col("line").rlike(_LINK), "link").when(F.col("line").rlike(_HEADER), "header").otherwise("text"))
    w = Window.partitionBy(key).orderBy("pos")
    starts = (F.col("kind") == "header") | ((F.col("kind") == "text") & (F.lag("kind").over(w) == "link")) | F.lag("kind").over(w).isNull()
    lines = lines.withColumn("block", F.sum(F.when(starts, 1).otherwise(0)).over(w))
    part = lambda k: F.transform(F.filter("_l", lambda x: x["kind"] == k), lambda x: F.trim(x["line"]))
    grouped = lines.groupBy(key, "block").agg(F.array_sort(F.collect_list(F.struct("pos", "kind", "line"))).alias("_l"))
    title = F.regexp_replace(F.array_join(part("header"), " "), r"^#+\s*|\*\*", "")
    return grouped.select(key, F.col("block").cast("int").alias("block"), title.alias("title"), F.array_join(part("text"), "\n").alias("text"), F.transform(part("link"), parse_link).alias("links"))


def parse_link(line: Column) -> Column:
    """``[title](url) - (source)``, with or without the last brackets, after any marks in front and without ``**``; the title reaches to the last ``](``. Anything else is kept raw."""
    line = F.trim(F.replace(F.regexp_replace(line, r"^[>•\-*]+\s*", ""), F.lit("**"), F.lit("")))
    strong, weak = r"(?s)\[(.*)\]\((.*?)\)\s*-\s*\((.*?)\)", r"(?s)\[(.*)\]\((.*?)\)\s*-\s*(.*)"
    pick = lambda p: F.struct(*(F.trim(F.regexp_extract(line, p, k)).alias(n) for k, n in enumerate(("title", "url", "source"), 1)), F.lit(None).cast("string").alias("raw"))
    none = F.lit(None).cast("string")
    return F.when(line.rlike(strong), pick(strong)).when(line.rlike(weak), pick(weak)).otherwise(F.struct(none.alias("title"), none.alias("url"), none.alias("source"), line.alias("raw")))


_REF = r"\[Ref:\s*([0-9,\s]+)\]"


def expand_citations(sections: DataFrame, articles: DataFrame, key: str = "section", most: int = 5) -> DataFrame:
    """``section, text``: every ``[Ref: 1, 2]`` becomes a link line per known article, at most ``most`` per section; unknown ids vanish.

    articles: ``id, title, url, publisher``, unique ids.
    """
    parts = sections.select(key, F.posexplode(F.split(F.regexp_replace("text", _REF, "\u0001$1\u0001"), "\u0001")).alias("pos", "part"))
    refs = parts.where("pos % 2 = 1").select(key, "pos", F.posexplode(F.split("part", ",")).alias("k", "i")).withColumn("id", F.trim("i").try_cast("bigint"))
    known = refs.join(articles.select("id", "title", "url", "publisher"), "id")
    w = Window.partitionBy(key).orderBy("pos", "k")
    shown = known.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most)
    line = F.concat(F.lit("\n> • ["), "title", F.lit("]("), "url", F.lit(") - ("), F.coalesce("publisher", F.lit("")), F.lit(")"))
    links = shown.groupBy(key, "pos").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", line.alias("line")))), lambda x: x["line"]), "").alias("links"))
    whole = parts.join(links, [key, "pos"], "left").withColumn("out", F.when(F.col("pos") % 2 == 1, F.coalesce("links", F.lit(""))).otherwise(F.col("part")))
    return whole.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "out"))), lambda x: x["out"]), "").alias("text"))


def blocks_markdown(blocks: DataFrame, key: str) -> DataFrame:
    """``key, markdown`` of blocks in order."""
    link = lambda x: F.coalesce(x["raw"], F.concat(F.lit("> • ["), x["title"], F.lit("]("), x["url"], F.lit(") - ("), x["source"], F.lit(")")))
    head = F.when(F.col("title") != "", F.concat(F.lit("### "), F.col("title"), F.lit("\n"))).otherwise("")
    one = F.concat(head, F.col("text"), F.lit("\n"), F.array_join(F.transform("links", link), "\n"))
    return blocks.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", one.alias("t")))), lambda x: x["t"]), "\n\n").alias("markdown"))


def drop_sections(lines: DataFrame, key: str, headings: str) -> DataFrame:
    """Lines (``key, pos, line``) without those under a ``## `` heading that matches, up to the next one."""
    w = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    current = F.last(F.when(F.col("line").startswith("## "), F.col("line")), ignorenulls=True).over(w)
    return lines.withColumn("_h", current).where(F.col("_h").isNull() | ~F.col("_h").rlike(headings)).drop("_h")


def trim_lines(lines: DataFrame, key: str, begins: Column, ends: Column) -> DataFrame:
    """Lines (``key, pos, line``) from the last one that ``begins`` (all if there is none) to before the last one that ``ends``."""
    w = Window.partitionBy(key)
    low, high = F.coalesce(F.max(F.when(begins, F.col("pos"))).over(w), F.lit(0)), F.max(F.when(ends, F.col("pos"))).over(w)
    return lines.withColumn("_low", low).withColumn("_high", high).where((F.col("pos") >= F.col("_low")) & (F.col("_high").isNull() | (F.col("pos") < F.col("_high")))).drop("_low", "_high")


def payload_counts(topics: DataFrame) -> DataFrame:
    return topics.groupBy("category").agg(F.sum(F.size("news_ids").cast("bigint")).alias("n_articles"), F.count("*").alias("n_topics"))


def topic_messages(topics: DataFrame, articles: DataFrame, most: int = 2) -> DataFrame:
    """``id, message``: a chat text per topic, its title and size and its first ``most`` articles. articles: as of ``topic_articles``."""
    few = articles.withColumn("_k", F.row_number().over(Window.partitionBy("topic_id").orderBy("ord"))).where(F.col("_k") <= most)
    line = F.concat(F.lit("- "), F.coalesce("title", F.lit("")), F.lit(" ("), F.coalesce("publisher", F.lit("")), F.lit(")"))
    links = few.groupBy(F.col("topic_id").alias("id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", line.alias("l")))), lambda x: x["l"]), "\n").alias("links"))
    head = F.concat(F.coalesce("topic_title", F.lit("")), F.lit(" ["), F.size("news_ids").cast("string"), F.lit("]"))
    return topics.join(links, "id", "left").select("id", F.concat(head, F.coalesce(F.concat(F.lit("\n"), "links"), F.lit(""))).alias("message"))


def split_message(text: str, most: int = 4096) -> list[str]:
    """Paragraphs packed in messages of at most ``most`` characters; the first line is repeated with a part number."""
    if len(text) <= most:
        return [text]
    header, _, body = text.partition("\n")
    room = most - len(header) - 16
    parts, now = [], ""
    for paragraph in re.split(r"\n\s*\n", body):
        for piece in (paragraph[i : i + room] for i in range(0, max(1, len(paragraph)), room)):
            if now and len(now) + len(piece) + 2 > room:
                parts.append(now)
                now = ""
            now = f"{now}\n\n{piece}" if now else piece
    parts.append(now)
    return [f"{header} ({i}/{len(parts)})\n{p}" for i, p in enumerate(parts, 1)]


def messages(texts: Column | str, most: int = 4096) -> Column:
    @F.pandas_udf(ArrayType(StringType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(lambda t: split_message(t, most) if t is not None else None)

    return run(texts)


def digest(rows: DataFrame, per_topic: int = 6) -> DataFrame:
    """``category, html``: topics of a category as a list with their first articles. rows: ``category, topic_title, topic_id, ord, title, url, publisher``."""
    w = Window.partitionBy("topic_id").orderBy("ord")
    few = rows.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= per_topic)
    item = F.concat(F.lit('<li><a href="'), "url", F.lit('">'), escape_html("title"), F.lit("</a> ("), F.coalesce(escape_html("publisher"), F.lit("")), F.lit(")</li>"))
    topic = few.groupBy("category", "topic_id", "topic_title").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", item.alias("h")))), lambda x: x["h"]), "").alias("items"))
    one = F.concat(F.lit("<h3>"), escape_html("topic_title"), F.lit("</h3><ul>"), "items", F.lit("</ul>"))
    return topic.groupBy("category").agg(F.concat(F.lit("<h2>"), F.any_value(category_name("category")), F.lit("</h2>"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("topic_id", one.alias("h")))), lambda x: x["h"]), "")).alias("html"))
