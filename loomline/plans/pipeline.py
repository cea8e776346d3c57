"""The phases of a run, each a transform from tables to tables; a driver chains them and stops at the first failure."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.functions.text import drop_reason, is_domestic, unescape_html
from loomline.functions.time import recent
from loomline.operators.changes import fold_upserts
from loomline.operators.dedup import fresh_groups, representatives
from loomline.operators.labels import Scorer, score, work_list
from loomline.operators.similarity import fuzzy_groups, group_picks, prune


def ingest(articles: DataFrame, order: list[str]) -> DataFrame:
    """Collected articles folded by address, titles unescaped."""
    folded = fold_upserts(articles, order)
    return folded.withColumn("title", F.when(F.col("title").contains("&"), unescape_html("title")).otherwise(F.col("title")))


def select_new(raw: DataFrame, processed: DataFrame) -> DataFrame:
    """One representative per title group that is not processed yet, as processed rows without ids."""
    best = representatives(fresh_groups(raw, processed))
    rows = raw.select(F.col("id").alias("ref_raw_id"), F.coalesce("source", F.lit("")).alias("source_normalized"), "search_rank", F.col("publisher").alias("_p"), F.col("title").alias("_t"))
    return best.select(F.col("id").alias("ref_raw_id"), "weight").join(rows, "ref_raw_id").withColumn("is_kr", is_domestic("_p", "_t")).withColumn("language", F.when(F.col("is_kr"), "ko").otherwise("en")).drop("_p", "_t")


def dropped(processed: DataFrame, raw: DataFrame) -> DataFrame:
    """``id, reason`` of processed rows whose raw text a rule drops."""
    text = raw.select(F.col("id").alias("ref_raw_id"), F.concat_ws(" ", "title", "snippet").alias("t"))
    return processed.select("id", "ref_raw_id").join(text, "ref_raw_id").select("id", drop_reason("t").alias("reason")).where("reason IS NOT NULL")


def label(processed: DataFrame, raw: DataFrame, scorer: Scorer, size: int = 50) -> DataFrame:
    """Labels of the work list, failures tried once more."""
    titles = raw.select(F.col("id").alias("ref_raw_id"), "title")
    rows = work_list(processed).select("id", "ref_raw_id").join(titles, "ref_raw_id").select("id", "title")
    first = score(rows, scorer, size)
    good = first.where("decision != 'ERROR'")
    again = score(rows.join(good.select("id"), "id", "left_anti"), scorer, size)
    return good.unionByName(again)


def kept_recent(processed: DataFrame, raw: DataFrame, as_of: datetime, hours: float = 24) -> DataFrame:
    """Rows labelled KEEP whose raw row was created in the window, with what clustering needs."""
    r = raw.where(recent("created_at", as_of, hours) & F.col("created_at").isNotNull()).select(F.col("id").alias("ref_raw_id"), "title", "snippet", "url", F.coalesce("publisher", "source").alias("publisher"), "created_at")
    p = processed.where("llm_decision = 'KEEP'").select("id", "ref_raw_id", "llm_category", "llm_reason").distinct()
    return p.join(r, "ref_raw_id")


def topics(kept: DataFrame, within: list[str] | None = None) -> DataFrame:
    """``topic_id, category, topic_title, news_ids, original_count``: similar articles of a category; the title is that of the first pick."""
    category = F.coalesce(F.nullif("llm_category", F.lit("")), F.lit("Uncategorized"))
    grouped = fuzzy_groups(kept.withColumn("category", category), within=["category", *(within or [])])
    titles = group_picks(grouped).where("pick = 1").select(F.col("component").alias("topic_id"), F.col("title").alias("topic_title"))
    held = prune(grouped.withColumnRenamed("component", "topic_id"))
    ids = F.transform(F.array_sort(F.collect_list(F.struct("topic_rank", "id"))), lambda x: x["id"])
    return held.groupBy("topic_id").agg(F.min("category").alias("category"), ids.alias("news_ids"), F.max("original_count").alias("original_count")).join(titles, "topic_id")


@dataclass(frozen=True)
class Phase:
    name: str
    run: Callable[[], object]


def run_phases(phases: list[Phase], say: Callable[[str], None] = print) -> list[str]:
    """Runs phases in order and returns the names of those that ended; the first failure is raised after it is told."""
    done = []
    for p in phases:
        try:
            p.run()
        except Exception as e:
            say(f"{p.name} failed: {e}")
            raise
        done.append(p.name)
        say(f"{p.name} done")
    return done
