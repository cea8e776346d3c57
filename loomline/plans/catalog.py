"""Named queries over the test tables, with the SQL that checks them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomline import dims
from loomline.functions.text import canonical_press, drop_reason, is_domestic, normalise_title, reason_subject, source_tier, trusted_rank, valid_title
from loomline.functions.time import in_zone
from loomline.functions.url import url_key
from loomline.operators import changes, collect, dedup, report, similarity, stats, vectors
from loomline.operators.labels import batches_of, label_udf, work_list
from loomline.plans.pipeline import dropped, kept_recent, topics

AS_OF = datetime(2026, 1, 15, 0, 0, 0)
_WS = r"[\s\x0B\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _or(words: list[str]) -> str:
    return "|".join(w.replace(".", r"\.") for w in words)


def _sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# --- SQL forms of the column functions
def _norm(c: str) -> str:
    return f"lower(trim(regexp_replace({c}, '{_WS}', ' ', 'g'), ' '))"


def _tier(c: str) -> str:
    whens = " ".join(f"WHEN {' OR '.join(f'contains(lower({c}), {_sql(n.lower())})' for n in names)} THEN {tier}" for tier, names in dims.SOURCE_TIERS)
    return f"CASE WHEN {c} IS NULL OR {c} = '' THEN 999 {whens} WHEN regexp_matches({c}, '[가-힣]') THEN 199 ELSE 99 END"


def _rank(c: str) -> str:
    return "CASE " + " ".join(f"WHEN contains(lower({c}), {_sql(n.lower())}) THEN {k}" for k, n in enumerate(dims.TRUSTED_PUBLISHERS)) + " ELSE 999 END"


def _press(c: str) -> str:
    whens = []
    for name, contained, equal in dims.PRESS_NAMES:
        tests = [f"contains(lower({c}), {_sql(x)})" for x in contained] + [f"lower({c}) = {_sql(x)}" for x in equal]
        whens.append(f"WHEN {' OR '.join(tests)} THEN {_sql(name)}")
    return f"CASE WHEN {c} IS NULL THEN '' {' '.join(whens)} ELSE trim({c}, ' ') END"


def _drop(c: str) -> str:
    rules = [f"WHEN regexp_matches({c}, '^\\[({'|'.join(dims.DROP_TAGS)})\\]') THEN 'Rule: Title Prefix Drop'"]
    rules += [f"WHEN contains(replace({c}, '인사이트', ''), '인사') THEN 'Rule: Noise Keyword (인사)'", f"WHEN contains({c}, '[표]') THEN 'Rule: Noise Keyword ([표])'"]
    rules += [f"WHEN regexp_matches({c}, '(^|[^\\p{{L}}\\p{{N}}_]){w}($|[^\\p{{L}}\\p{{N}}_])') THEN 'Rule: Drop Keyword ''{w}'''" for w in dims.DROP_WORDS]
    return f"CASE {' '.join(rules)} END"


_KEY = "regexp_replace(lower(regexp_replace(url, '[?#].*$', '')), '/$', '')"
_REPR = f"""
named AS (SELECT id, title, source, coalesce(nullif(publisher, ''), source) AS publisher, {_norm('title')} AS norm_title FROM raw_news),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY norm_title ORDER BY {_tier('publisher')}, length(title) DESC, id) AS rn FROM named WHERE norm_title <> ''
)"""


# --- deduplication
def title_dedup_representatives(spark: SparkSession, d: str) -> DataFrame:
    r = dedup.representatives(_t(spark, d, "raw_news"))
    return r.select("norm_title", "id", "title", "publisher", "weight", F.array_join("sources", ",").alias("sources"))


def title_dedup_stats(spark: SparkSession, d: str) -> DataFrame:
    return dedup.dedup_stats(_t(spark, d, "raw_news"))


def removed_to_kept_map(spark: SparkSession, d: str) -> DataFrame:
    return dedup.removed_to_kept(_t(spark, d, "raw_news"))


def incremental_group_antijoin(spark: SparkSession, d: str) -> DataFrame:
    return dedup.fresh_groups(_t(spark, d, "raw_news"), _t(spark, d, "processed_news")).select("id", "norm_title")


def unprocessed_antijoin(spark: SparkSession, d: str) -> DataFrame:
    return dedup.unprocessed(_t(spark, d, "raw_news"), _t(spark, d, "processed_news")).select("id", "source", "search_rank")


def url_normalize_dedup(spark: SparkSession, d: str) -> DataFrame:
    return dedup.dedup_urls(_t(spark, d, "raw_news")).select("id", url_key("url").alias("url_key"))


def url_title_dedup(spark: SparkSession, d: str) -> DataFrame:
    return dedup.dedup_titles(dedup.dedup_urls(_t(spark, d, "raw_news"))).select("id")


# --- filters and scalar functions
def keyword_drop_reasons(spark: SparkSession, d: str) -> DataFrame:
    return dropped(_t(spark, d, "processed_news").distinct(), _t(spark, d, "raw_news"))


def keyword_drop_stats(spark: SparkSession, d: str) -> DataFrame:
    raw = _t(spark, d, "raw_news").select(drop_reason(F.concat_ws(" ", "title", "snippet")).alias("reason"))
    return raw.groupBy("reason").agg(F.count("*").alias("n"))


def publisher_functions(spark: SparkSession, d: str) -> DataFrame:
    p = _t(spark, d, "raw_news").groupBy("publisher").agg(F.count("*").alias("n"))
    return p.select("publisher", "n", source_tier("publisher").alias("tier"), trusted_rank("publisher").alias("trust"), canonical_press("publisher").alias("press"))


def valid_titles(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "raw_news").select("source", valid_title("title").alias("ok")).groupBy("source").agg(F.count("*").alias("n"), F.count_if("ok").alias("n_valid"))


def language_split(spark: SparkSession, d: str) -> DataFrame:
    lang = F.when(is_domestic("publisher", "title"), "ko").otherwise("en")
    return _t(spark, d, "raw_news").groupBy(lang.alias("language"), "source").agg(F.count("*").alias("n"))


def keep_recent_articles(spark: SparkSession, d: str) -> DataFrame:
    return kept_recent(_t(spark, d, "processed_news"), _t(spark, d, "raw_news"), AS_OF, 24 * 30).select("id", "ref_raw_id", "publisher", "llm_category")


def kst_day_buckets(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "events").groupBy(F.substring(in_zone("ts", "Asia/Seoul"), 1, 10).alias("day_kst"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("value"))


# --- joins and aggregates
def processed_raw_join(spark: SparkSession, d: str) -> DataFrame:
    r = _t(spark, d, "raw_news").select(F.col("id").alias("ref_raw_id"), "title", F.coalesce("publisher", "source").alias("publisher"))
    return _t(spark, d, "processed_news").select("id", "ref_raw_id", "llm_decision").join(r, "ref_raw_id")


def topic_articles(spark: SparkSession, d: str) -> DataFrame:
    return report.topic_articles(_t(spark, d, "topics"), _t(spark, d, "processed_news"), _t(spark, d, "raw_news")).select("topic_id", "ord", "id", "title", "publisher")


def topics_ordered(spark: SparkSession, d: str) -> DataFrame:
    t = _t(spark, d, "topics").where(F.size("news_ids") > 0)
    return t.select("id", report.category_name("category").alias("category_name"), report.category_order("category").cast("int").alias("category_order"), F.size("news_ids").alias("n_ids"))


def decision_days(spark: SparkSession, d: str) -> DataFrame:
    return stats.decision_day(_t(spark, d, "processed_news").distinct())


def source_rollup(spark: SparkSession, d: str) -> DataFrame:
    return stats.source_totals(_t(spark, d, "raw_news"))


# The sources of the table of collectors, for the columns of the pivot.
_PIVOT = [
    "Naver Finance", "Korean Economy", "Infomax", "GEnews", "Hanbit Desk", "Big Tech", "US Real Estate", "Meridian Wire", "Albion Markets",
    "Harbour Street", "Southern Ledger", "Deccan Ticker", "Kanto Feed", "Rheinblick", "Bourse du Lac", "Mesa Abierta",
]


def source_count_pivot(spark: SparkSession, d: str) -> DataFrame:
    """Rows per day and source; rows without a source are in no column, as in the fixed wide table."""
    p = stats.source_pivot(_t(spark, d, "raw_news"), F.date_format("created_at", "yyyy-MM-dd"), _PIVOT)
    return p.select("dt", *(F.col(c).alias(c.lower().replace(" ", "_")) for c in _PIVOT))


def two_pass_work_list(spark: SparkSession, d: str) -> DataFrame:
    return work_list(_t(spark, d, "processed_news").distinct()).groupBy("language", "llm_decision").agg(F.count("*").alias("n"))


def reason_subjects(spark: SparkSession, d: str) -> DataFrame:
    p = _t(spark, d, "processed_news").select("id", "llm_reason").distinct()
    return p.select(reason_subject("llm_reason").alias("subject")).groupBy("subject").agg(F.count("*").alias("n"))


def label_replay(spark: SparkSession, d: str) -> DataFrame:
    """Replies as a model would write them, from the stored labels, parsed again."""
    rows = _t(spark, d, "processed_news").where("llm_decision IN ('KEEP', 'DROP')").select("id", "llm_decision", "llm_category", "llm_reason").distinct()
    asked = batches_of(rows.withColumn("title", F.col("llm_reason")))
    one = F.to_json(F.array(F.col("id").cast("string"), F.when(F.col("llm_decision") == "KEEP", "1").otherwise("0"), F.coalesce("llm_category", F.lit("Noise")), F.coalesce("llm_reason", F.lit(""))))
    said = asked.select("batch", F.explode("ids").alias("id")).join(rows, "id").groupBy("batch").agg(F.concat(F.lit("```json\n["), F.array_join(F.collect_list(one), ","), F.lit("]\n```\nDone.")).alias("reply"))
    labels = said.join(asked.select("batch", "ids"), "batch").select(F.explode(label_udf()("reply", "ids")).alias("l")).select("l.id", "l.decision")
    return labels.groupBy("decision").agg(F.count("*").alias("n"))


# --- changes and limits
def upsert_last_title_wins(spark: SparkSession, d: str) -> DataFrame:
    log = _t(spark, d, "raw_news").where("url IS NOT NULL")
    return changes.fold_upserts(log.select("id", "source", "publisher", "url", "title", "search_rank", "collected_at"), ["id"])


def decision_update(spark: SparkSession, d: str) -> DataFrame:
    p = _t(spark, d, "processed_news").distinct()
    updates = p.where("llm_decision = 'ERROR'").select("id", F.lit("DROP").alias("llm_decision"), F.lit(None).cast("string").alias("llm_category"), F.lit(0).alias("pos"))
    out = changes.update_by_id(p, updates, ["llm_decision", "llm_category"], status="PHASE_4_DONE")
    return out.groupBy("llm_decision", "process_status").agg(F.count("*").alias("n"))


def deferred_delete(spark: SparkSession, d: str) -> DataFrame:
    raw, processed = changes.delete_dropped(_t(spark, d, "raw_news"), _t(spark, d, "processed_news"))
    return raw.select(F.lit("raw_news").alias("table_name"), "id").unionByName(processed.select(F.lit("processed_news").alias("table_name"), "id").distinct()).groupBy("table_name").agg(F.count("*").alias("n"), F.sum("id").alias("ids"))


def _feed(spark: SparkSession, d: str) -> DataFrame:
    raw = _t(spark, d, "raw_news").where("url IS NOT NULL AND url != '' AND source IS NOT NULL AND source != ''")
    return raw.select("id", "source", "url", F.to_date("created_at").alias("feed_ord"), F.col("id").alias("pos"), F.lit(0).alias("tier"))


def waterfall_feed_limit(spark: SparkSession, d: str) -> DataFrame:
    return collect.waterfall(_feed(spark, d), 30, "source", cap=50).select("source", "id")


def primary_fallback_topk(spark: SparkSession, d: str) -> DataFrame:
    rows = _feed(spark, d).withColumn("tier", F.when(F.pmod("id", F.lit(3)) == 0, 0).otherwise(1)).withColumnRenamed("source", "topic")
    return collect.primary_then_fallback(rows, 30).select("topic", "id", "tier")


def topic_publisher_quota(spark: SparkSession, d: str) -> DataFrame:
    """Per topic the two newest articles of a publisher with different titles, 15 at most by tier."""
    rows = report.topic_articles(_t(spark, d, "topics"), _t(spark, d, "processed_news"), _t(spark, d, "raw_news")).withColumn("k", normalise_title("title"))
    once = rows.withColumn("_o", F.row_number().over(Window.partitionBy("topic_id", "publisher", "k").orderBy(F.desc("id")))).where("_o = 1")
    held = once.withColumn("_p", F.row_number().over(Window.partitionBy("topic_id", "publisher").orderBy(F.desc("id")))).where("_p <= 2")
    ranked = held.withColumn("topic_rank", F.row_number().over(Window.partitionBy("topic_id").orderBy(source_tier("publisher"), F.desc("id"))))
    return ranked.where("topic_rank <= 15").select("topic_id", "topic_rank", "id")


def section_selection_topk(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("category").orderBy(F.desc("original_count"), F.desc("id"))
    return _t(spark, d, "topics").where(F.size("news_ids") > 0).withColumn("place", F.row_number().over(w)).where("place <= 5").select("category", "place", "id")


# --- reports
def newline_agg(spark: SparkSession, d: str) -> DataFrame:
    rows = topic_articles(spark, d).withColumn("title", F.regexp_replace(F.coalesce("title", F.lit("")), "\n", " "))
    return report.joined_columns(rows, "topic_id", ["ord", "id"], ["title", "publisher"])


def newline_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    return report.split_columns(newline_agg(spark, d), "topic_id", ["title", "publisher"])


def citation_expand(spark: SparkSession, d: str) -> DataFrame:
    t = _t(spark, d, "topics").select(F.col("id").alias("section"), F.concat(F.lit("Summary [Ref: "), F.array_join("news_ids", ", "), F.lit("] end [Ref: 999999999]")).alias("text"))
    p = _t(spark, d, "processed_news").select("id", "ref_raw_id").distinct()
    articles = p.join(_t(spark, d, "raw_news").select(F.col("id").alias("ref_raw_id"), "title", "url", "publisher"), "ref_raw_id").withColumns({"title": F.coalesce("title", F.lit("")), "url": F.coalesce("url", F.lit(""))})
    return report.expand_citations(t, articles)


def section_blocks(spark: SparkSession, d: str) -> DataFrame:
    blocks = report.section_blocks(_t(spark, d, "documents"), "doc_id")
    return blocks.select("doc_id", "block", "title", F.length("text").alias("n_text"), F.size("links").alias("n_links"))


def report_digest(spark: SparkSession, d: str) -> DataFrame:
    t = _t(spark, d, "topics").select(F.col("id").alias("topic_id"), F.coalesce("category", F.lit("Uncategorized")).alias("category"), "topic_title")
    rows = report.topic_articles(_t(spark, d, "topics"), _t(spark, d, "processed_news"), _t(spark, d, "raw_news")).join(t, "topic_id")
    return report.digest(rows.withColumn("url", F.coalesce("url", F.lit(""))).withColumn("title", F.coalesce("title", F.lit(""))))


# --- similarity and vectors
def _kept(spark: SparkSession, d: str) -> DataFrame:
    kept = kept_recent(_t(spark, d, "processed_news"), _t(spark, d, "raw_news"), datetime(2030, 1, 1), 24 * 3650)
    return kept.withColumn("day", F.to_date("created_at")).where("title IS NOT NULL")


def _grouped(spark: SparkSession, d: str) -> DataFrame:
    return similarity.fuzzy_groups(_kept(spark, d), 0.5, ["day"])


def fuzzy_components(spark: SparkSession, d: str) -> DataFrame:
    """Equal subjects or similar titles of a day, as a daily run sees them; a row on its own is its own component."""
    return _grouped(spark, d).select("id", "component")


def fuzzy_representatives(spark: SparkSession, d: str) -> DataFrame:
    return similarity.group_picks(_grouped(spark, d)).select("id", "component", "pick")


def greedy_curate(spark: SparkSession, d: str) -> DataFrame:
    rows = topic_articles(spark, d).withColumn("rank", trusted_rank("publisher"))
    return similarity.curate(rows.where("title IS NOT NULL"), most=5).select("topic_id", "id", "curated_rank")


def pruned_topics(spark: SparkSession, d: str) -> DataFrame:
    return topics(_kept(spark, d), ["day"]).select("topic_id", "category", F.size("news_ids").alias("n"), "original_count")


def weighted_centroid(spark: SparkSession, d: str) -> DataFrame:
    c = vectors.centroids(_t(spark, d, "embeddings").withColumn("w", F.lit(1.0) + F.pmod("vec_id", F.lit(3))), "label", weight="w")
    return c.select("label", F.posexplode("centroid").alias("d", "v")).select("label", "d", F.round("v", 5).alias("v"))


def anchor_pick(spark: SparkSession, d: str) -> DataFrame:
    return vectors.anchors(_t(spark, d, "embeddings"), "label", "vec_id").select("label", "id", F.round("distance", 5).alias("distance"), "n")


def kmeans_by_label(spark: SparkSession, d: str) -> DataFrame:
    return vectors.kmeans(_t(spark, d, "embeddings")).groupBy("label", "cluster").agg(F.count("*").alias("n"))


# --- star schema
def daily_source_window(spark: SparkSession, d: str) -> DataFrame:
    w = _t(spark, d, "events").groupBy(F.window("ts", "6 hours").alias("w"), "event_type").agg(F.count("*").alias("n"))
    return w.select(F.col("w.start").alias("start"), "event_type", "n")


def order_status_rollup(spark: SparkSession, d: str) -> DataFrame:
    o = _t(spark, d, "orders").rollup("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return o


def nation_revenue(spark: SparkSession, d: str) -> DataFrame:
    """Nations join after the aggregate, so that the small tables meet one row per customer."""
    revenue = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("r"))
    by_customer = revenue.join(_t(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey")), "o_orderkey").groupBy("c_custkey").agg(F.sum("r").alias("r"))
    n = _t(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return by_customer.join(_t(spark, d, "customer").select("c_custkey", "c_nationkey"), "c_custkey").join(n, "c_nationkey").groupBy("n_name").agg(F.round(F.sum("r"), 2).alias("revenue"))


QUERIES = {
    f.__name__: f
    for f in (
        title_dedup_representatives, title_dedup_stats, removed_to_kept_map, incremental_group_antijoin, unprocessed_antijoin, url_normalize_dedup, url_title_dedup,
        keyword_drop_reasons, keyword_drop_stats, publisher_functions, valid_titles, language_split, keep_recent_articles, kst_day_buckets, processed_raw_join, topic_articles, topics_ordered,
        decision_days, source_rollup, source_count_pivot, two_pass_work_list, reason_subjects, label_replay, upsert_last_title_wins, decision_update, deferred_delete, waterfall_feed_limit,
        primary_fallback_topk, topic_publisher_quota, section_selection_topk, newline_agg, newline_roundtrip, citation_expand, section_blocks, report_digest, fuzzy_components,
        fuzzy_representatives, greedy_curate, pruned_topics, weighted_centroid, anchor_pick, kmeans_by_label, daily_source_window, order_status_rollup, nation_revenue,
    )
}

_ARTICLES = """
arts AS (
  SELECT n.topic_id, n.ord, p.id, r.title, r.snippet, coalesce(r.publisher, r.source) AS publisher
  FROM (SELECT topic_id, pid, min(ord) AS ord FROM (SELECT id AS topic_id, unnest(news_ids) AS pid, unnest(range(len(news_ids))) AS ord FROM topics) WHERE pid IS NOT NULL GROUP BY ALL) n
  JOIN (SELECT DISTINCT id, ref_raw_id FROM processed_news) p ON p.id = n.pid JOIN raw_news r ON r.id = p.ref_raw_id
)"""
_ONCE = f"once AS (SELECT *, {_KEY} AS k, row_number() OVER (PARTITION BY {_KEY} ORDER BY id) AS rn FROM raw_news)"
_FEED = "feed AS (SELECT id, source, url, CAST(created_at AT TIME ZONE 'UTC' AS DATE) AS feed_ord FROM raw_news WHERE url <> '' AND source <> '')"
_OUTLETS = _or(dims.OUTLET_NAMES)
_SECTIONS = ", ".join(_sql(s.lower()) for s in dims.SECTION_TITLES)

ORACLE = {
    "title_dedup_representatives": f"WITH {_REPR}, g AS (SELECT norm_title, count(*) AS weight, array_to_string(list_sort(list(DISTINCT source)), ',') AS sources FROM ranked GROUP BY 1) SELECT norm_title, id, title, publisher, weight, coalesce(sources, '') AS sources FROM ranked JOIN g USING (norm_title) WHERE rn = 1",
    "title_dedup_stats": f"WITH {_REPR}, g AS (SELECT count(*) AS n FROM ranked GROUP BY norm_title) SELECT CAST(sum(n) AS BIGINT) AS total, count(*) AS n_groups, CAST(sum(n - 1) AS BIGINT) AS removed, round(sum(n - 1) * 100.0 / sum(n), 4) AS removed_pct FROM g",
    "removed_to_kept_map": f"WITH {_REPR} SELECT a.id AS removed_id, b.id AS kept_id FROM ranked a JOIN ranked b USING (norm_title) WHERE b.rn = 1 AND a.rn > 1",
    "incremental_group_antijoin": f"WITH k AS (SELECT id, {_norm('title')} AS norm_title FROM raw_news), done AS (SELECT DISTINCT norm_title FROM k WHERE id IN (SELECT ref_raw_id FROM processed_news)) SELECT id, norm_title FROM k WHERE NOT EXISTS (SELECT 1 FROM done WHERE done.norm_title = k.norm_title)",
    "unprocessed_antijoin": "SELECT id, source, search_rank FROM raw_news r WHERE NOT EXISTS (SELECT 1 FROM processed_news p WHERE p.ref_raw_id = r.id)",
    "url_normalize_dedup": f"WITH {_ONCE} SELECT id, k AS url_key FROM once WHERE k IS NULL OR k = '' OR rn = 1",
    "url_title_dedup": f"WITH {_ONCE}, u AS (SELECT id, nullif({_norm('title')}, '') AS t FROM once WHERE k IS NULL OR k = '' OR rn = 1), v AS (SELECT id, t, row_number() OVER (PARTITION BY t ORDER BY id) AS rn FROM u) SELECT id FROM v WHERE t IS NULL OR rn = 1",
    "keyword_drop_reasons": f"SELECT p.id, {_drop('t')} AS reason FROM (SELECT DISTINCT * FROM processed_news) p JOIN (SELECT id AS rid, concat_ws(' ', title, snippet) AS t FROM raw_news) r ON r.rid = p.ref_raw_id WHERE {_drop('t')} IS NOT NULL",
    "keyword_drop_stats": f"SELECT {_drop('t')} AS reason, count(*) AS n FROM (SELECT concat_ws(' ', title, snippet) AS t FROM raw_news) GROUP BY 1",
    "publisher_functions": f"SELECT publisher, count(*) AS n, {_tier('publisher')} AS tier, {_rank('publisher')} AS trust, {_press('publisher')} AS press FROM raw_news GROUP BY publisher",
    "valid_titles": f"SELECT source, count(*) AS n, count(*) FILTER (WHERE length(t) >= 10 AND NOT regexp_matches(t, '(?i)^(-\\s*)?({_OUTLETS})\\.?$') AND lower(t) NOT IN ({_SECTIONS}) AND NOT regexp_matches(t, '(?i)^(Print\\s+Edition|WSJ|Bloomberg|Reuters|FT)\\s*[|:]')) AS n_valid FROM (SELECT source, trim(title, ' ') AS t FROM raw_news) GROUP BY source",
    "language_split": f"SELECT CASE WHEN coalesce(regexp_matches(lower(publisher), '{_or(dims.DOMESTIC_PUBLISHERS)}'), false) OR coalesce(regexp_matches(title, '[가-힣]'), false) THEN 'ko' ELSE 'en' END AS language, source, count(*) AS n FROM raw_news GROUP BY 1, 2",
    "keep_recent_articles": "SELECT p.id, p.ref_raw_id, coalesce(r.publisher, r.source) AS publisher, p.llm_category FROM (SELECT DISTINCT id, ref_raw_id, llm_category, llm_reason FROM processed_news WHERE llm_decision = 'KEEP') p JOIN raw_news r ON r.id = p.ref_raw_id WHERE r.created_at >= TIMESTAMPTZ '2025-12-16 00:00:00+00'",
    "kst_day_buckets": "SELECT strftime(CAST(ts AS TIMESTAMP) + INTERVAL 9 HOUR, '%Y-%m-%d') AS day_kst, event_type, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY 1, 2",
    "processed_raw_join": "SELECT p.id, p.ref_raw_id, p.llm_decision, r.title, coalesce(r.publisher, r.source) AS publisher FROM processed_news p JOIN raw_news r ON r.id = p.ref_raw_id",
    "topic_articles": f"WITH {_ARTICLES} SELECT topic_id, CAST(ord AS INT) AS ord, id, title, publisher FROM arts",
    "topics_ordered": "SELECT id, CASE " + " ".join(f"WHEN category = '{c}' THEN '{n}'" for c, n in dims.CATEGORIES) + " ELSE category END AS category_name, CASE " + " ".join(f"WHEN category = '{c}' THEN {k}" for k, (c, _) in enumerate(dims.CATEGORIES, 1)) + " ELSE 99 END AS category_order, len(news_ids) AS n_ids FROM topics WHERE len(news_ids) > 0",
    "decision_days": "SELECT CAST(updated_at AT TIME ZONE 'UTC' AS DATE) AS dt, count(*) FILTER (WHERE llm_decision = 'KEEP') AS n_keep, count(*) FILTER (WHERE llm_decision = 'DROP') AS n_drop, count(*) FILTER (WHERE llm_decision = 'ERROR') AS n_error, count(*) FILTER (WHERE llm_decision IS NULL) AS n_open, round(count(*) FILTER (WHERE llm_decision = 'KEEP') * 100.0 / count(*), 4) AS keep_pct FROM (SELECT DISTINCT * FROM processed_news) GROUP BY 1",
    "source_rollup": "SELECT coalesce(s, 'TOTAL') AS source, count(*) AS n FROM (SELECT coalesce(nullif(source, ''), '(none)') AS s FROM raw_news) GROUP BY ROLLUP (s)",
    "source_count_pivot": "SELECT strftime(created_at AT TIME ZONE 'UTC', '%Y-%m-%d') AS dt, " + ", ".join(f"count(*) FILTER (WHERE source = '{c}') AS {c.lower().replace(' ', '_')}" for c in _PIVOT) + " FROM raw_news GROUP BY 1",
    "two_pass_work_list": "SELECT language, llm_decision, count(*) AS n FROM (SELECT DISTINCT * FROM processed_news) WHERE llm_decision IS NULL OR llm_decision = 'ERROR' GROUP BY 1, 2",
    "reason_subjects": "SELECT coalesce(lower(trim(regexp_extract(llm_reason, '^\\[(.*?)\\]', 1), ' ')), '') AS subject, count(*) AS n FROM (SELECT DISTINCT id, llm_reason FROM processed_news) GROUP BY 1",
    "upsert_last_title_wins": f"""
WITH s AS (SELECT * REPLACE (regexp_replace(regexp_replace(url, '^{_WS}', ''), '{_WS}$', '') AS url, regexp_replace(regexp_replace(coalesce(title, ''), '^{_WS}', ''), '{_WS}$', '') AS title) FROM raw_news WHERE url IS NOT NULL),
a AS (SELECT *, title AS t FROM s WHERE url <> ''),
b AS (SELECT *, lag(t) OVER w AS before, coalesce(max(CASE WHEN t = '' THEN 1 ELSE 0 END) OVER (PARTITION BY url ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS frozen FROM a WINDOW w AS (PARTITION BY url ORDER BY id)),
c AS (SELECT *, max(CASE WHEN before IS NULL OR before <> t THEN id END) OVER (PARTITION BY url) AS last_change, min(id) OVER (PARTITION BY url) AS first_id FROM b WHERE frozen = 0)
SELECT f.id, f.source, f.publisher, f.url, m.title, m.search_rank, m.collected_at FROM c f JOIN c m ON m.url = f.url AND m.id = f.last_change WHERE f.id = f.first_id""",
    "decision_update": "SELECT CASE WHEN llm_decision = 'ERROR' THEN 'DROP' ELSE llm_decision END AS llm_decision, CASE WHEN llm_decision = 'ERROR' THEN 'PHASE_4_DONE' ELSE process_status END AS process_status, count(*) AS n FROM (SELECT DISTINCT * FROM processed_news) GROUP BY 1, 2",
    "deferred_delete": "SELECT 'raw_news' AS table_name, count(*) AS n, CAST(sum(id) AS BIGINT) AS ids FROM raw_news r WHERE NOT EXISTS (SELECT 1 FROM processed_news p WHERE p.ref_raw_id = r.id AND p.llm_decision = 'DROP') UNION ALL SELECT 'processed_news', count(*), CAST(sum(id) AS BIGINT) FROM (SELECT DISTINCT id FROM processed_news WHERE id NOT IN (SELECT id FROM processed_news WHERE llm_decision = 'DROP'))",
    "waterfall_feed_limit": f"WITH {_FEED}, o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, url ORDER BY feed_ord, id) AS rn FROM feed) WHERE rn = 1), c AS (SELECT source, feed_ord, count(*) AS n FROM o GROUP BY 1, 2), k AS (SELECT source, feed_ord, coalesce(sum(n) OVER (PARTITION BY source ORDER BY feed_ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM c) SELECT source, id FROM (SELECT o.source, o.id, row_number() OVER (PARTITION BY o.source ORDER BY o.feed_ord, o.id) AS place FROM o JOIN k ON k.source = o.source AND k.feed_ord = o.feed_ord WHERE before < 30) WHERE place <= 50",
    "primary_fallback_topk": f"WITH {_FEED}, f AS (SELECT source AS topic, id, url, CASE WHEN id % 3 = 0 THEN 0 ELSE 1 END AS tier FROM feed), o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY topic, url ORDER BY tier, id) AS rn FROM f) WHERE rn = 1) SELECT topic, id, tier FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY tier, id) AS place FROM o) WHERE place <= 30",
    "topic_publisher_quota": f"WITH {_ARTICLES}, a AS (SELECT *, row_number() OVER (PARTITION BY topic_id, publisher, {_norm('title')} ORDER BY id DESC) AS o FROM arts), b AS (SELECT *, row_number() OVER (PARTITION BY topic_id, publisher ORDER BY id DESC) AS p FROM a WHERE o = 1), c AS (SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY {_tier('publisher')}, id DESC) AS topic_rank FROM b WHERE p <= 2) SELECT topic_id, CAST(topic_rank AS INT) AS topic_rank, id FROM c WHERE topic_rank <= 15",
    "section_selection_topk": "SELECT category, CAST(place AS INT) AS place, id FROM (SELECT category, id, row_number() OVER (PARTITION BY category ORDER BY original_count DESC NULLS LAST, id DESC) AS place FROM topics WHERE len(news_ids) > 0) WHERE place <= 5",
    "newline_agg": f"WITH {_ARTICLES} SELECT topic_id, string_agg(replace(coalesce(title, ''), chr(10), ' '), chr(10) ORDER BY ord, id) AS title, string_agg(coalesce(publisher, ''), chr(10) ORDER BY ord, id) AS publisher FROM arts GROUP BY 1",
    "newline_roundtrip": f"WITH {_ARTICLES} SELECT topic_id, CAST(row_number() OVER (PARTITION BY topic_id ORDER BY ord, id) - 1 AS INT) AS pos, replace(coalesce(title, ''), chr(10), ' ') AS title, coalesce(publisher, '') AS publisher FROM arts",
    "weighted_centroid": "SELECT label, CAST(d AS INT) AS d, round(sum(v * w) / sum(w), 5) AS v FROM (SELECT label, 1.0 + vec_id % 3 AS w, unnest(embedding) AS v, unnest(range(len(embedding))) AS d FROM embeddings) GROUP BY 1, 2",
    "daily_source_window": "SELECT time_bucket(INTERVAL 6 HOUR, ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "order_status_rollup": "SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)",
    "nation_revenue": "SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1",
}
