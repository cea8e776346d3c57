"""Named queries of single operators over the test tables, each beside the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline import dims
from loomline.functions import text, time, url
from loomline.operators import changes, collect, insight, labels, publish, report, stats, vectors
from loomline.plans.catalog import _ARTICLES, _PIVOT, _WS, _norm, _or, _rank, _sql, _t, _tier
from loomline.runtime import scratch_path
from loomline.sources import sinks, tables
from loomline.sources.outlets import OUTLETS
from loomline.streaming import distinct_articles, each_batch, follow_parquet, sessions, windowed_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
AS_OF = datetime(2026, 3, 1)


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _strip(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^{_WS}', ''), '{_WS}$', '')"


# --- collecting
_ENTRIES = ["title", "summary", "link", "id", "href", "published", "updated", "pubDate"]


def _entries(spark: SparkSession, d: str) -> DataFrame:
    """The stored articles as feed entries of the outlets, dealt out by number."""
    raw = _t(spark, d, "raw_news")
    feed = raw.select(
        F.pmod("id", F.lit(len(OUTLETS))).cast("int").alias("outlet"), F.lit(0).alias("feed_ord"), F.col("id").alias("pos"), F.concat("title", F.lit(" - Reuters")).alias("title"),
        F.col("snippet").alias("summary"), F.col("url").alias("link"), F.lit(None).cast("string").alias("id"), F.lit(None).cast("string").alias("href"),
        F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("published"), F.lit(None).cast("string").alias("updated"), F.lit(None).cast("string").alias("pubDate"),
    )
    return feed


def _outlet_sql(k: int, spec: collect.SourceSpec) -> str:
    title = f"trim(regexp_replace(regexp_replace(t, '<[^>]+>', ' ', 'g'), '{_WS}', ' ', 'g'), ' ')"
    if spec.outlets:
        title = f"trim(regexp_replace({title}, '(?i)[ \\t]*-[ \\t]*({_or(spec.outlets)})\\.?[ \\t]*$', ''), ' ')"
    summary = f"trim(regexp_replace(regexp_replace(coalesce(snippet, ''), '<[^>]+>', ' ', 'g'), '{_WS}', ' ', 'g'), ' ')"
    if spec.summary_chars:
        summary = f"substr({summary}, 1, {spec.summary_chars})"
    blank = " OR ".join(["trim(s, ' ') = title", *(f"contains(lower(s), {_sql(w.lower())})" for w in spec.blank_words)])
    keep = "''" if spec.clear_snippet else f"CASE WHEN {blank} THEN '' ELSE s END"
    valid = f"WHERE length(title) >= 10 AND NOT regexp_matches(title, '(?i)^(-\\s*)?({_or(dims.OUTLET_NAMES)})\\.?$') AND lower(title) NOT IN ({', '.join(_sql(x.lower()) for x in dims.SECTION_TITLES)}) AND NOT regexp_matches(title, '(?i)^(Print\\s+Edition|WSJ|Bloomberg|Reuters|FT)\\s*[|:]')"
    cap = f"ORDER BY pos LIMIT {spec.cap}" if spec.cap else ""
    return f"""(SELECT {_sql(spec.name)} AS source, pos, title, {keep} AS summary, link AS url FROM (SELECT *, row_number() OVER (PARTITION BY link ORDER BY pos) AS rn FROM (
  SELECT pos, {title} AS title, {summary} AS s, link FROM (SELECT id AS pos, title || ' - Reuters' AS t, snippet, trim(url, ' ') AS link, created_at FROM raw_news WHERE id % {len(OUTLETS)} = {k} AND regexp_matches(trim(url, ' '), '^https?://')
    AND created_at >= TIMESTAMPTZ '2026-03-01 00:00:00+00' - INTERVAL {int(spec.hours)} HOUR) WHERE t IS NOT NULL) {valid if spec.check_title else ''}) WHERE rn = 1 {cap})"""


def collected_sources(spark: SparkSession, d: str) -> DataFrame:
    """Every declared outlet over its feed entries: window, suffix, validity, summary rules, first address, cap."""
    entries = _entries(spark, d).where("title IS NOT NULL")
    out = None
    for k, spec in enumerate(OUTLETS.values()):
        part = collect.collect(entries.where(F.col("outlet") == k), spec, AS_OF).select("source", "pos", "title", "summary", "url")
        out = part if out is None else out.unionByName(part)
    return out


query(" UNION ALL ".join(_outlet_sql(k, s) for k, s in enumerate(OUTLETS.values())))(collected_sources)


@query("SELECT id, row_number() OVER (PARTITION BY source, CAST(created_at AT TIME ZONE 'UTC' AS DATE) ORDER BY id) AS search_rank FROM raw_news WHERE source IS NOT NULL")
def search_ranks(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "raw_news").where("source IS NOT NULL").withColumn("batch", F.concat_ws("|", "source", F.to_date("created_at")))
    return collect.search_rank(rows.drop("search_rank"), "batch", "id").select("id", "search_rank")


@query("SELECT DISTINCT publisher, 'https://feeds.example/search?q=' || replace(url_encode(publisher || ' when:1d'), '%20', '+') || '&hl=en' AS feed FROM raw_news WHERE publisher IS NOT NULL")
def search_feeds(spark: SparkSession, d: str) -> DataFrame:
    names = _t(spark, d, "raw_news").where("publisher IS NOT NULL").select("publisher").distinct()
    return names.select("publisher", url.search_feed(F.concat("publisher", F.lit(" when:1d")), "https://feeds.example/search?q=", "&hl=en").alias("feed"))


_FULL = "coalesce(title, '') || ' - ' || coalesce(publisher, '')"


@query(f"SELECT id, trim(regexp_extract(t, '(?s)^(.*) - (.*)$', 1), ' ') AS title, trim(regexp_extract(t, '(?s)^(.*) - (.*)$', 2), ' ') AS press_name, coalesce(nullif(trim(regexp_extract(t, '(?s)^(.*) - (.*)$', 2), ' '), ''), source) AS source FROM (SELECT id, source, {_FULL} AS t FROM raw_news)")
def split_press(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "raw_news").select("id", F.concat(F.coalesce("title", F.lit("")), F.lit(" - "), F.coalesce("publisher", F.lit(""))).alias("title"), F.col("source").alias("topic"))
    return collect.split_press(rows).select("id", "title", "press_name", "source")


@query("SELECT id, CASE WHEN coalesce(trim(title), '') = '' THEN 'Empty required field: title' WHEN coalesce(trim(url), '') = '' THEN 'Empty required field: url' WHEN coalesce(trim(source), '') = '' THEN 'Empty required field: source' WHEN NOT regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+') THEN 'Invalid URL format: ' || url END AS error FROM (SELECT id, " + ", ".join(f"{_strip(c)} AS {c}" for c in ("title", "url", "source")) + " FROM raw_news)")
def article_errors(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "raw_news").select("id", collect.article_error("title", "url", "source").alias("error"))


@query("SELECT id, coalesce(nullif(snippet, ''), title) AS snippet, coalesce(nullif(publisher, ''), nullif(source, ''), 'unknown') AS publisher, created_at FROM raw_news WHERE source IN ('Infomax', 'Naver Finance', 'Rheinblick', 'Meridian Wire')")
def sheet_rows(spark: SparkSession, d: str) -> DataFrame:
    """Chosen sources, each column the first that is filled."""
    rows = _t(spark, d, "raw_news").where(F.col("source").isin("Infomax", "Naver Finance", "Rheinblick", "Meridian Wire"))
    return rows.select("id", collect.first_filled("snippet", "title").alias("snippet"), F.coalesce(collect.first_filled("publisher", "source"), F.lit("unknown")).alias("publisher"), "created_at")


@query("SELECT id, coalesce(CAST(published_at AS TIMESTAMP) >= TIMESTAMP '2025-03-01 00:00:00', true) AND length(trim(coalesce(llm_reason, ''), ' ')) >= 10 AS ok FROM (SELECT DISTINCT id, published_at AT TIME ZONE 'UTC' AS published_at, llm_reason FROM processed_news)")
def recent_within_a_year(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "processed_news").select("id", "published_at", "llm_reason").distinct()
    return rows.select("id", (time.recent("published_at", AS_OF, 24 * 365) & (F.length(F.trim(F.coalesce("llm_reason", F.lit("")))) >= 10)).alias("ok"))


# --- text
@query(f"SELECT id, trim(regexp_replace(regexp_replace(x, '<[^>]+>', ' ', 'g'), '{_WS}', ' ', 'g'), ' ') AS bare, translate(title, '[]', '()') AS round, replace(replace(replace(title, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS escaped, {_norm('title')} AS normal FROM (SELECT id, title, '<b>' || title || '</b><br/>' || snippet AS x FROM raw_news)")
def title_cleaning(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "raw_news").select("id", "title", F.concat(F.lit("<b>"), "title", F.lit("</b><br/>"), "snippet").alias("x"))
    return rows.select("id", text.strip_tags("x").alias("bare"), text.round_brackets("title").alias("round"), text.escape_html("title").alias("escaped"), text.normalise_title("title").alias("normal"))


@query("SELECT id, replace(replace(replace(replace(replace(replace(title, '&quot;', '\"'), '&#39;', ''''), '&lt;', '<'), '&gt;', '>'), '&nbsp;', chr(160)), '&amp;', '&') AS title FROM raw_news WHERE contains(title, '&')")
def entities_resolved(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "raw_news").where(F.col("title").contains("&")).select("id", text.unescape_html("title").alias("title"))


_KEYS = ", ".join(_sql(w) for w in dims.KEYWORD_STOPS)
_SPLIT = _WS[:-2] + ",!·&]+"


@query(f"SELECT id, array_to_string(CASE WHEN len(w) > 0 THEN w[1:3] ELSE ['Finance', 'Market'] END, '|') AS words FROM (SELECT id, list_filter(string_split_regex(title, '{_SPLIT}'), lambda x: length(x) >= 2 AND x NOT IN ({_KEYS}) AND NOT regexp_matches(x, '^[!?,.]+$')) AS w FROM raw_news WHERE title IS NOT NULL)")
def keywords(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "raw_news").where("title IS NOT NULL").select("id", F.array_join(text.title_keywords("title"), "|").alias("words"))


@query("SELECT id, array_to_string(list_concat(['News', 'Daily'], list_filter(string_split(title, ' '), lambda x: length(x) > 3)[1:3]), '|') AS tags, '[' || strftime(day, '%-m/%-d') || '] ' || title AS short, '[' || strftime(day, '%b %-d') || '] ' || title AS long FROM (SELECT id, title, created_at AT TIME ZONE 'UTC' AS day FROM raw_news) WHERE title IS NOT NULL")
def headlines_and_tags(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "raw_news").where("title IS NOT NULL")
    return rows.select("id", F.array_join(publish.title_tags("title", ["News", "Daily"]), "|").alias("tags"), publish.dated_headline("title", "created_at").alias("short"), publish.dated_headline("title", "created_at", "MMM d").alias("long"))


@query("SELECT id, CASE WHEN length(title) > 50 THEN substr(title, 1, 50) || '...' ELSE title END AS title, CASE WHEN length(snippet) > 150 THEN substr(snippet, 1, 150) || '...' ELSE snippet END AS snippet FROM raw_news")
def shortened(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "raw_news").select("id", text.shorten("title", 50).alias("title"), text.shorten("snippet", 150).alias("snippet"))


@query(f"WITH p AS (SELECT DISTINCT publisher FROM raw_news), s AS (SELECT DISTINCT source FROM raw_news) SELECT publisher, source, CAST(sign({_tier('publisher')} - {_tier('source')}) AS INT) AS cmp FROM p, s")
def tier_comparison(spark: SparkSession, d: str) -> DataFrame:
    """Every publisher that occurs beside every source: two lists of names."""
    rows = _t(spark, d, "raw_news")
    names = rows.agg(F.collect_set("source").alias("s"), F.max(F.col("source").isNull()).alias("n")).select(F.explode(F.when(F.col("n"), F.concat("s", F.array(F.lit(None).cast("string")))).otherwise(F.col("s"))).alias("source"))
    return rows.select("publisher").distinct().join(F.broadcast(names)).select("publisher", "source", text.compare_tiers("publisher", "source").alias("cmp"))


_BLOCKED = " OR ".join(f"contains(lower(publisher), {_sql(n.lower())})" for n in dict.fromkeys(dims.CITATION_BLOCKLIST))


@query(f"SELECT id FROM raw_news WHERE NOT coalesce({_BLOCKED}, false)")
def citable(spark: SparkSession, d: str) -> DataFrame:
    """Rows that an English report may cite."""
    return _t(spark, d, "raw_news").where(~text.contains_any("publisher", dims.CITATION_BLOCKLIST)).select("id")


@query("SELECT source, round(n * 100.0 / sum(n) OVER (), 1) AS pct, printf('%.1f%%', n * 100.0 / sum(n) OVER ()) AS shown FROM (SELECT source, count(*) AS n FROM raw_news GROUP BY 1)")
def source_percentages(spark: SparkSession, d: str) -> DataFrame:
    by = _t(spark, d, "raw_news").groupBy("source").agg(F.count("*").alias("n"))
    return stats.with_share(by, "n", "pct").select("source", F.round("pct", 1).alias("pct"), publish.percent("n", "whole").alias("shown"))


@query("SELECT id, array_to_string(list_transform(news_ids, lambda x, i: i || '. ' || x), chr(10)) AS listed, CAST(to_json(news_ids) AS VARCHAR) AS ids_json FROM topics WHERE NOT list_contains(list_transform(news_ids, lambda x: x IS NULL), true)")
def numbered_lists(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "topics").where(~F.exists("news_ids", lambda x: x.isNull()))
    there = rows.select("id", F.transform("news_ids", lambda x: x.cast("string")).alias("s"), F.to_json("news_ids").alias("ids_json"))
    back = there.withColumn("back", F.from_json("ids_json", "array<bigint>"))
    return back.where(F.size("back") == F.size("s")).select("id", text.numbered("s").alias("listed"), "ids_json")


# --- addresses and dates
_NAMES = "(" + "|".join(dims.KEPT_PARAMETERS) + ")"


@query(f"""
WITH u AS (SELECT id, regexp_replace(url, '(?s)#.*$', '') AS u FROM raw_news WHERE url IS NOT NULL),
p AS (SELECT id, u, regexp_extract(u, '(?s)^([^?]*)', 1) AS base, CASE WHEN contains(u, '?') THEN string_split(substr(u, strpos(u, '?') + 1), '&') ELSE [] END AS parts FROM u),
f AS (SELECT id, base, list_filter(parts, lambda x: regexp_matches(regexp_extract(x, '^([^=]*)', 1), '{_NAMES}') AND contains(x, '=')) AS kept FROM p),
g AS (SELECT id, base, list_filter(kept, lambda x, i: list_position(list_transform(kept, lambda y: regexp_extract(y, '^([^=]*)', 1)), regexp_extract(x, '^([^=]*)', 1)) = i) AS first FROM f)
SELECT id, CASE WHEN len(first) > 0 THEN base || '?' || array_to_string(first, '&') ELSE base END AS clean_url FROM g""")
def url_clean_params(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "raw_news").where("url IS NOT NULL").select("id", url.clean_url("url").alias("clean_url"))


@query("""SELECT id, CASE WHEN regexp_matches(l, '^https?://') THEN l WHEN starts_with(l, '//') THEN 'https:' || l WHEN starts_with(l, '/') THEN 'https://site.example' || l ELSE 'https://site.example/' || l END AS url,
  coalesce(regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+'), false) AS ok, try_strptime(nullif(regexp_extract('/a/' || strftime(t, '%Y%m%d%H%M%S'), '/(\\d{14})', 1), ''), '%Y%m%d%H%M%S') AS stamp
FROM (SELECT id, url, created_at AT TIME ZONE 'UTC' AS t, CASE id % 4 WHEN 0 THEN url WHEN 1 THEN regexp_replace(url, '^https?:', '') WHEN 2 THEN regexp_replace(url, '^https?://[^/]*', '') ELSE 'page?id=' || id END AS l FROM raw_news WHERE url IS NOT NULL)""")
def addresses(spark: SparkSession, d: str) -> DataFrame:
    """Links of all kinds against their site, validity, and the time that an address holds."""
    k = F.pmod("id", F.lit(4))
    link = F.when(k == 0, F.col("url")).when(k == 1, F.regexp_replace("url", "^https?:", "")).when(k == 2, F.regexp_replace("url", "^https?://[^/]*", "")).otherwise(F.concat(F.lit("page?id="), "id"))
    rows = _t(spark, d, "raw_news").where("url IS NOT NULL").select("id", "url", link.alias("l"), F.concat(F.lit("/a/"), F.date_format("created_at", "yyyyMMddHHmmss")).alias("path"))
    return rows.select("id", url.absolute_url("l", "https://site.example").alias("url"), url.valid_url("url").alias("ok"), url.path_timestamp("path").cast("timestamp_ntz").alias("stamp"))


@query("""SELECT id, strftime(t, '%Y-%m-%d %H:%M:%S') AS feed_time, strftime(date_trunc('minute', t), '%Y-%m-%d %H:%M:%S') AS dotted, strftime(t + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S') AS kst, strftime(t, '%Y-%m-%d') AS named,
  [70, 71, 72, 73, 74, 75, 76][isodow(t)] AS weekday_id FROM (SELECT id, created_at AT TIME ZONE 'UTC' AS t FROM raw_news)""")
def dates(spark: SparkSession, d: str) -> DataFrame:
    """Mail dates, dotted dates and file names written and read back; wall clock elsewhere; a number for the weekday."""
    rows = _t(spark, d, "raw_news").select("id", "created_at", F.concat(F.date_format("created_at", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT")).alias("mail"), F.date_format("created_at", "yyyy.MM.dd HH:mm").alias("dots"), F.concat(F.lit("report_"), F.date_format("created_at", "yyyy_MM_dd"), F.lit(".json")).alias("file"))
    shown = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return rows.select("id", shown(time.feed_timestamp("mail")).alias("feed_time"), shown(time.dotted_timestamp("dots")).alias("dotted"), time.in_zone("created_at", "Asia/Seoul").alias("kst"), F.date_format(time.file_date("file"), "yyyy-MM-dd").alias("named"), time.by_weekday("created_at", [70, 71, 72, 73, 74, 75, 76]).alias("weekday_id"))


@query("""SELECT id, CASE id % 3 WHEN 0 THEN strftime(t, '%Y-%m-%d %H:%M:%S') WHEN 1 THEN strftime(date_trunc('minute', make_timestamp(2026, month(t), least(day(t), 28), hour(t), minute(t), 0)) - INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S') ELSE strftime(date_trunc('day', t) - INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S') END AS published FROM (SELECT id, created_at AT TIME ZONE 'UTC' AS t FROM raw_news)""")
def page_dates(spark: SparkSession, d: str) -> DataFrame:
    """Dates of list pages: complete, without a year (that of ``as_of`` counts), with a two-digit year; wall clocks of the page's zone."""
    k = F.pmod("id", F.lit(3))
    day28 = F.lpad(F.least(F.dayofmonth("created_at"), F.lit(28)).cast("string"), 2, "0")
    shown = F.when(k == 0, F.date_format(F.from_utc_timestamp("created_at", "Asia/Seoul"), "yyyy-MM-dd HH:mm:ss")).when(k == 1, F.concat(F.date_format("created_at", "MM-"), day28, F.date_format("created_at", " HH:mm"))).otherwise(F.date_format("created_at", "yy.MM.dd"))
    rows = _t(spark, d, "raw_news").select("id", shown.alias("s"))
    return rows.select("id", F.date_format(time.page_timestamp("s", AS_OF, "Asia/Seoul"), "yyyy-MM-dd HH:mm:ss").alias("published"))


# --- order
@query("SELECT row_number() OVER (ORDER BY source NULLS FIRST, search_rank NULLS FIRST, id) AS place, id FROM raw_news")
def raw_in_order(spark: SparkSession, d: str) -> DataFrame:
    return changes.with_ids(_t(spark, d, "raw_news").select("source", "search_rank", "id"), ["source", "search_rank", "id"], column="place").select("place", "id")


@query("SELECT row_number() OVER (ORDER BY strftime(created_at AT TIME ZONE 'UTC', '%Y-%m-%d') DESC, id) AS place, id FROM raw_news")
def newest_first(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "raw_news").select("id", F.date_format("created_at", "yyyy-MM-dd").alias("day"))
    return changes.with_ids(rows, [F.desc("day"), F.asc("id")], column="place").select("place", "id")


_ORDINAL = "CASE " + " ".join(f"WHEN category = '{c}' THEN {k}" for k, (c, _) in enumerate(dims.CATEGORIES, 1)) + " ELSE 99 END"


@query(f"SELECT row_number() OVER (ORDER BY coalesce(original_count, 0) DESC, {_ORDINAL}, len(news_ids), id) AS place, row_number() OVER (ORDER BY category NULLS FIRST, coalesce(original_count, 0) DESC, id) AS by_category, row_number() OVER (ORDER BY id DESC) AS newest, id FROM topics")
def topics_in_sheet_order(spark: SparkSession, d: str) -> DataFrame:
    """The sheet's order (size first, the display order breaks ties), the category order, and newest first."""
    rows = _t(spark, d, "topics").select("id", "category", F.coalesce("original_count", F.lit(0)).alias("n"), report.category_order("category").alias("o"), F.size("news_ids").alias("k"))
    out = changes.with_ids(rows, [F.desc("n"), F.asc("o"), F.asc("k"), F.asc("id")], column="place")
    out = changes.with_ids(out, [F.asc("category"), F.desc("n"), F.asc("id")], column="by_category")
    return changes.with_ids(out, [F.desc("id")], column="newest").select("place", "by_category", "newest", "id")


@query("SELECT CAST((n - 1) // 50 AS BIGINT) AS batch, min(id) AS low, max(id) AS high, count(*) AS n FROM (SELECT id, row_number() OVER (ORDER BY id DESC) AS n FROM (SELECT DISTINCT id FROM processed_news WHERE llm_decision IS NULL OR llm_decision = 'ERROR')) GROUP BY 1")
def label_batches(spark: SparkSession, d: str) -> DataFrame:
    """The work list in batches of fifty, newest id first."""
    rows = labels.work_list(_t(spark, d, "processed_news")).select("id").distinct()
    return labels.slices(rows, 50).groupBy("batch").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("n"))


# --- labels and groups
_KNOWN = ", ".join(_sql(c) for c, _ in dims.CATEGORIES)


ORACLE["label_replay"] = f"SELECT CASE WHEN llm_category = 'Noise' OR (llm_category IS NULL) THEN 'DROP' WHEN llm_decision = 'KEEP' AND llm_category NOT IN ({_KNOWN}) THEN 'ERROR' ELSE llm_decision END AS decision, count(*) AS n FROM (SELECT DISTINCT ON (id) * FROM processed_news WHERE llm_decision IN ('KEEP', 'DROP')) GROUP BY 1"


@query("SELECT coalesce(nullif(llm_category, ''), 'Uncategorized') AS category, language, count(*) AS n FROM (SELECT DISTINCT * FROM processed_news) GROUP BY 1, 2")
def category_groups(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "processed_news").distinct()
    return rows.groupBy(F.coalesce(F.nullif("llm_category", F.lit("")), F.lit("Uncategorized")).alias("category"), "language").agg(F.count("*").alias("n"))


@query("SELECT category, CAST(sum(len(news_ids)) AS BIGINT) AS n_articles, count(*) AS n_topics FROM topics GROUP BY 1")
def payload_counts(spark: SparkSession, d: str) -> DataFrame:
    return report.payload_counts(_t(spark, d, "topics"))


ORACLE["anchor_pick"] = """
WITH v AS (SELECT label, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL),
c AS (SELECT label, list(m ORDER BY d) AS c FROM (SELECT label, d, avg(x) AS m FROM (SELECT label, unnest(e) AS x, unnest(range(len(e))) AS d FROM v) GROUP BY 1, 2) GROUP BY 1),
s AS (SELECT v.label, vec_id, 1 - list_cosine_similarity(e, c) AS x FROM v JOIN c ON c.label = v.label)
SELECT label, arg_min(vec_id, x) AS id, round(min(x), 5) AS distance, count(*) AS n FROM s GROUP BY 1"""


@query("SELECT label AS cluster, vec_id AS id, CAST(k AS INT) AS pick_number FROM (SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id DESC) AS k FROM embeddings) WHERE k <= 15")
def cluster_members(spark: SparkSession, d: str) -> DataFrame:
    return vectors.top_members(_t(spark, d, "embeddings"), "label", [F.desc("vec_id")], 15).select(F.col("label").alias("cluster"), F.col("vec_id").alias("id"), "pick_number")


@query("""
WITH m AS (SELECT t.id AS cluster, p.id, r.title, CAST(row_number() OVER (PARTITION BY t.id ORDER BY p.id DESC) AS INT) AS k FROM (SELECT DISTINCT id, unnest(news_ids) AS pid FROM topics) t JOIN (SELECT DISTINCT id, ref_raw_id FROM processed_news) p ON p.id = t.pid JOIN raw_news r ON r.id = p.ref_raw_id WHERE r.title IS NOT NULL),
a AS (SELECT * FROM m WHERE k = 1)
SELECT m.cluster, any_value(a.id) AS anchor_id, any_value(a.title) AS anchor_title, count(*) AS n, coalesce(array_to_string(list(m.title ORDER BY m.k) FILTER (WHERE m.k <= 16 AND m.id <> a.id AND m.title <> a.title)[1:15], chr(10)), '') AS linked FROM m JOIN a ON a.cluster = m.cluster GROUP BY 1""")
def insight_reports(spark: SparkSession, d: str) -> DataFrame:
    """The newest article of each topic with the titles of the others."""
    rows = report.topic_articles(_t(spark, d, "topics"), _t(spark, d, "processed_news"), _t(spark, d, "raw_news")).where("title IS NOT NULL")
    picked = vectors.top_members(rows, "topic_id", [F.desc("id")], 1 << 30).withColumnRenamed("topic_id", "cluster")
    return insight.cluster_reports(picked).withColumn("linked", F.array_join("linked", "\n"))


@query("SELECT id, CASE WHEN regexp_matches(llm_reason, '금리|rate') THEN 'ACTIVE' ELSE llm_decision END AS status FROM (SELECT DISTINCT id, llm_reason, llm_decision FROM processed_news)")
def protected_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "processed_news").select("id", "llm_reason", "llm_decision").distinct()
    return rows.select("id", insight.protect("llm_decision", "llm_reason", "금리|rate").alias("status"))


# --- reports
_REF = "string_split_regex(text, '\\[Ref:\\s*[0-9,\\s]+\\]')"


ORACLE["citation_expand"] = f"""
WITH t AS (SELECT id AS section, list_filter(news_ids, lambda x: x IS NOT NULL) AS ids FROM topics),
art AS (SELECT p.id, coalesce(r.title, '') AS title, coalesce(r.url, '') AS url, coalesce(r.publisher, '') AS publisher FROM (SELECT DISTINCT id, ref_raw_id FROM processed_news) p JOIN raw_news r ON r.id = p.ref_raw_id),
c AS (SELECT section, unnest(ids) AS id, unnest(range(len(ids))) AS k FROM t),
n AS (SELECT c.section, k, '\n> • [' || title || '](' || url || ') - (' || publisher || ')' AS line, row_number() OVER (PARTITION BY c.section ORDER BY k) AS r FROM c JOIN art ON art.id = c.id),
l AS (SELECT section, string_agg(line, '' ORDER BY k) AS links FROM n WHERE r <= 5 GROUP BY 1)
SELECT t.section, 'Summary ' || CASE WHEN len(ids) > 0 THEN coalesce(links, '') ELSE '[Ref: ]' END || ' end ' AS text FROM t LEFT JOIN l ON l.section = t.section""".replace("\n> •", "' || chr(10) || '> •")


_LINES = """
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents WHERE text IS NOT NULL),
kinds AS (SELECT doc_id, pos, line, CASE WHEN regexp_matches(line, '^\\s*(>|•|- |\\*-)') THEN 'link' WHEN regexp_matches(line, '^\\s*(#{3,}.*|\\*\\*[^*]{1,100}\\*\\*:?)\\s*$') THEN 'header' ELSE 'text' END AS kind FROM lines WHERE trim(line, ' ') <> ''),
marks AS (SELECT *, lag(kind) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM kinds),
blocks AS (SELECT *, sum(CASE WHEN kind = 'header' OR (kind = 'text' AND before = 'link') OR before IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS block FROM marks)"""


ORACLE["section_blocks"] = f"""
WITH {_LINES}
SELECT doc_id, CAST(block AS INT) AS block, regexp_replace(coalesce(string_agg(trim(line, ' '), ' ' ORDER BY pos) FILTER (WHERE kind = 'header'), ''), '^#+\\s*|\\*\\*', '', 'g') AS title,
  length(coalesce(string_agg(trim(line, ' '), chr(10) ORDER BY pos) FILTER (WHERE kind = 'text'), '')) AS n_text, CAST(count(*) FILTER (WHERE kind = 'link') AS INT) AS n_links FROM blocks GROUP BY doc_id, block"""


@query("""
WITH l AS (SELECT id, '> • **[' || coalesce(title, '') || '](' || coalesce(url, '') || ')** - ' || CASE id % 3 WHEN 0 THEN '(' || coalesce(publisher, '') || ')' WHEN 1 THEN coalesce(publisher, '') ELSE '' END AS line FROM raw_news WHERE NOT regexp_matches(coalesce(title, '') || coalesce(url, '') || coalesce(publisher, ''), '[\\n\\r]')),
c AS (SELECT id, trim(replace(regexp_replace(CASE WHEN id % 5 = 0 THEN '- plain words' ELSE line END, '^[>•\\-*]+\\s*', ''), '**', ''), ' ') AS c FROM l),
p AS (SELECT id, c, '\\[(.*)\\]\\((.*?)\\)\\s*-\\s*\\((.*?)\\)' AS s, '\\[(.*)\\]\\((.*?)\\)\\s*-\\s*(.*)' AS w FROM c)
SELECT id, CASE WHEN regexp_matches(c, '\\[(.*)\\]\\((.*?)\\)\\s*-\\s*\\((.*?)\\)') THEN trim(regexp_extract(c, '\\[(.*)\\]\\((.*?)\\)\\s*-\\s*\\((.*?)\\)', 1), ' ') WHEN regexp_matches(c, '\\[(.*)\\]\\((.*?)\\)\\s*-\\s*(.*)') THEN trim(regexp_extract(c, '\\[(.*)\\]\\((.*?)\\)\\s*-\\s*(.*)', 1), ' ') END AS title,
  CASE WHEN regexp_matches(c, '\\[(.*)\\]\\((.*?)\\)\\s*-\\s*\\((.*?)\\)') THEN trim(regexp_extract(c, '\\[(.*)\\]\\((.*?)\\)\\s*-\\s*\\((.*?)\\)', 3), ' ') WHEN regexp_matches(c, '\\[(.*)\\]\\((.*?)\\)\\s*-\\s*(.*)') THEN trim(regexp_extract(c, '\\[(.*)\\]\\((.*?)\\)\\s*-\\s*(.*)', 3), ' ') END AS source,
  CASE WHEN NOT regexp_matches(c, '\\[(.*)\\]\\((.*?)\\)\\s*-\\s*(.*)') THEN c END AS raw FROM p""")
def links_parsed(spark: SparkSession, d: str) -> DataFrame:
    e = lambda c: F.coalesce(c, F.lit(""))
    k = F.pmod("id", F.lit(3))
    tail = F.when(k == 0, F.concat(F.lit("("), e("publisher"), F.lit(")"))).when(k == 1, e("publisher")).otherwise("")
    line = F.when(F.pmod("id", F.lit(5)) == 0, "- plain words").otherwise(F.concat(F.lit("> • **["), e("title"), F.lit("]("), e("url"), F.lit(")** - "), tail))
    rows = _t(spark, d, "raw_news").where(~F.concat(e("title"), e("url"), e("publisher")).rlike("[\n\r]"))
    return rows.select("id", report.parse_link(line).alias("l")).select("id", "l.title", "l.source", "l.raw")


@query(f"""WITH {_LINES} SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars FROM (
  SELECT doc_id, line, last_value(CASE WHEN starts_with(line, '## ') THEN line END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos) AS h FROM lines) WHERE h IS NULL OR NOT regexp_matches(h, '(?i)outlook|risk|summary') GROUP BY 1""")
def sections_dropped(spark: SparkSession, d: str) -> DataFrame:
    lines = _t(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return report.drop_sections(lines, "doc_id", "(?i)outlook|risk|summary").groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.sum(F.length("line")).alias("n_chars"))


@query(f"""WITH {_LINES}, b AS (SELECT doc_id, coalesce(max(CASE WHEN starts_with(trim(line, ' '), '## ') THEN pos END), 0) AS low, max(CASE WHEN contains(line, '©') THEN pos END) AS high FROM lines GROUP BY 1)
SELECT l.doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(min(pos) AS INT) AS first_line FROM lines l JOIN b ON b.doc_id = l.doc_id WHERE pos >= low AND (high IS NULL OR pos < high) GROUP BY 1""")
def reports_trimmed(spark: SparkSession, d: str) -> DataFrame:
    """From the last ``## `` heading to the copyright line."""
    lines = _t(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    kept = report.trim_lines(lines, "doc_id", F.trim("line").startswith("## "), F.col("line").contains("©"))
    return kept.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.min("pos").alias("first_line"))


@query("""
WITH t AS (SELECT doc_id, text, strpos(text, chr(10)) AS p FROM documents WHERE text IS NOT NULL),
h AS (SELECT doc_id, text, CASE WHEN p > 0 THEN substr(text, 1, p - 1) ELSE text END AS header, CASE WHEN p > 0 THEN substr(text, p + 1) ELSE '' END AS body FROM t),
r AS (SELECT doc_id, text, header, 4096 - length(header) - 16 AS room, string_split_regex(body, '\\n\\s*\\n') AS ps FROM h WHERE length(text) > 4096),
q AS (SELECT doc_id, room, list_transform(flatten(list_transform(ps, lambda x: list_transform(range(0, greatest(1, length(x)), room), lambda i: substr(x, CAST(i AS INT) + 1, room)))), lambda x: {'s': x, 'n': length(x)}) AS pieces FROM r WHERE room > 0),
f AS (SELECT doc_id, list_reduce(list_transform(pieces, lambda x: {'parts': [0], 'now': x.n, 'room': room}), lambda a, x: {'parts': CASE WHEN a.now > 0 AND a.now + x.now + 2 > a.room THEN list_append(a.parts, a.now) ELSE a.parts END, 'now': CASE WHEN a.now > 0 AND a.now + x.now + 2 <= a.room THEN a.now + x.now + 2 ELSE x.now END, 'room': a.room}) AS z FROM q)
SELECT doc_id, 1 AS n_parts, length(text) AS n_body FROM h WHERE length(text) <= 4096
UNION ALL SELECT doc_id, CAST(len(z.parts) AS INT), CAST(list_sum(z.parts) + z.now AS BIGINT) FROM f""")
def messages_split(spark: SparkSession, d: str) -> DataFrame:
    """Number of messages of each document, and the length of what they hold without their headers."""
    rows = _t(spark, d, "documents").where("text IS NOT NULL").select("doc_id", "text", report.messages("text").alias("m"))
    body = F.aggregate(F.transform("m", lambda x: F.length(F.regexp_extract(x, r"(?s)^[^\n]*\n(.*)$", 1)).cast("bigint")), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return rows.select("doc_id", F.size("m").alias("n_parts"), F.when(F.size("m") == 1, F.length("text").cast("bigint")).otherwise(body).alias("n_body"))


_ESC = "replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


ORACLE["report_digest"] = f"""WITH {_ARTICLES}, a AS (SELECT topic_id, ord, coalesce(r.url, '') AS url, coalesce(arts.title, '') AS title, arts.publisher, row_number() OVER (PARTITION BY topic_id ORDER BY ord) AS k FROM arts JOIN (SELECT DISTINCT id, ref_raw_id FROM processed_news) p ON p.id = arts.id JOIN raw_news r ON r.id = p.ref_raw_id),
i AS (SELECT topic_id, string_agg('<li><a href="' || url || '">' || {_ESC.format('title')} || '</a> (' || coalesce({_ESC.format('publisher')}, '') || ')</li>', '' ORDER BY ord) AS items FROM a WHERE k <= 6 GROUP BY 1),
t AS (SELECT id, coalesce(category, 'Uncategorized') AS category, '<h3>' || {_ESC.format('topic_title')} || '</h3><ul>' || items || '</ul>' AS h FROM topics JOIN i ON i.topic_id = id)
SELECT category, '<h2>' || CASE """ + " ".join(f"WHEN category = '{c}' THEN '{n}'" for c, n in dims.CATEGORIES) + """ ELSE category END || '</h2>' || coalesce(string_agg(h, '' ORDER BY id), '') AS html FROM t GROUP BY category"""


@query(f"""WITH {_ARTICLES}, l AS (SELECT topic_id, string_agg('- ' || coalesce(title, '') || ' (' || coalesce(publisher, '') || ')', chr(10) ORDER BY ord) AS links FROM (SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY ord) AS k FROM arts) WHERE k <= 2 GROUP BY 1)
SELECT id, coalesce(topic_title, '') || ' [' || len(news_ids) || ']' || coalesce(chr(10) || links, '') AS message FROM topics LEFT JOIN l ON topic_id = id""")
def chat_topics(spark: SparkSession, d: str) -> DataFrame:
    """One message per topic: title, size and the first two articles."""
    arts = report.topic_articles(_t(spark, d, "topics"), _t(spark, d, "processed_news"), _t(spark, d, "raw_news"))
    return report.topic_messages(_t(spark, d, "topics"), arts)


@query("SELECT category AS section, id AS topic_id FROM (SELECT category, id, row_number() OVER (PARTITION BY category ORDER BY original_count DESC NULLS LAST, id DESC) AS k FROM topics WHERE len(news_ids) > 0) WHERE k <= 5 AND category IS NOT NULL UNION ALL SELECT 'Executive Summary', id FROM (SELECT id, row_number() OVER (ORDER BY original_count DESC NULLS LAST, id DESC) AS k FROM topics WHERE len(news_ids) > 0) WHERE k <= 10")
def section_picks(spark: SparkSession, d: str) -> DataFrame:
    """The picks of every section as a map, and the map as rows again; the summary takes the largest topics of all."""
    topics = _t(spark, d, "topics")
    picks = publish.picks_map(publish.select_by_count(topics), publish.executive_summary(topics))
    return publish.picks_rows(picks)


@query("""
WITH m AS (SELECT id, '# ' || topic_title || chr(10) || '**' || coalesce(category, 'none') || '** of ' || len(news_ids) || chr(10) || '- one' || chr(10) || '- two & three' AS md, topic_title AS t, coalesce(category, 'none') AS c, len(news_ids) AS n FROM topics WHERE topic_title IS NOT NULL AND NOT regexp_matches(topic_title, '[*\\[\\]\\n]'))
SELECT id, '<h1>' || replace(replace(replace(trim(t, ' '), '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</h1>' || chr(10) || '<p><strong>' || c || '</strong> of ' || n || '</p>' || chr(10) || '<ul>' || chr(10) || '<li>one</li>' || chr(10) || '<li>two &amp; three</li>' || chr(10) || '</ul>' AS html FROM m WHERE trim(t, ' ') <> ''""")
def markdown_pages(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "topics").where("topic_title IS NOT NULL AND trim(topic_title) != ''").where(~F.col("topic_title").rlike(r"[*\[\]\n]"))
    md = F.concat(F.lit("# "), "topic_title", F.lit("\n**"), F.coalesce("category", F.lit("none")), F.lit("** of "), F.size("news_ids").cast("string"), F.lit("\n- one\n- two & three"))
    return rows.select("id", publish.page(md).alias("html"))


# --- tables and changes
@query("SELECT id, url FROM raw_news n WHERE id > (SELECT median(id) FROM raw_news) AND url IS NOT NULL AND NOT EXISTS (SELECT 1 FROM raw_news o WHERE o.url = n.url AND o.id <= (SELECT median(id) FROM raw_news))")
def unseen_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the newer half whose address the older half lacks."""
    raw = _t(spark, d, "raw_news")
    half = raw.agg(F.median("id")).first()[0]
    return sinks.unseen(raw.where((F.col("id") > half) & F.col("url").isNotNull()), raw.where((F.col("id") <= half) & F.col("url").isNotNull())).select("id", "url")


@query("WITH a AS (SELECT id FROM raw_news WHERE id % 2 = 0) SELECT id, 'kept' AS origin FROM a UNION ALL SELECT id, 'new' FROM raw_news WHERE id % 3 = 0 AND id NOT IN (SELECT id FROM a)")
def inserted_if_absent(spark: SparkSession, d: str) -> DataFrame:
    raw = _t(spark, d, "raw_news")
    mark = lambda n, o: raw.where(F.pmod("id", F.lit(n)) == 0).select("id", F.lit(o).alias("origin"))
    return changes.insert_absent(mark(2, "kept"), mark(3, "new"), "id")


@query("WITH s AS (SELECT strftime(created_at AT TIME ZONE 'UTC', '%Y-%m-%d') AS dt, count(*) AS n FROM raw_news GROUP BY 1) SELECT dt, CASE WHEN dt >= '2026-03-01' THEN -1 ELSE n END AS n FROM s")
def day_replaced(spark: SparkSession, d: str) -> DataFrame:
    stored = _t(spark, d, "raw_news").groupBy(F.date_format("created_at", "yyyy-MM-dd").alias("dt")).agg(F.count("*").alias("n"))
    today = stored.where("dt >= '2026-03-01'").select("dt", F.lit(-1).cast("bigint").alias("n"))
    return stats.replace_day(stored, today)


@query("SELECT id, title, created_at FROM raw_news")
def parquet_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Written by day, one day replaced, read back."""
    path = scratch_path(spark, "days")
    rows = _t(spark, d, "raw_news").select("id", "title", "created_at", F.to_date("created_at").alias("dt"))
    tables.write_days(rows, path)
    tables.write_days(rows.where("dt = DATE '2026-03-01'"), path)
    return tables.read_parquet(spark, path).select("id", "title", "created_at")


@query("SELECT id, category, topic_title, news_ids FROM topics")
def json_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "report")
    rows = _t(spark, d, "topics").select("id", "category", "topic_title", "news_ids")
    sinks.write_report(rows, path)
    return spark.read.schema(rows.schema).json(path)


@query("SELECT id, title, NULL AS snippet, CAST(search_rank AS INT) AS search_rank FROM raw_news")
def to_stored_schema(spark: SparkSession, d: str) -> DataFrame:
    """Missing columns come as NULL, types are those of the table, others go."""
    rows = _t(spark, d, "raw_news").select("id", "title", F.col("search_rank").cast("string").alias("search_rank"), F.lit(1).alias("extra"))
    return tables.to_schema(rows, "id bigint, title string, snippet string, search_rank int")


@query("SELECT dt, source, n FROM (UNPIVOT (SELECT strftime(created_at AT TIME ZONE 'UTC', '%Y-%m-%d') AS dt, " + ", ".join(f"count(*) FILTER (WHERE source = '{c}') AS \"{c}\"" for c in _PIVOT) + " FROM raw_news GROUP BY 1) ON COLUMNS(* EXCLUDE dt) INTO NAME source VALUE n)")
def daily_statistics(spark: SparkSession, d: str) -> DataFrame:
    """The wide table of the pivot as rows again."""
    wide = stats.source_pivot(_t(spark, d, "raw_news"), F.date_format("created_at", "yyyy-MM-dd"), _PIVOT)
    return wide.unpivot("dt", _PIVOT, "source", "n")


@query(f"SELECT publisher, {_tier('publisher')} AS tier, {_rank('publisher')} AS trust, count(*) AS n, count(DISTINCT regexp_replace(lower(regexp_replace(url, '[?#].*$', '')), '/$', '')) AS n_addresses FROM raw_news GROUP BY publisher")
def sql_functions(spark: SparkSession, d: str) -> DataFrame:
    """The library's functions called from SQL."""
    from loomline.functions.sql import register

    register(spark)
    return spark.sql("SELECT publisher, source_tier(publisher) AS tier, trusted_rank(publisher) AS trust, count(*) AS n, count(DISTINCT url_key(url)) AS n_addresses FROM {raw} GROUP BY publisher", raw=_t(spark, d, "raw_news"))


# --- streams, run over what is there
_SESSIONS = """
SELECT event_type, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS "end", count(*) AS n FROM (SELECT event_type, ts, sum(fresh) OVER (PARTITION BY event_type ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM (
  SELECT event_type, ts, CASE WHEN ts > lag(ts) OVER (PARTITION BY event_type ORDER BY ts) + INTERVAL 30 MINUTE OR lag(ts) OVER (PARTITION BY event_type ORDER BY ts) IS NULL THEN 1 ELSE 0 END AS fresh FROM events)) GROUP BY event_type, s"""


@query(_SESSIONS)
def event_sessions(spark: SparkSession, d: str) -> DataFrame:


    return sessions(_t(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")), "ts", "event_type").withColumns({"start": F.col("start").cast("timestamp_ntz"), "end": F.col("end").cast("timestamp_ntz")})


def _streamed(spark: SparkSession, d: str, table: str, transform: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A table read as a stream, taken through ``transform`` to the end, and what came out of it as a table."""
    # a folder whose only data are those of the table
    source, out, marks = (scratch_path(spark, n) for n in ("source", "sink", "marks"))
    rows = _t(spark, d, table)
    rows.write.parquet(source)
    stream = transform(follow_parquet(spark, source, rows.schema))
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", marks).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


@query("SELECT start, event_type, n FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, (SELECT max(ts) FROM events) AS last FROM events GROUP BY 1, 2) WHERE start + INTERVAL 1 HOUR <= last - INTERVAL 1 HOUR")
def streamed_windows(spark: SparkSession, d: str) -> DataFrame:
    """Counts per hour of a stream: windows that the watermark has passed are final and come out."""
    out = _streamed(spark, d, "events", lambda s: windowed_counts(s.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "event_type"))
    return out.withColumn("start", F.col("start").cast("timestamp_ntz"))


@query(f"SELECT count(DISTINCT coalesce(nullif(regexp_replace(lower(regexp_replace(url, '[?#].*$', '')), '/$', ''), ''), {_norm('title')})) AS n FROM raw_news WHERE coalesce(url, title) IS NOT NULL")
def streamed_distinct(spark: SparkSession, d: str) -> DataFrame:
    """Articles of a stream, the first of each address; the watermark here keeps all of them in mind."""
    out = _streamed(spark, d, "raw_news", lambda s: distinct_articles(s.where("coalesce(url, title) IS NOT NULL").select("id", "url", "title", "created_at"), "created_at", "2000 days"))
    return out.agg(F.count("*").alias("n"))


@query("SELECT source, count(*) AS n FROM raw_news GROUP BY 1")
def micro_batches(spark: SparkSession, d: str) -> DataFrame:
    """A batch transform run on every micro-batch, each written under its number."""
    source, out = scratch_path(spark, "source"), scratch_path(spark, "batches")
    _t(spark, d, "raw_news").select("id", "source").write.parquet(source)
    stream = follow_parquet(spark, source, "id bigint, source string")
    count = lambda df: df.groupBy("source").agg(F.count("*").alias("n"))
    each_batch(stream, count, lambda df, n: df.write.mode("overwrite").parquet(f"{out}/batch={n}"), scratch_path(spark, "marks")).awaitTermination()
    return spark.read.schema("source string, n bigint, batch int").parquet(out).groupBy("source").agg(F.sum("n").alias("n"))
