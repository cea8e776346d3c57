"""Registered queries of the core's data-quality operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.core import instants
from loomline.core.instants import Field, instant_text, normalise_instants
from loomline.core.references import ReferenceSpec, dangling_references, dangling_report


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _specs(spark: SparkSession, d: str) -> list[ReferenceSpec]:
    raw, processed, topics, gone = (_table(spark, d, t) for t in ("raw_news", "processed_news", "topics", "deletions"))
    removed = lambda name: gone.where(F.col("table_name") == name).select(F.col("record_id").alias("key"))
    return [
        ReferenceSpec(
            "processed_news", processed.select(F.col("id").alias("record_id"), F.col("ref_raw_id").alias("ref_key"), F.col("updated_at").alias("ref_time")),
            raw.select(F.col("id").alias("key"), F.col("created_at").alias("time")), removed("raw_news"),
        ),
        ReferenceSpec(
            "topics", topics.select(F.col("id").alias("record_id"), F.explode("news_ids").alias("ref_key"), F.col("created_at").alias("ref_time")),
            processed.select(F.col("id").alias("key"), F.col("updated_at").alias("time")), removed("processed_news"),
        ),
    ]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return dangling_references(spark, _specs(spark, d)).select("ref_table", "record_id", "ref_key", "ref_state")


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    return dangling_report(dangling_references(spark, _specs(spark, d)))


def _instants(spark: SparkSession, d: str) -> DataFrame:
    fields = [Field("published", "feed_tz", "date_order"), Field("collected_at", "host_tz")]
    return normalise_instants(_table(spark, d, "raw_news"), _table(spark, d, "collectors"), fields)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """A value counts as determined only if what its source declares leaves one instant."""
    return _instants(spark, d).select("id", "field_name", F.when(F.col("n_valid") == 1, instant_text(F.col("instant"))).otherwise("undetermined").alias("instant_utc"))


def p4_chosen(spark: SparkSession, d: str) -> DataFrame:
    """Like p4_found, but undecided values get the choice of the Viterbi pass."""
    return _instants(spark, d).select("id", "field_name", instant_text(F.col("instant")).alias("instant_utc"), "n_valid")


QUERIES = {"p1_found": p1_found, "p1_report": p1_report, "p4_found": p4_found, "p4_chosen": p4_chosen}

_P1 = """
WITH refs AS (
  SELECT 'processed_news' AS ref_table, id AS record_id, ref_raw_id AS ref_key, updated_at AS ref_time FROM processed_news
  UNION ALL SELECT 'topics', id, unnest(news_ids), created_at FROM topics
), parents AS (
  SELECT 'processed_news' AS ref_table, id AS ref_key, min(created_at) AS t FROM raw_news GROUP BY id
  UNION ALL SELECT 'topics', id, min(updated_at) FROM processed_news GROUP BY id
), gone AS (
  SELECT DISTINCT CASE table_name WHEN 'raw_news' THEN 'processed_news' ELSE 'topics' END AS ref_table, record_id AS ref_key FROM deletions
), faults AS (
  SELECT DISTINCT r.ref_table, r.record_id, r.ref_key, r.ref_time,
    CASE WHEN p.ref_key IS NOT NULL THEN CASE WHEN p.t > r.ref_time THEN 'late' END WHEN g.ref_key IS NOT NULL THEN 'deleted' ELSE 'missing' END AS ref_state
  FROM refs r LEFT JOIN parents p ON p.ref_table = r.ref_table AND p.ref_key = r.ref_key
  LEFT JOIN gone g ON g.ref_table = r.ref_table AND g.ref_key = r.ref_key
  WHERE r.ref_key IS NOT NULL
)
"""



def _sql_text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _instants_sql() -> str:
    """The values read with the same notations; zones, clock changes and calendar are DuckDB's own."""
    blank = r"[\s\x0B\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]+"
    whens = " ".join(f"WHEN regexp_matches(t, {_sql_text(pattern)}) THEN {_sql_text(name)} || '|' || regexp_replace(t, {_sql_text(pattern)}, {_sql_text(groups.replace('$', chr(92)))})" for name, pattern, groups in instants._NOTATIONS)
    months = "[" + ", ".join(map(_sql_text, instants.MONTHS)) + "]"
    named = " ".join(f"WHEN {_sql_text(n)} THEN {m}" for n, m in instants.ABBREVIATIONS.items())
    others = " OR ".join(f"((u + INTERVAL {m} MINUTE) AT TIME ZONE z) = w OR ((u - INTERVAL {m} MINUTE) AT TIME ZONE z) = w" for m in (30, 60, 120))
    wall = lambda month, day: f"try_strptime(printf('%04d-%02d-%02d %02d:%02d:%02d', y, coalesce({month}, 99), coalesce({day}, 99), h, mi, s), '%Y-%m-%d %H:%M:%S') + to_microseconds(CAST(rpad(substr(f, 1, 6), 6, '0') AS BIGINT))"
    return f"""
WITH v AS (
  SELECT r.id, 'published' AS field_name, r.published AS t, c.feed_tz AS z, c.date_order AS o FROM raw_news r LEFT JOIN collectors c ON c.source = r.source
  UNION ALL SELECT r.id, 'collected_at', r.collected_at, c.host_tz, 'ymd' FROM raw_news r LEFT JOIN collectors c ON c.source = r.source),
x AS (SELECT id, field_name, z, o, regexp_replace(regexp_replace(t, '^{blank}', ''), '{blank}$', '') AS t FROM v),
k AS (SELECT *, string_split(CASE {whens} END, '|') AS p FROM x WHERE length(t) > 0),
n AS (SELECT id, field_name, z, o, length(t) AS n, p[1] AS kind, try_cast(p[2] AS BIGINT) AS y, coalesce(try_cast(p[3] AS INT), list_position({months}, lower(p[3]))) AS mo, try_cast(p[4] AS INT) AS d,
  CASE WHEN coalesce(p[9], '') = '' THEN coalesce(try_cast(p[5] AS INT), 0) WHEN try_cast(p[5] AS INT) BETWEEN 1 AND 12 THEN CAST(p[5] AS INT) % 12 + CASE WHEN p[9] IN ('p', 'P', '오후') THEN 12 ELSE 0 END WHEN coalesce(p[5], '') <> '' THEN 99 ELSE 0 END AS h,
  coalesce(try_cast(p[6] AS INT), 0) AS mi, coalesce(try_cast(p[7] AS INT), 0) AS s, coalesce(p[8], '') AS f, upper(coalesce(p[10], '')) AS zone FROM k),
a AS (SELECT *, CASE WHEN kind = 'number' THEN NULL WHEN kind = 'month-first' AND o = 'dmy' THEN {wall('d', 'mo')} WHEN kind = 'month-first' AND coalesce(o, '') <> 'mdy' AND (o IS NULL AND {wall('mo', 'd')} IS NULL) THEN {wall('d', 'mo')}
    WHEN kind = 'month-first' AND o IS NULL AND {wall('d', 'mo')} IS NOT NULL AND mo <> d THEN NULL WHEN kind = 'month-first' AND o = 'ymd' THEN NULL ELSE {wall('mo', 'd')} END AS w,
  CASE WHEN zone = 'Z' THEN 0 WHEN regexp_matches(zone, '^[+-]') AND CAST(regexp_replace(zone, '[^0-9]', '', 'g') AS INT) % 100 < 60 AND CAST(regexp_replace(zone, '[^0-9]', '', 'g') AS INT) <= 1800
    THEN (CASE WHEN zone[1] = '-' THEN -1 ELSE 1 END) * (CAST(regexp_replace(zone, '[^0-9]', '', 'g') AS INT) // 100 * 60 + CAST(regexp_replace(zone, '[^0-9]', '', 'g') AS INT) % 100) ELSE CASE zone {named} END END AS minutes FROM n),
b AS (SELECT *, CASE WHEN zone = '' AND z IS NOT NULL THEN w AT TIME ZONE z END AS u FROM a)
SELECT id, field_name, coalesce(strftime(CASE WHEN kind = 'number' THEN make_timestamp(CAST(y AS BIGINT) * CASE n WHEN 10 THEN 1000000 WHEN 13 THEN 1000 ELSE 1 END) WHEN zone <> '' THEN w - to_minutes(minutes)
  WHEN (u AT TIME ZONE z) = w AND NOT ({others}) THEN u AT TIME ZONE 'UTC' END, '%Y-%m-%d %H:%M:%S.%f'), 'undetermined') AS instant_utc FROM b"""


ORACLE = {
    "p4_found": _instants_sql(),
    "p1_found": _P1 + "SELECT DISTINCT ref_table, record_id, ref_key, ref_state FROM faults WHERE ref_state IS NOT NULL",
    "p1_report": _P1
    + """SELECT ref_table, strftime(ref_time AT TIME ZONE 'UTC', '%Y-%m') AS period, ref_state, count(*) AS n_references,
  count(DISTINCT record_id) AS n_records, count(DISTINCT ref_key) AS n_keys
FROM (SELECT ref_table, record_id, ref_key, ref_state, min(ref_time) AS ref_time FROM faults WHERE ref_state IS NOT NULL GROUP BY ALL) GROUP BY 1, 2, 3""",
}
