"""Registered queries of the text operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.llm.batches import FingerprintStore, admit
from loomline.llm.format_dups import collapse, headline_groups
from loomline.llm.garbled import garbled_fields
from loomline.llm.mixing import astray, mix, share_report, stock
from loomline.llm.near_dups import near_duplicate_groups, near_duplicate_pairs
from loomline.llm.packing import fill_report, pack
from loomline.llm.subjects import calibration, composition, document_subjects, mine_terms
from loomline.llm.survivors import resolve, retained_values, survivors
from loomline.llm.tokens import count_tokens
from loomline.runtime import stage_table


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _story():
    return F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("snippet", F.lit("")))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return garbled_fields(_table(spark, d, "raw_news"), ["title", "snippet"]).select("id", "field_name")


def p2_repaired(spark: SparkSession, d: str) -> DataFrame:
    return garbled_fields(_table(spark, d, "raw_news"), ["title", "snippet"])


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return headline_groups(_table(spark, d, "raw_news")).where("id > first_id").select("first_id", "id")


def p3_copies(spark: SparkSession, d: str) -> DataFrame:
    return collapse(_table(spark, d, "raw_news"))


def _admitted(spark: SparkSession, d: str, cuts: list) -> DataFrame:
    """Rows listed when the batches after each of ``cuts`` (times, ascending) are admitted together, the first ones as an initial load."""
    raw = _table(spark, d, "raw_news").select("id", "created_at", "url", "title")
    store, listed, after = FingerprintStore(spark), [], None
    for cut in [*cuts, None]:
        part = raw if after is None else raw.where(F.col("created_at") > F.lit(after))
        if cut is not None:
            part = part.where(F.col("created_at").isNull() | (F.col("created_at") <= F.lit(cut)) if after is None else F.col("created_at") <= F.lit(cut))
        listed.append(admit(store, part).where("state = 'known'").select("id"))
        after = cut
    return reduce(DataFrame.unionByName, listed)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """The first half of the batches is the initial load, the rest is admitted against the store."""
    first, last = _table(spark, d, "raw_news").agg(F.min("created_at"), F.max("created_at")).first()
    return _admitted(spark, d, [first + (last - first) / 2] if first else [])


#: Batches that ``p5_daily`` admits one by one.
DAYS = 10


def p5_daily(spark: SparkSession, d: str) -> DataFrame:
    """The same rows, as a daily run finds them: all but the newest batches as the initial load, each of those on its own."""
    days = _table(spark, d, "raw_news").where("created_at IS NOT NULL").groupBy("created_at").count().orderBy(F.desc("created_at")).limit(DAYS + 1).collect()
    return _admitted(spark, d, sorted(r["created_at"] for r in days)[:-1])


#: Collectors claim titles and publishers, publishers claim the collector.
_CLAIMANTS = {"title": "source", "source": "publisher", "publisher": "source"}
_FIELDS = list(_CLAIMANTS)


def _resolved(spark: SparkSession, d: str) -> DataFrame:
    raw = _table(spark, d, "raw_news")
    return resolve(raw, headline_groups(raw), _CLAIMANTS)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _resolved(spark, d).where("best AND n_values > 1").select("first_id", "field_name")


def p6_survivors(spark: SparkSession, d: str) -> DataFrame:
    return survivors(_resolved(spark, d), _FIELDS)


def p6_values(spark: SparkSession, d: str) -> DataFrame:
    return retained_values(_resolved(spark, d))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicate_pairs(_table(spark, d, "raw_news"), "id", _story())


def p7_groups(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicate_groups(_table(spark, d, "raw_news"), "id", _story())


def _packed(spark: SparkSession, d: str, capacity: int) -> DataFrame:
    return pack(stage_table(count_tokens(_table(spark, d, "documents"), ["doc_id"]), "sizes"), capacity)


def p8_pack_2048(spark: SparkSession, d: str) -> DataFrame:
    return _packed(spark, d, 2048)


def p8_pack_8192(spark: SparkSession, d: str) -> DataFrame:
    return _packed(spark, d, 8192)


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    sizes = stage_table(count_tokens(_table(spark, d, "documents"), ["doc_id"]), "sizes")
    return fill_report(pack(sizes, 2048), 2048).unionByName(fill_report(pack(sizes, 8192), 8192))


def p8_faults(spark: SparkSession, d: str) -> DataFrame:
    """What may not be, counted for both capacities: containers over it, documents split that fit, documents with tokens in no container."""
    sizes, out = stage_table(count_tokens(_table(spark, d, "documents"), ["doc_id"]), "sizes"), []
    for capacity in (2048, 8192):
        packed = stage_table(pack(sizes, capacity), "packed")
        over = packed.where("bin_id IS NOT NULL").groupBy("bin_id").agg(F.sum("n_tokens").alias("n")).agg(F.count_if(F.col("n") > capacity).alias("n_overfull"))
        per = packed.where("bin_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("pieces"), F.sum("n_tokens").alias("placed"))
        faults = sizes.join(per, "doc_id", "left").agg(F.count("*").alias("n_documents"), F.count_if((F.col("n_tokens") <= capacity) & (F.col("pieces") > 1)).alias("n_split"), F.count_if((F.col("n_tokens") > 0) & (F.coalesce("placed", F.lit(0)) != F.col("n_tokens"))).alias("n_unplaced"))
        out.append(over.join(F.broadcast(faults)).select(F.lit(capacity).alias("capacity"), "n_documents", "n_overfull", "n_split", "n_unplaced"))  # one row each
    return out[0].unionByName(out[1])


def _sizes(spark: SparkSession, d: str) -> DataFrame:
    return stage_table(count_tokens(_table(spark, d, "documents"), ["doc_id", "source"]), "sizes")


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    """Volume comes first: as many tokens as the target sources have; small sources are repeated as often as they may be, then fall short."""
    sizes, targets = _sizes(spark, d), _table(spark, d, "mix_targets")
    return mix(sizes, targets, stock(sizes, targets))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    sizes, targets = _sizes(spark, d), _table(spark, d, "mix_targets")
    return share_report(mix(sizes, targets, stock(sizes, targets)), sizes, targets)


def p9_faults(spark: SparkSession, d: str) -> DataFrame:
    """What may not be, counted for each source: documents used too often, and blocks of which a source is more than one block ahead or behind its share."""
    sizes, targets = _sizes(spark, d), _table(spark, d, "mix_targets")
    mixed = stage_table(mix(sizes, targets, stock(sizes, targets)), "mixed")
    over = mixed.groupBy("source", "doc_id").agg(F.count("*").alias("uses")).join(targets.select("source", "max_repeats"), "source").where("uses > max_repeats").groupBy("source").agg(F.count("*").alias("n_overused"))
    return targets.select("source").join(over, "source", "left").join(astray(mixed), "source", "left").select("source", F.coalesce("n_overused", F.lit(0)).alias("n_overused"), F.coalesce("n_astray", F.lit(0)).alias("n_astray"))


def p9_mix_by_share(spark: SparkSession, d: str) -> DataFrame:
    """Shares come first: the total is the largest at which every source with documents reaches its target."""
    return mix(_sizes(spark, d), _table(spark, d, "mix_targets"))


def p9_shares_by_share(spark: SparkSession, d: str) -> DataFrame:
    sizes, targets = _sizes(spark, d), _table(spark, d, "mix_targets")
    return share_report(mix(sizes, targets), sizes, targets)


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return document_subjects(_table(spark, d, "documents")).select("doc_id", "subject")


def p10_composition(spark: SparkSession, d: str) -> DataFrame:
    documents = _table(spark, d, "documents")
    return composition(documents, document_subjects(documents))


def p10_calibration(spark: SparkSession, d: str) -> DataFrame:
    return calibration(_table(spark, d, "documents"), _table(spark, d, "doc_labels"))


def p10_mined(spark: SparkSession, d: str) -> DataFrame:
    """Calibration with terms mined anew from the fitted half of the labels: what the whole procedure gives without the curated table."""
    documents, labels = _table(spark, d, "documents"), _table(spark, d, "doc_labels")
    return calibration(documents, labels, source=mine_terms(documents, labels))


QUERIES = {
    "p2_found": p2_found,
    "p2_repaired": p2_repaired,
    "p3_found": p3_found,
    "p3_copies": p3_copies,
    "p5_found": p5_found,
    "p5_daily": p5_daily,
    "p6_found": p6_found,
    "p6_survivors": p6_survivors,
    "p6_values": p6_values,
    "p7_found": p7_found,
    "p7_groups": p7_groups,
    "p8_pack_2048": p8_pack_2048,
    "p8_pack_8192": p8_pack_8192,
    "p8_fill": p8_fill,
    "p8_faults": p8_faults,
    "p9_mix": p9_mix,
    "p9_shares": p9_shares,
    "p9_shares_by_volume": p9_shares,
    "p9_faults": p9_faults,
    "p9_mix_by_share": p9_mix_by_share,
    "p9_shares_by_share": p9_shares_by_share,
    "p10_found": p10_found,
    "p10_composition": p10_composition,
    "p10_calibration": p10_calibration,
    "p10_mined": p10_mined,
}

_SPACE = r"[\s\x0B\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
# RE2 has no look-around: a second pass takes the dashes whose white space the first has used
_DASH = f"'({_SPACE})[-–—]({_SPACE})', '\\1|\\2', 'g'"
_HEADLINES = f"""
keyed AS (
  SELECT *, list_sort(list_filter(list_transform(string_split(replace(regexp_replace(regexp_replace(title, {_DASH}), {_DASH}), '·', '|'), '|'),
    lambda x: lower(regexp_replace(x, '[^\\p{{L}}\\p{{N}}]+', '', 'g'))), lambda x: x <> '')) AS pieces FROM raw_news
), runs AS (SELECT *, min(id) OVER (PARTITION BY pieces) AS first_id, count(*) OVER (PARTITION BY pieces) AS n FROM keyed WHERE len(pieces) > 0)"""
# batch after batch: the recursion carries the accepted ids
_ADDRESS = f"""
parts AS (SELECT id, title, created_at, CASE WHEN contains(url, '://') THEN regexp_replace(regexp_replace(url, '^(?s:.*?)://', ''), '(?s:#.*)$', '') END AS rest FROM raw_news),
cut AS (SELECT id, title, created_at, rest, regexp_extract(rest, '^([^?]*)', 1) AS place, CASE WHEN contains(rest, '?') THEN substr(rest, strpos(rest, '?') + 1) ELSE '' END AS query FROM parts),
addr AS (SELECT id, title, created_at, CASE WHEN rest IS NOT NULL THEN regexp_replace(regexp_replace(lower(regexp_extract(place, '^([^/]*)', 1)), '^www\\.', ''), ':(80|443)$', '')
  || regexp_replace(substr(place, length(regexp_extract(place, '^([^/]*)', 1)) + 1), '/$', '') || '?'
  || array_to_string(list_sort(list_filter(string_split(query, '&'), lambda q: list_contains(['article_id', 'office_id', 'idxno', 'id', 'no', 'seq'], regexp_extract(q, '^([^=]*)', 1)))), '&') END AS u FROM cut)"""
_BATCHES = f"""
WITH RECURSIVE {_ADDRESS},
r AS (SELECT id, u, dense_rank() OVER (ORDER BY created_at) AS b, list_distinct(list_transform(regexp_extract_all(title, '[\\p{{L}}\\p{{N}}]+'), lambda x: lower(x))) AS ws FROM addr WHERE created_at IS NOT NULL),
tok AS (SELECT id, b, len(ws) AS n, unnest(ws) AS w FROM r),
shared AS (SELECT y.id, x.id AS old, any_value(x.n) + any_value(y.n) AS t, count(*) AS c FROM tok x JOIN tok y ON x.w = y.w AND x.b < y.b GROUP BY ALL),
hits AS (SELECT id, old FROM shared WHERE c >= 0.8 * (t - c) - 1e-9 UNION SELECT y.id, x.id FROM r x JOIN r y ON x.u = y.u AND x.b < y.b),
m AS (SELECT id, list(old) AS olds FROM hits GROUP BY id),
days AS (SELECT b, list({{'id': r.id, 'olds': coalesce(m.olds, [])}}) AS items FROM r LEFT JOIN m ON m.id = r.id GROUP BY b),
walk AS (
  SELECT CAST(0 AS BIGINT) AS b, CAST([] AS BIGINT[]) AS ok
  UNION ALL SELECT days.b, list_concat(walk.ok, list_transform(list_filter(days.items, lambda i: NOT list_has_any(i.olds, walk.ok)), lambda i: i.id)) FROM walk JOIN days ON days.b = walk.b + 1
), fine AS (SELECT unnest(ok) AS id FROM walk WHERE b = (SELECT max(b) FROM days))
SELECT id FROM r WHERE id NOT IN (SELECT id FROM fine)"""
_DIFFER = " UNION ALL ".join(
    f"SELECT first_id, '{f}' AS field_name FROM runs WHERE n > 1 GROUP BY first_id HAVING count(DISTINCT CASE WHEN {f} IS NULL OR regexp_matches({f}, '^{_SPACE}*$') THEN '' ELSE {f} END) > 1" for f in _FIELDS
)

# every pair that shares a word, whatever the word: no prefix rule as the operator has one
_SIMILAR = """
s AS (SELECT id, list_distinct(list_transform(regexp_extract_all(coalesce(title, '') || ' ' || coalesce(snippet, ''), '[\\p{L}\\p{N}]+'), lambda x: lower(x))) AS ws FROM raw_news),
tok AS (SELECT id, len(ws) AS n, unnest(ws) AS w FROM s),
pairs AS (SELECT a.id AS id_a, b.id AS id_b FROM tok a JOIN tok b ON a.w = b.w AND a.id < b.id AND a.n >= 0.65 * b.n - 1e-9 AND b.n >= 0.65 * a.n - 1e-9 GROUP BY a.id, b.id, a.n, b.n HAVING count(*) >= 0.65 * (a.n + b.n - count(*)) - 1e-9)"""

ORACLE: dict[str, str] = {
    "p3_found": f"WITH {_HEADLINES} SELECT first_id, id FROM runs WHERE id > first_id",
    "p3_copies": f"WITH {_HEADLINES} SELECT id, title, n AS n_copies FROM runs WHERE id = first_id",
    "p5_found": _BATCHES,
    "p5_daily": _BATCHES,
    "p6_found": f"WITH {_HEADLINES} {_DIFFER}",
    "p7_found": f"WITH {_SIMILAR} SELECT id_a, id_b FROM pairs",
    "p7_groups": f"""
WITH RECURSIVE {_SIMILAR}, c AS (SELECT id, CASE WHEN len(ws) = 0 THEN id ELSE min(id) OVER (PARTITION BY list_sort(ws)) END AS class_id FROM s),
e AS (SELECT DISTINCT a.class_id AS x, b.class_id AS y FROM pairs JOIN c a ON a.id = id_a JOIN c b ON b.id = id_b WHERE a.class_id <> b.class_id),
l AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
walk AS (SELECT x AS a, y AS b FROM l UNION SELECT walk.a, l.y FROM walk JOIN l ON l.x = walk.b),
g AS (SELECT a, min(least(a, b)) AS group_id FROM walk GROUP BY 1), n AS (SELECT x, count(*) AS n FROM l GROUP BY 1)
SELECT c.id, c.class_id, coalesce(g.group_id, c.class_id) AS group_id, coalesce(n.n, 0) AS n_links FROM c LEFT JOIN g ON g.a = c.class_id LEFT JOIN n ON n.x = c.class_id""",
    "p8_faults": "SELECT 2048 AS capacity, count(*) AS n_documents, CAST(0 AS BIGINT) AS n_overfull, CAST(0 AS BIGINT) AS n_split, CAST(0 AS BIGINT) AS n_unplaced FROM documents UNION ALL SELECT 8192, count(*), 0, 0, 0 FROM documents",
    "p9_faults": "SELECT source, CAST(0 AS BIGINT) AS n_overused, CAST(0 AS BIGINT) AS n_astray FROM mix_targets",
}
