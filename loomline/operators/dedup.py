"""Exact deduplication and representatives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomline.functions.text import normalise_title, source_tier
from loomline.functions.url import url_key


def first_by(df: DataFrame, key: Column, *order: Column) -> DataFrame:
    """The first row of each key; rows with a NULL key are all kept. Spark stops each group at its first row before the shuffle."""
    keyed = df.withColumn("_key", key)
    ranked = keyed.where("_key IS NOT NULL").withColumn("_rn", F.row_number().over(Window.partitionBy("_key").orderBy(*order))).where("_rn = 1")
    return ranked.drop("_rn").unionByName(keyed.where("_key IS NULL")).drop("_key")


def dedup_urls(df: DataFrame, id_column: str = "id") -> DataFrame:
    """One row per address (without query and fragment), the smallest id; rows without address stay."""
    return first_by(df, F.nullif(url_key("url"), F.lit("")), F.col(id_column))


def dedup_titles(df: DataFrame, id_column: str = "id") -> DataFrame:
    return first_by(df, F.nullif(normalise_title("title"), F.lit("")), F.col(id_column))


def _named(df: DataFrame) -> DataFrame:
    named = df.withColumn("publisher", F.coalesce(F.nullif("publisher", F.lit("")), "source")).withColumn("norm_title", normalise_title("title"))
    return named.where("norm_title IS NOT NULL AND norm_title != ''")


def representatives(df: DataFrame) -> DataFrame:
    """``norm_title, id, title, publisher, weight, sources`` for ``id, title, publisher, source``.

    One row per normalised title: best tier of the publisher, then the longest title, then the smallest id. weight is the number of
    members, sources the different ones; groups are combined before the shuffle and never listed, so a title may hold any part of the
    rows (``removed_to_kept`` has the members as rows). Blank titles form no group. The publisher falls back to the source where it is NULL or empty.
    """
    best = F.min_by(F.struct("id", "title", "publisher"), F.struct(source_tier("publisher").alias("tier"), (-F.length("title")).alias("len"), F.col("id").alias("low")))
    return _named(df).groupBy("norm_title").agg(best.alias("best"), F.count("*").alias("weight"), F.array_sort(F.collect_set("source")).alias("sources")).select("norm_title", "best.*", "weight", "sources")


def removed_to_kept(df: DataFrame) -> DataFrame:
    """``removed_id, kept_id``: every member of a title group but its representative."""
    kept = representatives(df).where("weight > 1").select("norm_title", F.col("id").alias("kept_id"))
    return _named(df).select("norm_title", F.col("id").alias("removed_id")).join(kept, "norm_title").where("removed_id != kept_id").select("removed_id", "kept_id")


def unprocessed(raw: DataFrame, processed: DataFrame) -> DataFrame:
    """Raw rows that no processed row refers to."""
    return raw.join(processed.select(F.col("ref_raw_id").alias("id")), "id", "left_anti")


def fresh_groups(raw: DataFrame, processed: DataFrame) -> DataFrame:
    """Rows of title groups none of whose members is processed."""
    keyed = raw.withColumn("norm_title", normalise_title("title"))
    done = keyed.join(processed.select(F.col("ref_raw_id").alias("id")).distinct(), "id", "left_semi").select("norm_title").distinct()
    return keyed.join(done, "norm_title", "left_anti")


def dedup_stats(df: DataFrame) -> DataFrame:
    """One row: ``total, n_groups, removed, removed_pct``; the rate is 0 for an empty table."""
    groups = df.withColumn("norm_title", normalise_title("title")).where("norm_title != ''").groupBy("norm_title").agg(F.count("*").alias("n"))
    s = groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count("*").alias("n_groups"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("removed"))
    return s.withColumn("removed_pct", F.round(F.coalesce(F.try_divide(F.col("removed") * 100.0, "total"), F.lit(0.0)), 4))
