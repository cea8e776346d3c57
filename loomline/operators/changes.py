"""Upserts, inserts, updates and deletes as table-to-table transforms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomline.runtime import shuffle_width, stage_table

MUTABLE = ["title", "snippet", "published", "search_rank", "collected_at"]


def fold_upserts(log: DataFrame, order: list[str], key: str = "url") -> DataFrame:
    """The state after applying a log of articles by ``key``; keys and titles count (and are stored) without white space around them.

    The first row of a key is inserted and fixes every column but ``MUTABLE``; a later row replaces those if its title differs from
    the current one. A row with an empty title changes the state once and freezes it. So the mutable columns are those of
    the first row of the last run of equal titles up to the first empty title.
    """
    w = Window.partitionBy(key).orderBy(*order)
    strip = lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    rows = log.withColumns({key: strip(key), "title": F.coalesce(strip("title"), F.lit(""))}).where(F.length(key) > 0).withColumn("_t", F.col("title"))
    rows = rows.withColumn("_frozen", F.coalesce(F.max(F.col("_t") == "").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False))).where("NOT _frozen")
    rows = rows.withColumn("_new", F.coalesce(F.col("_t") != F.lag("_t").over(w), F.lit(True)))
    at = F.struct(*order)
    fixed = [c for c in log.columns if c not in MUTABLE and c != key]
    moving = [c for c in log.columns if c in MUTABLE]
    out = rows.groupBy(key).agg(F.min_by(F.struct(*fixed), at).alias("_f"), F.max_by(F.struct(*moving), F.when(F.col("_new"), at)).alias("_m"))
    return out.select(*(F.col("_f")[c].alias(c) if c in fixed else F.col("_m")[c].alias(c) if c in moving else F.col(c) for c in log.columns))


def insert_absent(target: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``target`` and the rows of ``new`` whose key it lacks; within ``new`` keys must be unique."""
    return target.unionByName(new.join(target.select(key), key, "left_anti"), allowMissingColumns=True)


def update_by_id(target: DataFrame, updates: DataFrame, columns: list[str], position: str = "pos", status: str | None = None) -> DataFrame:
    """Sets ``columns`` from the last update of each id; ``status`` goes to ``process_status`` of the updated rows."""
    last = updates.groupBy("id").agg(F.max_by(F.struct(*columns), position).alias("_u"))
    joined = target.join(last, "id", "left")
    hit = F.col("_u").isNotNull()
    out = joined.withColumns({c: F.when(hit, F.col("_u")[c]).otherwise(F.col(c)) for c in columns})
    if status:
        out = out.withColumn("process_status", F.when(hit, status).otherwise(F.col("process_status")))
    return out.select(*target.columns)


def delete_ids(target: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    return target.join(ids.select(key).distinct(), key, "left_anti")


def delete_dropped(raw: DataFrame, processed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows labelled DROP by the run before leave both tables."""
    dropped = processed.where("llm_decision = 'DROP'")
    return raw.join(dropped.select(F.col("ref_raw_id").alias("id")).distinct(), "id", "left_anti"), delete_ids(processed, dropped)


def with_ids(df: DataFrame, order: list[str | Column], start: int = 0, column: str = "id") -> DataFrame:
    """Consecutive ids in ``order``, above ``start``: ranks within range partitions plus the counts before them, no single sorted task."""
    # staged: both branches below must see the same partitions
    laid = stage_table(df.repartitionByRange(shuffle_width(df.sparkSession, df), *order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id()).withColumn("_m", F.monotonically_increasing_id()), "ids")
    counts = laid.groupBy("_p").agg(F.count("*").alias("_n"), F.min("_m").alias("_first"))
    before = counts.select("_p", "_first", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
    return laid.join(F.broadcast(before), "_p").withColumn(column, F.col("_m") - F.col("_first") + F.col("_b") + 1 + start).drop("_p", "_m", "_first", "_b")
